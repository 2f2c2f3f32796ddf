"""Versions that are switched in one step, and statistics kept up to date with new rows only."""

from __future__ import annotations

import datetime as dt
import json

import pytest
import samples
from pyspark.sql import functions as F

from tillwarden import schemas
from tillwarden.operators import enrich, ranking
from tillwarden.plans import batch
from tillwarden.plans.statistics import Statistics, merged_totals, stats_of, user_totals
from tillwarden.sources import warehouse
from tillwarden.sources.snapshots import Snapshots

LAYOUT = "a long, b string"


def _rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), LAYOUT)


def _read(table):
    return sorted(map(tuple, table.read(LAYOUT).collect()))


def test_a_version_is_current_only_after_the_switch(spark, tmp_path, monkeypatch):
    table = Snapshots(spark, str(tmp_path / "t"))
    assert table.current() is None and table.read(LAYOUT) is None and table.note() == {}
    table.publish(_rows(spark, (1, "x")), note={"n": 1})

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(Snapshots, "switch", killed)
        with pytest.raises(KeyboardInterrupt):
            table.publish(_rows(spark, (2, "y"), (3, "z")), note={"n": 2})
    assert _read(table) == [(1, "x")] and table.note() == {"n": 1}
    assert len(table.versions()) == 2
    table.publish(_rows(spark, (4, "w")), note={"n": 3})
    assert _read(table) == [(4, "w")] and table.note() == {"n": 3}
    # A reader that began before the switch still has its rows, and the others' rest is gone soon.
    table.publish(_rows(spark), ["b"])
    assert _read(table) == [] and len(table.versions()) == 2


def test_a_reader_keeps_the_version_it_has(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"))
    table.publish(_rows(spark, (1, "x"), (2, "x")))
    held = table.read(LAYOUT)
    table.publish(_rows(spark, (9, "q")), ["b"])
    assert sorted(r.a for r in held.collect()) == [1, 2] and _read(table) == [(9, "q")]
    assert not [n for n in (tmp_path / "t").iterdir() if n.name.startswith("_current-")]


AMOUNTS = [1.5, 2.25, None, 1e17, float("nan"), 3.0, -4.0, 0.1, 0.2, 5000.01, 1e9 + 0.01, 1e9, 1e9 - 0.01]


def _transactions(spark, n, start=0):
    rows = [
        samples.wire_row(f"t{i}", [None, "u1", "u2", f"u{i}"][i % 4], AMOUNTS[i % len(AMOUNTS)], at=samples.clock(i))
        for i in range(start, start + n)
    ]
    return samples.transactions(spark, rows)


def _as_rows(rows, *drop):
    return sorted(map(repr, rows.drop(*drop).collect()))


def test_kept_statistics_equal_those_of_all_rows(spark, tmp_path):
    kept = Statistics(spark, str(tmp_path / "kept"))
    assert kept.user_stats() is None and kept.amount_ranks() is None
    sizes = [40, 1, 25, 60]
    for batch_id, n in enumerate(sizes):
        new = _transactions(spark, n, sum(sizes[:batch_id]))
        kept.add(new, batch_id)
        kept.add(new, batch_id)  # as after a failure
    whole = _transactions(spark, sum(sizes))
    assert _as_rows(kept.user_stats(), "user_amount_stddev") == _as_rows(enrich.user_stats(whole), "user_amount_stddev")
    ranks = ranking.distinct_value_ranks(whole, "amount", "amount_percentile")
    assert _as_rows(kept.amount_ranks()) == _as_rows(ranks)
    assert len(kept.users.versions()) == 2


def test_deviations_are_merged_without_cancellation(spark):
    amounts = [1e9 + d for d in (0.01, 0.02, 0.03, 0.04, 0.05)]
    rows = [spark.createDataFrame([("u", a)], "user_id string, amount double") for a in amounts]
    totals = user_totals(rows[0])
    for more in rows[1:]:
        totals = merged_totals(totals.unionByName(user_totals(more)))
    found = stats_of(totals).first()
    assert abs(found.user_amount_stddev - 0.0158113883) < 1e-6
    one = stats_of(user_totals(rows[0])).first()
    assert one.user_amount_stddev is None and one.user_transaction_count == 1


def _send(folder, number, rows):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps(dict(zip(schemas.TRANSACTION.names, row))) for row in rows]
    (folder / f"{number}.txt").write_text("\n".join(lines) + "\n")


def test_a_second_run_reads_only_new_rows_for_its_statistics(spark, tmp_path, monkeypatch):
    topic, read = tmp_path / "topic", []
    rows = [samples.wire_row(f"t{i}", f"u{i % 3}", float(i), at=samples.clock(i * 50000)) for i in range(20)]
    add = Statistics.add
    monkeypatch.setattr(Statistics, "add", lambda self, new, n: (read.append(new.count()), add(self, new, n))[1])

    def run(day):
        batch.run_batch(
            spark.readStream.text(str(topic)),
            "s_rerun",
            str(tmp_path / "checkpoint"),
            dt.date(2024, 3, 20),
            location=str(tmp_path / "tables"),
            processing_date=day,
        )
        return warehouse.table(spark, "s_rerun", warehouse.PROCESSED)

    _send(topic, 0, rows[:14])
    first = run(dt.date(2024, 3, 18))
    assert first.count() == 14
    _send(topic, 1, rows[14:])
    second = run(dt.date(2024, 3, 19))
    assert read == [14, 6]
    raw = warehouse.table(spark, "s_rerun", warehouse.RAW)
    assert _as_rows(second) == _as_rows(enrich.enrich(raw, dt.date(2024, 3, 19)))
    assert second.count() == 20 and first.count() == 14
    run(None)
    assert read == [14, 6]
    assert spark.table("s_rerun.transactions_processed_current").columns == schemas.PROCESSED.names
    assert spark.table("s_rerun.transactions_processed_current").select("processing_date").distinct().count() > 5


def test_a_run_killed_before_the_switch_leaves_the_old_table(spark, tmp_path, monkeypatch):
    warehouse.create_tables(spark, "s_killed", str(tmp_path / "tables"))
    day = lambda amount, n: enrich.enrich(
        samples.transactions(spark, [samples.wire_row(f"{i}", "u", amount) for i in range(n)])
    )
    warehouse.replace_partitions(day(1.0, 3), "s_killed", warehouse.PROCESSED, whole=True)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(Snapshots, "switch", killed)
        with pytest.raises(KeyboardInterrupt):
            warehouse.replace_partitions(day(2.0, 5), "s_killed", warehouse.PROCESSED, whole=True)
    stored = lambda: warehouse.table(spark, "s_killed", warehouse.PROCESSED)
    assert stored().agg(F.count("*"), F.sum("amount")).first()[:] == (3, 3.0)
    # Dates replaced afterwards are replaced inside the version.
    other = enrich.enrich(samples.transactions(spark, [samples.wire_row("x", "u", 7.0, at="2024-04-01T00:00:00")]))
    warehouse.replace_partitions(other, "s_killed", warehouse.PROCESSED)
    assert stored().agg(F.count("*"), F.sum("amount")).first()[:] == (4, 10.0)
