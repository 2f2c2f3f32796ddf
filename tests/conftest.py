from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tillwarden.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        4,
        memory="4g",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": shared,
            "spark.sql.warehouse.dir": f"{shared}/warehouse",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def small():
    return SMALL
