"""Operators that turn texts into ids, against the libraries."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import edges
import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillwarden.llm import byte_bpe, library_ids, packing, queries, token_count, token_files
from tillwarden.llm.common import ready

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE)


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def rank_library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def ids_of(library, text, end=()):
    return [*library.encode(text, add_special_tokens=False).ids, *end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1_counts_as_the_library_does(spark, documents, byte_library):
    got = queries.QUERIES["op1_token_counts"](spark, SMALL).collect()
    assert len(got) == len(documents)
    texts = dict(documents)
    for r in got:
        text = texts[r.doc_id]
        assert r.n_tokens == len(ids_of(byte_library, text))
        assert r.n_bytes == len(text.encode())
        assert r.over_limit == (r.n_tokens > 512)


def test_op1_edges(spark, byte_library):
    docs = edges.clashing(edges.frame(ready(spark)), ["n_tokens", "n_bytes", "ids"])
    got = token_count.token_counts(docs, BYTE).collect()
    want = Counter((r[0], len((r[1] or "").encode()), len(ids_of(byte_library, r[1] or ""))) for r in edges.rows())
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert token_count.token_counts(docs.limit(0), BYTE).count() == 0


def test_op1_merges_equal_ranks_from_the_left():
    ranks, made = {1 << 32 | 1: 0}, [2]
    assert token_count.merged_length([1, 1, 1], ranks, made) == 2
    assert token_count.merged_length([], ranks, made) == 0


def test_op3_is_the_library_s_and_comes_back(spark, documents, rank_library):
    got = {r.doc_id: r for r in queries.QUERIES["op3_byte_bpe"](spark, SMALL).collect()}
    assert len(got) == len(documents)
    for doc_id, text in documents:
        ids = np.array(rank_library.encode_ordinary(text), "<u4")
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_op3_edges(spark, rank_library):
    docs = edges.clashing(edges.frame(ready(spark)), ["ids", "decoded"])
    got = byte_bpe.decode(byte_bpe.encode(docs, RANKS), RANKS).collect()
    want = Counter(
        (r[0], np.array(rank_library.encode_ordinary(r[1] or ""), "<u4").tobytes(), (r[1] or "").encode())
        for r in edges.rows()
    )
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got) == want
    assert byte_bpe.encode(docs.limit(0), RANKS).count() == 0


def test_op3_boundaries_are_the_pattern_s():
    coder = byte_bpe.rank_coder(RANKS)
    texts = [t or "" for t in edges.texts()]
    ids, ends = coder.encode(texts)
    for text, i, e in zip(texts, ids, ends, strict=True):
        pieces = regex.findall(public_tokenizers.PATTERN, text)
        assert len(np.frombuffer(e, "<u4")) == len(pieces)
        assert [p.decode() for p in coder.decode(i, e)] == pieces
    with pytest.raises(ValueError):
        coder.decode(ids[-1], ends[-1][:-4])


def test_library_ids_of_words_are_those_of_texts(byte_library, word_library):
    texts = [t or "" for t in edges.texts()]
    for path, library, rule in ((BYTE, byte_library, "joined"), (WORD, word_library, "dropped")):
        encoder = library_ids.LibraryIds(path)
        assert encoder.rule == rule
        for _ in range(2):
            assert [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(texts)] == [
                ids_of(library, t) for t in texts
            ]


# What the cuts of library_ids tell apart: classes of plain characters, spaces of all kinds, and what is neither.
BITS = "a b the The É ß ÿ Ÿ µ ª 0 12 . , ' 's \" ( ) ~ ` { [ \\ ] ^ _ @ / - & ing tion e\u0301 İ ſ Σ × ÷ 中 १ “ … <|endoftext|>".split()
BITS += ["\n", "\n\n", " ", "  ", " ", "\t", "\r", "\x00", "\x1c", "\u00a0", "\u0085", "\u2028", "\u2009", "\u3000", "\u1680", "🙂"]


@pytest.mark.parametrize("bits", [BITS, BITS[:33] + ["\n", " ", " ", "'"]])
def test_library_ids_of_random_texts(byte_library, word_library, bits):
    chance = edges.random.Random(11)
    texts = ["".join(chance.choice(bits) for _ in range(chance.randrange(40))) for _ in range(6000)]
    for path, library in ((BYTE, byte_library), (WORD, word_library)):
        encoder = library_ids.LibraryIds(path)
        want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
        got = [np.frombuffer(i, "<u4").tolist() for a in range(0, 6000, 500) for i in encoder.encode(texts[a : a + 500])]
        assert got == want


def test_library_ids_forget_pieces_not_answers(monkeypatch, byte_library):
    monkeypatch.setattr(library_ids, "PIECES_KEPT", 50)
    monkeypatch.setattr(library_ids, "LONGEST_KEPT", 4)
    monkeypatch.setattr(library_ids, "PIECES_ASKED", 7)
    encoder, texts = library_ids.LibraryIds(BYTE), [t or "" for t in edges.texts()]
    for _ in range(2):
        for a in range(0, len(texts), 9):
            got = [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(texts[a : a + 9])]
            assert got == [ids_of(byte_library, t) for t in texts[a : a + 9]]
    assert encoder.encode([]) == [] and encoder.encode(["", ""]) == [b"", b""]


def test_op5_files_give_back_every_document(spark, documents, word_library):
    got = queries.QUERIES["op5_token_files"](spark, SMALL).collect()
    before, want = 0, set()
    for doc_id, text in sorted(documents):
        ids = ids_of(word_library, text, [1])
        want.add((doc_id, before, len(ids), crc(ids)))
        before += len(ids)
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_op5_edges_and_pruning(spark, tmp_path, word_library):
    docs = edges.clashing(edges.frame(ready(spark)), ["ids", "part", "start", "tie", "seat"])
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(docs, WORD, folder)
    read = token_files.read_tokens(spark, folder)
    got = sorted(read.collect(), key=lambda r: r.start)
    keys = [(r.doc_id is not None, r.doc_id) for r in got]
    assert keys == sorted(keys, key=lambda k: (k[0], k[1] or 0))
    starts = np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    assert [r.start for r in got] == starts
    want = Counter((r[0], tuple(ids_of(word_library, r[1] or "", [1]))) for r in edges.rows())
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    plan = read.where("doc_id = 7")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,7)" in plan
    empty = str(tmp_path / "empty")
    token_files.write_tokens(docs.limit(0), WORD, empty)
    assert token_files.read_tokens(spark, empty).count() == 0


def check_pieces(rows, want, limits=packing.Limits()):
    """Pieces cover each document once and lie gapless in sequences within the limits."""
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert ids
        documents[r.doc_id].append((r.start, ids, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, len(ids)))
    for doc_id, ids in want.items():
        joined = []
        for start, piece, total in sorted(documents.pop(doc_id)):
            assert start == len(joined) and total == len(ids)
            joined += piece
        assert joined == ids
    assert not documents
    padding = 0
    for pieces in sequences.values():
        total = 0
        for offset, size in sorted(pieces):
            assert offset == total
            total += size
        assert total <= limits.tokens and len(pieces) <= limits.segments
        if total & (total - 1):
            padding += limits.tokens - total
    return padding, sum(map(len, want.values()))


def test_op8_places_every_id_once_with_little_padding(spark, documents, byte_library):
    docs = ready(spark).read.parquet(f"{SMALL}/documents.parquet")
    want = {d: ids_of(byte_library, t, [0]) for d, t in documents}
    padding, total = check_pieces(packing.pack(docs, BYTE).collect(), want)
    assert padding <= total / 1000
    got = queries.QUERIES["op8_packing"](spark, SMALL)
    assert got.agg(F.sum("length")).first()[0] == total
    first = got.where("start = 0 and length = doc_tokens").limit(20).collect()
    assert first and all(r.ids_crc32 == crc(want[r.doc_id]) for r in first)


def plain_fill(documents, limits):
    """Sequences a packer needs that takes examples in order, whole, and opens a sequence when one does not fit."""
    made = 1
    tokens = loss = segments = 0
    for size, bears in documents:
        while size:
            room = min(limits.tokens - tokens, size - bears + limits.loss_tokens - loss)
            if segments == limits.segments or (size > room and tokens) or room <= 0:
                made, tokens, loss, segments = made + 1, 0, 0, 0
                continue
            take = min(size, room)
            held = max(0, take - (size - bears))
            tokens, loss, segments = tokens + take, loss + held, segments + 1
            size, bears = size - take, bears - held
    return made


@pytest.mark.parametrize(
    ("limits", "most"),
    [
        (packing.Limits(loss_tokens=512), 0.001),
        (packing.Limits(256, 128, 128), 0.001),
        # The smallest pieces come last, and then the limit of segments closes sequences.
        (packing.Limits(1024, 60, 640), 0.005),
    ],
)
def test_op8_masked_examples(spark, byte_library, limits, most):
    """Instruction data: prompts bear no loss; all limits hold, nearly no padding, fewer sequences than in order."""
    chance, rows = edges.random.Random(4), []
    for i in range(3000):
        words = chance.choice([20, 60, 150, 400])
        text = " ".join(chance.choice(["the", "answer", "is", "42,", "Köln", "naïve"]) for _ in range(chance.randrange(1, words)))
        size = len(ids_of(byte_library, text)) + 1
        rows.append((i, text, chance.choice([None, -3, size + 9, size // 2, int(size * 0.8), size])))
    docs = ready(spark).createDataFrame(rows, "doc_id long, text string, prompt long").repartition(1)
    got = packing.pack(docs, BYTE, limits=limits, free="prompt").collect()
    want = {d: ids_of(byte_library, t, [0]) for d, t, _ in rows}
    padding, total = check_pieces(got, want, limits)
    loss, free = Counter(), {d: min(max(p or 0, 0), len(want[d])) for d, _, p in rows}
    for r in got:
        end = r.start + len(r.ids) // 4
        assert r.loss_tokens == max(0, end - max(r.start, free[r.doc_id]))
        loss[r.sequence_id] += r.loss_tokens
    assert max(loss.values()) <= limits.loss_tokens
    assert padding <= total * most
    assert len(loss) < plain_fill([(len(i), len(i) - free[d]) for d, i in want.items()], limits)


def test_op8_takes_the_largest_dot_product():
    """With much room for loss and little for tokens the piece that bears more loss goes first, and the other way."""
    packer = packing.Packer(packing.Limits(tokens=100, segments=10, loss_tokens=100))
    sizes, losses = np.array([40, 38]), np.array([2, 38])
    assert packer._best(sizes, losses, 100, 10, 100) == 1
    assert packer._best(sizes, losses, 100, 10, 38) == 1
    assert packer._best(sizes, losses, 100, 10, 2) == 0
    assert packer._best(np.array([60, 20]), np.array([0, 20]), 50, 10, 30) == 1
    # None fits: the cut that fills most of the room; without any, nothing.
    assert packer._best(np.array([80, 90]), np.array([80, 10]), 50, 10, 5) == 1
    assert packer._best(np.array([80, 90]), np.array([80, 90]), 50, 10, 0) is None


def test_op8_edges(spark, byte_library):
    rows = [(i, r[1]) for i, r in enumerate(edges.rows())] + [(10_000 + i, None) for i in range(700)]
    docs = ready(spark).createDataFrame(rows, "doc_id long, text string").repartition(2)
    docs = edges.clashing(docs, ["ids", "offset", "start"])
    want = {d: ids_of(byte_library, t or "", [0]) for d, t in rows}
    for limits in (packing.Limits(), packing.Limits(segments=3), packing.Limits(loss_tokens=64)):
        check_pieces(packing.pack(docs, BYTE, limits=limits).collect(), want, limits)
    assert packing.pack(docs.limit(0), BYTE).count() == 0
    null_id = spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string")
    assert [r.doc_id for r in packing.pack(null_id, BYTE).collect()] == [None, None]
