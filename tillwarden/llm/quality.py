"""Quality classifier: hashed word and character n-gram vectors, averaged, softmax, trained by SGD.

Each word stands for its own bucket and those of its character n-grams; a word
that follows itself is a pair with a bucket of its own. A text is the mean of the vectors of all its words' buckets; two outputs and a softmax
say how likely label 1 is. Vectors and outputs are learned together, by plain
stochastic gradient descent in numpy, from a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import islice
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwarden.llm.common import Memo, texts_of
from tillwarden.operators.lookup import stage

WORDS_KEPT = 300_000
# A text spreads one step over thousands of buckets; this makes up for it.
WORD_RATE = 20.0
# Buckets of a longer word are counted in numpy, so many grams at a time.
LONG, GRAMS = 4096, 1 << 16
END = 0  # the bucket every text has once, so that an empty text has a score
# The bucket of the word pair whose second word repeats the first, and what it counts
# for: about as much as a word with its character n-grams.
AGAIN, AGAIN_COUNTS = 1, 16


@dataclass(frozen=True)
class Training:
    """How the classifier is fitted.

    ``sample`` bounds the labelled rows it learns from: those whose ids have the
    smallest hashes, whatever the number of rows.
    """

    sample: int = 6000
    buckets: int = 1 << 16
    dim: int = 8
    shortest: int = 3
    longest: int = 5
    epochs: int = 6
    rate: float = 0.5
    seed: int = 17


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def buckets_of(word: str, how: Training) -> list[int]:
    """The buckets of a word and of its character n-grams, with its ends marked."""
    usable = how.buckets - 2
    found = [crc32(word.encode()) % usable + 2]
    marked = f"<{word}>"
    for n in range(how.shortest, how.longest + 1):
        for i in range(len(marked) - n + 1):
            found.append(crc32(marked[i : i + n].encode(), n) % usable + 2)
    return found


def bucket_counts(word: str, how: Training) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of :func:`buckets_of`, each once, and how often; for words of any length."""
    usable, marked = how.buckets - 2, f"<{word}>"
    times = np.zeros(how.buckets, np.int64)
    times[crc32(word.encode()) % usable + 2] += 1
    for n in range(how.shortest, how.longest + 1):
        many = len(marked) - n + 1
        for start in range(0, many, GRAMS):
            grams = range(start, min(start + GRAMS, many))
            hashes = np.array([crc32(marked[i : i + n].encode(), n) for i in grams], np.int64)
            times += np.bincount(hashes % usable + 2, minlength=how.buckets)
    found = np.flatnonzero(times)
    return found, times[found]


def repeats(words: list[str]) -> int:
    """How often a word follows itself."""
    return sum(map(eq, words, islice(words, 1, None)))


def _features(batches: Iterator[pa.RecordBatch], how: Training) -> Iterator[pa.RecordBatch]:
    known = Memo(partial(buckets_of, how=how), WORDS_KEPT // 10)
    for batch in batches:
        buckets, weights = [], []
        for text in texts_of(batch):
            words = text.split()
            count = Counter({END: 1})
            if again := repeats(words):
                count[AGAIN] = again * AGAIN_COUNTS
            for word, times in Counter(words).items():
                if len(word) > LONG:
                    for b, inside in zip(*(a.tolist() for a in bucket_counts(word, how)), strict=True):
                        count[b] += inside * times
                    continue
                for b in known[word]:
                    count[b] += times
            total = sum(count.values())
            buckets.append(list(count))
            weights.append([c / total for c in count.values()])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("turn"),
                batch.column("quality"),
                pa.array(buckets, pa.list_(pa.int32())),
                pa.array(weights, pa.list_(pa.float32())),
            ],
            names=["turn", "quality", "buckets", "weights"],
        )


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], how: Training) -> np.ndarray:
    """What each bucket adds to the log-odds of label 1.

    The mean and the output layer are linear, so a bucket's vector times the
    difference of the two outputs is all that scoring needs.
    """
    chance = np.random.default_rng(how.seed)
    vectors = chance.uniform(-1 / how.dim, 1 / how.dim, (how.buckets, how.dim))
    outputs = np.zeros((2, how.dim))
    steps, step = how.epochs * len(examples), 0
    for _ in range(how.epochs):
        for i in chance.permutation(len(examples)):
            label, buckets, weights = examples[i]
            rate = how.rate * (1 - step / steps)
            step += 1
            mean = weights @ vectors[buckets]
            odds = outputs @ mean
            share = np.exp(odds - odds.max())
            share /= share.sum()
            share[label] -= 1
            back = share @ outputs
            outputs -= rate * np.outer(share, mean)
            vectors[buckets] -= rate * weights[:, None] * back * WORD_RATE
    return (vectors @ (outputs[1] - outputs[0])).astype(np.float32)


def _train(key: tuple[pa.Scalar, ...], table: pa.Table, how: Training) -> pa.Table:
    # Arrays are views of the table: as Python objects they would be ten times as large.
    table = table.sort_by("turn").combine_chunks()
    labels = table.column("quality").to_pylist()
    lists = [table.column(n).chunk(0) for n in ("buckets", "weights")]
    buckets, weights = (a.values.to_numpy() for a in lists)
    stops = lists[0].offsets.to_numpy()
    examples = [
        (label, buckets[i:j], weights[i:j])
        for label, i, j in zip(labels, stops, stops[1:], strict=False)
    ]
    return pa.table({"weights": pa.array([train(examples, how).tobytes()], pa.binary())})


def fit(docs: DataFrame, labels: DataFrame, folder: str, how: Training = Training()) -> np.ndarray:
    """Learn from labelled rows that are not held out; the weight of each bucket.

    A label of an id that has several is the smallest; rows without a label or an
    id teach nothing. Labels are joined to at most ``how.sample`` ids, so one task
    can hold all examples; texts become buckets in parallel, and are used whole.
    Without any example every weight is 0.
    """
    turn = F.xxhash64("doc_id")
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("quality"))
        .withColumn("turn", turn)
        .orderBy("turn", "doc_id")
        .limit(how.sample)
    )
    known = stage(known, f"{folder}/sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Rows that repeat an id teach once: of their texts the smallest hash counts.
    taught = (
        texts.join(F.broadcast(known), "doc_id")
        .groupBy("doc_id", "turn", "quality")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    )
    examples = taught.select("turn", "quality", "text").mapInArrow(
        partial(_features, how=how), "turn long, quality int, buckets array<int>, weights array<float>"
    )

    def one(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _train(key, table, how)

    together = examples.withColumn("model", F.lit(1)).groupBy("model")
    model = stage(together.applyInArrow(one, "weights binary"), f"{folder}/model")
    row = model.first()
    if row is None:
        return np.zeros(how.buckets, np.float32)
    return np.frombuffer(bytes(row.weights), np.float32)


class Scorer:
    def __init__(self, weights: np.ndarray, how: Training):
        self.weights, self.how = weights, how
        self.base = complex(float(weights[END]), 1)
        self.again = complex(float(weights[AGAIN]) * AGAIN_COUNTS, AGAIN_COUNTS)
        self.words = Memo(self._word, WORDS_KEPT)

    def _word(self, word: str) -> complex:
        """The sum of a word's weights, and how many they are."""
        if len(word) > LONG:
            found, times = bucket_counts(word, self.how)
            return complex(float(self.weights[found].astype(float) @ times), int(times.sum()))
        buckets = buckets_of(word, self.how)
        return complex(float(self.weights[buckets].sum()), len(buckets))

    def score(self, text: str) -> float:
        words = text.split()
        total = sum(map(self.words.__getitem__, words), self.base)
        total += repeats(words) * self.again
        return float(1 / (1 + np.exp(-np.clip(total.real / total.imag, -30, 30))))


def _score(
    batches: Iterator[pa.RecordBatch], weights: Broadcast, how: Training
) -> Iterator[pa.RecordBatch]:
    score = Scorer(weights.value, how).score
    for batch in batches:
        found = pa.array([score(t) for t in texts_of(batch)], pa.float64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], names=["doc_id", "score"])


def scored(docs: DataFrame, weights: np.ndarray, how: Training = Training()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, by its whole text only.

    No shuffle; the weights (``how.buckets`` numbers) go to every executor. A null
    or empty text is scored by what every text has. Repeated rows are scored each;
    a null id is not held out. No rows give no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(partial(_score, weights=sent, how=how), "doc_id long, score double")
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
