"""Documents every operator must bear: nulls, empty, long, alike, clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts() -> list[str | None]:
    chance = random.Random(7)
    letters = "ab's tlrevmd \n\t 1٣é!?<|🙂 　'#%"
    mixed = ["".join(chance.choice(letters) for _ in range(chance.randrange(1, 60))) for _ in range(150)]
    words = ["the", "of", "Köln", "don't", "x²", "naïve,", "they've", "ΣΑΣ", "é"]
    return [
        None,
        "",
        " ",
        "\n\n\n",
        "x<|endoftext|>\n y a  <|endoftext|>",
        "<|startoftext|> plain <|endoftext|>",
        "a\x1c b \x1c c d e",
        "word " * 3000,
        "z" * 5000,
        " ".join(chance.choice(words) for _ in range(4000)),
        *mixed,
        *mixed[:20],
    ]


def rows() -> list[tuple]:
    """Texts with ids; an id that comes twice, a null id, a row that comes twice."""
    made = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts())]
    return [*made, (5, "another text", "de", None, 12), (None, "no id", None, "s", 5), made[9], made[0]]


def frame(spark, parts: int = 3):
    return spark.createDataFrame(rows(), SCHEMA).repartition(parts)


def clashing(docs, names):
    """The documents with more columns, named like those an operator makes."""
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit("other").alias(n) for n in names])
