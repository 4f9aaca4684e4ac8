"""Rows that are odd in every way at once, and invented prose."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: Extra columns with names that operators use inside.
CLASHING = "words string, node long, key string, score double, bucket int, piece int, kept string, _id long, host string"
DOC_SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
EXTRA = ("x", 1, "k", 2.0, 3, 4, "yes", 5, "h")


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    """Invented prose: reproducible words in lines."""
    rng = random.Random(seed)
    stems = random.Random(0)
    words = ["".join(stems.choice("bdfklmnprstvz") + stems.choice("aeiou") for _ in range(stems.randint(1, 4)))
             for _ in range(vocabulary)]
    out = [rng.choice(words) for _ in range(n)]
    return "\n".join(" ".join(out[i : i + 12]) for i in range(0, n, 12))


def doc_rows(texts: dict) -> list[tuple]:
    return [(k, t, "en", "s", None if t is None else len(t), *EXTRA) for k, t in texts.items()]


def make_docs(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, DOC_SCHEMA)


def odd_rows() -> list[tuple]:
    long_text = prose(99, 30_000)
    return [
        (1, prose(1, 120), "en", "a", 10, *EXTRA),
        (1, prose(1, 120), "en", "a", 10, *EXTRA),  # a repeated row
        (2, None, None, None, None, *[None] * len(EXTRA)),
        (3, "", "fr", "a", 0, *EXTRA),
        (4, " \t\n\x0b\x0c\r ", "de", "b", 7, *EXTRA),
        (5, long_text, "en", "a", len(long_text), *EXTRA),
        (6, prose(1, 120).upper(), "en", "b", 10, *EXTRA),  # a copy in capitals
        (None, prose(7, 60), "es", "c", 10, *EXTRA),
        (8, "eins zwei\neins zwei\n\n eins zwei\n" + prose(8, 80), "de", "b", 10, *EXTRA),
        (9, "été ÀÉÎ 日本語 \U0001f600 naïve é " * 20, "fr", "b", 10, *EXTRA),
    ]
