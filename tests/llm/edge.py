"""Small inputs that every operator must take."""

from __future__ import annotations

from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))

#: (doc_id, text): null, empty and blank texts, a very long one, ties, non-ASCII, odd characters.
ROWS = [
    (1, None),
    (2, ""),
    (3, " \t\n\n "),
    (4, LONG),
    (5, "one two three"),
    (6, "one two three"),
    (7, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (7, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (8, "ÄÖÜ éèà ñandú 漢字 \U0001f600 𝔘𝔫𝔦"),
    (9, "a\x00b \x1c c d"),
    (10, "x" * 5000),
    (None, "a row without an id has words too"),
]


def frame(spark, rows=ROWS, extra=True):
    """The rows with columns whose names clash with what operators add."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        df = df.withColumns({c: F.lit("mine") for c in ("n", "key", "score", "slot", "shard", "n_words", "spans", "t", "h", "lang", "marks", "grow", "marked_lines")})
    return df.withColumn("source", F.lit(None).cast("string"))


def empty(spark):
    return frame(spark).where("doc_id > 1000")
