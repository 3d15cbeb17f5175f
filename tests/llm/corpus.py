"""Small awkward documents: nulls, blanks, ties, repeated rows, long and odd texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, hash long, n string, start long, cell long, word string"


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text) with extra columns whose names the operators use themselves."""
    wide = [(i, t, None if k % 3 else "en", k, "x", None, k, "w") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(wide, SCHEMA).repartition(3)


AWKWARD: list[tuple] = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one  two\x0bthree"), (6, "one two three"),
    (7, "one two three"), (7, "one two three"), (9, "ONE two three"), (10, "été   naïve 😀 x\x00y"),
    (11, "word " * 30_000), (12, "a" * 50_000), (13, "one\ntwo\r\nthree"), (None, "one two three"),
    (None, None), (-3, "negative id"), (15, "\x1c\x1d nbsp here 　 wide"), (16, "😀" * 700),
]
