"""Small tables for the tests of the training-data operators."""

from __future__ import annotations

import duckdb

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; as extra input columns they must not clash.
CLASHES = "fp size key bucket ticket words row at found position copies item_id root node h2 t n_words".split()


def docs(spark, rows, extra: bool = False):
    """``documents`` from (doc_id, text[, lang[, source]]) tuples."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", 0) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in CLASHES})
    return df


def table(name: str) -> list[dict]:
    rel = duckdb.sql(f"SELECT * FROM '{SF}/{name}.parquet'")
    return [dict(zip(rel.columns, r)) for r in rel.fetchall()]


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (4, "one"),
    (5, "one"),
    (None, "a row without an id and a few more words"),
    (None, None),
    (6, "é ü ñ 漢字 🙂 mit license mit license"),
    (7, "word " * 30_000),
]
