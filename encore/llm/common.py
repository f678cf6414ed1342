"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.sources.parquet import materialize  # noqa: F401  (re-exported)

# ASCII white space as a character class body; a word is a run of anything else.
SPACE = r"\x20\x09-\x0D"
# Upper bound of one Arrow batch between the JVM and a Python worker, so that
# a run of very long texts does not fill a worker's memory.
BATCH_BYTES = "16m"
BATCH_ROWS = "2000"


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches of this session by bytes, not by rows alone.

    A session that has set either value keeps its own.
    """
    for key, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        if not spark.sparkContext.getConf().contains(key):
            try:
                spark.conf.set(key, value)
            except Exception:  # a Spark version without the byte bound
                if "Bytes" not in key:
                    raise


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row.

    A lambda that names an outer column may get that column's expression
    inlined and evaluated for each element; a lambda variable is bound once.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text: runs of anything but ASCII white space (null: none)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
