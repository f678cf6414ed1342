"""The reference's input tables, derived from the driver's star-schema tables.

A line item is one listen: the order's customer is the user, the part is the
song. Fixed mapping (it must equal the SQL twin in ``encore.plans.oracle``):

* ``user_id``        = ``o_custkey`` (line item joined to its order)
* ``timestamp``      = ``l_shipdate``
* ``recording_msid`` = ``'msid-' || l_partkey``
* track ``recording_msid`` = ``'msid-' || p_partkey``
* track ``recording_mbid`` = NULL when ``p_size % 5 = 0``,
  else ``'mbid-' || (p_partkey - p_partkey % 2)`` (two parts may share a song)
* split: train when ``l_shipdate < 1999-06-01``, else test
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the mapping.
SPLIT_DATE = "1999-06-01 00:00:00"
MSID_PREFIX = "msid-"
MBID_PREFIX = "mbid-"
NULL_MBID_SIZE_MODULUS = 5


# The columns read from each driver table. Declaring them skips schema
# inference (one job per file) and keeps every scan to these columns.
SOURCE_COLUMNS = {
    "lineitem": T.StructType(
        [
            T.StructField("l_orderkey", T.LongType()),
            T.StructField("l_partkey", T.LongType()),
            T.StructField("l_shipdate", T.TimestampNTZType()),
        ]
    ),
    "orders": T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType())]),
    "part": T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_size", T.IntegerType())]),
    "customer": T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_nationkey", T.IntegerType())]),
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_COLUMNS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def interactions(spark: SparkSession, sf_dir: str, split: str | None = None) -> DataFrame:
    """Listening events ``(user_id, timestamp, recording_msid)``.

    ``split`` is ``'train'``, ``'test'`` or ``None`` (the whole log). The split
    predicate is on the line item's own column, so it reaches the Parquet scan.
    """
    lineitem = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    cut = F.lit(SPLIT_DATE).cast("timestamp_ntz")
    if split == "train":
        lineitem = lineitem.where(F.col("l_shipdate") < cut)
    elif split == "test":
        lineitem = lineitem.where(F.col("l_shipdate") >= cut)
    elif split is not None:
        raise ValueError(f"unknown split {split!r}")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey, "inner").select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_shipdate").alias("timestamp"),
        F.concat(F.lit(MSID_PREFIX), F.col("l_partkey").cast("string")).alias("recording_msid"),
    )


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track dimension ``(recording_msid, recording_mbid)``."""
    part = _table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return part.select(
        F.concat(F.lit(MSID_PREFIX), key.cast("string")).alias("recording_msid"),
        F.when(F.col("p_size") % NULL_MBID_SIZE_MODULUS == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(MBID_PREFIX), (key - key % 2).cast("string")))
        .alias("recording_mbid"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User dimension (not read by any operator; kept for the loader's shape)."""
    return _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("nation_id")
    )


def dataset(spark: SparkSession, sf_dir: str, split: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(interactions, tracks, users)`` like the file loader returns them."""
    return interactions(spark, sf_dir, split), tracks(spark, sf_dir), users(spark, sf_dir)


def write_dataset_files(spark: SparkSession, sf_dir: str, out_dir: str, version: str = "") -> dict[str, str]:
    """Write the train and test triples as the reference's Parquet files.

    Gives ``encore.sources.parquet.load_dataset`` and the job CLI real files to
    read. The users table is written with the ``user_id`` column only.
    """
    suffix = "_small" if version == "small" else ""
    written = {}
    for split in ("train", "test"):
        inter, trk, usr = dataset(spark, sf_dir, split)
        for name, frame in (("interactions", inter), ("tracks", trk), ("users", usr)):
            path = os.path.join(out_dir, f"{name}_{split}{suffix}.parquet")
            frame.write.mode("overwrite").parquet(path)
            written[f"{name}_{split}"] = path
    return written
