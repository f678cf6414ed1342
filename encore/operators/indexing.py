"""Dense indexes of string ids.

``fit_index`` numbers the distinct values of a column by frequency, most
frequent first, ties by the value ascending: the order of ``StringIndexer``
with ``stringOrderType='frequencyDesc'``. Unlike ``StringIndexer`` the
vocabulary never passes through the driver: the counts are sorted by a
range-partitioned sort, each task numbers its own rows, and task offsets come
from a table with one row per task. Like an estimator's ``fit`` it runs a
job: the mapping is written to the shared checkpoint folder, so every later
use reads that table instead of re-running the count and sort. Applying the
index is a join (broadcast when AQE measures the mapping as small, a shuffle
join otherwise).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.session import ensure_checkpoint_dir
from encore.sources.parquet import materialize


def dense_ranks(df: DataFrame, order: list, index_col: str = "index") -> DataFrame:
    """Number the rows of ``df`` 0, 1, 2, ... in ``order`` (a total order).

    Distributed: after the global sort, ``monotonically_increasing_id``
    carries (task, row-in-task); each task's offset is the running sum of
    the sizes of the tasks before it, over a table of one row per task. The
    sorted rows are checkpointed into the shared checkpoint folder first, so
    the sizes and the numbering see the same range bounds and task ids.
    """
    ensure_checkpoint_dir(df.sparkSession)
    numbered = (
        df.orderBy(*order)
        .checkpoint(eager=True)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
    )
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return numbered.join(F.broadcast(offsets), on="_part", how="inner").select(
        *df.columns, (F.col("_offset") + F.col("_row")).alias(index_col)
    )


@dataclass
class IndexModel:
    """A fitted dense index: ``mapping`` has ``(label, frequency, index)``
    columns and ``size`` labels (index ``size`` is the invalid bucket)."""

    mapping: DataFrame
    input_col: str
    output_col: str
    size: int

    def transform(self, df: DataFrame, handle_invalid: str = "keep") -> DataFrame:
        """Add ``output_col`` (DOUBLE) to ``df``.

        ``handle_invalid='keep'`` gives unseen and NULL values the index
        ``size`` (as ``StringIndexer`` does); ``'skip'`` drops those rows.
        """
        mapping = self.mapping.select(
            F.col("label").alias(self.input_col), F.col("index").alias("_index")
        )
        if handle_invalid == "skip":
            joined = df.join(mapping, on=self.input_col, how="inner")
            return joined.select(*df.columns, F.col("_index").cast("double").alias(self.output_col))
        if handle_invalid != "keep":
            raise ValueError("handle_invalid must be 'keep' or 'skip'")
        joined = df.join(mapping, on=self.input_col, how="left")
        return joined.select(
            *df.columns, F.coalesce(F.col("_index"), F.lit(self.size)).cast("double").alias(self.output_col)
        )

    def save(self, path: str) -> str:
        self.mapping.write.mode("overwrite").parquet(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str, input_col: str, output_col: str) -> "IndexModel":
        mapping = spark.read.parquet(path)
        return cls(mapping, input_col, output_col, mapping.count())


def index_mapping(df: DataFrame, input_col: str) -> DataFrame:
    """The lazy ``(label, frequency, index)`` table of ``fit_index``."""
    counts = df.where(F.col(input_col).isNotNull()).groupBy(input_col).agg(F.count(F.lit(1)).alias("_n"))
    ranked = dense_ranks(counts, [F.col("_n").desc(), F.col(input_col).asc()], "index")
    return ranked.select(F.col(input_col).alias("label"), F.col("_n").alias("frequency"), "index")


def fit_index(df: DataFrame, input_col: str, output_col: str | None = None) -> IndexModel:
    """Fit a frequency-descending dense index on ``input_col`` (M1).

    NULLs are not labels. Runs one job that writes the mapping to the shared
    checkpoint folder; the label count is read from the written table.
    """
    mapping = materialize(index_mapping(df, input_col), f"{input_col}_index")
    return IndexModel(mapping, input_col, output_col or f"{input_col}_index", mapping.count())


def fit_shared_index(train: DataFrame, test: DataFrame, input_col: str, output_col: str | None = None) -> IndexModel:
    """One vocabulary over train and test together."""
    return fit_index(train.select(input_col).unionByName(test.select(input_col)), input_col, output_col)
