"""Descriptive statistics of a listen log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.sources.parquet import materialize

USER = "user_id"
SONG = "recording_id"


def _pairs(listens: DataFrame, user_col: str, item_col: str) -> DataFrame:
    """(item, user) groups with non-null counts of both columns.

    Null-aware so that the counts below equal ``count(col)`` and
    ``count(distinct col)`` on the raw listens.
    """
    return listens.groupBy(item_col, user_col).agg(
        F.count(user_col).alias("n_user"), F.count(item_col).alias("n_item")
    )


def _by_song(pairs: DataFrame, user_col: str, item_col: str) -> DataFrame:
    return pairs.groupBy(item_col).agg(
        F.sum("n_user").alias("user_count"), F.count(user_col).alias("unique_user_count")
    )


def _by_user(pairs: DataFrame, user_col: str, item_col: str) -> DataFrame:
    return pairs.groupBy(user_col).agg(
        F.sum("n_item").alias("interaction_count"), F.count(item_col).alias("unique_interaction_count")
    )


def song_play_counts(listens: DataFrame, user_col: str = USER, item_col: str = SONG) -> DataFrame:
    """Per song: plays (``user_count``) and distinct listeners (``unique_user_count``) (A3)."""
    return _by_song(_pairs(listens, user_col, item_col), user_col, item_col)


def user_play_counts(listens: DataFrame, user_col: str = USER, item_col: str = SONG) -> DataFrame:
    """Per user: plays (``interaction_count``) and distinct songs (``unique_interaction_count``) (A4)."""
    return _by_user(_pairs(listens, user_col, item_col), user_col, item_col)


def _summary(counts: DataFrame, measures: list[tuple[str, str]]) -> DataFrame:
    """Mean / sample stddev / min / max of each measure, one row per measure.

    ``measures`` pairs a column with the metric name it is reported under.
    One aggregate computes all of them; ``stack`` turns the wide row into
    rows (no union of re-computed branches, no join).
    """
    aggs = []
    for col, _ in measures:
        aggs += [
            F.avg(col).alias(f"mean_{col}"),
            F.stddev_samp(col).alias(f"std_{col}"),
            F.min(col).cast("bigint").alias(f"min_{col}"),
            F.max(col).cast("bigint").alias(f"max_{col}"),
        ]
    wide = counts.agg(*aggs)
    parts = ", ".join(
        f"'{name}', mean_{col}, std_{col}, min_{col}, max_{col}" for col, name in measures
    )
    return wide.selectExpr(f"stack({len(measures)}, {parts}) as (Metric, mean, stddev, min, max)")


def listen_stats(listens: DataFrame, user_col: str = USER, item_col: str = SONG) -> DataFrame:
    """Four-row summary (T1): ``Metric, mean, stddev, min, max``.

    Metrics: ``users_per_interaction`` (plays per song),
    ``unique_users_per_interaction`` (listeners per song),
    ``interactions_per_user`` (plays per user) and
    ``unique_interactions_per_user`` (songs per user). ``stddev`` is the
    sample standard deviation. The pair aggregate with both counts is written
    once and both count tables read it, so the listens are scanned and
    shuffled once.
    """
    pairs = materialize(_pairs(listens, user_col, item_col), "pair_counts")
    per_song = _summary(
        _by_song(pairs, user_col, item_col),
        [("user_count", "users_per_interaction"), ("unique_user_count", "unique_users_per_interaction")],
    )
    per_user = _summary(
        _by_user(pairs, user_col, item_col),
        [
            ("interaction_count", "interactions_per_user"),
            ("unique_interaction_count", "unique_interactions_per_user"),
        ],
    )
    return per_song.unionByName(per_user)


def listener_histogram(listens: DataFrame, user_col: str = USER, item_col: str = SONG) -> DataFrame:
    """Histogram of distinct listeners per song with unit-wide bins.

    ``buckets`` (DOUBLE) is the bin's offset from the smallest count, as a
    unit-split bucketizer numbers it; ``unique_user_count`` is the bin's
    count itself; ``frequency`` the number of songs. Empty bins have no row.
    The count-of-counts table (at most one row per distinct count) is
    written once (one job); the smallest count is a scalar subquery over
    it, so the log is aggregated once, and one song alone gives bucket 0
    rather than an error.
    """
    per_song = listens.groupBy(item_col).agg(F.countDistinct(user_col).alias("unique_user_count"))
    freq = materialize(
        per_song.groupBy("unique_user_count").agg(F.count(F.lit(1)).alias("frequency")), "listener_counts"
    )
    lowest = freq.agg(F.min("unique_user_count")).scalar()
    return freq.select(
        (F.col("unique_user_count") - lowest).cast("double").alias("buckets"),
        F.col("unique_user_count").cast("bigint").alias("unique_user_count"),
        F.col("frequency"),
    ).orderBy("buckets")
