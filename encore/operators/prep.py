"""Data preparation: canonical listens, pruning, ratings, id checks.

``prune_rare``, ``user_item_ratings`` and ``known_test_rows`` write the small
tables that they join (counts, totals, ids) to the shared checkpoint folder
first. A join whose two sides are both read from storage ends in two plain
exchanges, which AQE can broadcast by measured size or split where one key is
hot; over an aggregate's own shuffle it can do neither. The other functions
run no action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.columns import canonical_id, epoch_seconds
from encore.sources.parquet import materialize

USER = "user_id"
SONG = "recording_id"


def canonical_listens(tracks: DataFrame, interactions: DataFrame) -> DataFrame:
    """Listens ``(user_id, timestamp, recording_id)``.

    Inner join on ``recording_msid``: a listen without a track row is dropped,
    a track listed twice yields the listen twice. The song id is the track's
    MusicBrainz id, else the listen's msid; time becomes epoch seconds. The
    join strategy is left to AQE (broadcast only when the measured track side
    is under the broadcast threshold; a hot msid is split by skew handling).
    """
    tracks = tracks.select("recording_msid", "recording_mbid")
    return interactions.join(tracks, on="recording_msid", how="inner").select(
        F.col(USER),
        epoch_seconds("timestamp").alias("timestamp"),
        canonical_id("recording_mbid", "recording_msid").alias(SONG),
    )


def prune_rare(
    listens: DataFrame,
    min_users: int = 20,
    min_items: int = 20,
    user_col: str = USER,
    item_col: str = SONG,
) -> DataFrame:
    """Keep songs with more than ``min_users`` distinct listeners, then users
    with more than ``min_items`` distinct remaining songs (D4).

    One pass, not a k-core: a song may fall back under its bound after the
    user step, as in the original. Both bounds are strict.

    Plan: the log is written once, so its source join runs once. Its distinct
    (song, user) pairs are built with a map-side combine and written; both
    bounds are counts of pairs, taken with joins of pairs to short id tables.
    The log itself is joined once, to the kept pairs, and so exchanged once,
    by (song, user): a hot song is spread by its users and a hot user by their
    songs. (Bucketing the written log by song would leave a hot song in one
    bucket, which one task reads.)
    """
    pair = [item_col, user_col]
    log = materialize(listens, "log")
    pairs = materialize(log.select(*pair).dropna().distinct(), "pairs")
    songs = materialize(
        pairs.groupBy(item_col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min_users).select(item_col),
        "kept_songs",
    )
    of_songs = pairs.join(songs, on=item_col, how="left_semi")
    users = materialize(
        of_songs.groupBy(user_col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min_items).select(user_col),
        "kept_users",
    )
    kept = of_songs.join(users, on=user_col, how="left_semi")
    return log.join(kept, on=pair, how="left_semi").select(*listens.columns)


def user_item_ratings(
    indexed: DataFrame, user_col: str = USER, item_col: str = "recording_id_index"
) -> DataFrame:
    """Rating = the user's share of plays per song.

    ``(user_id, avg_rating, recording_id_index)``; the ratings of a user sum
    to 1. Plays by pair and their sum by user are written, then divided.
    """
    plays = materialize(indexed.groupBy(user_col, item_col).agg(F.count(F.lit(1)).alias("plays")), "plays")
    by_user = materialize(plays.groupBy(user_col).agg(F.sum("plays").alias("all_plays")), "plays_by_user")
    share = F.col("plays") / F.col("all_plays")
    return plays.join(by_user, on=user_col).select(user_col, share.alias("avg_rating"), item_col)


def known_test_rows(
    train: DataFrame, test: DataFrame, user_col: str = USER, item_col: str = "recording_id_index"
) -> DataFrame:
    """Test rows whose user and item both occur in train."""
    train_users = materialize(train.select(user_col).distinct(), "train_users")
    train_items = materialize(train.select(item_col).distinct(), "train_items")
    known = test.join(train_users, on=user_col, how="left_semi").join(train_items, on=item_col, how="left_semi")
    return known.select(*test.columns)


def unseen_ids(train: DataFrame, test: DataFrame, col: str) -> DataFrame:
    """Distinct ids of ``col`` present in test but not in train."""
    return test.select(col).distinct().join(train.select(col).distinct(), on=col, how="left_anti")


def unseen_report(train: DataFrame, test: DataFrame, user_col: str = USER, item_col: str = "recording_id_index") -> DataFrame:
    """One row: how many test users and items are unseen in train, and flags."""
    users = unseen_ids(train, test, user_col).agg(F.count(F.lit(1)).alias("unseen_users"))
    items = unseen_ids(train, test, item_col).agg(F.count(F.lit(1))).scalar()
    return users.select("unseen_users", items.alias("unseen_items")).select(
        "unseen_users",
        "unseen_items",
        (F.col("unseen_users") > 0).alias("has_unseen_users"),
        (F.col("unseen_items") > 0).alias("has_unseen_items"),
    )


def combine_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    """UNION ALL of two splits by column name."""
    return train.unionByName(test)


def id_profile(df: DataFrame, col: str = USER) -> DataFrame:
    """Min, max and count of an id column."""
    return df.agg(
        F.min(col).alias("min"),
        F.max(col).alias("max"),
        F.count(col).alias("count"),
    )


def ratings_profile(ratings: DataFrame, user_col: str = USER, item_col: str = "recording_id_index") -> DataFrame:
    """Id ranges of a ratings table (D8, A16): user min/max/count, largest item index."""
    return ratings.agg(
        F.min(user_col).alias("min"),
        F.max(user_col).alias("max"),
        F.count(user_col).alias("count"),
        F.max(item_col).alias("max_item_index"),
    )


def lookup_user(df: DataFrame, user_id: int, user_col: str = USER) -> DataFrame:
    """Rows of one user (P9); the predicate reaches the scan when it can."""
    return df.where(F.col(user_col) == F.lit(user_id))
