"""Declared schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw listening events of one split.
INTERACTIONS_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("recording_msid", T.StringType(), True),
    ]
)

# Track dimension: the listen id and an optional MusicBrainz id.
TRACKS_SCHEMA = T.StructType(
    [
        T.StructField("recording_msid", T.StringType(), True),
        T.StructField("recording_mbid", T.StringType(), True),
    ]
)
