"""A hot user, or a hot song, holding a third of all listens.

Derived from the sf0.01 log. Checks that the ordered-list evaluation splits
the hot user over several range partitions, and that pruning and both metric
orders still equal DuckDB brute force on the same rows.
"""

import duckdb
import pytest
from pyspark.sql import functions as F

from paths import SF_CHECK
from encore.operators import popularity, prep
from encore.plans import catalogue
from encore.plans import oracle as O
from encore.sources.parquet import write_table

HOT_USER = 1
HOT_SONG = "hot-song"


def _hot_log(spark, split, column):
    # about a third of the listens (by a hash of the row) move to one user or song
    log = catalogue.listens(spark, SF_CHECK, split)
    hot_value = F.lit(HOT_USER).cast("bigint") if column == "user_id" else F.lit(HOT_SONG)
    third = F.pmod(F.xxhash64("timestamp", "recording_id", "user_id"), F.lit(3)) == 0
    return log.withColumn(column, F.when(third, hot_value).otherwise(F.col(column)))


def _write_hot(spark, folder, column):
    paths = {}
    for split in ("train", "test"):
        path = str(folder / f"{column}-{split}.parquet")
        write_table(_hot_log(spark, split, column), path)
        paths[split] = path
    return paths


@pytest.fixture(scope="module", params=["user_id", "recording_id"])
def hot(spark, tmp_path_factory, request):
    return _write_hot(spark, tmp_path_factory.mktemp("hot"), request.param)


def test_hot_user_spans_range_partitions(spark, tmp_path):
    hot = _write_hot(spark, tmp_path, "user_id")
    test = spark.read.parquet(hot["test"])
    total = test.count()
    hot_rows = test.where(F.col("user_id") == HOT_USER).count()
    assert hot_rows > total / 4
    collapsed = test.groupBy("user_id", "timestamp", "recording_id").count()
    ranged = collapsed.repartitionByRange(16, "user_id", "timestamp", "recording_id").withColumn(
        "_part", F.spark_partition_id()
    )
    parts = ranged.where(F.col("user_id") == HOT_USER).select("_part").distinct().count()
    assert parts >= 3


@pytest.mark.parametrize("order", ["standard", "reference"])
def test_hot_key_metrics_equal_brute_force(spark, hot, order):
    train = spark.read.parquet(hot["train"])
    test = spark.read.parquet(hot["test"])
    top = popularity.recommend(train, 100)
    got = {
        r["user_id"]: (r["precision_at_k"], r["map"], r["map_at_k"], r["ndcg_at_k"])
        for r in popularity.per_user_scores(test, top, 100, order).collect()
    }
    ctes = [
        f"train_log AS (SELECT * FROM read_parquet('{hot['train']}'))",
        f"test_log AS (SELECT * FROM read_parquet('{hot['test']}'))",
        O.popularity("train_log"),
        O.idcg(100),
        O.standard_order("test_log", 100) if order == "standard" else O.reference_order("test_log", 100),
        O.per_user_from_hits("hits", "users", 100),
    ]
    rows = duckdb.sql(O.with_(*ctes) + "SELECT user_id, precision_at_k, map, map_at_k, ndcg_at_k FROM per_user").fetchall()
    want = {r[0]: r[1:] for r in rows}
    assert set(got) == set(want)
    for user, values in want.items():
        assert got[user] == pytest.approx(values, rel=1e-9, abs=1e-12), user


def test_hot_key_pruning_equals_brute_force(spark, hot):
    log = spark.read.parquet(hot["train"])
    got = sorted(tuple(r) for r in prep.prune_rare(log, 5, 5).collect())
    sql = O.with_(f"src AS (SELECT * FROM read_parquet('{hot['train']}'))", O.prune("src", "pruned", 5))
    want = sorted(duckdb.sql(sql + 'SELECT user_id, "timestamp", recording_id FROM pruned').fetchall())
    assert got == want


def test_hot_user_time_threshold(spark, tmp_path):
    """The hot user's threshold against an exact quantile (DuckDB quantile_disc)."""
    from encore.operators import splits

    hot = _write_hot(spark, tmp_path, "user_id")
    log = spark.read.parquet(hot["train"])
    exact = dict(
        duckdb.sql(
            f"SELECT user_id, quantile_disc(\"timestamp\", 0.8) FROM read_parquet('{hot['train']}') GROUP BY user_id"
        ).fetchall()
    )
    n_hot = log.where(F.col("user_id") == HOT_USER).count()
    assert {r["user_id"]: r["threshold"] for r in splits.time_thresholds(log, 0.8).collect()} == exact
    got = {r["user_id"]: r["threshold"] for r in splits.time_thresholds(log, 0.8, accuracy=10_000).collect()}
    assert set(got) == set(exact)
    hot_times = sorted(r["timestamp"] for r in log.where(F.col("user_id") == HOT_USER).collect())
    off = abs(sum(t <= got[HOT_USER] for t in hot_times) - sum(t <= exact[HOT_USER] for t in hot_times))
    assert off <= n_hot / 10_000 + 1


SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.files.maxPartitionBytes": "32k",
    "spark.sql.files.openCostInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",  # these few KB would become one map task
}


def _skew_frames(spark, hot):
    """Joins of raw listens. (Ratings join pairs: a hot user is as many rows as there are songs, at most.)"""
    from encore.operators import splits

    # many files, so many map tasks, as a large log has: a partition is split between them
    for split in ("train", "test"):
        spark.read.parquet(hot[split]).repartition(12).write.parquet(f"{hot[split]}-12")
    train, test = (spark.read.parquet(f"{hot[split]}-12") for split in ("train", "test"))
    return {
        "time split": splits.split_by_time(train, 0.8)[0],
        "known rows": prep.known_test_rows(train, test, item_col="recording_id"),
    }


@pytest.fixture
def splitting(spark):
    before = {k: spark.conf.get(k, None) for k in SPLITTING}
    for k, v in SPLITTING.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _final(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_keys_of_joins_are_split(spark, tmp_path, splitting):
    hot = _write_hot(spark, tmp_path, "user_id")
    for name, frame in _skew_frames(spark, hot).items():
        assert "skew=true" in _final(frame), name


@pytest.mark.parametrize("column", ["user_id", "recording_id"])
def test_pruning_spreads_a_hot_key(spark, tmp_path, column):
    """The log is exchanged by (song, user): a third of it on one of them lies in no single partition."""
    log = spark.read.parquet(_write_hot(spark, tmp_path, column)["train"])
    parts = log.repartition(16, "recording_id", "user_id").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 16 and max(r["count"] for r in parts) < 0.15 * log.count()


def test_pruning_splits_a_hot_pair(spark, tmp_path, splitting):
    both = _hot_log(spark, "train", "user_id").withColumn(
        "recording_id", F.when(F.col("user_id") == HOT_USER, HOT_SONG).otherwise(F.col("recording_id"))
    )
    # the hot song has a few more listeners, so that the pair is kept
    others = both.where(F.col("user_id") != HOT_USER).withColumn("recording_id", F.lit(HOT_SONG))
    more = both.where(F.col("user_id") != HOT_USER).limit(200).withColumn("user_id", F.lit(HOT_USER).cast("bigint"))
    path = str(tmp_path / "pair.parquet")
    both.unionByName(others.limit(300)).unionByName(more).repartition(12).write.parquet(path)
    assert "skew=true" in _final(prep.prune_rare(spark.read.parquet(path), 5, 5))


def test_null_users_belong_to_nobody(spark):
    log = spark.createDataFrame(
        [(1, 1.0, "a"), (2, 1.0, "b"), (None, 2.0, "a"), (1, 3.0, None)], "user_id long, timestamp double, recording_id string"
    )
    top = spark.createDataFrame([(1, "a", 1.0)], "rank long, recording_id string, combined_score double")
    seen = [popularity.evaluate(log, top, 10, order).first() for order in ("standard", "reference")]
    seen += popularity.evaluate_splits({"x": log}, top, 10, "reference").collect()
    seen += popularity.evaluate_splits({"x": log}, top, 10, "standard").collect()
    assert [r["n_users"] for r in seen] == [2, 2, 2, 2]
    assert all(r["map"] in (0.25, 0.5) for r in seen)
