"""Hand-computed goldens on toy inputs (FIXTURES.md §3)."""

import pytest
from pyspark.sql import functions as F

from encore.functions.columns import min_max_scale
from encore.operators import indexing, prep, profiling, ranking, splits


def _long(spark, lists, col):
    rows = [(u, p, float(x)) for u, xs in lists.items() for p, x in enumerate(xs)]
    return spark.createDataFrame(rows, f"user_id long, pos long, {col} double")


def _metrics(spark, preds, labels, k, users=None):
    p = _long(spark, preds, "item")
    lab = _long(spark, labels, "item").select("user_id", "item")
    u = spark.createDataFrame([(x,) for x in users], "user_id long") if users else None
    per_user = ranking.list_metrics(p, lab, k, users=u)
    return ranking.mean_metrics(per_user, k).first().asDict()


@pytest.mark.parametrize(
    "k,precision,map_,map_k,ndcg",
    [(2, 0.5, 1.0833333, 1.0, 0.8154649), (100, 0.015, 1.0833333, 1.0833333, 0.9687517)],
)
def test_rank_metric_goldens(spark, k, precision, map_, map_k, ndcg):
    m = _metrics(spark, {1: [1, 2, 3], 2: [5, 5, 6]}, {1: [3, 9], 2: [5]}, k)
    assert m["n_users"] == 2
    assert m["precision_at_k"] == pytest.approx(precision, abs=1e-7)
    assert m["map"] == pytest.approx(map_, abs=1e-7)
    assert m["map_at_k"] == pytest.approx(map_k, abs=1e-7)
    assert m["ndcg_at_k"] == pytest.approx(ndcg, abs=1e-7)


def test_empty_labels_score_zero(spark):
    m = _metrics(spark, {1: [1, 2], 2: [1]}, {2: [1]}, 10, users=[1, 2])
    assert m["map"] == pytest.approx(0.5)


def test_repeated_labels_count_once(spark):
    m = _metrics(spark, {1: [1, 4]}, {1: [1, 1, 7]}, 10)
    assert m["map"] == pytest.approx(0.5)


def test_index_order_and_invalid(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "s string")
    model = indexing.fit_index(df, "s", "s_index")
    labels = [r["label"] for r in model.mapping.orderBy("index").collect()]
    assert labels == ["c", "a", "b"]
    probe = spark.createDataFrame([("c",), ("zzz",), (None,)], "s string")
    out = {r["s"]: r["s_index"] for r in model.transform(probe).collect()}
    assert out == {"c": 0.0, "zzz": 3.0, None: 3.0}
    skipped = model.transform(probe, handle_invalid="skip").collect()
    assert [r["s"] for r in skipped] == ["c"]


def test_unit_histogram(spark):
    # songs with 3, 3, 4 and 6 distinct listeners
    rows = []
    for song, n in (("s1", 3), ("s2", 3), ("s3", 4), ("s4", 6)):
        rows += [(u, 0.0, song) for u in range(n)]
    listens = spark.createDataFrame(rows, "user_id long, timestamp double, recording_id string")
    hist = [(r["buckets"], r["frequency"]) for r in profiling.listener_histogram(listens).collect()]
    assert hist == [(0.0, 2), (1.0, 1), (3.0, 1)]


def test_single_song_histogram_and_zero_range(spark):
    listens = spark.createDataFrame([(1, 0.0, "x"), (2, 0.0, "x")], "user_id long, timestamp double, recording_id string")
    assert [(r["buckets"], r["frequency"]) for r in profiling.listener_histogram(listens).collect()] == [(0.0, 1)]
    df = spark.createDataFrame([(5,)], "v long")
    lo = df.agg(F.min("v")).scalar()
    hi = df.agg(F.max("v")).scalar()
    assert df.select(min_max_scale("v", lo, hi).alias("s")).first()["s"] == 0.0


def _interactions(spark, rows):
    return spark.createDataFrame(rows, "user_id long, timestamp timestamp, recording_msid string")


def _tracks(spark, rows):
    return spark.createDataFrame(rows, "recording_msid string, recording_mbid string")


def test_canonical_listens_edge_cases(spark):
    import datetime as dt

    t = dt.datetime(2020, 1, 1)
    inter = _interactions(spark, [(1, t, "x"), (1, t, "y"), (2, t, "nothere")])
    trk = _tracks(spark, [("x", None), ("y", "Y"), ("y", "Y")])
    out = sorted((r["user_id"], r["recording_id"]) for r in prep.canonical_listens(trk, inter).collect())
    # null mbid -> msid; duplicate track row -> listen twice; no track -> dropped
    assert out == [(1, "Y"), (1, "Y"), (1, "x")]
    epoch = prep.canonical_listens(trk, inter).first()["timestamp"]
    assert epoch == 1577836800.0


def test_time_split_one_user(spark):
    listens = spark.createDataFrame(
        [(1, float(t), "s") for t in range(1, 11)], "user_id long, timestamp double, recording_id string"
    )
    train, test = splits.split_by_time(listens, 0.6)
    assert train.count() == 6 and test.count() == 4
    assert max(r["timestamp"] for r in train.collect()) < min(r["timestamp"] for r in test.collect())


def test_rating_shares(spark):
    rows = [(1, 0.0)] * 3 + [(1, 1.0)]
    df = spark.createDataFrame(rows, "user_id long, recording_id_index double")
    shares = sorted(r["avg_rating"] for r in prep.user_item_ratings(df).collect())
    assert shares == [0.25, 0.75]


def test_prune_is_one_pass(spark):
    # song a: 3 listeners, song b: 2 listeners; bounds 2 -> only a survives,
    # then users need > 0 songs among survivors.
    rows = [(1, 0.0, "a"), (2, 0.0, "a"), (3, 0.0, "a"), (1, 0.0, "b"), (2, 0.0, "b")]
    listens = spark.createDataFrame(rows, "user_id long, timestamp double, recording_id string")
    out = prep.prune_rare(listens, min_users=2, min_items=0).collect()
    assert sorted((r["user_id"], r["recording_id"]) for r in out) == [(1, "a"), (2, "a"), (3, "a")]


def test_wide_user_ids_need_an_index(spark):
    from encore.operators import factors

    big = 2**40
    ratings = spark.createDataFrame(
        [(big, 1.0, 0.0), (big + 1, 0.5, 1.0), (big, 0.5, 1.0)], "user_id long, avg_rating double, recording_id_index double"
    )
    with pytest.raises(Exception):
        factors.fit(factors.als(rank=2, max_iter=1), ratings)
    index = factors.index_users(ratings)
    indexed = index.transform(ratings.withColumn("user_id", F.col("user_id").cast("string")))
    fitted = factors.fit(factors.als(rank=2, max_iter=1, user_col="user_index"), indexed)
    assert fitted.model.userFactors.count() == 2
