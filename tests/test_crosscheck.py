"""Cross-checks against Spark's own implementations and brute force."""

import random

import pytest
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import Window
from pyspark.sql import functions as F

from encore.functions.columns import harmonic_gap
from encore.operators import indexing, ranking

METRICS = {
    "precisionAtK": "precision_at_k",
    "meanAveragePrecision": "map",
    "meanAveragePrecisionAtK": "map_at_k",
    "ndcgAtK": "ndcg_at_k",
}


def _random_lists(seed, users=60, items=30):
    rnd = random.Random(seed)
    data = []
    for u in range(users):
        preds = [float(rnd.randrange(items)) for _ in range(rnd.randrange(1, 15))]  # repeats allowed
        labels = [float(rnd.randrange(items)) for _ in range(rnd.randrange(1, 12))]  # repeats allowed
        data.append((u, preds, labels))
    return data


@pytest.mark.parametrize("k", [1, 5, 10, 100])
def test_list_metrics_equal_ranking_evaluator(spark, k):
    data = _random_lists(k)
    arrays = spark.createDataFrame(data, "user_id long, predictions array<double>, labels array<double>")
    preds = arrays.select("user_id", F.posexplode("predictions").alias("pos", "item"))
    labels = arrays.select("user_id", F.explode("labels").alias("item"))
    mine = ranking.mean_metrics(ranking.list_metrics(preds, labels, k), k).first()
    assert mine["n_users"] == len(data)
    for name, col in METRICS.items():
        ev = RankingEvaluator(k=k, metricName=name, predictionCol="predictions", labelCol="labels")
        assert mine[col] == pytest.approx(ev.evaluate(arrays), abs=1e-12), name


def _brute_reference(events, relevant, k):
    """Swapped-order metrics by expanding every list (pure Python)."""
    lists = {}
    for u, t, item in sorted(events, key=lambda e: (e[0], e[1], e[2])):
        lists.setdefault(u, []).append(item)
    rel = set(relevant)
    out = {}
    for u, items in lists.items():
        hits, ap, apk, dcg, hk = 0, 0.0, 0.0, 0.0, 0
        import math

        for i, it in enumerate(items):
            if it in rel:
                hits += 1
                ap += hits / (i + 1)
                if i < k:
                    hk += 1
                    apk += hits / (i + 1)
                    dcg += 1 / math.log(i + 2)
        idcg = sum(1 / math.log(i + 2) for i in range(min(len(rel), k)))
        out[u] = (hk / k, ap / len(rel), apk / min(len(rel), k), dcg / idcg)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_ordered_list_metrics_hot_user_and_copies(spark, seed):
    rnd = random.Random(seed)
    events = []
    # one hot user with most of the rows, long blocks of identical listens
    for _ in range(3000):
        events.append((7, float(rnd.randrange(200)), f"s{rnd.randrange(40)}"))
    events += [(7, 50.0, "s1")] * 400  # a block of 400+ copies
    for u in range(20):
        for _ in range(rnd.randrange(1, 60)):
            events.append((u, float(rnd.randrange(100)), f"s{rnd.randrange(40)}"))
    relevant = [f"s{i}" for i in range(0, 40, 3)]
    k = 50
    df = spark.createDataFrame(events, "user_id long, timestamp double, item string").repartition(16)
    rel = spark.createDataFrame([(r,) for r in relevant], "item string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {
            r["user_id"]: (r["precision_at_k"], r["map"], r["map_at_k"], r["ndcg_at_k"])
            for r in ranking.ordered_list_metrics(df, rel, k, order_cols=["timestamp", "item"]).collect()
        }
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = _brute_reference(events, relevant, k)
    assert set(got) == set(want)
    for u in want:
        assert got[u] == pytest.approx(want[u], rel=1e-9, abs=1e-12), u


def test_prefix_sums_span_partitions(spark):
    rows = [(1, i, 1) for i in range(5000)] + [(2, i, 2) for i in range(10)]
    df = spark.createDataFrame(rows, "g long, o long, w long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = ranking.exclusive_prefix_sums(df, "g", ["o"], ["w"])
        parts = out.groupBy("g").agg(F.count("*").alias("n")).collect()
        got = {(r["g"], r["o"]): r["w_before"] for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {r["g"]: r["n"] for r in parts} == {1: 5000, 2: 10}
    assert all(got[(1, i)] == i for i in range(5000))
    assert all(got[(2, i)] == 2 * i for i in range(10))


@pytest.mark.parametrize("a,b", [(0, 0), (0, 1), (3, 70), (0, 400), (63, 65), (64, 5000), (1000, 1_000_000), (10**9, 10**9 + 777)])
def test_harmonic_gap(spark, a, b):
    got = spark.range(1).select(harmonic_gap(F.lit(a), F.lit(b)).alias("h")).first()["h"]
    import math

    want = math.fsum(1.0 / i for i in range(a + 1, b + 1))
    assert got == pytest.approx(want, rel=1e-12, abs=1e-15)


def test_dense_index_equals_string_indexer(spark):
    rnd = random.Random(3)
    rows = [(f"id{rnd.randrange(300)}",) for _ in range(5000)]
    df = spark.createDataFrame(rows, "s string").repartition(7)
    mine = {r["label"]: float(r["index"]) for r in indexing.fit_index(df, "s").mapping.collect()}
    model = StringIndexer(inputCol="s", outputCol="i", stringOrderType="frequencyDesc").fit(df)
    theirs = {label: float(i) for i, label in enumerate(model.labels)}
    assert mine == theirs


def test_runs_from_hits_window_is_bounded_by_list(spark):
    hits = spark.createDataFrame([(1, 4), (1, 0), (1, 9)], "user_id long, pos long")
    got = sorted((r["start"], r["before"]) for r in ranking.runs_from_hits(hits).collect())
    assert got == [(0, 0), (4, 1), (9, 2)]
    w = Window.partitionBy("user_id").orderBy("pos")
    assert hits.select(F.row_number().over(w)).count() == 3
