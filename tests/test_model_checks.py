"""Exact top-k, proof of a fit, folds, resumable grids, brackets, and the life of scratch tables."""

import gc
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from encore.operators import factors, fitcheck, prep, splits, topk, tuning
from encore.session import ensure_checkpoint_dir
from encore.sources.parquet import materialize, owning_scratch, scratch_scope
from paths import SF_SMOKE

REG = 0.05


def factor_table(spark, matrix):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], "id int, features array<float>")


def brute_lists(users, items, k):
    scores = (users.astype("float64") @ items.astype("float64").T).astype("float32")
    ids = np.arange(len(items))
    return {u: [(int(i), float(scores[u, i])) for i in np.lexsort((ids, -scores[u]))[:k]] for u in range(len(users))}


@pytest.mark.parametrize("chunk_bytes", [1, 1 << 20])
def test_top_items_equal_brute_force(spark, chunk_bytes):
    rng = np.random.default_rng(3)
    users = (rng.normal(size=(120, 6)) * rng.gamma(1, 1, size=(120, 1))).astype("float32")
    items = (rng.normal(size=(1300, 6)) * rng.gamma(0.3, 1, size=(1300, 1))).astype("float32")
    users[7], items[5], items[700] = 0, items[9], items[9]  # a user without taste, and three equal items
    found = topk.top_items(factor_table(spark, users), factor_table(spark, items), 20, chunk_bytes)
    got = {r["id"]: list(zip(r["items"], r["scores"])) for r in found.collect()}
    assert got == brute_lists(users, items, 20)


def test_top_items_of_few_or_no_items(spark):
    users, items = np.ones((3, 2), "float32"), np.ones((4, 2), "float32")
    got = topk.top_items(factor_table(spark, users), factor_table(spark, items), 20).collect()
    assert [list(r["items"]) for r in got] == [[0, 1, 2, 3]] * 3
    nothing = spark.createDataFrame([], "id int, features array<float>")
    assert [list(r["items"]) for r in topk.top_items(factor_table(spark, users), nothing, 5).collect()] == [[]] * 3
    assert topk.top_items(nothing, factor_table(spark, items), 5).count() == 0


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(1)
    rows = [(u, float(i), float(rng.random())) for u in range(60) for i in rng.choice(80, 15, replace=False)]
    ratings = spark.createDataFrame(rows, "user_id int, recording_id_index double, avg_rating double")
    return ratings, factors.fit(factors.als(rank=8, max_iter=3, reg_param=REG), ratings).model


def test_lists_of_a_model_equal_brute_force_and_need_no_block_pairs(spark, fitted):
    ratings, model = fitted
    users = {r["id"]: np.array(r["features"], "float32") for r in model.userFactors.collect()}
    items = {r["id"]: np.array(r["features"], "float32") for r in model.itemFactors.collect()}
    numbers = sorted(items)
    wanted = ratings.where("user_id % 3 = 0").select("user_id")
    recs = factors.recommend_for(model, wanted, 10)
    got = {}
    for r in recs.orderBy("user_id", "pos").collect():
        got.setdefault(r["user_id"], []).append(r["recording_id_index"])
    assert set(got) == {u for u in users if u % 3 == 0}
    brute = brute_lists(np.array([users[u] for u in sorted(got)]), np.array([items[i] for i in numbers]), 10)
    assert [got[u] for u in sorted(got)] == [[numbers[i] for i, _ in brute[n]] for n in range(len(got))]
    plan = factors.recommend_all(model, 10)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_fit_is_proven_and_shuffled_factors_are_not(spark, fitted):
    ratings, model = fitted

    def report(users, reg=REG):
        return fitcheck.fit_report(fitcheck.normal_residuals(users, model.itemFactors, ratings, reg)).first()

    good = report(model.userFactors)
    assert (good["n_users"], good["n_ratings"], good["n_unsolved"]) == (60, 900, 0) and good["worst"] < 1e-5
    assert report(model.userFactors.withColumn("id", (F.col("id") + 1) % 60))["n_unsolved"] == 60
    assert report(model.userFactors, reg=10 * REG)["n_unsolved"] == 60
    assert report(model.userFactors.where("id > 4"))["n_unsolved"] == 5  # users without factors


def test_residual_equals_numpy(spark, fitted):
    ratings, model = fitted
    v = {r["id"]: np.array(r["features"], float) for r in model.itemFactors.collect()}
    u = {r["id"]: np.array(r["features"], float) + 0.1 for r in model.userFactors.collect()}
    moved = spark.createDataFrame([(i, [float(x) for x in f]) for i, f in u.items()], "id int, features array<double>")
    got = {r["user_id"]: r for r in fitcheck.normal_residuals(moved, model.itemFactors, ratings, REG).collect()}
    for user in (0, 17, 59):
        rows = [(v[int(r["recording_id_index"])], r["avg_rating"]) for r in ratings.where(F.col("user_id") == user).collect()]
        gram = sum(np.outer(x, x) for x, _ in rows) + REG * len(rows) * np.eye(8)
        right = sum(x * r for x, r in rows)
        assert got[user]["residual"] == pytest.approx(np.linalg.norm(gram @ u[user] - right))
        assert got[user]["scale"] == pytest.approx(np.linalg.norm(right))


def test_folds_and_grid_do_not_depend_on_the_layout_and_resume(spark, fitted, tmp_path):
    ratings, _ = fitted
    est = factors.als(rank=3, max_iter=2, blocks=2)
    grid = factors.param_grid(est, [2, 3], [2], [0.1])
    rows = {}
    for name, frame in (("one", ratings.coalesce(1)), ("many", ratings.orderBy(F.rand(5)).repartition(7))):
        frame.write.parquet(str(tmp_path / name))
        layout = spark.read.parquet(str(tmp_path / name))
        fits = tuning.grid_search(spark, layout, est, grid, str(tmp_path / f"run-{name}"))
        rows[name] = {(r["point"], r["fold"]): (r["n_fit"], r["n_held"], r["n_scored"], round(r["rmse"], 6)) for r in fits.collect()}
    assert rows["one"] == rows["many"] and len(rows["one"]) == 4
    sizes = {r["f"]: r["count"] for r in ratings.groupBy(tuning.fold_of(2).alias("f")).count().collect()}
    assert {f: h for (_, f), (_, h, _, _) in rows["one"].items()} == sizes

    run = tmp_path / "run-one"
    files = lambda: {str(p): p.stat().st_mtime_ns for p in run.rglob("part-*")}
    before = files()
    lost = run / "point-1-fold-0" / "_SUCCESS"
    os.rename(lost, tmp_path / "moved-success")  # as if the run had ended in this fit
    report = tuning.grid_report(tuning.grid_search(spark, ratings, est, grid, str(run))).collect()
    kept = {p for p, t in files().items() if before.get(p) == t}
    assert len(kept) == 3 and sum(r["is_best"] for r in report) == 1
    assert min(r["rmse"] for r in report) == next(r["rmse"] for r in report if r["is_best"])
    with pytest.raises(ValueError):
        tuning.grid_search(spark, ratings, est, factors.param_grid(est, [2, 4], [2], [0.1]), str(run))


def test_a_grid_fit_joins_its_factors_to_the_held_ratings_once(spark, fitted, tmp_path, monkeypatch):
    from pyspark.ml.evaluation import RegressionEvaluator

    ratings, _ = fitted
    seen, real = [], RegressionEvaluator.evaluate
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(RegressionEvaluator, "evaluate", lambda self, df: seen.append((plan(df), df.columns, df.count())) or real(self, df))
    before = tables(spark)
    odd = ratings.withColumn("f", F.when(F.col("user_id") > 2, (F.col("user_id") + F.col("recording_id_index").cast("int")) % 2))  # some ratings in no fold
    est = factors.als(rank=3, max_iter=2, blocks=2)
    with scratch_scope(spark):
        fits = tuning.grid_search(spark, odd, est, factors.param_grid(est, [2], [2], [0.1]), str(tmp_path / "run"), fold_col="f").collect()
        assert not [t for t in tables(spark) - before if t.startswith("scored")]
    assert len(seen) == 2 and all("Join" not in p and columns == ["avg_rating", "prediction"] for p, columns, _ in seen)
    sizes = {f: odd.where(F.col("f") == f).count() for f in (0, 1)}
    assert {r["fold"]: (r["n_fit"], r["n_held"]) for r in fits} == {f: (sizes[1 - f], n) for f, n in sizes.items()}
    assert sum(sizes.values()) == 57 * 15 and sorted(r["n_scored"] for r in fits) == sorted(n for _, _, n in seen)


def test_cross_validator_takes_the_folds_of_a_column(spark, fitted):
    ratings, _ = fitted
    est = factors.als(rank=2, max_iter=1, blocks=2)
    grid = factors.param_grid(est, [2], [1], [0.1])
    by_hash = factors.tune(spark, ratings, est, grid).report.first()["rmse"]
    given = factors.tune(spark, ratings.withColumn("part", tuning.fold_of(2)), est, grid, fold_col="part").report.first()["rmse"]
    assert by_hash == pytest.approx(given, rel=1e-6)


@pytest.mark.parametrize("bracket", [20, 300, 10_000])
def test_thresholds_of_any_bracket_equal_duckdb(spark, bracket):
    import duckdb
    import pandas as pd

    rng = np.random.default_rng(bracket)
    pdf = pd.concat([pd.DataFrame({"user_id": u, "timestamp": rng.integers(0, 700, size=n).astype(float)}) for u, n in enumerate((3000, 50, 1, 12_000))])
    listens = spark.createDataFrame(pdf).unionByName(
        spark.createDataFrame([(None, 1.0), (9, None)], "user_id long, timestamp double")
    )
    for q in (0.0, 0.5, 0.8, 1.0):
        want = dict(duckdb.sql(f"SELECT user_id, quantile_disc(timestamp, {q}) FROM pdf GROUP BY user_id").fetchall())
        assert {r[0]: r[1] for r in splits.time_thresholds(listens, q, bracket=bracket).collect()} == want


def test_threshold_of_a_million_listens_is_exact(spark):
    listens = spark.range(1_000_000).select(
        F.lit(1).cast("long").alias("user_id"), (F.col("id") * 7919 % 1_000_003).cast("double").alias("timestamp")
    )
    times = sorted(i * 7919 % 1_000_003 for i in range(1_000_000))
    assert splits.time_thresholds(listens, 0.8).first()["threshold"] == times[799_999]


def test_pruning_exchanges_the_log_once(spark):
    log = spark.range(4000).select(
        (F.col("id") % 40).alias("user_id"), F.col("id").cast("double").alias("timestamp"), (F.col("id") % 97).cast("string").alias("recording_id")
    )
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        kept = prep.prune_rare(log, 5, 5)
        assert kept.count() == 4000
        plan = kept._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    nodes = plan.split("\n\n")
    exchanges = [n for n in nodes if ") Exchange" in n.split("\n")[0] and "timestamp" in n]
    assert len(exchanges) == 1 and "recording_id" in exchanges[0].split("Arguments:")[1] and "user_id" in exchanges[0].split("Arguments:")[1]


def tables(spark):
    folder = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def gone(spark, before):
    for _ in range(100):
        gc.collect()
        if tables(spark) <= before:
            return True
        time.sleep(0.2)
    return False


@pytest.mark.parametrize("name", ["canonical_listens", "filter_low_interactions", "split_time_train", "user_item_ratings", "popularity_metrics_by_split", "fixed_list_metrics_sql"])
def test_a_query_leaves_no_scratch_table(spark, name):
    before = tables(spark)
    views = {t.name for t in spark.catalog.listTables()}
    frame = entry.queries()[name](spark, SF_SMOKE)
    derived = frame.select(*reversed(frame.columns))
    n = frame.count()
    del frame
    gc.collect()
    assert derived.count() == n  # a frame made from the query's keeps its tables
    del derived
    assert gone(spark, before)
    assert {t.name for t in spark.catalog.listTables()} == views


def test_a_failed_query_leaves_no_scratch_table(spark):
    before = tables(spark)

    def broken(session, folder):
        materialize(session.range(3), "half")
        raise KeyError(folder)

    with pytest.raises(KeyError):
        owning_scratch(broken, spark, "x")
    assert tables(spark) <= before


def test_large_rank_fit_gives_the_factors_of_spark(spark, fitted, monkeypatch):
    ratings, _ = fitted
    twice = ratings.unionByName(ratings.where("user_id < 3"))  # pairs may repeat
    est = factors.als(rank=24, max_iter=3, reg_param=REG, blocks=4)  # users have 15 or 30 ratings
    assert not factors._large(est) and factors._large(factors.als()) and not factors._large(factors.als(implicit_prefs=True))
    plain = factors.fit(est, twice).model
    monkeypatch.setattr(factors, "LARGE_RANK", 24)
    monkeypatch.setattr(type(est), "fit", lambda self, df, f=type(est).fit: pytest.fail("iterated") if self.getMaxIter() else f(self, df))
    found = factors.fit(est, twice).model
    for side in ("userFactors", "itemFactors"):
        want, got = ({r["id"]: r["features"] for r in getattr(m, side).collect()} for m in (plain, found))
        assert want.keys() == got.keys()
        assert max(np.abs(np.subtract(want[i], got[i])).max() for i in want) < 1e-4
    assert found.rank == 24 and factors.predict(found, ratings).count() == 900


def test_large_rank_predictions_join_no_vector_to_a_pair(spark, fitted, monkeypatch):
    ratings, model = fitted
    pairs = ratings.withColumn("at", F.current_timestamp()).unionByName(
        spark.createDataFrame([(999, 1.0, 0.5), (1, 999.0, None), (1, 1.0, None), (1, 1.0, None)], ratings.schema), allowMissingColumns=True
    )
    rows = lambda df: sorted((r["user_id"], r["recording_id_index"], str(r["avg_rating"]), str(r["prediction"])) for r in df.collect())
    everything = model.copy().setColdStartStrategy("nan")
    want, whole = model.transform(pairs), rows(everything.transform(pairs))
    want, schema = rows(want), want.schema.simpleString()
    monkeypatch.setattr(factors, "LARGE_RANK", 8)
    monkeypatch.setattr(type(model), "transform", lambda *a: pytest.fail("joined"))
    found = factors.predict(model, pairs)
    assert rows(found) == want and len(want) < len(whole) and found.schema.simpleString() == schema
    assert rows(factors.predict(everything, pairs)) == whole
    assert factors.predict(model, pairs.limit(0)).count() == 0
    for wrong in (None, 1.5):
        with pytest.raises(Exception, match="must be integers"):
            factors.predict(model, spark.createDataFrame([(1, wrong, 0.5)], ratings.schema)).collect()


def test_vectors_travel_as_bytes(spark, fitted, monkeypatch):
    from encore.operators import leastsq, vectors

    ratings, model = fitted
    packed = vectors.pack(model.userFactors)
    assert dict(packed.dtypes)["features"] == "binary"
    assert sorted(vectors.unpack(packed).collect()) == sorted(model.userFactors.collect())
    needed = leastsq._needed(ratings.selectExpr("user_id u", "int(recording_id_index) i", "float(avg_rating) r"), "u", "i", 3, "needed")
    assert dict(leastsq._half_step(packed, needed, 3, REG, 8).dtypes)["features"] == "binary"
    # more blocks where the vectors would not fit, and the same rows
    want = sorted(fitcheck.normal_residuals(model.userFactors, model.itemFactors, ratings, REG).collect())
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 2000)
    got = sorted(fitcheck.normal_residuals(model.userFactors, model.itemFactors, ratings, REG).collect())
    assert [tuple(r)[:2] for r in got] == [tuple(r)[:2] for r in want] and np.allclose([r["scale"] for r in got], [r["scale"] for r in want])


def test_vectors_are_sent_in_waves_that_weigh_little_more_than_their_table(spark, fitted, monkeypatch):
    from encore.operators import leastsq, vectors

    assert vectors.n_waves(104, 10, 810_000, 23_200_000, 300) == (26, 10)  # 28 GB of 1 GB of vectors
    assert vectors.n_waves(10, 10, 81_000, 2_300_000, 300) == (1, 10)
    ratings, model = fitted
    odd = ratings.unionByName(ratings.where("user_id < 3")).unionByName(ratings.where("recording_id_index = 7"))
    est = factors.als(rank=24, max_iter=2, reg_param=REG, blocks=4)
    monkeypatch.setattr(factors, "LARGE_RANK", 8)
    want = factors.fit(est, odd).model
    residuals = lambda: {r["user_id"]: r for r in fitcheck.normal_residuals(model.userFactors, model.itemFactors, odd, REG).collect()}
    predicted = lambda: sorted(map(tuple, factors.predict(model, odd).collect()))
    checked, scored = residuals(), predicted()
    sent, real = [], leastsq.write_table
    for module in (leastsq, vectors):
        monkeypatch.setattr(module, "write_table", lambda df, path, mode="overwrite": sent.append((path, mode)) or real(df, path, mode))
    monkeypatch.setattr(vectors, "WAVE_BYTES", 8000)
    got = factors.fit(est, odd).model
    assert sum(mode == "append" for _, mode in sent) >= 2 * 2
    for side in ("userFactors", "itemFactors"):
        a, b = ({r["id"]: r["features"] for r in getattr(m, side).collect()} for m in (want, got))
        assert a.keys() == b.keys() and max(np.abs(np.subtract(a[i], b[i])).max() for i in a) < 1e-5
    sent.clear()
    again = residuals()
    assert len(sent) > 2 and again.keys() == checked.keys()
    assert all(again[u]["n"] == r["n"] and again[u]["scale"] == pytest.approx(r["scale"]) for u, r in checked.items())
    assert predicted() == scored
    assert factors.predict(model, odd.limit(0)).count() == 0


def test_a_search_keeps_one_pass_on_disk(spark, monkeypatch):
    rng = np.random.default_rng(9)
    users, items = rng.normal(size=(40, 6)).astype("float32"), rng.normal(size=(3000, 6)).astype("float32")
    items /= np.linalg.norm(items, axis=1, keepdims=True)  # equal norms: nobody is done before the last pass
    before, held, real = tables(spark), [], topk._search
    folder = os.path.join(ensure_checkpoint_dir(spark), "tables")

    def search(*a):  # a pass begins: which tables hold vectors
        held.append([t for t in tables(spark) - before if "features" in spark.read.parquet(f"{folder}/{t}").columns])
        return real(*a)

    monkeypatch.setattr(topk, "_search", search)
    with scratch_scope(spark):
        found = topk.top_items(factor_table(spark, users), factor_table(spark, items), 20, 1)
        assert {r["id"]: list(zip(r["items"], r["scores"])) for r in found.collect()} == brute_lists(users, items, 20)
    assert len(held) == 6 and all(len(names) <= 2 for names in held), held  # the sorted items and one pass


def test_rows_with_many_ratings_are_summed_in_parts():
    from encore.operators import leastsq

    rng = np.random.default_rng(4)
    v, r = rng.normal(size=(50, 8)).astype("float32"), rng.random(50)
    want = np.linalg.solve(v.T.astype(float) @ v + REG * 50 * np.eye(8), v.T.astype(float) @ r)
    assert np.allclose(leastsq._solve_long(v, np.arange(50), r, REG, 7), want)
    assert np.allclose(leastsq.solve_rows(v[None].astype(float), r[None], REG)[0], want)
    few = v[:5].astype(float)
    assert np.allclose(leastsq.solve_rows(few[None], r[None, :5], REG)[0], np.linalg.solve(few.T @ few + REG * 5 * np.eye(8), few.T @ r[:5]))


def test_candidates_of_a_block_are_few_and_exact():
    rng = np.random.default_rng(5)
    users, items = rng.normal(size=(40, 32)).astype("float32"), rng.normal(size=(6000, 32)).astype("float32")
    norms = np.sqrt((items.astype(float) ** 2).sum(axis=1))
    ids = np.lexsort((np.arange(6000), -norms))
    best, merged = np.full((40, 20), topk._NOTHING), []
    real = topk._merge
    topk._merge = lambda b, rows, packed: (merged.append(len(rows)), real(b, rows, packed))
    try:
        topk._search_users(best, users, np.linalg.norm(users, axis=1), ids.astype("int32"), items[ids], norms[ids])
    finally:
        topk._merge = real
    brute = brute_lists(users, items, 20)
    assert [topk._ids(row).tolist() for row in best] == [[i for i, _ in brute[u]] for u in range(40)]
    assert sum(merged) < 40 * 6000 / 5


def test_ordered_lists_carry_no_order_columns_past_their_sort(spark, monkeypatch):
    from encore.operators import ranking

    seen = []
    real = ranking.exclusive_prefix_sums
    monkeypatch.setattr(ranking, "exclusive_prefix_sums", lambda *a, **b: seen.append(real(*a, **b)) or seen[-1])
    events = spark.createDataFrame(
        [(1, 1.0, "a"), (1, 1.0, "a"), (1, 2.0, "b"), (1, 3.0, "c"), (2, 1.0, "b"), (None, 1.0, "a")], "user_id int, t double, item string"
    )
    relevant = spark.createDataFrame([("a",), ("c",)], "item string")
    got = {r["user_id"]: r for r in ranking.ordered_list_metrics(events, relevant, 3, ["t", "item"]).collect()}
    assert set(got) == {1, 2} and got[2]["map"] == 0.0 and got[2]["n_labels"] == 2  # a user without hits counts
    assert got[1]["map"] == pytest.approx((1 + 1 + 3 / 4) / 2) and got[1]["precision_at_k"] == pytest.approx(2 / 3)
    assert seen[0].columns == ["user_id", "mult", "hit_mult", "mult_before", "hit_mult_before"]
    assert ranking.ordered_list_metrics(events.limit(0), relevant, 3, ["t", "item"]).count() == 0
