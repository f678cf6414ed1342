"""Job CLI runs and structural properties of the operators."""

import tempfile

import pytest
from pyspark.sql import functions as F

from paths import SF_SMOKE
from encore.operators import factors, indexing, prep, splits
from encore.plans import catalogue, jobs
from encore.sources import fixtures


@pytest.fixture(scope="module")
def data_dir(spark):
    folder = tempfile.mkdtemp(prefix="encore-files-")
    fixtures.write_dataset_files(spark, SF_SMOKE, folder, version="small")
    return folder


def _args(data_dir, *extra):
    return jobs.parse_args(["--data_dir", data_dir, "--version", "small", "--min_count", "2", *extra])


def test_job_popularity(spark, data_dir):
    for order in ("standard", "reference"):
        out = jobs.main(_args(data_dir, "--task", "1", "--order", order), spark)
        assert out["n_users"] > 0 and 0.0 <= out["precision_at_k"] <= 1.0


def test_job_popularity_by_split(spark, data_dir):
    out = jobs.main(_args(data_dir, "--task", "1", "--order", "reference", "--time_quantile", "0.8"), spark)
    assert set(out["splits"]) == {"train", "validation", "test"}
    assert all(v["n_users"] > 0 for v in out["splits"].values())


def test_job_als(spark, data_dir):
    out = jobs.main(_args(data_dir, "--task", "3", "--rank", "4", "--max_iter", "2", "--k", "10"), spark)
    assert out["n_users"] > 0 and out["fit_seconds"] > 0 and out["test_rmse"] >= 0


def test_job_tuning(spark, data_dir):
    out = jobs.main(
        _args(
            data_dir, "--task", "2", "--rank", "3", "--max_iter", "2",
            "--grid_ranks", "2", "3", "--grid_iters", "2", "--grid_regs", "0.1",
        ),
        spark,
    )
    # alpha is inert for explicit ALS, so it is not a grid axis
    assert out["grid_points"] == 2 and out["best"]["rank"] in (2, 3)


def test_launcher_runs_every_task_and_its_output_is_decoded(spark, tmp_path):
    """As a user starts it: a process of its own, over user ids beyond 32 bits."""
    import json
    import os
    import subprocess
    import sys

    from paths import ROOT

    wide = 1 << 40
    fixtures.write_dataset_files(spark, SF_SMOKE, str(tmp_path / "small"), version="")
    data = str(tmp_path / "wide")
    for name in os.listdir(tmp_path / "small"):
        df = spark.read.parquet(str(tmp_path / "small" / name))
        if "interactions" in name:
            df = df.withColumn("user_id", F.col("user_id") + wide)
        df.write.parquet(f"{data}/{name}")
    users = {r[0] for r in spark.read.parquet(f"{data}/interactions_train.parquet").select("user_id").distinct().collect()}
    common = ["--data_dir", data, "--min_count", "2", "--spark_session_url", "local[2]"]
    small = ["--rank", "3", "--max_iter", "2", "--k", "5", "--blocks", "2"]
    grid = ["--grid_ranks", "2", "--grid_iters", "1", "2", "--grid_regs", "0.1"]
    for task, flags in ((1, ["--k", "5"]), (2, [*small, *grid]), (3, small)):
        out = str(tmp_path / f"out{task}")
        done = subprocess.run(
            [sys.executable, f"{ROOT}/run_job.py", *common, "--task", str(task), "--output", out, *flags],
            capture_output=True, text=True, timeout=400, cwd=tmp_path,
        )
        assert done.returncode == 0, done.stderr[-2000:]
        assert json.loads(done.stdout.strip().splitlines()[-1])["task"] == task
        written = spark.read.parquet(out)
        if task == 1:
            assert written.columns == ["rank", "recording_id", "combined_score"] and written.count() == 5
        elif task == 2:
            assert written.count() == 2
        else:
            rows = written.collect()
            assert written.columns == ["user_id", "rank", "recording_id", "score"]
            assert {r["user_id"] for r in rows} <= users and all(r["recording_id"][:4] in ("mbid", "msid") for r in rows)
            assert {r["rank"] for r in rows} == {1, 2, 3, 4, 5}


def test_grid_has_the_points_of_the_method(spark):
    args = jobs.parse_args(["--data_dir", "d"])
    axes = (args.grid_ranks, args.grid_iters, args.grid_regs, args.grid_alphas)
    assert len(factors.param_grid(factors.als(), *axes)) == 27
    assert len(factors.param_grid(factors.als(implicit_prefs=True), *axes)) == 108


def test_threshold_and_fraction_are_exact(spark):
    import random

    rng = random.Random(7)
    rows = [(u, float(rng.randrange(50))) for u in range(40) for _ in range(rng.randrange(1, 60))]
    listens = spark.createDataFrame(rows, "user_id long, timestamp double")
    for q in (0.1, 0.5, 0.8, 1.0):
        got = {r["user_id"]: r["threshold"] for r in splits.time_thresholds(listens, q).collect()}
        for user in range(40):
            times = sorted(t for u, t in rows if u == user)
            rank = max(1, len(times) - int(len(times) - q * len(times)))
            assert got[user] == times[rank - 1]
    ids = spark.range(200_000).withColumnRenamed("id", "user_id")
    for fraction in (0.004, 0.805):
        share = splits.split_by_user(ids, fraction)[0].count() / 200_000
        assert abs(share - fraction) < 0.003


def test_scratch_scope_are_dropped(spark):
    import os

    from encore.sources.parquet import materialize, scratch_scope

    kept = materialize(spark.range(3), "kept")
    with scratch_scope(spark):
        df = materialize(spark.range(5), "probe")
        path = df.inputFiles()[0].replace("file:", "")
        assert df.count() == 5 and os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path))
    assert kept.count() == 3  # written before the block: untouched


def test_splits_partition_the_log(spark):
    listens = catalogue.listens(spark, SF_SMOKE)
    n = listens.count()
    for train, test in (splits.split_by_time(listens, 0.6), splits.split_by_user(listens, 0.8)):
        assert train.count() + test.count() == n
        assert train.intersect(test).count() == 0
    tr, te = splits.split_by_user(listens, 0.8)
    assert tr.select("user_id").distinct().join(te.select("user_id").distinct(), "user_id").count() == 0


def test_prune_bounds_hold_for_users(spark):
    listens = catalogue.listens(spark, SF_SMOKE)
    pruned = prep.prune_rare(listens, 5, 5)
    low = pruned.groupBy("user_id").agg(F.countDistinct("recording_id").alias("n")).where("n <= 5").count()
    assert low == 0


def test_ratings_sum_to_one(spark):
    ratings = catalogue.ratings(spark, SF_SMOKE, "train")
    off = ratings.groupBy("user_id").agg(F.sum("avg_rating").alias("s")).where(F.abs(F.col("s") - 1) > 1e-9).count()
    assert off == 0


def test_als_outputs(spark):
    train, _ = catalogue.ratings_pair(spark, SF_SMOKE)
    fitted = factors.fit(factors.als(rank=4, max_iter=3), train)
    recs = factors.recommend_all(fitted.model, 5)
    # at most k distinct items per user, in descending score
    per_user = recs.groupBy("user_id").agg(
        F.count("*").alias("n"), F.countDistinct("recording_id_index").alias("d"),
        F.sort_array(F.collect_list(F.struct("pos", "score"))).alias("ps"),
    ).collect()
    for r in per_user:
        assert r["n"] == r["d"] <= 5
        scores = [x["score"] for x in r["ps"]]
        assert scores == sorted(scores, reverse=True)
    # unknown ids are dropped by the cold-start strategy
    unknown = spark.createDataFrame([(10**6, 0.5, 10**6 * 1.0)], "user_id long, avg_rating double, recording_id_index double")
    assert factors.predict(fitted.model, unknown).count() == 0
    arrays = factors.prediction_arrays(fitted.model.recommendForAllUsers(3))
    assert dict(arrays.dtypes)["predictions"] == "array<double>"


def test_index_round_trip(spark, tmp_path):
    listens = catalogue.listens(spark, SF_SMOKE)
    model = indexing.fit_index(listens, "recording_id")
    path = model.save(str(tmp_path / "idx"))
    again = indexing.IndexModel.load(spark, path, "recording_id", "recording_id_index")
    a = sorted(model.mapping.select("label", "index").collect())
    b = sorted(again.mapping.select("label", "index").collect())
    assert a == b
