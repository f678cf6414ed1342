"""Batch job with the method's three tasks.

    spark-submit run_job.py --data_dir DIR --task {1,2,3} [--version small]

1. popularity baseline: top-k on train, ranking metrics on test;
2. cross-validated ALS grid search on RMSE, each fit written when done (``--grid_run``);
3. ALS fit with fixed parameters, top-k for all users, ranking metrics.

Shared prefix: load the train and test triples, canonical listens, pruning
of each split (written to the shared checkpoint folder, because several jobs
read them). Results are printed as one JSON line and, with ``--output``,
written as Parquet: the top list (1), the grid's report (2), or every user's
recommendations as ``user_id, rank, recording_id, score`` (3).
"""

from __future__ import annotations

import argparse
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators import factors, indexing, popularity, prep, ranking, splits, tuning
from encore.session import build_session, cluster_conf, ensure_checkpoint_dir, scratch_path
from encore.sources.parquet import load_dataset, materialize, scratch_scope, side_by_side, write_table

INT_MAX = 2**31 - 1


def prepared_logs(spark: SparkSession, args) -> tuple[DataFrame, DataFrame]:
    """Canonical, pruned train and test listens, materialised."""

    def log(split: str) -> DataFrame:
        interactions, tracks, _users = load_dataset(spark, version=args.version, split=split, data_dir=args.data_dir)
        listens = prep.canonical_listens(tracks, interactions)
        return materialize(prep.prune_rare(listens, args.min_count, args.min_count), f"{split}_listens")

    train, test = side_by_side(spark, lambda: log("train"), lambda: log("test"))
    return train, test


@dataclass
class Ratings:
    """Indexed ratings of both splits and what leads back from their ids.

    ``user_col`` is ``user_id``, or ``user_index`` where ids exceed 32 bits.
    """

    train: DataFrame
    test: DataFrame
    songs: indexing.IndexModel
    users: indexing.IndexModel | None
    user_col: str

    def decode(self, recs: DataFrame) -> DataFrame:
        """Recommendations as ``user_id, rank, recording_id, score``."""
        songs = self.songs.mapping.select(
            F.col("label").alias("recording_id"), F.col("index").cast("double").alias("recording_id_index")
        )
        named = recs.join(songs, "recording_id_index")
        if self.users is not None:
            users = self.users.mapping.select(
                F.col("label").cast("long").alias("user_id"), F.col("index").cast("int").alias(self.user_col)
            )
            named = named.join(users, self.user_col)
        return named.select(
            F.col("user_id").cast("long").alias("user_id"), (F.col("pos") + 1).alias("rank"), "recording_id", "score"
        )


def ratings_tables(train: DataFrame, test: DataFrame) -> Ratings:
    """Indexed ratings of both splits; user ids are indexed when they exceed 32 bits."""
    index = indexing.fit_shared_index(train, test, "recording_id", "recording_id_index")

    def ratings(log: DataFrame, name: str) -> DataFrame:
        return materialize(prep.user_item_ratings(index.transform(log)), name)

    train_r, test_r = side_by_side(
        train.sparkSession, lambda: ratings(train, "train_ratings"), lambda: ratings(test, "test_ratings")
    )
    bounds = train_r.unionByName(test_r).agg(F.min("user_id"), F.max("user_id")).first()
    if bounds[0] is None or (bounds[0] >= 0 and bounds[1] <= INT_MAX):
        return Ratings(train_r, test_r, index, None, "user_id")
    users = factors.index_users(train_r.unionByName(test_r))
    indexed = [users.transform(df.withColumn("user_id", F.col("user_id").cast("string")), "skip") for df in (train_r, test_r)]
    return Ratings(*indexed, index, users, "user_index")


def task_popularity(train: DataFrame, test: DataFrame, args) -> dict:
    if args.time_quantile is None:
        top = materialize(popularity.recommend(train, args.k, beta=args.beta), "top")
        if args.output:
            write_table(top, args.output)
        metrics = popularity.evaluate(test, top, args.k, args.order).first().asDict()
        return {"task": 1, "order": args.order, **metrics}
    # fit on the early part of each user's train listens, score train,
    # validation (the later part) and test
    labelled = materialize(splits.label_by_time(train, args.time_quantile), "time_split")
    fit_part = labelled.where(F.col("split") == "train").drop("split")
    held_out = {
        "train": fit_part,
        "validation": labelled.where(F.col("split") == "test").drop("split"),
        "test": test,
    }
    top = materialize(popularity.recommend(fit_part, args.k, beta=args.beta), "top")
    if args.output:
        write_table(top, args.output)
    rows = popularity.evaluate_splits(held_out, top, args.k, args.order).collect()
    return {"task": 1, "order": args.order, "splits": {r["split"]: r.asDict() for r in rows}}


def estimator(spark: SparkSession, data: Ratings, args):
    return factors.als(
        rank=args.rank, max_iter=args.max_iter, reg_param=args.reg_param, alpha=args.alpha,
        implicit_prefs=args.implicit, user_col=data.user_col, blocks=args.blocks or factors.default_blocks(spark),
    )


def task_tune(spark: SparkSession, data: Ratings, args) -> dict:
    est = estimator(spark, data, args)
    grid = factors.param_grid(est, args.grid_ranks, args.grid_iters, args.grid_regs, args.grid_alphas)
    run = args.grid_run or scratch_path(spark, "grid")
    fits = tuning.grid_search(spark, data.train, est, grid, run, folds=args.folds, parallelism=args.parallelism)
    report = tuning.grid_report(fits)
    best = report.where("is_best").first().asDict()
    model = factors.fit(est.copy(grid[best["point"]]), data.train).model
    test_rmse = factors.rmse(factors.predict(model, data.test))
    if args.output:
        report.write.mode("overwrite").parquet(args.output)
    return {"task": 2, "grid_points": len(grid), "best": best, "test_rmse": test_rmse}


def task_als(spark: SparkSession, data: Ratings, args) -> dict:
    """Fit, score, and with ``--output`` write ``user_id, rank, recording_id, score`` for every user.

    With an output the lists of all users are made once and written, and the
    metrics read them; without, only users with held-out rows get a list.
    """
    fitted = factors.fit(estimator(spark, data, args), data.train)
    if args.output:
        recs = materialize(factors.recommend_all(fitted.model, args.k, user_col=data.user_col), "recommendations")
        write_table(data.decode(recs), args.output)
    else:
        held_out = data.test.select(data.user_col)
        recs = factors.recommend_for(fitted.model, held_out, args.k, user_col=data.user_col)
    per_user = factors.ranking_scores(recs, data.test, args.k, user_col=data.user_col)
    metrics = ranking.mean_metrics(per_user, args.k).first().asDict()
    test_rmse = factors.rmse(factors.predict(fitted.model, data.test))
    return {"task": 3, "fit_seconds": fitted.seconds, "test_rmse": test_rmse, **metrics}


def main(args, spark: SparkSession) -> dict:
    ensure_checkpoint_dir(spark)
    # intermediate tables are read only inside this job
    with scratch_scope(spark):
        train, test = prepared_logs(spark, args)
        if args.task == 1:
            result = task_popularity(train, test, args)
        else:
            data = ratings_tables(train, test)
            result = (task_tune if args.task == 2 else task_als)(spark, data, args)
    print(json.dumps(result, default=str))
    return result


def parse_args(argv: list[str] | None = None):
    p = argparse.ArgumentParser(description="listening-log recommender jobs")
    p.add_argument("--data_dir", required=True)
    p.add_argument("--spark_session_url", default=None, help="master URL (default: from spark-submit)")
    p.add_argument("--version", default="", help="'small' reads the _small files")
    p.add_argument("--task", type=int, choices=[1, 2, 3], default=1)
    p.add_argument("--min_count", type=int, default=20)
    p.add_argument("--k", type=int, default=100)
    p.add_argument("--beta", type=int, default=popularity.ITEM_BETA)
    p.add_argument("--order", choices=["standard", "reference"], default="standard")
    p.add_argument(
        "--time_quantile", type=float, default=None,
        help="task 1: fit on listens up to this per-user time quantile, score train/validation/test",
    )
    p.add_argument("--rank", type=int, default=factors.DEFAULT_RANK)
    p.add_argument("--max_iter", type=int, default=factors.DEFAULT_MAX_ITER)
    p.add_argument("--reg_param", type=float, default=factors.DEFAULT_REG)
    p.add_argument("--alpha", type=float, default=factors.DEFAULT_ALPHA)
    p.add_argument("--implicit", action="store_true")
    p.add_argument("--grid_ranks", type=int, nargs="+", default=[10, 100, 300])
    p.add_argument("--grid_iters", type=int, nargs="+", default=[10, 20, 30])
    p.add_argument("--grid_regs", type=float, nargs="+", default=[0.001, 0.01, 0.1])
    p.add_argument("--grid_alphas", type=float, nargs="+", default=[0.01, 0.1, 0.5, 1.0])
    p.add_argument("--blocks", type=int, default=None, help="ALS user and item blocks (default: the parallelism)")
    p.add_argument("--grid_run", default=None, help="task 2: folder of written fits; a second run over it resumes")
    p.add_argument("--folds", type=int, default=2)
    p.add_argument("--parallelism", type=int, default=2)
    p.add_argument("--output", default=None)
    p.add_argument("--input_tb", type=float, default=None, help="input size in TB: sizes shuffles and splits")
    p.add_argument("--total_cores", type=int, default=8000)
    return p.parse_args(argv)


def run(argv: list[str] | None = None) -> dict:
    arguments = parse_args(argv)
    sizing = cluster_conf(arguments.input_tb * 1e12, arguments.total_cores) if arguments.input_tb else None
    session = build_session(arguments.spark_session_url, app_name="encore-jobs", conf=sizing)
    return main(arguments, session)
