"""The query catalogue: every operator as a query over the driver's tables.

``QUERIES[name]`` is ``(build, sql)``: ``build(spark, sf_dir)`` returns the
Spark DataFrame, ``sql`` the DuckDB twin (``None`` for model outputs, which
are checked by properties in the tests instead). Doubles are rounded to
``DECIMALS`` places on both sides.

Fixed parameters of the catalogue: the whole log is pruned at 20, the train
and test logs at 5 each (the test log at 20 would be empty); top lists and
metrics use k = 100; the time split uses the exact 0.8 quantile; the user
split keeps the hash points below 0.8 in train; ALS runs at the method's rank
of 300 for 10 iterations.

Factors differ from build to build in their last digits, so the model queries
with a twin fit on all ratings and return what the method determines: that the
factors solve every user's equations, which pairs are predicted, whom a list
belongs to and what may stand in it, which grid points and models are compared,
and whether the figures are in range. The ``_rows`` and ``_value`` queries return
the lists, errors, metrics and reports themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.operators import factors, fitcheck, indexing, popularity, prep, profiling, ranking, splits, tuning
from encore.plans import oracle as O
from encore.session import kept_path, scratch_path
from encore.sources import fixtures
from encore.sources.parquet import (
    file_states,
    load_dataset,
    materialize,
    path_exists,
    read_table,
    scratch_scope,
    side_by_side,
    write_table,
)

DECIMALS = O.DECIMALS
K = 100
LOG_BOUND = 20
SPLIT_BOUND = 5
TIME_QUANTILE = 0.8
USER_FRACTION = 0.8
LOOKUP_USER = 53
ALS_RANK = factors.DEFAULT_RANK
ALS_ITER = factors.DEFAULT_MAX_ITER
# the method's grid at its smallest rank and number of iterations; the job runs all 27 points
GRID_RANKS, GRID_ITERS, GRID_REGS = [10], [10], [0.001, 0.01, 0.1]
GRID_FOLDS, GRID_PARALLELISM = 2, 4
COMPARE_RANK, COMPARE_ITER = 10, 10
COMPARE_FRACTIONS = (0.5, 1.0)
ALS_REG = 0.01
ALS_SEED = 42


# ------------------------------------------------------------ shared frames


def listens(spark: SparkSession, sf: str, split: str | None = None) -> DataFrame:
    return prep.canonical_listens(fixtures.tracks(spark, sf), fixtures.interactions(spark, sf, split))


def pruned(spark: SparkSession, sf: str, split: str) -> DataFrame:
    return prep.prune_rare(listens(spark, sf, split), SPLIT_BOUND, SPLIT_BOUND)


def written_logs(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Pruned train and test logs written to the shared checkpoint folder.

    For queries that read a pruned log more than once (the index fit and
    the ratings built with it), so the pruning runs once per split.
    """
    builds = [lambda s=split: materialize(pruned(spark, sf, s), f"{s}_listens") for split in ("train", "test")]
    return dict(zip(("train", "test"), side_by_side(spark, *builds)))


def song_index(spark: SparkSession, sf: str, logs: dict[str, DataFrame] | None = None) -> indexing.IndexModel:
    logs = logs or written_logs(spark, sf)
    return indexing.fit_shared_index(logs["train"], logs["test"], "recording_id", "recording_id_index")


def indexed_logs(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Written train and test logs with the shared song index applied."""
    logs = written_logs(spark, sf)
    index = song_index(spark, sf, logs)
    return {split: index.transform(logs[split]) for split in ("train", "test")}


def ratings_pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Train and test ratings over one shared index, from written logs."""
    logs = indexed_logs(spark, sf)
    return tuple(side_by_side(spark, *[lambda s=split: prep.user_item_ratings(logs[s]) for split in ("train", "test")]))


def ratings(spark: SparkSession, sf: str, split: str) -> DataFrame:
    """Ratings of one split; the other split's log is needed for the shared index only."""
    return prep.user_item_ratings(indexed_logs(spark, sf)[split])


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.round(c, DECIMALS).alias(c) if c in cols else F.col(c) for c in df.columns])


def test_and_top(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The pruned test log and the train log's top list."""
    return tuple(side_by_side(spark, lambda: pruned(spark, sf, "test"), lambda: train_top(spark, sf)))


def train_top(spark: SparkSession, sf: str) -> DataFrame:
    return popularity.recommend(pruned(spark, sf, "train"), K)


# -------------------------------------------------------------- builders


def q_canonical_listens(spark, sf):
    return listens(spark, sf)


def q_filter_low_interactions(spark, sf):
    return prep.prune_rare(listens(spark, sf), LOG_BOUND, LOG_BOUND)


def _time_split(spark, sf, part):
    train, test = splits.split_by_time(listens(spark, sf), TIME_QUANTILE)
    return train if part == "train" else test


def _user_split(spark, sf, part):
    train, test = splits.split_by_user(listens(spark, sf), USER_FRACTION)
    return train if part == "train" else test


def q_song_index(spark, sf):
    return song_index(spark, sf).mapping.select(
        F.col("label").alias("recording_id"), F.col("index").cast("double").alias("recording_id_index")
    )


def q_train_test_union(spark, sf):
    both = side_by_side(spark, lambda: pruned(spark, sf, "train"), lambda: pruned(spark, sf, "test"))
    return prep.combine_splits(*both)


def q_user_item_ratings(spark, sf):
    return rounded(ratings(spark, sf, "train"), "avg_rating")


def q_known_test_rows(spark, sf):
    train, test = ratings_pair(spark, sf)
    return rounded(prep.known_test_rows(train, test), "avg_rating")


def q_unseen_test_ids(spark, sf):
    train, test = ratings_pair(spark, sf)
    return prep.unseen_report(train, test)


def q_id_profile(spark, sf):
    return prep.id_profile(listens(spark, sf), "user_id")


def q_ratings_id_profile(spark, sf):
    return prep.ratings_profile(ratings(spark, sf, "train"))


def q_user_lookup(spark, sf):
    rows = prep.lookup_user(ratings(spark, sf, "train"), LOOKUP_USER)
    return rows.select(
        F.col("user_id").cast("int").alias("user_id"),
        F.round("avg_rating", DECIMALS).alias("avg_rating"),
        F.col("recording_id_index").cast("int").alias("recording_id_index"),
    )


def q_song_play_counts(spark, sf):
    return profiling.song_play_counts(listens(spark, sf))


def q_user_play_counts(spark, sf):
    return profiling.user_play_counts(listens(spark, sf))


def q_listen_stats(spark, sf):
    return rounded(profiling.listen_stats(listens(spark, sf)), "mean", "stddev")


def q_listener_histogram(spark, sf):
    return profiling.listener_histogram(listens(spark, sf))


def q_global_bias(spark, sf):
    return rounded(popularity.global_bias_frame(pruned(spark, sf, "train")), "global_bias")


def q_popularity_scores(spark, sf):
    scores = popularity.popularity_scores(pruned(spark, sf, "train"))
    return rounded(scores, "naive_score", "normalized_unique_users", "normalized_score", "combined_score")


def q_popular_top100(spark, sf):
    return rounded(train_top(spark, sf), "combined_score")


def q_popularity_metrics(spark, sf):
    return popularity.evaluate(*test_and_top(spark, sf), K, "standard", DECIMALS)


def q_popularity_metrics_reference_order(spark, sf):
    return popularity.evaluate(*test_and_top(spark, sf), K, "reference", DECIMALS)


def q_popularity_precision_by_user(spark, sf):
    per_user = popularity.per_user_scores(*test_and_top(spark, sf), K, "standard")
    return rounded(per_user, *ranking.METRIC_COLUMNS)


def q_popularity_metrics_by_split(spark, sf):
    labelled, test = side_by_side(
        spark,
        # written, as the thresholds and the labels both read it
        lambda: materialize(splits.label_by_time(materialize(pruned(spark, sf, "train"), "train_listens"), TIME_QUANTILE), "time_split"),
        lambda: pruned(spark, sf, "test"),
    )
    train = labelled.where(F.col("split") == "train").drop("split")
    validation = labelled.where(F.col("split") == "test").drop("split")
    top = popularity.recommend(train, K)
    held_out = {"train": train, "validation": validation, "test": test}
    return popularity.evaluate_splits(held_out, top, K, "reference", DECIMALS)


def q_ground_truth(spark, sf):
    """The sorted rows with their place in the sort, so that the order itself is compared."""
    truth = rounded(ratings(spark, sf, "test"), "avg_rating")
    return indexing.dense_ranks(truth, factors.ground_truth_order(), "place")


def q_parquet_round_trip(spark, sf):
    path = scratch_path(spark, "train_ratings")
    write_table(ratings(spark, sf, "train"), path)
    return rounded(read_table(spark, path), "avg_rating")


def q_loaded_listens(spark, sf):
    folder = scratch_path(spark, "dataset")
    fixtures.write_dataset_files(spark, sf, folder, version="")
    inter, trk, _users = load_dataset(spark, version="", split="train", data_dir=folder)
    return prep.canonical_listens(trk, inter)


def q_index_round_trip(spark, sf):
    logs = written_logs(spark, sf)
    path = scratch_path(spark, "song_index")
    song_index(spark, sf, logs).save(path)
    loaded = indexing.IndexModel.load(spark, path, "recording_id", "recording_id_index")
    return loaded.transform(logs["test"])


# ---------------------------------------------------------- model queries


def _kept(spark: SparkSession, sf: str, name: str, parameters: str, write: Callable[[str], None]) -> str:
    """The folder of a long run's tables over ``sf``, written by ``write`` unless it is complete.

    The key holds the parameters and the input files with their sizes and
    times, so a later process over the same tables finds the run, and changed
    tables or parameters start another.
    """
    files = [f for table in ("lineitem", "orders", "part") for f in file_states(spark, f"{sf}/{table}.parquet")]
    key = hashlib.md5("\n".join([parameters, *files]).encode()).hexdigest()
    folder = kept_path(spark, f"{name}-{key}")
    if not path_exists(spark, f"{folder}/done/_SUCCESS"):
        write(folder)
        write_table(spark.range(1), f"{folder}/done")
    return folder


def _als_fit(spark: SparkSession, sf: str) -> tuple[ALSModel, DataFrame, DataFrame]:
    """The fitted model with its train and test ratings, from written tables.

    The first model query over a folder fits and writes; the others, and later
    processes with the same checkpoint folder, read what it wrote.
    """

    def write(folder: str) -> None:
        with scratch_scope(spark):
            for part, name in zip(ratings_pair(spark, sf), ("train", "test")):
                write_table(part, f"{folder}/{name}")
        estimator = factors.als(
            rank=ALS_RANK, max_iter=ALS_ITER, reg_param=ALS_REG, seed=ALS_SEED, blocks=factors.default_blocks(spark)
        )
        with scratch_scope(spark):
            fitted = factors.fit(estimator, read_table(spark, f"{folder}/train"))
            fitted.model.write().overwrite().save(f"{folder}/model")

    folder = _kept(spark, sf, "als", f"{ALS_RANK} {ALS_ITER} {ALS_REG} {ALS_SEED}", write)
    return ALSModel.load(f"{folder}/model"), read_table(spark, f"{folder}/train"), read_table(spark, f"{folder}/test")


def _list_facts(recs: DataFrame, train: DataFrame) -> DataFrame:
    """Per user of a recommendation list: its length, different items, order, and items not in train."""
    known = materialize(train.select("recording_id_index").distinct().withColumn("known", F.lit(1)), "known")
    by_place = F.sort_array(F.collect_list(F.struct("pos", "score")))
    falls = F.forall(
        F.sequence(F.lit(1), F.size("list")), lambda i: (i == 1) | (F.get("list", i - 2)["score"] >= F.get("list", i - 1)["score"])
    )
    return (
        recs.join(known, "recording_id_index", "left")
        .groupBy("user_id")
        .agg(
            F.count("*").alias("n"),
            F.countDistinct("recording_id_index").alias("n_items"),
            F.count_if(F.col("known").isNull()).alias("n_unknown"),
            by_place.alias("list"),
        )
        .select(F.col("user_id").cast("long").alias("user_id"), "n", "n_items", "n_unknown", falls.alias("descending"))
    )


def q_als_recommendations(spark, sf):
    model, train, _ = _als_fit(spark, sf)
    return _list_facts(factors.recommend_all(model, K), train)


def q_als_subset_recommendations(spark, sf):
    model, train, test = _als_fit(spark, sf)
    return _list_facts(factors.recommend_for(model, test.select("user_id"), K), train)


def q_als_predicted_pairs(spark, sf):
    model, _, test = _als_fit(spark, sf)
    found = factors.predict(model, test)
    return found.where(F.col("prediction").isNotNull() & ~F.isnan("prediction")).select(
        F.col("user_id").cast("long").alias("user_id"),
        F.col("recording_id_index").cast("double").alias("recording_id_index"),
    )


def q_als_fit_residual(spark, sf):
    """Every user's normal equations hold for the saved factors: no user is left unsolved."""
    model, train, _ = _als_fit(spark, sf)
    residuals = fitcheck.normal_residuals(model.userFactors, model.itemFactors, train, ALS_REG)
    return fitcheck.fit_report(residuals).select("n_users", "n_ratings", "n_unsolved")


def q_als_recommendation_rows(spark, sf):
    """The lists themselves: user, place, song and score."""
    model, _, _ = _als_fit(spark, sf)
    return factors.recommend_all(model, K)


def q_als_rmse_value(spark, sf):
    model, _, test = _als_fit(spark, sf)
    return factors.rmse_frame(factors.predict(model, test))


def q_als_metric_values(spark, sf):
    model, _, test = _als_fit(spark, sf)
    recs = factors.recommend_for(model, test.select("user_id"), K)
    return ranking.mean_metrics(factors.ranking_scores(recs, test, K), K)


def q_als_fold_sizes(spark, sf):
    """Ratings, users and songs of each fold of the grid search."""
    train = ratings(spark, sf, "train").withColumn("fold", tuning.fold_of(GRID_FOLDS))
    return train.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("recording_id_index").alias("n_items"),
    )


def q_als_rmse(spark, sf):
    model, _, test = _als_fit(spark, sf)
    frame = factors.rmse_frame(factors.predict(model, test))
    return frame.select("n", F.col("rmse").between(0.0, 1.0).alias("rmse_in_range"))


def q_rmse_of_user_mean(spark, sf):
    """E5 on a predictor that SQL knows: a user's mean rating in train."""
    train, test = ratings_pair(spark, sf)
    mean = materialize(train.groupBy("user_id").agg(F.avg("avg_rating").alias("prediction")), "user_mean")
    return rounded(factors.rmse_frame(test.join(mean, "user_id")), "rmse")


def _metric_facts(row: DataFrame) -> DataFrame:
    inside = F.lit(True)
    for name in ("precision_at_k", "map", "map_at_k", "ndcg_at_k"):
        inside = inside & F.col(name).between(0.0, 1.0)
    return row.select("k", "n_users", inside.alias("metrics_in_range"))


def q_als_metrics(spark, sf):
    model, _, test = _als_fit(spark, sf)
    recs = factors.recommend_for(model, test.select("user_id"), K)
    return _metric_facts(ranking.mean_metrics(factors.ranking_scores(recs, test, K), K, DECIMALS))


def q_als_metrics_sql(spark, sf):
    model, _, test = _als_fit(spark, sf)
    recs = factors.recommend_for(model, test.select("user_id"), K)
    return _metric_facts(ranking.mean_metrics(factors.ranking_scores_sql(spark, recs, test, K), K, DECIMALS))


def _fixed_lists(train: DataFrame) -> DataFrame:
    """A list for each user that SQL knows too: the user's own items, best rated first, K at most."""
    order = Window.partitionBy("user_id").orderBy(F.round("avg_rating", 10).desc(), F.col("recording_id_index").asc())
    # a user's items, written down to K: the window's groups are bounded by the songs; the metrics read them twice
    lists = (
        train.withColumn("pos", F.row_number().over(order) - 1)
        .where(F.col("pos") < K)
        .select("user_id", F.col("pos").cast("long").alias("pos"), "recording_id_index", F.col("avg_rating").alias("score"))
    )
    return materialize(lists, "fixed_lists")


def q_fixed_list_metrics(spark, sf):
    train, test = ratings_pair(spark, sf)
    return ranking.mean_metrics(factors.ranking_scores(_fixed_lists(train), test, K), K, DECIMALS)


def q_fixed_list_metrics_sql(spark, sf):
    train, test = ratings_pair(spark, sf)
    return ranking.mean_metrics(factors.ranking_scores_sql(spark, _fixed_lists(train), test, K), K, DECIMALS)


def _array_facts(pairs: DataFrame) -> DataFrame:
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("long").cast("string")), ",")
    return pairs.select(
        F.col("user_id").cast("long").alias("user_id"),
        F.size("predictions").alias("n_predictions"),
        F.size("scores").alias("n_scores"),
        text(F.col("true_positives")).alias("true_positives"),
    )


def q_als_prediction_arrays(spark, sf):
    model, _, test = _als_fit(spark, sf)
    path = scratch_path(spark, "predictions")
    arrays = factors.prediction_arrays(factors.recommendation_arrays(model, K, test.select("user_id")))
    write_table(factors.ranking_pairs(arrays, test), path)
    return _array_facts(read_table(spark, path))


def _grid_report(spark: SparkSession, sf: str) -> DataFrame:
    """The grid's report, from the fits that are written one by one as they end."""
    est = factors.als(seed=ALS_SEED, blocks=factors.default_blocks(spark))
    grid = factors.param_grid(est, GRID_RANKS, GRID_ITERS, GRID_REGS)

    def write(folder: str) -> None:
        with scratch_scope(spark):
            train = materialize(ratings(spark, sf, "train"), "grid_train")
            fits = tuning.grid_search(spark, train, est, grid, f"{folder}/fits", GRID_FOLDS, GRID_PARALLELISM)
            write_table(tuning.grid_report(fits), f"{folder}/report")

    parameters = f"{GRID_RANKS} {GRID_ITERS} {GRID_REGS} {GRID_FOLDS} {ALS_SEED}"
    return read_table(spark, _kept(spark, sf, "grid", parameters, write) + "/report")


def q_als_grid(spark, sf):
    report = _grid_report(spark, sf)
    least = report.agg(F.min("rmse")).scalar()
    return report.select(
        "rank",
        "max_iter",
        "reg_param",
        "alpha",
        "n_held",
        F.col("rmse").between(0.0, 1.0).alias("rmse_in_range"),
        (F.col("is_best") == (F.col("rmse") == least)).alias("best_is_least"),
    )


def q_als_grid_rows(spark, sf):
    return _grid_report(spark, sf)


def _comparison(spark: SparkSession, sf: str) -> DataFrame:
    from encore.plans.compare import compare_models

    def write(folder: str) -> None:
        with scratch_scope(spark):
            logs = indexed_logs(spark, sf)
            train, test = (materialize(prep.user_item_ratings(logs[s]), f"compare_{s}") for s in ("train", "test"))
            report = compare_models(
                spark, train, test, fractions=COMPARE_FRACTIONS, k=K, rank=COMPARE_RANK, max_iter=COMPARE_ITER,
                train_listens=logs["train"],
            )
            write_table(report, f"{folder}/report")

    parameters = f"{COMPARE_FRACTIONS} {K} {COMPARE_RANK} {COMPARE_ITER}"
    return read_table(spark, _kept(spark, sf, "comparison", parameters, write) + "/report")


def q_model_comparison(spark, sf):
    popular = F.col("model") == "popularity"
    return _comparison(spark, sf).select(
        "model",
        "fraction",
        "n_ratings",
        "n_users",
        (F.col("fit_seconds") > 0).alias("timed"),
        F.when(popular, F.round("precision_at_k", DECIMALS)).alias("precision_at_k"),
        F.when(popular, F.round("map", DECIMALS)).alias("map"),
    )


def q_model_comparison_rows(spark, sf):
    return _comparison(spark, sf)


# ------------------------------------------------------------------- SQL


def _sql_listens(src: str) -> str:
    return O.with_(O.BASE) + f'SELECT user_id, "timestamp", recording_id FROM {src}'


def _sql_pruned_log() -> str:
    return O.with_(O.BASE, O.prune("listens", "pruned", LOG_BOUND)) + 'SELECT user_id, "timestamp", recording_id FROM pruned'


def _sql_time_split(op: str) -> str:
    return O.with_(
        O.BASE,
        f'thr AS (SELECT user_id, quantile_disc("timestamp", {TIME_QUANTILE}) AS threshold FROM listens GROUP BY user_id)',
    ) + f'SELECT l.user_id, l."timestamp", l.recording_id FROM listens l JOIN thr ON l.user_id = thr.user_id WHERE l."timestamp" {op} thr.threshold'


def _sql_user_split(op: str) -> str:
    point = "(('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 13))::BIGINT / CAST(power(2, 52) AS DOUBLE))"
    return O.with_(O.BASE) + f'SELECT user_id, "timestamp", recording_id FROM listens WHERE {point} {op} {USER_FRACTION}::DOUBLE'


_SPLITS = O.pruned_splits(SPLIT_BOUND)
_RATINGS = [O.BASE, _SPLITS, O.SONG_INDEX, O.ratings("train5"), O.ratings("test5")]


def _r(col: str) -> str:
    return f"round({col}, {DECIMALS}) AS {col}"


SQL: dict[str, str] = {
    "canonical_listens": _sql_listens("listens"),
    "filter_low_interactions": _sql_pruned_log(),
    "split_time_train": _sql_time_split("<="),
    "split_time_test": _sql_time_split(">"),
    "split_user_train": _sql_user_split("<"),
    "split_user_test": _sql_user_split(">="),
    "song_index": O.with_(O.BASE, _SPLITS, O.SONG_INDEX) + "SELECT recording_id, recording_id_index FROM song_index",
    "train_test_union": O.with_(O.BASE, _SPLITS)
    + 'SELECT user_id, "timestamp", recording_id FROM train5 UNION ALL SELECT user_id, "timestamp", recording_id FROM test5',
    "user_item_ratings": O.with_(*_RATINGS) + f"SELECT user_id, {_r('avg_rating')}, recording_id_index FROM train5_ratings",
    "known_test_rows": O.with_(*_RATINGS)
    + f"""SELECT user_id, {_r('avg_rating')}, recording_id_index FROM test5_ratings
WHERE user_id IN (SELECT user_id FROM train5_ratings)
  AND recording_id_index IN (SELECT recording_id_index FROM train5_ratings)""",
    "unseen_test_ids": O.with_(
        *_RATINGS,
        """u AS (SELECT count(*) AS n FROM (SELECT DISTINCT user_id FROM test5_ratings
                 WHERE user_id NOT IN (SELECT user_id FROM train5_ratings)))""",
        """i AS (SELECT count(*) AS n FROM (SELECT DISTINCT recording_id_index FROM test5_ratings
                 WHERE recording_id_index NOT IN (SELECT recording_id_index FROM train5_ratings)))""",
    )
    + """SELECT u.n AS unseen_users, i.n AS unseen_items, u.n > 0 AS has_unseen_users, i.n > 0 AS has_unseen_items
FROM u, i""",
    "id_profile": O.with_(O.BASE) + 'SELECT min(user_id) AS "min", max(user_id) AS "max", count(user_id) AS "count" FROM listens',
    "ratings_id_profile": O.with_(*_RATINGS)
    + """SELECT min(user_id) AS "min", max(user_id) AS "max", count(user_id) AS "count",
       max(recording_id_index) AS max_item_index FROM train5_ratings""",
    "user_lookup": O.with_(*_RATINGS)
    + f"""SELECT CAST(user_id AS INTEGER) AS user_id, {_r('avg_rating')},
       CAST(recording_id_index AS INTEGER) AS recording_id_index
FROM train5_ratings WHERE user_id = {LOOKUP_USER}""",
    "song_play_counts": O.with_(O.BASE)
    + """SELECT recording_id, count(user_id) AS user_count, count(DISTINCT user_id) AS unique_user_count
FROM listens GROUP BY recording_id""",
    "user_play_counts": O.with_(O.BASE)
    + """SELECT user_id, count(recording_id) AS interaction_count, count(DISTINCT recording_id) AS unique_interaction_count
FROM listens GROUP BY user_id""",
    "listen_stats": O.with_(
        O.BASE,
        """per_song AS (SELECT recording_id, count(user_id) AS a, count(DISTINCT user_id) AS b FROM listens GROUP BY recording_id)""",
        """per_user AS (SELECT user_id, count(recording_id) AS a, count(DISTINCT recording_id) AS b FROM listens GROUP BY user_id)""",
    )
    + f"""SELECT 'users_per_interaction' AS "Metric", round(avg(a), {DECIMALS}) AS mean, round(stddev_samp(a), {DECIMALS}) AS stddev, CAST(min(a) AS BIGINT) AS "min", CAST(max(a) AS BIGINT) AS "max" FROM per_song
UNION ALL SELECT 'unique_users_per_interaction', round(avg(b), {DECIMALS}), round(stddev_samp(b), {DECIMALS}), CAST(min(b) AS BIGINT), CAST(max(b) AS BIGINT) FROM per_song
UNION ALL SELECT 'interactions_per_user', round(avg(a), {DECIMALS}), round(stddev_samp(a), {DECIMALS}), CAST(min(a) AS BIGINT), CAST(max(a) AS BIGINT) FROM per_user
UNION ALL SELECT 'unique_interactions_per_user', round(avg(b), {DECIMALS}), round(stddev_samp(b), {DECIMALS}), CAST(min(b) AS BIGINT), CAST(max(b) AS BIGINT) FROM per_user""",
    "listener_histogram": O.with_(
        O.BASE,
        "per_song AS (SELECT recording_id, count(DISTINCT user_id) AS c FROM listens GROUP BY recording_id)",
    )
    + """SELECT CAST(c - (SELECT min(c) FROM per_song) AS DOUBLE) AS buckets, CAST(c AS BIGINT) AS unique_user_count,
       count(*) AS frequency
FROM per_song GROUP BY c ORDER BY buckets""",
    "global_bias": O.with_(O.BASE, _SPLITS)
    + f"""SELECT count(*) AS total_interactions, count(DISTINCT recording_id) AS unique_interactions,
       round(CAST(count(*) AS DOUBLE) / CAST(count(DISTINCT recording_id) + 100000 AS DOUBLE), {DECIMALS}) AS global_bias
FROM train5""",
    "popularity_scores": O.with_(O.BASE, _SPLITS, O.popularity("train5"))
    + f"""SELECT recording_id, total_play_count, unique_user_count, {_r('naive_score')},
       {_r('normalized_unique_users')}, {_r('normalized_score')}, {_r('combined_score')}
FROM scores""",
    "popular_top100": O.with_(O.BASE, _SPLITS, O.popularity("train5"))
    + f"SELECT pos + 1 AS rank, recording_id, {_r('combined_score')} FROM top",
    "popularity_metrics": O.with_(
        O.BASE, _SPLITS, O.popularity("train5"), O.idcg(K), O.standard_order("test5", K), O.per_user_from_hits("hits", "users", K)
    )
    + O.mean_select(K),
    "popularity_metrics_reference_order": O.with_(
        O.BASE, _SPLITS, O.popularity("train5"), O.idcg(K), O.reference_order("test5", K), O.per_user_from_hits("hits", "users", K)
    )
    + O.mean_select(K),
    "popularity_precision_by_user": O.with_(
        O.BASE, _SPLITS, O.popularity("train5"), O.idcg(K), O.standard_order("test5", K), O.per_user_from_hits("hits", "users", K)
    )
    + f"SELECT user_id, n_labels, {_r('precision_at_k')}, {_r('map')}, {_r('map_at_k')}, {_r('ndcg_at_k')} FROM per_user",
    "ground_truth": O.with_(*_RATINGS)
    + f"""SELECT user_id, recording_id_index, {_r('avg_rating')},
       row_number() OVER (ORDER BY user_id, round(avg_rating, {DECIMALS}) DESC, recording_id_index) - 1 AS place
FROM test5_ratings""",
    "parquet_round_trip": O.with_(*_RATINGS) + f"SELECT user_id, {_r('avg_rating')}, recording_id_index FROM train5_ratings",
    "loaded_listens": _sql_listens("listens_train"),
    "index_round_trip": O.with_(O.BASE, _SPLITS, O.SONG_INDEX)
    + """SELECT t.recording_id, t.user_id, t."timestamp", s.recording_id_index
FROM test5 t JOIN song_index s ON t.recording_id = s.recording_id""",
}


def _sql_by_split() -> str:
    thr = f'thr AS (SELECT user_id, quantile_disc("timestamp", {TIME_QUANTILE}) AS threshold FROM train5 GROUP BY user_id)'
    tv = """tv AS (SELECT t.user_id, t."timestamp", t.recording_id,
                 CASE WHEN t."timestamp" <= thr.threshold THEN 'train' ELSE 'validation' END AS split
               FROM train5 t JOIN thr ON t.user_id = thr.user_id)"""
    fit = "fit_log AS (SELECT user_id, \"timestamp\", recording_id FROM tv WHERE split = 'train')"
    held = """held AS (SELECT split, user_id, "timestamp", recording_id FROM tv
                 UNION ALL SELECT 'test', user_id, "timestamp", recording_id FROM test5)"""
    pred = """pred AS (
  SELECT split, user_id, recording_id,
         row_number() OVER (PARTITION BY split, user_id ORDER BY "timestamp", recording_id) - 1 AS pos
  FROM held)"""
    users = "users AS (SELECT DISTINCT split, user_id, (SELECT count(DISTINCT recording_id) FROM top) AS n_labels FROM pred)"
    hits = """hits AS (
  SELECT p.split, p.user_id, p.pos, row_number() OVER (PARTITION BY p.split, p.user_id ORDER BY p.pos) AS cnt
  FROM pred p JOIN top t ON p.recording_id = t.recording_id)"""
    sums = f"""hit_sums AS (
  SELECT split, user_id,
         count(*) FILTER (WHERE pos < {K}) AS hk,
         sum(CAST(cnt AS DOUBLE) / (pos + 1)) AS ap,
         sum(CASE WHEN pos < {K} THEN CAST(cnt AS DOUBLE) / (pos + 1) ELSE 0.0 END) AS apk,
         sum(CASE WHEN pos < {K} THEN 1.0::DOUBLE / ln(pos + 2) ELSE 0.0 END) AS dcg
  FROM hits GROUP BY split, user_id)"""
    per_user = f"""per_user AS (
  SELECT u.split, u.user_id,
         CAST(COALESCE(h.hk, 0) AS DOUBLE) / {K} AS precision_at_k,
         COALESCE(h.ap, 0.0) / u.n_labels AS map,
         COALESCE(h.apk, 0.0) / LEAST(u.n_labels, {K}) AS map_at_k,
         COALESCE(h.dcg, 0.0) / d.v AS ndcg_at_k
  FROM users u LEFT JOIN hit_sums h ON u.split = h.split AND u.user_id = h.user_id
  LEFT JOIN idcg d ON d.n = LEAST(u.n_labels, {K}))"""
    return O.with_(O.BASE, _SPLITS, thr, tv, fit, O.popularity("fit_log"), O.idcg(K), held, pred, users, hits, sums, per_user) + O.mean_select(K, "split")


SQL["popularity_metrics_by_split"] = _sql_by_split()

_TRAIN_USERS = "(SELECT DISTINCT user_id FROM train5_ratings)"
_N_ITEMS = f"least({K}, (SELECT count(DISTINCT recording_id_index) FROM train5_ratings))"
_KNOWN = """test5_ratings WHERE user_id IN (SELECT user_id FROM train5_ratings)
  AND recording_id_index IN (SELECT recording_id_index FROM train5_ratings)"""
_LISTS = f"SELECT user_id, {_N_ITEMS} AS n, {_N_ITEMS} AS n_items, 0::BIGINT AS n_unknown, true AS descending FROM "
_FIXED = f"""
lists AS (
  SELECT user_id, recording_id_index, row_number() OVER (PARTITION BY user_id
    ORDER BY round(avg_rating, 10) DESC, recording_id_index) - 1 AS pos FROM train5_ratings),
users AS (
  SELECT user_id, count(*) AS n_labels FROM test5_ratings
  WHERE user_id IN (SELECT user_id FROM train5_ratings) GROUP BY user_id),
hits AS (
  SELECT l.user_id, l.pos, row_number() OVER (PARTITION BY l.user_id ORDER BY l.pos) AS cnt
  FROM lists l JOIN test5_ratings t ON l.user_id = t.user_id AND l.recording_id_index = t.recording_id_index
  WHERE l.pos < {K})
"""
_EVALUATED = f"SELECT {K} AS k, count(DISTINCT user_id) AS n_users, true AS metrics_in_range FROM test5_ratings WHERE user_id IN {_TRAIN_USERS}"


def _sql_comparison() -> str:
    point = "('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 13))::BIGINT / CAST(power(2, 52) AS DOUBLE)"
    parts = []
    for fraction in COMPARE_FRACTIONS:
        keep = f"{point} < {fraction}::DOUBLE" if fraction < 1 else "true"
        scored = O.with_(
            f"part AS (SELECT i.recording_id_index AS recording_id, l.user_id FROM train5 l JOIN song_index i USING (recording_id) WHERE {keep})",
            O.popularity("part"),
            f"test_part AS (SELECT user_id, recording_id_index AS recording_id FROM test5_ratings WHERE {keep})",
            O.idcg(K),
            O.standard_order("test_part", K),
            O.per_user_from_hits("hits", "users", K),
        ) + f"SELECT round(avg(precision_at_k), {DECIMALS}) AS p, round(avg(map), {DECIMALS}) AS m, count(*) AS n FROM per_user"
        n_ratings = f"(SELECT count(*) FROM train5_ratings WHERE {keep})"
        parts.append(
            f"SELECT 'popularity' AS model, {fraction}::DOUBLE AS fraction, {n_ratings} AS n_ratings, n AS n_users, "
            f"true AS timed, p AS precision_at_k, m AS map FROM ({scored})"
        )
        evaluated = f"(SELECT count(DISTINCT user_id) FROM test5_ratings WHERE {keep} AND user_id IN {_TRAIN_USERS})"
        parts += [
            f"SELECT '{model}', {fraction}::DOUBLE, {n_ratings}, {evaluated}, true, NULL::DOUBLE, NULL::DOUBLE"
            for model in ("als_explicit", "als_implicit")
        ]
    return O.with_(*_RATINGS) + " UNION ALL ".join(parts)


SQL |= {
    "als_recommendations": O.with_(*_RATINGS) + _LISTS + _TRAIN_USERS,
    "als_subset_recommendations": O.with_(*_RATINGS)
    + _LISTS
    + f"(SELECT DISTINCT user_id FROM test5_ratings WHERE user_id IN {_TRAIN_USERS})",
    "als_predicted_pairs": O.with_(*_RATINGS) + "SELECT user_id, recording_id_index FROM " + _KNOWN,
    "als_rmse": O.with_(*_RATINGS) + "SELECT count(*) AS n, true AS rmse_in_range FROM " + _KNOWN,
    "rmse_of_user_mean": O.with_(*_RATINGS)
    + f"""SELECT count(*) AS n, round(sqrt(avg((m.mean - t.avg_rating) * (m.mean - t.avg_rating))), {DECIMALS}) AS rmse
FROM test5_ratings t JOIN (SELECT user_id, avg(avg_rating) AS mean FROM train5_ratings GROUP BY user_id) m ON t.user_id = m.user_id""",
    "als_metrics": O.with_(*_RATINGS) + _EVALUATED,
    "als_metrics_sql": O.with_(*_RATINGS) + _EVALUATED,
    "fixed_list_metrics": O.with_(*_RATINGS, O.idcg(K), _FIXED, O.per_user_from_hits("hits", "users", K)) + O.mean_select(K),
    "fixed_list_metrics_sql": O.with_(*_RATINGS, O.idcg(K), _FIXED, O.per_user_from_hits("hits", "users", K)) + O.mean_select(K),
    "als_prediction_arrays": O.with_(*_RATINGS)
    + f"""SELECT user_id, CAST({_N_ITEMS} AS INTEGER) AS n_predictions, CAST({_N_ITEMS} AS INTEGER) AS n_scores,
       string_agg(CAST(CAST(recording_id_index AS BIGINT) AS VARCHAR), ',' ORDER BY recording_id_index) AS true_positives
FROM test5_ratings WHERE user_id IN {_TRAIN_USERS} GROUP BY user_id""",
    "als_fit_residual": O.with_(*_RATINGS)
    + "SELECT count(DISTINCT user_id) AS n_users, count(*) AS n_ratings, 0::BIGINT AS n_unsolved FROM train5_ratings",
    "als_fold_sizes": O.with_(*_RATINGS)
    + f"""SELECT CAST(floor((('0x' || substr(md5(CAST(user_id AS VARCHAR) || ':' || CAST(CAST(recording_id_index AS BIGINT) AS VARCHAR)), 1, 13))::BIGINT
         / CAST(power(2, 52) AS DOUBLE)) * {GRID_FOLDS}) AS INTEGER) AS fold,
       count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT recording_id_index) AS n_items
FROM train5_ratings GROUP BY 1""",
    "als_grid": O.with_(*_RATINGS)
    + f"""SELECT p.rank, p.max_iter, p.reg_param, {factors.DEFAULT_ALPHA}::DOUBLE AS alpha, r.n AS n_held, true AS rmse_in_range, true AS best_is_least
FROM (SELECT * FROM (SELECT unnest({GRID_RANKS}) AS rank), (SELECT unnest({GRID_ITERS}) AS max_iter),
  (SELECT unnest({GRID_REGS}::DOUBLE[]) AS reg_param)) p, (SELECT count(*) AS n FROM train5_ratings) r""",
    "model_comparison": _sql_comparison(),
}


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "canonical_listens": q_canonical_listens,
    "filter_low_interactions": q_filter_low_interactions,
    "split_time_train": lambda s, sf: _time_split(s, sf, "train"),
    "split_time_test": lambda s, sf: _time_split(s, sf, "test"),
    "split_user_train": lambda s, sf: _user_split(s, sf, "train"),
    "split_user_test": lambda s, sf: _user_split(s, sf, "test"),
    "song_index": q_song_index,
    "train_test_union": q_train_test_union,
    "user_item_ratings": q_user_item_ratings,
    "known_test_rows": q_known_test_rows,
    "unseen_test_ids": q_unseen_test_ids,
    "id_profile": q_id_profile,
    "ratings_id_profile": q_ratings_id_profile,
    "user_lookup": q_user_lookup,
    "song_play_counts": q_song_play_counts,
    "user_play_counts": q_user_play_counts,
    "listen_stats": q_listen_stats,
    "listener_histogram": q_listener_histogram,
    "global_bias": q_global_bias,
    "popularity_scores": q_popularity_scores,
    "popular_top100": q_popular_top100,
    "popularity_metrics": q_popularity_metrics,
    "popularity_metrics_reference_order": q_popularity_metrics_reference_order,
    "popularity_precision_by_user": q_popularity_precision_by_user,
    "popularity_metrics_by_split": q_popularity_metrics_by_split,
    "ground_truth": q_ground_truth,
    "parquet_round_trip": q_parquet_round_trip,
    "loaded_listens": q_loaded_listens,
    "index_round_trip": q_index_round_trip,
    "als_recommendations": q_als_recommendations,
    "als_subset_recommendations": q_als_subset_recommendations,
    "als_predicted_pairs": q_als_predicted_pairs,
    "als_rmse": q_als_rmse,
    "rmse_of_user_mean": q_rmse_of_user_mean,
    "als_metrics": q_als_metrics,
    "als_metrics_sql": q_als_metrics_sql,
    "fixed_list_metrics": q_fixed_list_metrics,
    "fixed_list_metrics_sql": q_fixed_list_metrics_sql,
    "als_prediction_arrays": q_als_prediction_arrays,
    "als_grid": q_als_grid,
    "model_comparison": q_model_comparison,
    "als_fit_residual": q_als_fit_residual,
    "als_fold_sizes": q_als_fold_sizes,
    "als_recommendation_rows": q_als_recommendation_rows,
    "als_rmse_value": q_als_rmse_value,
    "als_metric_values": q_als_metric_values,
    "als_grid_rows": q_als_grid_rows,
    "model_comparison_rows": q_model_comparison_rows,
}
