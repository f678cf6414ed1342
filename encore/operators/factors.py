"""Latent-factor recommender on ``pyspark.ml`` ALS.

Ratings are ``(user_id, avg_rating, recording_id_index)``. ALS ids must fit a
32-bit int; ``index_users`` maps wider user ids to a dense index first.
Evaluation works on long-form rows (user, position, item): the top-k arrays of
ALS are bounded by k and exploded, labels stay as rows, nothing is collected.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.operators import leastsq, ranking
from encore.operators.indexing import IndexModel, fit_index
from encore.operators.topk import top_items
from encore.operators.tuning import fold_of
from encore.operators.vectors import in_blocks

USER = "user_id"
ITEM = "recording_id_index"
RATING = "avg_rating"

# Fixed defaults of the method.
DEFAULT_RANK = 300
DEFAULT_MAX_ITER = 10
DEFAULT_REG = 0.01
DEFAULT_ALPHA = 0.2
DEFAULT_K = 100
# From this rank on a fit is left to ``leastsq``: the rank x rank systems of pyspark.ml outweigh its overhead.
LARGE_RANK = 64
PRODUCTS = 1024  # of vectors taken at once


def als(
    rank: int = DEFAULT_RANK,
    max_iter: int = DEFAULT_MAX_ITER,
    reg_param: float = DEFAULT_REG,
    alpha: float = DEFAULT_ALPHA,
    implicit_prefs: bool = False,
    seed: int = 42,
    user_col: str = USER,
    item_col: str = ITEM,
    rating_col: str = RATING,
    cold_start: str = "drop",
    blocks: int | None = None,
    checkpoint_interval: int = 1,
) -> ALS:
    """An ALS estimator with the method's defaults (M3).

    ``alpha`` only acts when ``implicit_prefs`` is on. ``blocks`` sets user
    and item blocks; Spark's default is 10 of each, whatever the input, so on
    a cluster pass ``default_blocks(spark)`` or more. Long
    runs cut their lineage every ``checkpoint_interval`` iterations into the
    session's checkpoint folder.
    """
    estimator = ALS(
        rank=rank,
        maxIter=max_iter,
        regParam=reg_param,
        alpha=alpha,
        implicitPrefs=implicit_prefs,
        seed=seed,
        userCol=user_col,
        itemCol=item_col,
        ratingCol=rating_col,
        coldStartStrategy=cold_start,
        checkpointInterval=checkpoint_interval,
    )
    if blocks:
        estimator = estimator.setNumUserBlocks(blocks).setNumItemBlocks(blocks)
    return estimator


def default_blocks(spark: SparkSession) -> int:
    """Blocks for a fit on this session: its parallelism, at least Spark's default of 10."""
    return max(10, spark.sparkContext.defaultParallelism)


@dataclass
class FitResult:
    model: ALSModel
    seconds: float


def fit(estimator: ALS, ratings: DataFrame) -> FitResult:
    """Fit and time it on the driver clock.

    The ratings are dealt by user and sorted first, so a fit depends on its
    rows and blocks and not on how its input files happen to be laid out.
    Explicit fits at a large rank take the same iterations in ``leastsq``.
    """
    user, item = estimator.getUserCol(), estimator.getItemCol()
    dealt = ratings.repartition(estimator.getNumUserBlocks(), user).sortWithinPartitions(user, item)
    start = time.perf_counter()
    model = leastsq.fit(estimator, dealt) if _large(estimator) else estimator.fit(dealt)
    return FitResult(model, time.perf_counter() - start)


def _large(estimator: ALS) -> bool:
    plain = not estimator.getImplicitPrefs() and not estimator.getNonnegative()
    return plain and estimator.getRegParam() > 0 and estimator.getRank() >= LARGE_RANK


def index_users(ratings: DataFrame, user_col: str = USER, output_col: str = "user_index") -> IndexModel:
    """Dense user index for ids that may not fit 32 bits."""
    return fit_index(ratings.select(F.col(user_col).cast("string").alias(user_col)), user_col, output_col)


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Predicted rating per (user, item) pair; unknown ids dropped (M4).

    ``model.transform`` joins both vectors to every pair; at a large rank they
    meet in blocks instead, with the same checks, sums and dropped rows.
    """
    if model.rank < LARGE_RANK:
        return model.transform(pairs)
    user, item, output = model.getUserCol(), model.getItemCol(), model.getPredictionCol()
    # like ``transform``, the ids are returned as the integers they are looked up by
    asked = pairs.withColumns({c: _model_id(pairs, c) for c in (user, item)})
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in asked.schema] + [T.StructField(output, T.FloatType())])
    found = in_blocks(
        asked, model.userFactors, model.itemFactors, user, item, _products(asked.columns, output), schema,
        default_blocks(pairs.sparkSession),
    )
    return found.dropna("all", subset=[output]) if model.getColdStartStrategy() == "drop" else found


def _model_id(pairs: DataFrame, column: str) -> Column:
    """A column's ids as ``ALSModel`` takes them: integers of 32 bits, or an error."""
    whole = F.col(column).cast("int")
    wrong = F.col(column).isNull() | (F.col(column) != whole)
    return F.when(wrong, F.raise_error(F.lit(f"{column}: ids must be integers of 32 bits and not null"))).otherwise(whole)


def _products(columns: list[str], output: str):
    """Inner products, summed in single precision from the first factor on, as ``ALSModel`` sums them."""

    def work(pairs: Iterator, near, far) -> Iterator[pa.RecordBatch]:
        for rows, at_u, at_v in pairs:
            total = np.full(len(at_u), np.nan, dtype=np.float32)
            known = np.flatnonzero((at_u >= 0) & (at_v >= 0))
            for at in range(0, len(known), PRODUCTS):
                part = known[at : at + PRODUCTS]
                terms = near.rows[at_u[part]] * far.rows[at_v[part]]
                total[part] = np.add.accumulate(terms, axis=1, dtype=np.float32)[:, -1]
            kept = [rows.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(total)], [*columns, output])

    return work


def rmse(predictions: DataFrame, label_col: str = RATING, prediction_col: str = "prediction") -> float:
    """RMSE through ``RegressionEvaluator`` (E5)."""
    return RegressionEvaluator(metricName="rmse", labelCol=label_col, predictionCol=prediction_col).evaluate(
        predictions
    )


def rmse_frame(predictions: DataFrame, label_col: str = RATING, prediction_col: str = "prediction") -> DataFrame:
    """RMSE as a one-row DataFrame: ``n, rmse`` (E5, distributed)."""
    err = F.col(prediction_col) - F.col(label_col)
    return predictions.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(err * err)).alias("rmse"))


def explode_recommendations(recs: DataFrame, user_col: str = USER, item_col: str = ITEM) -> DataFrame:
    """Long form ``(user, pos, item, score)`` of ALS top-k arrays.

    ``item`` is cast to DOUBLE like the ratings' index column.
    """
    return recs.select(
        F.col(user_col), F.posexplode("recommendations").alias("pos", "rec")
    ).select(
        F.col(user_col),
        F.col("pos").cast("bigint").alias("pos"),
        F.col(f"rec.{item_col}").cast("double").alias(item_col),
        F.col("rec.rating").cast("double").alias("score"),
    )


def recommendation_arrays(
    model: ALSModel, k: int = DEFAULT_K, users: DataFrame | None = None, user_col: str = USER, item_col: str = ITEM
) -> DataFrame:
    """``user, recommendations array<struct<item int, rating float>>`` of all users or the given ones.

    The layout of ``recommendForAllUsers``; the exact search goes through the
    items by norm instead of scoring all pairs of factor blocks.
    """
    factors = model.userFactors
    if users is not None:
        wanted = users.select(F.col(user_col).cast("int").alias("id")).distinct()
        factors = factors.join(wanted, "id", "left_semi")
    pair = F.arrays_zip(F.col("items").alias(item_col), F.col("scores").alias("rating"))
    layout = f"array<struct<{item_col}:int,rating:float>>"
    return top_items(factors, model.itemFactors, k).select(
        F.col("id").alias(user_col), pair.cast(layout).alias("recommendations")
    )


def recommend_all(model: ALSModel, k: int = DEFAULT_K, user_col: str = USER, item_col: str = ITEM) -> DataFrame:
    """Top-k items for every training user, long form (M5)."""
    return explode_recommendations(recommendation_arrays(model, k, None, user_col, item_col), user_col, item_col)


def recommend_for(model: ALSModel, users: DataFrame, k: int = DEFAULT_K, user_col: str = USER, item_col: str = ITEM) -> DataFrame:
    """Top-k items for the given users, long form (M6)."""
    return explode_recommendations(recommendation_arrays(model, k, users, user_col, item_col), user_col, item_col)


def prediction_arrays(recs: DataFrame, item_col: str = ITEM, user_col: str = USER) -> DataFrame:
    """``(user_id, predictions array<double>, scores array<float>)`` from ALS top-k output.

    Item ids through a higher-order function (F7) and a native cast (F8, in
    place of a Python UDF, X1); scores through struct-field access on the
    array (P12). Arrays are bounded by k.
    """
    return recs.select(
        F.col(user_col),
        F.transform("recommendations", lambda x: x[item_col]).cast(T.ArrayType(T.DoubleType())).alias("predictions"),
        F.col("recommendations.rating").alias("scores"),
    )


def ranking_pairs(predictions: DataFrame, test: DataFrame, user_col: str = USER, item_col: str = ITEM) -> DataFrame:
    """``user_id, predictions, scores, true_positives``: both lists side by side.

    ``true_positives`` holds a user's held-out items; a user without any has
    no row, as by the inner join of the two lists. It is as long as the user's
    distinct items, which this table is asked to hold; the metrics never
    build it.
    """
    truth = (
        test.groupBy(user_col)
        .agg(F.sort_array(F.collect_set(F.col(item_col).cast("double"))).alias("true_positives"))
    )
    return predictions.join(truth, on=user_col)


def hits_sql(spark: SparkSession, recs_long: DataFrame, test: DataFrame, user_col: str = USER, item_col: str = ITEM) -> DataFrame:
    """Hits ``(user, pos)`` of long-form recommendations in the test rows, as SQL.

    Both inputs are registered as temp views and joined in Spark SQL; the
    plan is the same as the DataFrame join. The views are dropped once the
    query is analysed: the returned frame holds their plans.
    """
    suffix = uuid.uuid4().hex
    preds, truth = f"predictions_{suffix}", f"groundtruth_{suffix}"
    recs_long.createOrReplaceTempView(preds)
    test.select(user_col, F.col(item_col).cast("double").alias(item_col)).distinct().createOrReplaceTempView(truth)
    hits = spark.sql(
        f"SELECT p.{user_col}, p.pos FROM {truth} g INNER JOIN {preds} p "
        f"ON g.{user_col} = p.{user_col} AND g.{item_col} = p.{item_col}"
    )
    for view in (preds, truth):
        spark.catalog.dropTempView(view)
    return hits


def ranking_scores_sql(spark: SparkSession, recs_long: DataFrame, test: DataFrame, k: int = DEFAULT_K, user_col: str = USER, item_col: str = ITEM) -> DataFrame:
    """``ranking_scores`` with the hit join written in SQL."""
    hits = hits_sql(spark, recs_long, test, user_col, item_col)
    labels = test.select(user_col, F.col(item_col).cast("double").alias("item"))
    users = ranking.label_counts(labels.distinct(), user_col, "item", distinct=True).join(
        recs_long.select(user_col).distinct(), on=user_col, how="left_semi"
    )
    return ranking.per_user_metrics(ranking.runs_from_hits(hits, user_col), users, k, user_col, unit_runs=True)


def ranking_scores(recs_long: DataFrame, test: DataFrame, k: int = DEFAULT_K, user_col: str = USER, item_col: str = ITEM) -> DataFrame:
    """Per-user metrics of model recommendations against test ratings.

    Users with both recommendations and test rows are evaluated, as the
    inner join of predictions and ground truth does.
    """
    preds = recs_long.select(user_col, "pos", F.col(item_col).alias("item"))
    labels = test.select(user_col, F.col(item_col).cast("double").alias("item"))
    return ranking.list_metrics(preds, labels, k, user_col)


def ground_truth(test: DataFrame, user_col: str = USER, item_col: str = ITEM, rating_col: str = RATING) -> DataFrame:
    """Held-out items per user as rows, best-rated first within a user.

    Kept long: labels are a set to every metric, so no per-user array is
    built. The sort is a range-partitioned global sort.
    """
    return test.select(user_col, item_col, rating_col).orderBy(*ground_truth_order(user_col, item_col, rating_col))


def ground_truth_order(user_col: str = USER, item_col: str = ITEM, rating_col: str = RATING) -> list:
    """Users ascending, a user's best-rated items first, equal ratings by item."""
    return [F.col(user_col).asc(), F.col(rating_col).desc(), F.col(item_col).asc()]


# ------------------------------------------------------------------ tuning


@dataclass
class TuningResult:
    cv_model: object
    report: DataFrame
    best: dict = field(default_factory=dict)


def param_grid(estimator: ALS, ranks, max_iters, reg_params, alphas=None):
    """Grid over rank x maxIter x regParam (x alpha only when implicit) (M8)."""
    builder = (
        ParamGridBuilder()
        .addGrid(estimator.rank, list(ranks))
        .addGrid(estimator.maxIter, list(max_iters))
        .addGrid(estimator.regParam, list(reg_params))
    )
    if alphas and estimator.getImplicitPrefs():
        builder = builder.addGrid(estimator.alpha, list(alphas))
    return builder.build()


def tune(
    spark: SparkSession,
    train: DataFrame,
    estimator: ALS,
    grid,
    folds: int = 2,
    parallelism: int = 2,
    seed: int = 42,
    label_col: str = RATING,
    fold_col: str | None = None,
) -> TuningResult:
    """Cross-validated grid search on RMSE over a one-stage pipeline.

    Folds are those of ``fold_col``, or of the hash point of (user, song), so
    they do not depend on the layout of ``train``. ``tuning.grid_search`` is
    the form for long grids: it resumes. The report has one row per grid point: its parameters and mean RMSE over
    the folds, plus ``is_best``. Parameters are read from the param maps, not
    from private model internals.
    """
    pipeline = Pipeline(stages=[estimator])
    evaluator = RegressionEvaluator(metricName="rmse", labelCol=label_col, predictionCol="prediction")
    if fold_col is None:
        fold_col = "_fold"
        train = train.withColumn(fold_col, fold_of(folds, estimator.getUserCol(), estimator.getItemCol()))
    cv = CrossValidator(
        foldCol=fold_col,
        estimator=pipeline,
        estimatorParamMaps=grid,
        evaluator=evaluator,
        numFolds=folds,
        parallelism=parallelism,
        seed=seed,
    )
    cv_model = cv.fit(train)
    rows = []
    best_i = min(range(len(cv_model.avgMetrics)), key=lambda i: cv_model.avgMetrics[i])
    for i, (params, metric) in enumerate(zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics)):
        named = {p.name: v for p, v in params.items()}
        rows.append(
            (
                int(named.get("rank", estimator.getRank())),
                int(named.get("maxIter", estimator.getMaxIter())),
                float(named.get("regParam", estimator.getRegParam())),
                float(named.get("alpha", estimator.getAlpha())),
                float(metric),
                i == best_i,
            )
        )
    schema = "rank int, max_iter int, reg_param double, alpha double, rmse double, is_best boolean"
    report = spark.createDataFrame(rows, schema)
    best = dict(zip(["rank", "max_iter", "reg_param", "alpha", "rmse"], rows[best_i][:5]))
    return TuningResult(cv_model, report, best)


def best_als(cv_model) -> ALSModel:
    """The ALS stage of the best pipeline."""
    best = cv_model.bestModel
    return best.stages[-1] if isinstance(best, PipelineModel) else best
