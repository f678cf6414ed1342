"""Ranking metrics (precision@k, MAP, MAP@k, NDCG@k) as DataFrame code.

Semantics are those of Spark's ``RankingMetrics`` / ``RankingEvaluator`` with
binary relevance, per evaluated user with prediction list ``P`` and label set
``L`` (labels de-duplicated, predictions not):

* precision@k = |{i < min(|P|, k) : P[i] in L}| / k
* AP          = sum over hits i of (hits in P[0..i]) / (i + 1), divided by |L|
* AP@k        = the same over i < k, divided by min(|L|, k)
* NDCG@k      = sum over hits i < k of 1/ln(i+2), divided by
                sum over i < min(|L|, k) of 1/ln(i+2)

and 0 for a user with no labels. Metrics are the mean over evaluated users.

Nothing is collected into per-user arrays. Hits are kept in *run* form
``(user, start, length, before)``: the positions ``start .. start+length-1``
are all hits, and ``before`` hits precede the run. A plain hit is a run of
length 1; a block of identical listens is one run, however long, and its sums
have closed forms (``encore.functions.columns.harmonic_gap``).

Rows without a user belong to nobody: they are dropped, in every metric here.

Eager step: ``exclusive_prefix_sums`` checkpoints its range-sorted input into
the shared checkpoint folder (one job). Everything else is lazy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions.columns import gain_sum, harmonic_gap, ideal_dcg
from encore.session import ensure_checkpoint_dir

USER = "user_id"
METRIC_COLUMNS = ["precision_at_k", "map", "map_at_k", "ndcg_at_k"]
Key = str | list[str]  # one user column, or several that name a user together


def _cols(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


# ---------------------------------------------------------------- run sums


def _precision_sum(start: Column, length: Column, bound: Column) -> Column:
    """Number of run positions below ``bound``."""
    return F.least(F.greatest(bound - start, F.lit(0)), length)


def _ap_sum(start: Column, length: Column, before: Column) -> Column:
    """``sum((before + 1 + j) / (start + 1 + j) for j < length)``.

    Each term is ``1 - (start - before) / (start + 1 + j)``, so the sum is
    ``length - (start - before) * (H(start + length) - H(start))``.
    """
    single = (before + F.lit(1)).cast("double") / (start + F.lit(1)).cast("double")
    run = length.cast("double") - (start - before).cast("double") * harmonic_gap(start, start + length)
    return F.when(length == 1, single).otherwise(run)


def _run_sums(runs: DataFrame, k: int, user_col: Key, unit_runs: bool) -> DataFrame:
    """Per-user sums over hit runs: hits below k, AP and AP@k numerators, DCG@k."""
    start, length, before = F.col("start"), F.col("length"), F.col("before")
    if unit_runs:
        # Every run is one hit at ``start`` with ``before`` earlier hits.
        in_k = start < F.lit(k)
        ap = (before + F.lit(1)).cast("double") / (start + F.lit(1)).cast("double")
        return runs.groupBy(*_cols(user_col)).agg(
            F.count(F.when(in_k, F.lit(1))).alias("hits_at_k"),
            F.sum(ap).alias("ap_sum"),
            F.sum(F.when(in_k, ap).otherwise(F.lit(0.0))).alias("ap_k_sum"),
            F.sum(F.when(in_k, F.lit(1.0) / F.log(start + F.lit(2))).otherwise(F.lit(0.0))).alias("dcg_k"),
        )
    prepared = runs.select(
        *_cols(user_col), "start", "length", "before", _precision_sum(start, length, F.lit(k)).alias("in_k")
    )
    in_k, none = F.col("in_k"), F.lit(0.0)
    return prepared.groupBy(*_cols(user_col)).agg(
        F.sum(in_k).alias("hits_at_k"),
        F.sum(F.when(length > 0, _ap_sum(start, length, before)).otherwise(none)).alias("ap_sum"),
        F.sum(F.when(in_k > 0, _ap_sum(start, in_k, before)).otherwise(none)).alias("ap_k_sum"),
        F.sum(gain_sum(start, in_k)).alias("dcg_k"),
    )


def per_user_metrics(
    runs: DataFrame, users: DataFrame, k: int, user_col: Key = USER, unit_runs: bool = False
) -> DataFrame:
    """Per-user metrics from hit runs.

    ``runs``: ``(user, start, length, before)``; ``users``: one row per
    evaluated user with ``n_labels`` (distinct labels). Users without hits
    score 0; users without labels score 0 on every metric. ``unit_runs``
    declares that every run has length 1 (a simpler plan).
    """
    sums = _run_sums(runs, k, user_col, unit_runs)
    return _measured(users.join(sums, on=_cols(user_col), how="left"), k, user_col)


def _measured(sums: DataFrame, k: int, user_col: Key) -> DataFrame:
    """Metrics from each user's ``n_labels`` and run sums (null: no hits)."""
    n = F.col("n_labels")
    has = n > 0
    zero = F.lit(0.0)
    return sums.select(
        *_cols(user_col),
        n.alias("n_labels"),
        F.when(has, F.coalesce(F.col("hits_at_k"), F.lit(0)) / F.lit(float(k))).otherwise(zero).alias("precision_at_k"),
        F.when(has, F.coalesce(F.col("ap_sum"), zero) / n).otherwise(zero).alias("map"),
        F.when(has, F.coalesce(F.col("ap_k_sum"), zero) / F.least(n, F.lit(k))).otherwise(zero).alias("map_at_k"),
        F.when(has, F.coalesce(F.col("dcg_k"), zero) / ideal_dcg(F.least(n, F.lit(k)))).otherwise(zero).alias("ndcg_at_k"),
    )


def mean_metrics(per_user: DataFrame, k: int, decimals: int | None = None) -> DataFrame:
    """One row: ``k, n_users`` and the mean of each metric over users."""
    cols = [F.avg(c) for c in METRIC_COLUMNS]
    if decimals is not None:
        cols = [F.round(c, decimals) for c in cols]
    return per_user.agg(
        F.lit(k).alias("k"),
        F.count(F.lit(1)).alias("n_users"),
        *[c.alias(name) for c, name in zip(cols, METRIC_COLUMNS)],
    )


# ------------------------------------------------------------ run builders


def runs_from_hits(hits: DataFrame, user_col: Key = USER, pos_col: str = "pos") -> DataFrame:
    """Runs of length 1 from hit rows ``(user, pos)`` with distinct positions.

    The window numbers each user's hits; it is used only where a user's hits
    are bounded by a list length k (model or top-k predictions).
    """
    w = Window.partitionBy(*_cols(user_col)).orderBy(pos_col)
    return hits.select(
        *_cols(user_col),
        F.col(pos_col).cast("bigint").alias("start"),
        F.lit(1).cast("bigint").alias("length"),
        (F.row_number().over(w) - 1).cast("bigint").alias("before"),
    )


def label_counts(labels: DataFrame, user_col: Key = USER, item_col: str = "item", distinct: bool = False) -> DataFrame:
    """``(user, n_labels)``: distinct labels per user.

    ``distinct=True`` declares the rows already distinct, so a plain count
    replaces a second distinct aggregation.
    """
    if distinct:
        return labels.groupBy(*_cols(user_col)).agg(F.count(item_col).alias("n_labels"))
    return labels.groupBy(*_cols(user_col)).agg(F.countDistinct(item_col).alias("n_labels"))


def list_metrics(
    predictions: DataFrame,
    labels: DataFrame,
    k: int,
    user_col: Key = USER,
    item_col: str = "item",
    pos_col: str = "pos",
    users: DataFrame | None = None,
) -> DataFrame:
    """Per-user metrics for per-user prediction lists in long form.

    ``predictions``: ``(user, pos, item)`` with ``pos`` unique per user (a
    list of bounded length, e.g. a model's top-k); ``labels``: ``(user,
    item)``. Evaluated users are those with both a prediction and a label
    (the inner join of the two lists), or the ``users`` given; a given user
    without labels scores 0.
    """
    user = _cols(user_col)
    distinct_labels = labels.dropna(subset=user).select(*user, item_col).distinct()
    hits = predictions.join(distinct_labels, on=[*user, item_col], how="inner").select(*user, pos_col)
    counts = label_counts(distinct_labels, user_col, item_col, distinct=True)
    if users is None:
        evaluated = counts.join(predictions.select(*user).distinct(), on=user, how="left_semi")
    else:
        evaluated = (
            users.select(*user)
            .distinct()
            .join(counts, on=user, how="left")
            .select(*user, F.coalesce(F.col("n_labels"), F.lit(0)).alias("n_labels"))
        )
    return per_user_metrics(runs_from_hits(hits, user_col, pos_col), evaluated, k, user_col, unit_runs=True)


def shared_list_metrics(
    ranked: DataFrame,
    labels: DataFrame,
    k: int,
    user_col: Key = USER,
    item_col: str = "item",
    pos_col: str = "pos",
) -> DataFrame:
    """Per-user metrics when every user gets the same list ``ranked``.

    ``ranked``: ``(pos, item)`` with distinct items, e.g. a top-k popularity
    list; the join is left to AQE, which broadcasts it by its measured size.
    Every user with a label is evaluated.
    """
    user = _cols(user_col)
    distinct_labels = labels.dropna(subset=user).select(*user, item_col).distinct()
    hits = distinct_labels.join(ranked.select(pos_col, item_col), on=item_col, how="inner")
    users = label_counts(distinct_labels, user_col, item_col, distinct=True)
    return per_user_metrics(
        runs_from_hits(hits.select(*user, pos_col), user_col, pos_col), users, k, user_col, unit_runs=True
    )


# -------------------------------------------------- ordered-list positions


def _local_exclusive_sums(groups: list[str], sum_cols: list[str]):
    """Exclusive running sums per group over a sorted partition (pandas)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry_key, carry = None, {}
        for pdf in batches:
            if pdf.empty:
                yield pdf.assign(**{f"{c}_local": pd.Series(dtype="int64") for c in sum_cols})
                continue
            keys = [pdf[g].to_numpy() for g in groups]
            begins = np.zeros(len(pdf), dtype=bool)
            for key in keys:
                begins[1:] |= key[1:] != key[:-1]
            part = np.cumsum(begins)
            starts = np.concatenate([[0], np.flatnonzero(begins)])
            carried = tuple(key[0] for key in keys) == carry_key
            out = {}
            for c in sum_cols:
                values = pdf[c].to_numpy().astype("int64")
                before = np.cumsum(values) - values
                local = before - before[starts][part]
                if carried:
                    local[part == 0] += carry[c]
                carry[c] = int(local[-1] + values[-1])
                out[f"{c}_local"] = local
            carry_key = tuple(key[-1] for key in keys)
            yield pdf.assign(**out)

    return run


def exclusive_prefix_sums(
    df: DataFrame, group_cols: str | list[str], order_cols: list[str], sum_cols: list[str], keep: list[str] | None = None
) -> DataFrame:
    """Add ``<c>_before``: the sum of ``c`` over the group's earlier rows.

    A group is one value of a column or of several; rows with a null in one
    of them belong to no group and are dropped. Rows are ordered by
    ``order_cols`` inside each group; the order must be total within a group
    (collapse identical rows first). A distributed prefix sum that tolerates
    any group size:

    1. range-partition on ``(groups..., order...)`` and sort each range: a hot
       group is cut into contiguous ranges over many tasks. The result is
       checkpointed into the shared checkpoint folder, which fixes the range
       bounds and task ids for both uses below (and survives executor loss);
    2. each task takes local running sums over its sorted range (vectorised);
    3. only a task's first group can have begun in an earlier task. The sums
       of each task's first and last group, two rows for each task at most,
       give the first groups' offsets by a running sum over tasks;
    4. the offsets, one row for each task, are broadcast (their number is the
       number of partitions) and added to the rows of the first groups. The
       rows themselves are not shuffled again.

    ``keep`` names the columns that are returned besides the groups and sums;
    the others end with the sort.
    """
    groups = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    keys = [*groups, *order_cols]
    group = F.struct(*groups)
    carried = [c for c in df.columns if keep is None or c in {*groups, *sum_cols, *keep}]
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (
        df.dropna(subset=groups)
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(*carried)
        .checkpoint(eager=True)
        .withColumn("_part", F.spark_partition_id())
    )
    local_schema = T.StructType(
        ranged.schema.fields + [T.StructField(f"{c}_local", T.LongType(), False) for c in sum_cols]
    )
    local = ranged.mapInPandas(_local_exclusive_sums(groups, sum_cols), schema=local_schema)
    ends = ranged.groupBy("_part").agg(F.min(group).alias("_first"), F.max(group).alias("_last"))
    totals = (
        ranged.join(F.broadcast(ends), "_part")
        .where((group == F.col("_first")) | (group == F.col("_last")))
        .groupBy("_part", *groups, "_first")
        .agg(*[F.sum(c).alias(f"{c}_total") for c in sum_cols])
    )
    w = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        "_first",
        (group == F.col("_first")).alias("_carried"),
        *[F.coalesce(F.sum(f"{c}_total").over(w), F.lit(0)).alias(f"{c}_offset") for c in sum_cols],
    ).where("_carried")
    first = group == F.col("_first")
    return local.join(F.broadcast(offsets), on="_part", how="left").select(
        *carried,
        *[
            (F.col(f"{c}_local") + F.when(first, F.col(f"{c}_offset")).otherwise(F.lit(0))).cast("bigint").alias(f"{c}_before")
            for c in sum_cols
        ],
    )


def ordered_list_metrics(
    events: DataFrame,
    relevant: DataFrame,
    k: int,
    order_cols: list[str],
    user_col: Key = USER,
    item_col: str = "item",
) -> DataFrame:
    """Per-user metrics when each user's prediction list is its own event log.

    The list of a user is all its ``events`` rows ordered by ``order_cols``
    (repeats kept, each occurrence a position); the label set is the shared
    ``relevant`` items (distinct). Every user with an event is evaluated, with ``n_labels = |relevant|``.

    Identical events are collapsed into one row with a multiplicity first (a
    partial aggregate); positions come from ``exclusive_prefix_sums``, so no
    user's log is ever gathered into one task.
    """
    user = _cols(user_col)
    keys = [*user, *order_cols]
    if item_col not in order_cols:
        keys.append(item_col)
    collapsed = events.dropna(subset=user).groupBy(*keys).agg(F.count(F.lit(1)).alias("mult"))
    rel = relevant.select(item_col).distinct().withColumn("_hit", F.lit(1))
    n_relevant = rel.agg(F.count(F.lit(1))).scalar()
    flagged = collapsed.join(rel, on=item_col, how="left").select(
        *keys,
        F.col("mult"),
        (F.col("mult") * F.coalesce(F.col("_hit"), F.lit(0))).cast("bigint").alias("hit_mult"),
    )
    # the order's columns are not needed once the rows are sorted
    positioned = exclusive_prefix_sums(flagged, user, keys[len(user) :], ["mult", "hit_mult"], keep=[])
    # rows without a hit are runs of length 0, so the sums have every user with an event
    runs = positioned.select(
        *user,
        F.col("mult_before").alias("start"),
        F.col("hit_mult").alias("length"),
        F.col("hit_mult_before").alias("before"),
    )
    sums = _run_sums(runs, k, user_col, unit_runs=False)
    return _measured(sums.withColumn("n_labels", n_relevant.cast("bigint")), k, user_col)
