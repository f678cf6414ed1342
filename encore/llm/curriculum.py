"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight and a schedule, a piecewise linear density over the
training clock ``[0, 1]``. The weights fix how many words each source gives in
all: 100 % of the sizes are shared by weight, a source's target stops at
``max_epochs`` times its size and what is over goes to the others by weight
until none is above. The schedule fixes when they come: its integral is the
source's cumulative demand, and inverting it at the middle of a document in
its source's stream gives the document's training position. Documents are
range-sorted by position.

A source's stream is its documents in the order of a hash of their ids,
repeated epoch after epoch. An occurrence is taken if its middle lies below
the target, so the words taken are within half a document of the target and a
document is taken at most ``max_epochs`` times.

Running sums over a source do not go through one task: documents are dealt by
(source, bucket), 4,096 buckets of the hash for each source; a table of one
row for each source and bucket gives each bucket its offset in the stream.

Defined results: a null text has size 0; a null source is a source of its own,
last in the order; documents of size 0 are taken like others and give 0 words.
With no words at all every target is 0 and nothing is taken. Rows with a null
id are ordered by their text, rows of one id and size by their text's hash. Repeated rows are separate documents. An empty
table gives an empty result.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import SPACE, materialize

MAX_EPOCHS = 3
# Densities over the training clock, as knots (time, density).
SCHEDULES: dict[str, list[tuple[float, float]]] = {
    "fading": [(0.0, 1.5), (1.0, 0.5)],
    "steady": [(0.0, 1.0), (1.0, 1.0)],
    "growing": [(0.0, 0.5), (1.0, 1.5)],
}


def size_of(text: Column) -> Column:
    """Words of a text, by ASCII white space (null: 0)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, f"[{SPACE}]+"))).cast("long")


def integrate(knots: list[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """Segments ``(t0, t1, w0, w1, demand before)`` of a schedule, scaled to an integral of 1."""
    times = [t for t, _ in knots]
    if times[0] != 0 or times[-1] != 1 or sorted(set(times)) != times or min(w for _, w in knots) < 0:
        raise ValueError("a schedule runs from 0 to 1 in rising times with densities of 0 or more")
    pieces = list(zip(knots, knots[1:]))
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in pieces]
    total = sum(areas)
    if total <= 0:
        raise ValueError("a schedule needs some demand")
    before = [0.0, *accumulate(areas)]
    return [
        (a[0], b[0], a[1] / total, b[1] / total, done / total) for (a, b), done in zip(pieces, before)
    ]


def position(demand: Column, knots: list[tuple[float, float]]) -> Column:
    """The time at which a schedule's integral reaches ``demand`` (0 to 1)."""
    chosen = F.lit(0.0)
    for t0, t1, w0, w1, before in integrate(knots):
        # w0 x + slope x^2 / 2 = rest, solved in the form that also holds for a slope of 0
        slope = (w1 - w0) / (t1 - t0)
        rest = demand - before
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0)))
        here = F.lit(t0) + F.coalesce(F.try_divide(2 * rest, F.lit(w0) + root), F.lit(0.0))
        chosen = F.when(demand >= before, F.least(here, F.lit(t1))).otherwise(chosen)
    return chosen


def cyclic_weights(sources: DataFrame) -> DataFrame:
    """Weights 1, 2, 3, repeating, by source in code point order, null last.

    ``sources`` has one row for each source. Weight 1 fades, 2 is steady, 3 grows.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = (F.pmod(rank - 1, F.lit(3)) + 1).cast("long")
    names = list(SCHEDULES)
    schedule = F.when(weight == 1, names[0]).when(weight == 2, names[1]).otherwise(names[2])
    return sources.withColumn("weight", weight).withColumn("schedule", schedule)


def targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to ``sources(source, source_size, weight)``, one row for each source.

    With sources in order of the share per weight at which they are full, the
    full ones are a prefix; the others split what is left by weight.
    """
    full = F.col("source_size") * max_epochs
    by_share = Window.orderBy(full / F.col("weight"), F.col("source").asc_nulls_last())
    upto = by_share.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = sources.select(
        "*",
        F.sum("source_size").over(everything).alias("__all"),
        F.coalesce(F.sum(full).over(upto), F.lit(0)).alias("__before"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0))).alias("__weights"),
    )
    # at this source, sharing what the earlier full ones leave: is it full as well?
    left = F.col("__all") - F.col("__before")
    is_full = left * F.col("weight") >= full * F.col("__weights")
    level = ranked.withColumn("__full", is_full)
    first_open = Window.partitionBy()
    open_left = F.min_by(
        F.when(~F.col("__full"), left), F.when(~F.col("__full"), F.struct(full / F.col("weight"), F.col("__before")))
    ).over(first_open)
    open_weights = F.max(F.when(~F.col("__full"), F.col("__weights"))).over(first_open)
    shared = F.try_divide((open_left * F.col("weight")).cast("double"), open_weights.cast("double"))
    return level.withColumn(
        "target", F.when(F.col("__full"), full.cast("double")).otherwise(F.coalesce(shared, F.lit(0.0)))
    ).select(*sources.columns, "target")


def place(docs: DataFrame, weigh=cyclic_weights, max_epochs: int = MAX_EPOCHS, columns: list[str] | None = None) -> DataFrame:
    """Each row of ``docs`` with its part in the mix.

    Returns ``doc`` (a struct of ``columns``, default all), ``size,
    source_size, target, copies, taken, positions`` (a training position for
    each copy), ``ticket`` (the hash that orders a source's stream) and
    ``text_hash`` (which orders rows of one id and size).
    ``weigh`` gets a frame with ``source`` and ``source_size`` and adds
    ``weight`` and ``schedule``.
    """
    ticket = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.coalesce("text", F.lit("")))))
    base = docs.select(
        F.struct(*(columns or docs.columns)).alias("doc"),
        F.col("doc_id").alias("id"),
        F.col("source").alias("source"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"),
        ticket.alias("ticket"),
        F.xxhash64("text").alias("text_hash"),
        F.substring(ticket, 1, 3).alias("bucket"),
        size_of(F.col("text")).alias("size"),
    )
    sums = materialize(base.groupBy("key", "source", "bucket").agg(F.sum("size").alias("words")), "bucket-sizes")
    sources = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    shares = materialize(targets(weigh(sources), max_epochs), "targets").select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"), "source_size", "target", "schedule"
    )
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = materialize(
        sums.select("key", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")).join(
            shares, "key"
        ),
        "offsets",
    )
    within = (
        Window.partitionBy("key", "bucket").orderBy("ticket", "id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    )
    begins = F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0))
    rounds = F.ceil(F.try_divide(F.col("target") - F.col("middle"), F.col("source_size")))

    def at(epoch: int) -> Column:
        demand = F.try_divide(epoch * F.col("source_size") + F.col("middle"), F.col("target"))
        out = F.lit(None).cast("double")
        for name, knots in SCHEDULES.items():
            out = F.when(F.col("schedule") == name, position(demand, knots)).otherwise(out)
        return out

    return (
        base.join(plan, ["key", "bucket"])
        .withColumn("middle", begins + F.col("size") / 2)
        .withColumn("copies", F.least(F.greatest(F.coalesce(rounds, F.lit(0)), F.lit(0)), F.lit(max_epochs)).cast("int"))
        .select(
            "doc",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
            F.slice(F.array(*(at(e) for e in range(max_epochs))), F.lit(1), F.col("copies")).alias("positions"),
            "ticket",
            "text_hash",
        )
    )


def mix(docs: DataFrame, weigh=cyclic_weights, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The training sequence: rows of ``docs``, repeated as the mix takes them, range-sorted by position."""
    taken = place(docs, weigh, max_epochs).select("doc", F.explode("positions").alias("position"), "ticket", "text_hash")
    return taken.orderBy("position", "ticket", "text_hash").select("doc.*")
