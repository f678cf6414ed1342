"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has one bit for each bit position of its shingles' hashes, set
if more than half of the hashes have it. Fingerprints link at ``max_distance``
or fewer differing bits; links chain into components.

Candidates: ``max_distance // 2 + 1`` segments leave one segment in which two
linked fingerprints differ by at most one bit (three segments for 4 bits). A
segment is indexed once for each of its bits with that bit deleted, so both
the equal and the one-bit-different case meet in an equality join. The join
condition verifies the whole distance and lets each pair pass at its first
meeting key only, so a pair comes out once. Fingerprints, not documents, are
joined: a group of copies of any size is one row. The join is sorted, never
broadcast: Spark sizes the 64 keys of a fingerprint by the table they are made
of, and would send that many times the size it expects through the driver.

Defined results: null and blank texts have fingerprint zero, linked like any
other. Rows with equal ids or texts each get their own row. A null id never
becomes a component's name unless the component has no other (then null).
Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import bounded_batches, materialize

SEED = 42
_BLOCK = 1 << 16  # shingles whose bits are counted at once


def fingerprint_of(text: str | None, shingle: int = 4, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of one text (see the module's rules)."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    if not text:
        return 0
    found = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII rules for both
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= shingle:
        return digest(joined, seed)
    gaps = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1)).tolist()
    ends = np.concatenate((gaps, [len(joined)]))[shingle - 1 :].tolist()
    count = len(ends)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, count, _BLOCK):
        hashes = np.array(
            [digest(joined[a:b], seed) for a, b in zip(starts[at : at + _BLOCK], ends[at : at + _BLOCK])],
            dtype="<u8",
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int.from_bytes(np.packbits(2 * ones > count, bitorder="little").tobytes(), "little")


def fingerprint(text: Column, shingle: int = 4, seed: int = SEED) -> Column:
    """Column of signed 64-bit fingerprints."""

    @F.pandas_udf("long")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.array([fingerprint_of(t, shingle, seed) for t in texts], dtype=np.uint64)
            yield pd.Series(found.view(np.int64))

    return compute(text)


def _segments(max_distance: int) -> list[tuple[int, int]]:
    """(offset, width) of the fewest segments of which one differs by at most one bit."""
    parts = max_distance // 2 + 1
    edges = [64 * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def links(prints: DataFrame, max_distance: int = 4) -> DataFrame:
    """All pairs ``(a, b)``, ``a < b``, of distinct ``fp`` values that link."""
    if not 0 <= max_distance < 64:
        raise ValueError("max_distance must be from 0 to 63")
    cuts = _segments(max_distance)
    variants = [  # (number, segment, its offset, mask of the bits that stay)
        (i, s, offset, ((1 << width) - 1) & ~(1 << bit))
        for i, (s, offset, width, bit) in enumerate(
            (s, offset, width, bit) for s, (offset, width) in enumerate(cuts) for bit in range(width)
        )
    ]
    firsts = [next(v[0] for v in variants if v[1] == s) for s in range(len(cuts))]
    # key: bits that stay, rotated into the low end, and the variant's number above them
    signature = F.array(
        *(
            F.struct(
                F.lit(i).cast("int").alias("variant"),
                F.shiftrightunsigned("fp", offset).bitwiseAND(F.lit(_signed(mask))).alias("bits"),
            )
            for i, _, offset, mask in variants
        )
    )
    signed = prints.select("fp", F.inline(signature))
    a, b = signed.alias("a"), signed.alias("b")
    differing = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    in_segment = [
        F.bit_count(differing.bitwiseAND(F.lit(_signed(((1 << width) - 1) << offset)))) for offset, width in cuts
    ]
    # the first key at which the pair meets: its first segment that differs by
    # at most a bit, and of an equal segment the variant of its first bit
    variant = F.col("a.variant")
    first = F.lit(False)
    for s in reversed(range(len(cuts))):
        here = variant >= firsts[s]
        if s + 1 < len(cuts):
            here = here & (variant < firsts[s + 1])
        first = F.when(in_segment[s] == 0, variant == firsts[s]).when(in_segment[s] == 1, here).otherwise(first)
    return a.join(
        b.hint("merge"),
        (F.col("a.variant") == F.col("b.variant"))
        & (F.col("a.bits") == F.col("b.bits"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (F.bit_count(differing) <= max_distance)
        & first,
    ).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``edges(a, b)``; root: its component's smallest node.

    Alternating large-star and small-star rounds, each written to the shared
    folder. The table of smallest neighbours is written before it is joined,
    so both inputs of the join are exchanges that Spark can split where one
    node has very many neighbours.
    """
    current = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    seen = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "smallest")
        large = materialize(
            both.join(smallest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "large",
        )
        lowest = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        # every lower neighbour of u, and u itself, moves to u's smallest
        moved = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = lowest.select("u", F.col("m").alias("v"))
        current = materialize(moved.unionByName(kept).distinct(), "links")
        state = current.agg(
            F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            break
        seen = state
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def groups(prints: DataFrame, max_distance: int = 4) -> DataFrame:
    """``(fp, component_id, component_fp)`` for each distinct ``fp`` of ``prints(doc_id, fp)``.

    ``component_id`` is the component's smallest id, ``component_fp`` the
    smallest fingerprint among its rows with that id.
    """
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "prints")
    rooted = components(links(nodes, max_distance))
    placed = materialize(
        nodes.join(rooted, nodes.fp == rooted.node, "left").select(
            "fp", "doc_id", F.coalesce("root", "fp").alias("root")
        ),
        "placed",
    )
    named = materialize(
        placed.groupBy("root").agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("least")
        ),
        "named",
    )
    return materialize(
        placed.join(named, "root").select(
            "fp", F.col("least.doc_id").alias("component_id"), F.col("least.fp").alias("component_fp")
        ),
        "groups",
    )


def near_duplicates(docs: DataFrame, shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """One row for each document: ``doc_id, fingerprint, component_id``."""
    bounded_batches(docs.sparkSession)
    prints = materialize(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fp")), "fingerprints")
    return prints.join(groups(prints, max_distance), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """One whole row of each component, with the columns of ``docs``.

    The row with the component's smallest id (rows without an id come last);
    among rows that share that id the one with the smallest fingerprint, then
    the first in the order of its text and the other columns.
    """
    bounded_batches(docs.sparkSession)
    inner = "__fp"
    while inner in docs.columns:
        inner += "_"
    marked = materialize(docs.withColumn(inner, fingerprint(F.col("text"), shingle)), "marked")
    chosen = materialize(
        groups(marked.select("doc_id", F.col(inner).alias("fp")), max_distance)
        .select(F.col("component_id").alias("__id"), F.col("component_fp").alias("__print"))
        .distinct()
        .withColumn("__key", F.xxhash64("__id", "__print")),
        "chosen",
    )
    # joined by id and print, so a group of copies spreads over all tasks
    keyed = marked.withColumn("__own", F.xxhash64("doc_id", inner))
    survivors = keyed.join(
        chosen,
        (keyed["__own"] == chosen["__key"])
        & keyed["doc_id"].eqNullSafe(chosen["__id"])
        & (keyed[inner] == chosen["__print"]),
        "left_semi",
    )
    order = [F.col(c) for c in dict.fromkeys(["text", *(c for c in docs.columns if c != "doc_id")])]
    rank = Window.partitionBy("__own", "doc_id", inner).orderBy(*order)
    return survivors.withColumn("__rank", F.row_number().over(rank)).filter("__rank = 1").select(*docs.columns)
