"""Merkle manifest of a dataset: per-row leaves, group roots, one root, proofs.

A leaf is the SHA-256 of a row's fields, each written as ``-`` when null, else
its UTF-8 byte count, ``:`` and the value. Leaves ascend by key inside a group
(null keys first, equal keys by leaf); every 8 consecutive nodes of a level
(the last run may be shorter, even a single node) become the digest of their
concatenated hex digests, until one is left: the group's sub-root. Sub-roots in
order of group (null first, then by bytes) are reduced to the root alike.

Method: rows get their place in the group by a distributed prefix sum, and 512
places in a row (three levels) form an aligned block. A block keeps each level
as one string of 64 hex digits a node, so the parents of a level are the
digests of its substrings of 512 digits, and a node's siblings are the two
substrings beside it in its run. Blocks become the nodes of the next round, so
a group of N rows takes log_512 N rounds, and a row's path is the path inside
its block followed by its block's path. No task holds more than a block.

Defined results: null columns are ``-`` (an empty text is ``0:``); rows without
a key stand first; repeated rows are separate leaves beside each other; a group
of one row has its leaf as sub-root and an empty path; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import materialize
from encore.operators.ranking import exclusive_prefix_sums

RUN = 8  # nodes that share a parent
DIGITS = 64  # hex digits of a digest
HEIGHT = 3  # levels inside a block
BLOCK = RUN**HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 over the fields of a row, each with its length, so no two rows share a byte string."""
    parts = []
    for value in values:
        value = value.cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to by a path of sibling segments."""
    return F.aggregate(path, leaf, lambda node, at: F.sha2(F.concat(at["before"], node, at["after"]), 256))


def siblings(path: Column) -> Column:
    """All sibling digests of a path, level by level from left to right."""
    return F.array_join(F.transform(path, lambda at: F.concat(at["before"], at["after"])), "")


def _parents(level: Column) -> Column:
    """The next level: one digest for each run of 8 nodes, as one hex string in bytes.

    Levels are kept as bytes because a substring of a string is found by
    walking its characters, of bytes by an offset.
    """
    runs = F.sequence(F.lit(0), F.ceil(F.octet_length(level) / F.lit(RUN * DIGITS)).cast("int") - 1)
    digests = F.transform(
        runs, lambda run: F.sha2(F.substring(level, run * RUN * DIGITS + 1, F.lit(RUN * DIGITS)), 256)
    )
    return F.array_join(digests, "").cast("binary")


def _segments(place: Column, height: Column) -> Column:
    """Sibling segments of a node inside its block, one pair for each level below ``height``."""
    steps = []
    for k in range(HEIGHT):
        at = F.floor(place / F.lit(RUN**k)).cast("int")
        run = F.substring(F.col(f"_level{k}"), F.floor(at / F.lit(RUN)).cast("int") * RUN * DIGITS + 1, F.lit(RUN * DIGITS))
        inside = F.pmod(at, F.lit(RUN)) * DIGITS
        before = F.substring(run, F.lit(1), inside).cast("string")
        after = F.substring(run, inside + DIGITS + 1, F.lit(RUN * DIGITS)).cast("string")
        steps.append(F.struct(before.alias("before"), after.alias("after")))
    return F.slice(F.array(*steps), F.lit(1), height)


def _blocks(nodes: DataFrame) -> DataFrame:
    """Written blocks ``(_group, _block, _size, _height, _nodes, _level0.._level3)``.

    ``nodes``: ``(_group, _place, _node)``, where ``_node`` is a struct with
    ``digest``. ``_size`` is the group's number of nodes.
    """
    sizes = materialize(nodes.groupBy("_group").agg(F.count(F.lit(1)).alias("_size")), "merkle_sizes")
    block = F.floor(F.col("_place") / F.lit(BLOCK))
    gathered = materialize(
        nodes.groupBy("_group", block.alias("_block")).agg(
            F.sort_array(F.collect_list(F.struct("_place", "_node"))).alias("_nodes")
        ),
        "merkle_nodes",
    )
    height = functools.reduce(
        lambda rest, k: F.when(F.col("_size") <= RUN**k, k).otherwise(rest), reversed(range(HEIGHT)), F.lit(HEIGHT)
    )
    out = gathered.join(sizes, "_group").withColumns(
        {
            "_height": height,
            "_level0": F.array_join(F.transform("_nodes", lambda n: n["_node"]["digest"]), "").cast("binary"),
        }
    )
    for k in range(HEIGHT):
        below = F.col(f"_level{k}")
        out = out.withColumn(f"_level{k + 1}", F.when(F.col("_height") > k, _parents(below)).otherwise(below))
    return materialize(out, "merkle_blocks")


def _block_paths(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(blocks with _above, tops)``: each block's path to its group's top, and ``(_group, _top)``."""
    largest = blocks.agg(F.max("_size")).first()[0] or 0
    top = F.col(f"_level{HEIGHT}").cast("string")
    if largest <= BLOCK:
        none = F.array().cast("array<struct<before:string,after:string>>")
        return blocks.withColumn("_above", none), blocks.select("_group", top.alias("_top"))
    nodes = blocks.select("_group", F.col("_block").alias("_place"), F.struct(top.alias("digest")).alias("_node"))
    paths, tops = _paths(nodes)
    above = materialize(
        paths.select("_group", F.col("_place").alias("_block"), F.col("_path").alias("_above")), "merkle_above"
    )
    return blocks.join(above, ["_group", "_block"]), tops


def _paths(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(nodes with _path, tops)`` of every group of ``(_group, _place, _node)``."""
    blocks, tops = _block_paths(_blocks(nodes))
    return _rows(blocks, F.col("_above")), tops


def _rows(blocks: DataFrame, above: Column) -> DataFrame:
    """One row for each node of a block, with its whole path."""
    keep = [c for c in blocks.columns if c != "_nodes"]
    rows = blocks.select(*keep, F.posexplode("_nodes").alias("_at", "_item"))
    return rows.withColumns(
        {
            "_place": F.col("_item._place"),
            "_node": F.col("_item._node"),
            "_path": F.concat(_segments(F.col("_at"), F.col("_height")), above),
        }
    )


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "lang",
    fields: tuple[str, ...] = FIELDS,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """``key, leaf, subroot, root, path`` of every row, and the ``carry`` columns.

    ``path`` lists ``(before, after)`` for each level from the leaf to the
    root: the hex digests left and right of the node in its run. ``carry``
    are expressions over the input's columns, evaluated beside the leaf, such
    as the leaf of another version of the row. Eager: leaves, blocks and the
    upper levels are written to the shared folder.
    """
    carry = carry or {}
    name = F.col(group).cast("string")
    leaves = materialize(
        docs.select(
            F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("_group"),
            F.col(key).alias("_key"),
            leaf_digest([F.col(c) for c in fields]).alias("_leaf"),
            F.struct(F.lit(0).alias("_none"), *[value.alias(c) for c, value in carry.items()]).alias("_carry"),
        ),
        "merkle_leaves",
    )
    order = leaves.select("_group", "_key", "_leaf", "_carry", F.lit(1).cast("bigint").alias("_one"))
    placed = exclusive_prefix_sums(order, "_group", ["_key", "_leaf"], ["_one"])
    node = F.struct(F.col("_leaf").alias("digest"), F.col("_key").alias("key"), F.col("_carry").alias("carry"))
    blocks, tops = _block_paths(
        _blocks(placed.select("_group", F.col("_one_before").alias("_place"), node.alias("_node")))
    )
    tops = materialize(tops, "merkle_tops")
    roots = exclusive_prefix_sums(
        tops.select(F.lit(0).alias("_all"), "_group", "_top", F.lit(1).cast("bigint").alias("_one")), "_all", ["_group"], ["_one"]
    )
    node = F.struct(F.col("_top").alias("digest"), F.col("_group").alias("name"))
    paths, root = _paths(roots.select(F.col("_all").alias("_group"), F.col("_one_before").alias("_place"), node.alias("_node")))
    groups = materialize(
        paths.select(
            F.col("_node.name").alias("_group"),
            F.col("_node.digest").alias("_subroot"),
            F.col("_path").alias("_to_root"),
            root.select("_top").scalar().alias("_root"),
        ),
        "merkle_groups",
    )
    rows = _rows(blocks.join(groups, "_group"), F.concat("_above", "_to_root"))
    return rows.select(
        F.col("_node.key").alias(key),
        F.col("_node.digest").alias("leaf"),
        F.col("_subroot").alias("subroot"),
        F.col("_root").alias("root"),
        F.col("_path").alias("path"),
        *[F.col(f"_node.carry.{c}").alias(c) for c in carry],
    )


def verify(rows: DataFrame, leaf: str, path: str = "path", root: str = "root") -> DataFrame:
    """Add ``folded_root`` (from ``leaf`` by the row's path) and ``verified`` (it equals the root)."""
    folded = rows.withColumn("folded_root", fold(F.col(leaf), F.col(path)))
    return folded.withColumn("verified", F.col("folded_root") == F.col(root))
