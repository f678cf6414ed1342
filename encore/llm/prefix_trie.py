"""Prefix trie of conversations, by union-find over the prefixes that neighbours share.

Every distinct sequence of the first d turns is a node of depth d; the root is
the empty sequence. Conversations are sorted by their turns, so the members of
a node stand together, and two neighbours with a longest common prefix (LCP) of
d turns share their nodes down to depth d.

1. A turn becomes a 128-bit digest of its role and text and the number of words
   of its text; a conversation is the list of its turns' digests.
2. Conversations are range-partitioned by that list and their id, so copies of
   one conversation spread over many tasks, and the order is checkpointed.
3. Inside a partition the edges between neighbours are taken in descending LCP;
   each edge merges two components, and the merge makes the node of that depth.
   Components are intervals, so finding one is a lookup at its ends. Between
   merges a component is a chain of nodes with the same members.
4. A node that reaches over a partition's edge is only a part. These nodes lie
   on the prefixes that the partition shares with its neighbours: the forest of
   a partition is contracted to them. Every figure of a part is a sum (a node,
   its share of its parent's children, and its last turn's words count where it
   begins, a leaf where it ends), so parts with the same prefix digest are added
   up, and nodes beneath them take their parent's final id by (partition, digest).
5. The ids that end at such a node are joined in the order of partitions and
   hashed as a stream.

Bounds: a task holds the nodes that its partition adds (integers, no texts), a
row holds one conversation's digests, and a partition's edge the digests of one
conversation. Nothing is gathered for a node, however many members it has.

Defined results: null role or text is empty; a null turn stands first, equal
turn numbers stand in the order of their digests, repeated rows are turns of
their own; rows without a conversation id belong to none and are left out; an
empty table has no nodes; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import materialize, words
from encore.session import ensure_checkpoint_dir

NO_ENDS = hashlib.sha256(b"").hexdigest()
ROOT_KEY = hashlib.md5(b"").digest()
ROWS_A_BATCH = 20_000
_NODE_SCHEMA = (
    "part int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, ends_sha256 string, node_key binary, parent_key binary, piece string"
)


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, steps``: the turns of each conversation as ``(turn, digest, n_words)`` in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    step = F.struct(F.col("turn").alias("turn"), digest.alias("digest"), F.size(words(F.col("text"))).alias("n_words"))
    return (
        turns.where(F.col("conv_id").isNotNull())
        .select(F.col("conv_id").cast("long").alias("conv_id"), step.alias("step"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("step")).alias("steps"))
    )


def _common_prefix(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs == 0, F.size(a)).otherwise(differs - 1).cast("int")


def _ends_of_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """First and last list of a sorted partition, one row."""
    first = last = part = None
    for pdf in batches:
        if len(pdf):
            if first is None:
                first, part = pdf["digests"].iloc[0], int(pdf["part"].iloc[0])
            last = pdf["digests"].iloc[-1]
    if first is not None:
        yield pd.DataFrame({"part": [part], "first": [first], "last": [last]})


class _Forest:
    """The nodes of one sorted run of conversations.

    ``before`` and ``after`` are the LCPs with the conversations beside the
    run, -1 where there is none. A component is named by its first row; its
    open node, at ``depth``, is emitted once the component grows beyond it.
    """

    def __init__(self, ids, lengths, lcps, new_words, before, after, first, last):
        self.lengths, self.lcps, self.new_words = lengths, lcps, new_words
        self.before, self.after = before, after
        self.keys_first, self.keys_last = _prefix_keys(first, before), _prefix_keys(last, after)
        n = len(ids)
        self.end = n - 1
        nexts = [*lcps[1:], after]
        self.low, self.depth = list(ids), list(lengths)
        self.n, self.children, self.saved = [1] * n, [0] * n, [0] * n
        self.leaves = [int(x < k) for x, k in zip(nexts, lengths)]
        self.beneath: list[list[int]] = [[] for _ in range(n)]
        self.ends: list[list[int]] = [[i] for i in ids]
        self.right, self.start_at = list(range(n)), list(range(n))
        self.rows: dict[str, list] = {c: [] for c in _NODE_COLUMNS}

    def _words(self, c: int, depth: int) -> int:
        """Words of the last text of a node: kept with the row that the node begins at."""
        return int(self.new_words[c][depth - 1 - (self.lcps[c] if c else 0)]) if depth else 0

    def close(self, c: int, to: int) -> None:
        """Emit the open nodes of component ``c`` that lie deeper than ``to``."""
        rows = self.rows
        while self.depth[c] > to:
            depth = self.depth[c]
            begins = not (c == 0 and depth <= self.before)
            goes_on = self.right[c] == self.end and depth <= self.after
            self.saved[c] += (self.n[c] - begins) * self._words(c, depth)
            part = goes_on or not begins
            key = None
            if part:
                key = self.keys_last[depth] if goes_on else self.keys_first[depth]
            ends = ",".join(map(str, self.ends[c]))
            at = len(rows["conv_id"])
            for name, value in (
                ("conv_id", self.low[c]),
                ("depth", depth),
                ("parent_conv_id", None),
                ("n_convs", self.n[c]),
                ("n_children", self.children[c]),
                ("n_leaves", self.leaves[c]),
                ("saved_tokens", self.saved[c]),
                ("ends_sha256", hashlib.sha256(ends.encode()).hexdigest() if ends else NO_ENDS),
                ("node_key", key),
                ("parent_key", None),
                ("piece", ends if part and ends else None),
            ):
                rows[name].append(value)
            for child in self.beneath[c]:
                rows["parent_conv_id"][child] = None if part else self.low[c]
                rows["parent_key"][child] = key
            self.beneath[c], self.ends[c] = [at], []
            self.children[c] = int(begins)
            self.depth[c] = depth - 1

    def merge(self, row: int) -> None:
        """The edge between ``row - 1`` and ``row``: both components meet in the node of their LCP."""
        lcp, a, b = self.lcps[row], self.start_at[row - 1], row
        self.close(a, lcp)
        self.close(b, lcp)
        self.n[a] += self.n[b]
        self.low[a] = min(self.low[a], self.low[b])
        self.leaves[a] += self.leaves[b]
        self.saved[a] += self.saved[b]
        self.children[a] += self.children[b]
        self.beneath[a] += self.beneath[b]
        self.ends[a] += self.ends[b]
        self.beneath[b] = self.ends[b] = []
        self.right[a] = self.right[b]
        self.start_at[self.right[a]] = a

    def nodes(self) -> dict[str, list]:
        lcps = np.array(self.lcps[1:], dtype=np.int64)
        for row in np.argsort(-lcps, kind="stable"):
            self.merge(int(row) + 1)
        self.close(0, -1)
        return self.rows


_NODE_COLUMNS = [field.split()[0] for field in _NODE_SCHEMA.split(",")][1:]


def _prefix_keys(digests, depth: int) -> list[bytes]:
    """Digests of the prefixes of length 0 to ``depth``, each chained to the one before."""
    keys = [ROOT_KEY]
    for digest in digests[: max(depth, 0)]:
        keys.append(hashlib.md5(keys[-1] + digest).digest())
    return keys


def _shared(a: list[bytes], b: list[bytes]) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def _local_nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All nodes of a sorted partition, parts of nodes with their prefix digests."""
    ids, lengths, lcps, new_words = [], [], [], []
    first = last = part = None
    before = after = -1
    for pdf in batches:
        for conv, digests, counts, number, b, a in zip(*(pdf[c] for c in ("conv_id", "digests", "words", "part", "before", "after"))):
            digests = list(digests)
            if first is None:
                first, part, before, after = digests, int(number), int(b), int(a)
                lcps.append(before)
                new_words.append(np.asarray(counts))
            else:
                lcps.append(_shared(last, digests))
                new_words.append(np.asarray(counts[lcps[-1] :]))
            ids.append(int(conv))
            lengths.append(len(digests))
            last = digests
    if first is None:
        return
    rows = _Forest(ids, lengths, lcps, new_words, before, after, first, last).nodes()
    for at in range(0, len(rows["conv_id"]), ROWS_A_BATCH):
        out = {c: values[at : at + ROWS_A_BATCH] for c, values in rows.items()}
        out["parent_conv_id"] = pd.array(out["parent_conv_id"], dtype="Int64")
        yield pd.DataFrame({"part": part, **out}, columns=["part", *_NODE_COLUMNS])


def _hash_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's pieces, joined by commas; rows come sorted by (node, partition)."""
    key, state = None, None
    for pdf in batches:
        done = []
        for node, piece in zip(pdf["node_key"], pdf["piece"]):
            if node == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = node, hashlib.sha256()
            state.update(piece.encode())
        yield pd.DataFrame(done, columns=["node_key", "sha"])
    if key is not None:
        yield pd.DataFrame([(key, state.hexdigest())], columns=["node_key", "sha"])


def _merged(parts: DataFrame) -> DataFrame:
    """One row for each node that reaches over a partition's edge."""
    sums = parts.groupBy("node_key").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.max("parent_key").alias("parent_key"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    pieces = (
        parts.where(F.col("piece").isNotNull())
        .select("node_key", "part", "piece")
        .repartition("node_key")
        .sortWithinPartitions("node_key", "part")
        .mapInPandas(_hash_pieces, "node_key binary, sha string")
    )
    return materialize(
        sums.join(pieces, "node_key", "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(NO_ENDS))), "trie_merged"
    )


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie over ``conv_id, steps`` (see ``sequences``).

    Returns ``conv_id`` (the smallest member), ``depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256``. Eager: the
    order is checkpointed, the nodes and the merged parts are written.
    """
    ensure_checkpoint_dir(conversations.sparkSession)
    lists = materialize(
        conversations.select(
            "conv_id", F.col("steps.digest").alias("digests"), F.col("steps.n_words").cast("array<int>").alias("words")
        ),
        "trie_sequences",
    )
    ordered = (
        lists.repartitionByRange("digests", "conv_id")
        .sortWithinPartitions("digests", "conv_id")
        .checkpoint()
        .withColumn("part", F.spark_partition_id())
    )
    ends = materialize(
        ordered.select("part", "digests").mapInPandas(
            _ends_of_part, "part int, first array<binary>, last array<binary>"
        ),
        "trie_ends",
    )
    # one row for each partition: a window over them is as short as the list of tasks
    order = Window.orderBy("part")
    edges = ends.select(
        "part",
        F.coalesce(_common_prefix(F.lag("last").over(order), F.col("first")), F.lit(-1)).alias("before"),
        F.coalesce(_common_prefix(F.col("last"), F.lead("first").over(order)), F.lit(-1)).alias("after"),
    )
    nodes = materialize(
        ordered.join(F.broadcast(edges), "part").mapInPandas(_local_nodes, _NODE_SCHEMA), "trie_nodes"
    )
    parts = nodes.where(F.col("node_key").isNotNull())
    merged = _merged(parts)
    parent = merged.select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("above"))
    own = ["n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    spine = merged.join(parent, "parent_key", "left").select("conv_id", "depth", F.col("above").alias("parent_conv_id"), *own)
    whole = nodes.where(F.col("node_key").isNull())
    inner = whole.where(F.col("parent_key").isNull()).select("conv_id", "depth", "parent_conv_id", *own)
    # an edge's nodes have children in one partition each, so (part, digest) is no hot key
    by_part = materialize(parts.select("part", F.col("node_key").alias("parent_key")).join(parent, "parent_key"), "trie_parents")
    under = (
        whole.where(F.col("parent_key").isNotNull())
        .join(by_part, ["part", "parent_key"])
        .select("conv_id", "depth", F.col("above").alias("parent_conv_id"), *own)
    )
    return inner.unionByName(under).unionByName(spine)
