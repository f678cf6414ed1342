"""The prefix trie against brute force."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from encore.llm import prefix_trie, queries
from util import CLASHES

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    """Turns of each conversation as (role, text) pairs, null turns first."""
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if conv is not None:
            out.setdefault(conv, []).append((role or "", text or ""))
    return out


def brute(convs):
    members = {}
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def below(node):
        leaves, saved = (0, 0) if node in children else (1, 0)
        if node:
            saved = (len(members[node]) - 1) * len(node[-1][1].encode().split())
        for child in children.get(node, []):
            more, words = below(child)
            leaves, saved = leaves + more, saved + words
        return leaves, saved

    rows = []
    for node, convs_here in members.items():
        ends = ",".join(str(c) for c in sorted(convs_here) if len(convs[c]) == len(node))
        rows.append(
            (min(convs_here), len(node), min(members[node[:-1]]) if node else None, len(convs_here),
             len(children.get(node, [])), *below(node), hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(rows, key=repr)


def check(spark, rows):
    got = prefix_trie.trie(prefix_trie.sequences(spark.createDataFrame(rows, SCHEMA)))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(ordered(rows))


def some(rng, n, words="abc", most=6):
    return [
        (c, t, rng.choice(["user", "assistant"]), " ".join(rng.choice(words) for _ in range(rng.randrange(3))))
        for c in range(n)
        for t in range(rng.randrange(1, most))
    ]


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_random_conversations(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        check(spark, some(random.Random(partitions), 150))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_copies_over_many_partitions(spark):
    """A third of the conversations are one conversation, another third begin alike."""
    rng = random.Random(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    same = [("user", "one two"), ("assistant", "three"), ("user", "four")]
    rows = []
    for c in range(300):
        turns = same if c % 3 == 0 else [same[0], ("assistant", f"{c} x")] if c % 3 == 1 else [("user", rng.choice("ab"))]
        rows += [(c, t, *turn) for t, turn in enumerate(turns)]
    try:
        check(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_nulls_repeats_and_long_chains(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (2, None, "", ""), (2, 0, "user", "a"), (None, 0, "user", "lost")]
    rows += [(3, 0, "user", "x")] * 2 + [(4, 0, "user", "x")]
    rows += [(c, t, "user", f"w {t}" if t < 350 else f"{c} z") for c in (5, 6) for t in range(400)]
    rows += [(7, 0, "user", "long " * 50_000), (8, 0, "user", "long " * 50_000)]
    check(spark, rows)


def test_other_columns_and_empty_table(spark):
    df = spark.createDataFrame(some(random.Random(1), 20), SCHEMA).withColumns({c: F.lit("x") for c in [*CLASHES, "steps", "part"]})
    plain = prefix_trie.trie(prefix_trie.sequences(df.select("conv_id", "turn", "role", "text")))
    assert sorted(map(repr, prefix_trie.trie(prefix_trie.sequences(df)).collect())) == sorted(map(repr, plain.collect()))
    assert prefix_trie.trie(prefix_trie.sequences(spark.createDataFrame([], SCHEMA))).collect() == []


def test_a_turnless_conversation_is_a_member_of_the_root(spark):
    empty = spark.createDataFrame([(9, []), (3, [])], "conv_id long, steps array<struct<turn:long,digest:binary,n_words:int>>")
    (row,) = prefix_trie.trie(empty).collect()
    assert tuple(row) == (3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,9").hexdigest())


def test_rebuilt_conversations(spark, tmp_path):
    """The query rebuilds every conversation on the head of the one at the last multiple of 20."""
    import zlib

    rng = random.Random(6)
    rows = [r for r in some(rng, 90, most=4) if r[0] != 40]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    own = ordered(rows)
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        convs[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    got = queries.op12_prefix_trie(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(convs)
