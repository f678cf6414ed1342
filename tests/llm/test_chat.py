"""Reply trees and the chat format against brute force and round trips."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from encore.llm import chat
from util import CLASHES

TREE = "tree string, node long, parent long, score double, role string, text string"
TURNS = "conv_id long, turn long, role string, text string"
PIECES = ["<", "[", "\\", "|", ">", "/", "s>", "</s>", "<s>", "[INST]", "[/INST]", "<|turn|>", "<|text|>", "<|end|>", "<|x|>", "a", "é", "\n", "🙂"]


def back(df):
    return df.withColumns(
        {"turns": chat.parsed(F.col("formatted")), "loss": chat.learned_text(F.col("formatted"), F.col("loss_mask"))}
    ).collect()


def brute_paths(messages):
    """``{(tree, leaf): [nodes from the root]}`` and each leaf's rank."""
    by_id = {(m[0], m[1]): m for m in messages}
    parents = {(m[0], m[2]) for m in messages if (m[0], m[2]) in by_id}
    found, ranked = {}, {}
    for tree, node in by_id:
        if (tree, node) in parents:
            continue
        path, at = [], (tree, node)
        while at in by_id and len(path) <= len(by_id):
            path.append(at[1])
            at = (tree, by_id[at][2])
        if len(path) > len(by_id):
            continue  # below a circle
        found[tree, node] = path[::-1]
        scores = [by_id[tree, n][3] for n in path if by_id[tree, n][3] is not None]
        ranked.setdefault(tree, []).append((-sum(scores) / len(scores) if scores else float("inf"), node))
    return found, {(t, leaf): i for t, leaves in ranked.items() for i, (_, leaf) in enumerate(sorted(leaves))}


def random_trees(rng, n):
    rows = []
    for i in range(n):
        tree = "hot" if i % 3 == 0 else f"t{rng.randrange(12)}"
        inside = [r[1] for r in rows if r[0] == tree]
        parent = rng.choice(inside[-4:]) if inside and rng.random() < 0.95 else None
        score = None if rng.random() < 0.2 else rng.randrange(8) / 8
        rows.append((tree, i, parent, score, rng.choice(["user", "assistant"]), "".join(rng.choice(PIECES) for _ in range(6))))
    return rows


@pytest.mark.parametrize("branches", [None, 1, 3])
def test_paths_and_formats_equal_brute_force(spark, branches):
    rows = random_trees(random.Random(1), 240)
    paths, ranks = brute_paths(rows)
    by_id = {(r[0], r[1]): r for r in rows}
    out = back(chat.conversations(spark.createDataFrame(rows, TREE), branches))
    chosen = {k for k, rank in ranks.items() if branches is None or rank < branches}
    assert {(r["tree"], r["leaf"]) for r in out} == chosen and len(out) == len(chosen)
    for r in out:
        key = r["tree"], r["leaf"]
        assert r["rank"] == ranks[key]
        turns = [(by_id[key[0], n][4], by_id[key[0], n][5]) for n in paths[key]]
        assert [tuple(t) for t in r["turns"]] == turns and r["n_turns"] == len(turns)
        assert r["loss"] == "".join(text for role, text in turns if role == "assistant")


def test_missing_parents_circles_and_clashing_columns(spark):
    rows = [
        ("t", 1, 99, 0.5, "user", "its parent is missing"), ("t", 2, 1, None, "assistant", "leaf"),
        ("c", 1, 2, 1.0, "user", "circle"), ("c", 2, 1, 1.0, "user", "circle"), ("c", 3, 2, 1.0, "user", "below it"),
        ("n", 1, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, TREE).withColumns({c: F.lit("x") for c in [*CLASHES, "up", "above", "leaf", "rank"] if c not in ("node",)})
    out = {(r["tree"], r["leaf"]): [tuple(t) for t in r["turns"]] for r in back(chat.conversations(df))}
    assert out == {("t", 2): [("user", "its parent is missing"), ("assistant", "leaf")], ("n", 1): [("", "")]}


def test_linear_conversations(spark):
    rng = random.Random(2)
    said = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said), (1, None, None, None), (1, 1, "assistant", ""), (2, 0, "user", "x")]
    rows += [(3, 0, "user", "same")] * 3 + [(None, 0, "assistant", "no id")]
    rows += [(4, t, "user" if t % 2 == 0 else "assistant", "".join(rng.choice(PIECES) for _ in range(5))) for t in range(333)]
    rows += [(5, 0, "assistant", "[INST]" * 20_000)]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in [*CLASHES, "tree", "parent"]}).repartition(5)
    want = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        want.setdefault("" if conv is None else f"={conv}", []).append((role or "", text or ""))
    out = back(chat.conversations(chat.chains(df)))
    assert {r["tree"]: [tuple(t) for t in r["turns"]] for r in out} == want and len(out) == len(want)
    for r in out:
        assert r["loss"] == "".join(text for role, text in want[r["tree"]] if role == "assistant")
        spans = [tuple(s) for s in r["loss_mask"]]
        assert spans == sorted(spans) and len(spans) == sum(role == "assistant" for role, _ in want[r["tree"]])


def test_empty_table(spark):
    assert chat.conversations(chat.chains(spark.createDataFrame([], TURNS))).collect() == []


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=1, max_size=40))
def test_escapes_are_reversible_and_leave_no_mark(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.withColumn("u", chat.unescape(F.col("e"))).collect():
        assert r["u"] == r["t"]
        assert not any(mark in r["e"] for mark in ("</s>", "<s>", "[INST]", "[/INST]", "<|turn|>", "<|text|>", "<|end|>", "<|x|>"))
