"""The Merkle manifest against brute force."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from encore.llm import manifest
from util import CLASHES, ODD, SCHEMA, docs


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row) -> str:
    """``row``: values in the order of ``manifest.FIELDS``."""
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute_tree(nodes):
    """The top of a list of digests, and each node's (before, after) pairs."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = nodes[p // 8 * 8 : p // 8 * 8 + 8]
            paths[i].append(("".join(run[: p % 8]), "".join(run[p % 8 + 1 :])))
            at[i] = p // 8
        nodes = [digest("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def brute(rows):
    """``(doc_id, leaf, subroot, root, path)`` of (doc_id, text, lang, source, n_chars) rows."""
    groups = {}
    for i, text, lang, source, n in rows:
        groups.setdefault(lang, []).append((i is not None, i or 0, brute_leaf((i, source, lang, n, text)), i))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: r[:3])
        trees[g] = brute_tree([r[2] for r in groups[g]])
    root, above = brute_tree([trees[g][0] for g in names]) if names else (None, [])
    return sorted(
        (repr(i), leaf, trees[g][0], root, tuple(path + above[k]))
        for k, g in enumerate(names)
        for (_, _, leaf, i), path in zip(groups[g], trees[g][1])
    )


def found(df):
    return sorted((repr(r["doc_id"]), r["leaf"], r["subroot"], r["root"], tuple(map(tuple, r["path"]))) for r in df.collect())


def given(rows):
    return [(r[0], r[1], r[2], r[3], r[4]) for r in rows]


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(r[0], r[1], lang, source, n) for r in ODD for lang, source, n in (("en", "s", 1), (None, None, None), ("é", "", 0))]
    rows += [(1, "x", "", "s", 5)]  # a language that is an empty string is no null
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in [*CLASHES, "leaf", "path", "_place"]})
    assert found(manifest.manifest(df)) == brute(given(rows))


@pytest.mark.parametrize("n", [1, 8, 9, 64, 65, 512, 513, 4700])
def test_sizes_around_the_levels(spark, n):
    rows = [(i, f"text {i}", "en", "s", i) for i in range(n)]
    random.Random(n).shuffle(rows)
    got = found(manifest.manifest(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert got == brute(rows)


def test_many_groups_with_a_hot_one(spark):
    rng = random.Random(3)
    rows = [(i, "t", "hot" if i % 3 == 0 else f"g{rng.randrange(700)}", None, None) for i in range(2500)]
    assert found(manifest.manifest(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_a_changed_row_is_found(spark):
    rows = [(i, f"Text {i}", "en" if i % 2 else "de", "s", i) for i in range(100)]
    changed = manifest.leaf_digest([F.lower("text") if c == "text" else F.col(c) for c in manifest.FIELDS])
    carry = {"given": F.when(F.col("doc_id") % 10 == 0, changed).otherwise(manifest.leaf_digest([F.col(c) for c in manifest.FIELDS]))}
    out = manifest.verify(manifest.manifest(spark.createDataFrame(rows, SCHEMA), carry=carry), "given").collect()
    assert {r["doc_id"] for r in out if not r["verified"]} == set(range(0, 100, 10))
    assert all((r["folded_root"] == r["root"]) == r["verified"] for r in out)


def test_empty_table(spark):
    assert manifest.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_fields_do_not_run_into_each_other(spark):
    df = docs(spark, [(1, "a"), (1, None), (1, "-"), (1, "")])
    assert len({r["leaf"] for r in manifest.manifest(df).collect()}) == 4
