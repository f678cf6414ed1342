"""Source mixing against brute force."""

import hashlib
import random

import pytest

from encore.llm import curriculum
from util import ODD, docs, rows, table


def brute_targets(sizes, weights, most=3):
    """Share by weight again and again, until no target is above its stop."""
    total, full, open_ = sum(sizes.values()), {}, dict(weights)
    while True:
        left, weight = total - sum(full.values()), sum(open_.values())
        shares = {s: left * w / weight for s, w in open_.items()} if weight else {}
        over = [s for s, x in shares.items() if x >= most * sizes[s]]
        if not over:
            return {**full, **shares}
        for s in over:
            full[s] = most * sizes[s]
            del open_[s]


def check(given, found):
    words = lambda t: len((t or "").encode().split())
    sizes = {}
    for _, text, _, source in given:
        sizes[source] = sizes.get(source, 0) + words(text)
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    targets = brute_targets(sizes, {s: i % 3 + 1 for i, s in enumerate(order)})
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    by_id = {r[0]: r for r in given}
    assert len(found) == len(given)
    for r in found:
        source = by_id[r["doc"]["doc_id"]][3]
        assert r["size"] == words(by_id[r["doc"]["doc_id"]][1]) and r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(targets[source])
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        assert len(r["positions"]) == r["copies"] and all(0 <= p <= 1 for p in r["positions"])
        taken[source] += r["taken"]
        largest[source] = max(largest[source], r["size"])
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s] / 2 + 1


def test_targets_and_words_taken(spark):
    rng = random.Random(2)
    names = ["b", "a", "é", "Z", None, "tiny", "none"]
    given = []
    for i in range(400):
        source = "b" if i % 3 == 0 else rng.choice(names)
        n = rng.randrange(1, 400) if source not in ("tiny", "none") else (source == "tiny")
        given.append((i, " ".join(["w"] * n) if n else None, "en", source))
    found = curriculum.place(docs(spark, given, extra=True), columns=["doc_id"]).collect()
    check(given, found)
    again = curriculum.place(docs(spark, given[::-1]).repartition(5), columns=["doc_id"]).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))


def test_rows_of_one_id_and_size_have_an_order(spark):
    given = [(7, f"text number {i}", "en", "s") for i in range(30)] + [(i, "a b c d " * 40, "en", "t") for i in range(100, 104)]
    first = [tuple(r) for r in curriculum.mix(docs(spark, given)).collect()]
    assert first == [tuple(r) for r in curriculum.mix(docs(spark, given[::-1]).repartition(7)).collect()]


def test_streams_equal_brute_force(spark):
    given = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in table("documents")]
    found = {r["doc"]["doc_id"]: r for r in curriculum.place(docs(spark, given), columns=["doc_id"]).collect()}
    check(given, list(found.values()))
    begin = {}
    for i, text, _, source in sorted(given, key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest()):
        size = len((text or "").encode().split())
        middle, begin[source] = begin.get(source, 0) + size / 2, begin.get(source, 0) + size
        r = found[i]
        assert r["copies"] == sum(e * r["source_size"] + middle < r["target"] for e in range(3))


@pytest.mark.parametrize("knots", [*curriculum.SCHEDULES.values(), [(0, 0), (0.5, 2), (1, 0)], [(0, 1), (0.25, 3), (1, 0.5)]])
def test_position_inverts_the_integral(spark, knots):
    from pyspark.sql import functions as F

    def demand(t, steps=4000):
        def density(x):
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                if x <= t1:
                    return w0 + (w1 - w0) * (x - t0) / (t1 - t0)

        area = lambda end: sum(density((k + 0.5) * end / steps) for k in range(steps)) * end / steps
        return area(t) / area(1.0)

    frame = spark.createDataFrame([(k / 20,) for k in range(21)], "u double")
    for u, t in frame.select("u", curriculum.position(F.col("u"), knots)).collect():
        assert demand(t) == pytest.approx(u, abs=2e-3)


def test_mix_repeats_rows_in_order_of_position(spark):
    given = [(i, "w " * (5 + i % 7), "en", "ab"[i % 2] if i % 5 else "c") for i in range(90)]
    frame = docs(spark, given, extra=True)
    placed = curriculum.place(frame).collect()
    wanted = sorted((p, r["ticket"], r["doc"]["doc_id"]) for r in placed for p in r["positions"])
    out = curriculum.mix(frame)
    assert out.columns == frame.columns
    assert [r["doc_id"] for r in out.collect()] == [i for _, _, i in wanted]


def test_odd_rows(spark):
    found = curriculum.place(docs(spark, [(*r, "en", None) for r in ODD], extra=True), columns=["doc_id"])
    assert len(rows(found)) == len(ODD)
    assert curriculum.place(docs(spark, [])).count() == 0 and curriculum.mix(docs(spark, [])).count() == 0
    blank = curriculum.place(docs(spark, [(1, None), (2, " ")])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in blank] == [(0, 0.0, 0)] * 2
