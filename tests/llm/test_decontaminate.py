"""Benchmark decontamination against brute force and planted copies."""

import random

import numpy as np
import pytest

from encore.llm import decontaminate
from util import CLASHES, ODD, docs, rows, table


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def brute(text, item):
    """Least edits between the item and any stretch of the text."""
    words, item = decontaminate.words_of(text), decontaminate.words_of(item)
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(words, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@pytest.fixture(scope="module")
def items():
    return [(r["item_id"], r["text"]) for r in table("benchmark")]


def benchmark(spark, items, extra=False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(items, "item_id long, text string")
    return df.withColumns({c: F.lit("x") for c in CLASHES if c != "item_id"}) if extra else df


def test_distance_is_the_least_over_stretches():
    rng = random.Random(1)
    for _ in range(200):
        item = np.array([rng.randrange(1, 6) for _ in range(rng.randrange(1, 8))])
        text = np.array([rng.randrange(6) for _ in range(rng.randrange(10))], dtype=np.int64)
        edits, end = decontaminate.distance(item, text)
        spans = [(levenshtein(item.tolist(), text[i:j].tolist()), j) for i in range(len(text) + 1) for j in range(i, len(text) + 1)]
        assert edits == min(s for s, _ in spans) and (edits, end) in spans


def test_whole_table_equals_brute_force(spark, items):
    given = [(r["doc_id"], r["text"]) for r in table("documents")][:120]
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontaminate.leaks(docs(spark, given), benchmark(spark, items)).collect()}
    wanted = {}
    vocabulary = {i: set(decontaminate.words_of(t)) for i, t in items}
    for doc_id, text in given:
        held = set(decontaminate.words_of(text))
        for item_id, item in items:
            size = len(decontaminate.words_of(item))
            if len(vocabulary[item_id] - held) > 0.2 * size:
                continue
            edits = brute(text, item)
            if edits <= int(0.2 * size + 1e-9):
                wanted[doc_id, item_id] = edits
    assert found == wanted and wanted


def test_edited_copies_are_found_and_clean_texts_are_not(items):
    rng = random.Random(9)
    index = decontaminate.LeakIndex.build([(i, decontaminate.words_of(t)) for i, t in items])
    clean = [decontaminate.words_of(r["text"]) for r in table("documents")[:60]]
    vocabulary = list(index.vocabulary)
    texts, wanted = [], []
    for _ in range(300):
        item_id, words = rng.choice([(i, decontaminate.words_of(t)) for i, t in items])
        edited = list(words)
        for _ in range(index.edits(len(words))):
            at, kind = rng.randrange(len(edited)), rng.randrange(3)
            edited[at : at + (kind != 2)] = [] if kind == 0 else [rng.choice(vocabulary)]
        around = rng.choice(clean)
        cut = rng.randrange(len(around) + 1)
        texts.append(" ".join(around[:cut] + edited + around[cut:]))
        wanted.append(item_id)
    found = index.find_all(texts)
    assert sum(any(leak[0] == i for leak in leaks) for leaks, i in zip(found, wanted)) >= 0.95 * len(wanted)
    plain = [(i, t) for i, t in items if "ß" not in t]  # whose capitals are two letters
    exact = index.find_all([f"before {t.upper()}!!! after" for _, t in plain])
    assert all((i, 0) in {(leak[0], leak[3]) for leak in leaks} for leaks, (i, _) in zip(exact, plain))
    for leaks, text in zip(found, texts):
        for item_id, first, n, edits, _ in leaks:
            stretch = decontaminate.words_of(text)[first : first + n]
            assert levenshtein(decontaminate.words_of(dict(items)[item_id]), stretch) == edits


@pytest.mark.parametrize("size", [5, 12, 50, 120, 200])
def test_recall_of_every_size_and_kind_of_edit(size):
    """Copies with the full number of edits inside other words, other than those the repetitions are measured on."""
    rng = random.Random(size)
    names = [f"w{chr(97 + i % 26)}{i}" for i in range(4000)]
    items = [(i, [rng.choice(names) for _ in range(size)]) for i in range(20)]
    index = decontaminate.LeakIndex.build(items)
    for kind in ("delete", "insert", "substitute", "mixed", "crowded"):
        texts, wanted = [], []
        for _ in range(60):
            item_id, words = rng.choice(items)
            copy = decontaminate.edited_copy(words, index.edits(size), kind, rng)
            filler = lambda: rng.choice(names) if rng.random() < 0.5 else "other"
            text = [filler() for _ in range(40)] + [w or filler() for w in copy] + [filler() for _ in range(40)]
            texts.append(" ".join(text))
            wanted.append(item_id)
        found = index.find_all(texts)
        assert sum(any(leak[0] == i for leak in leaks) for leaks, i in zip(found, wanted)) >= 0.95 * len(wanted), kind


def test_sizes_without_keys_are_searched_exactly(items, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_REPETITIONS", 0)
    decontaminate._repetitions_at.cache_clear()
    index = decontaminate.LeakIndex.build([(i, decontaminate.words_of(t)) for i, t in items[:6]])
    assert index.whole and not any(index.tables.values())
    rng, texts = random.Random(4), []
    for _, text in items[:6]:
        words = decontaminate.words_of(text)
        texts.append(" ".join(["x", *(w or "new" for w in decontaminate.edited_copy(words, index.edits(len(words)), "mixed", rng)), "y"]))
    assert all(i in {leak[0] for leak in leaks} for (i, _), leaks in zip(items, index.find_all(texts)))
    decontaminate._repetitions_at.cache_clear()


def test_short_items_are_found_as_exact_copies():
    index = decontaminate.LeakIndex.build([(1, ["lone"]), (2, ["two", "words"]), (3, ["a", "b", "c", "d"]), (4, ["two", "two"])])
    found = index.find_all(["so lone, a b c d!", "two words two", "a b d", "two two words", None])
    assert [[leak[:4] for leak in leaks] for leaks in found] == [
        [(1, 1, 1, 0), (3, 2, 4, 0)], [(2, 0, 2, 0)], [], [(2, 1, 2, 0), (4, 0, 2, 0)], []
    ]
    assert decontaminate.LeakIndex.build([(1, ["lone"])]).find("lone") == [(1, 0, 1, 0, 1.0)]


def test_alone_in_a_batch_or_not_a_text_gives_the_same(items):
    index = decontaminate.LeakIndex.build([(i, decontaminate.words_of(t)) for i, t in items])
    texts = [items[3][1], None, "", "x", items[5][1] + " " + items[5][1], "the the " * 500]
    assert [index.find(t) for t in texts] == index.find_all(texts)


def test_blocks_of_the_benchmark_give_the_same(spark, items):
    frame = docs(spark, [(r["doc_id"], r["text"]) for r in table("documents")][:80] + [(900, items[0][1])])
    whole = rows(decontaminate.leaks(frame, benchmark(spark, items)))
    assert whole == rows(decontaminate.leaks(frame, benchmark(spark, items), block_words=60)) and whole
    kept = decontaminate.clean(frame, benchmark(spark, items), block_words=60)
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in frame.collect()} - {r[0] for r in whole}


def test_odd_rows(spark, items):
    odd = benchmark(spark, [*items[:3], (None, "an item without an id but words"), (99, None), (98, ""), (97, "one two"), items[0]], True)
    frame = docs(spark, [*ODD, (20, items[0][1])], extra=True)
    assert {tuple(r)[:2] for r in decontaminate.leaks(frame, odd).collect()} == {(20, items[0][0])}  # "one two" is in no text
    kept = decontaminate.clean(frame, odd)
    assert kept.columns == frame.columns and kept.count() == len(ODD)
    nothing = benchmark(spark, [])
    assert decontaminate.leaks(frame, nothing).count() == 0 and decontaminate.clean(frame, nothing).count() == len(ODD) + 1
    assert decontaminate.leaks(docs(spark, []), odd).count() == 0
