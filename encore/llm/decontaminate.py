"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A leak is a stretch of a document within ``max_distance = floor((1 -
similarity) * n)`` word edits of a benchmark item of ``n`` words. Candidates
are windows of the item's size at every word of every text.

* CGK: a window is embedded by a random walk over it. Each step writes the
  word under a pointer and moves on by a random bit of (step, word), so equal
  stretches fall into step again after an edit and edit distance becomes
  Hamming distance.
* LSH: each repetition has its own walk and samples two of its steps; the
  words written there are the key. Items and windows of their size with equal
  keys are candidates. The two steps lie close together, because a walk that
  is in step with the item's at the one is likely to be so at the other; every
  second repetition samples the first forty steps, the others the whole walk,
  as edits may stand anywhere. Each item size has a number of repetitions of
  its own: copies with the full number of edits (deletions, insertions,
  substitutions, a mixture, and a mixture crowded into the first third) are
  drawn, and repetitions are added until ``target_recall`` of every kind is
  caught (an exact copy is caught by each). A size for which
  ``MAX_REPETITIONS`` do not reach it is searched without keys: every window
  that passes the pair test below is verified.
* Verification: the least number of word edits between the item and any
  stretch of the text around the window, exactly.

Before the walk, windows that cannot be within the distance are passed over:
``d`` edits spoil at most ``2 d`` of the item's ``n - 1`` word pairs, so a
window with fewer than ``n - 1 - 2 d`` pairs out of the items' pairs is not a
leak. The test loses nothing; a pair counts as often as one item can use it. Nothing of the corpus is shuffled.

The benchmark goes to the tasks in blocks of bounded size (``block_words``
words of items, about 100 bytes a word); a benchmark of more than a block
takes a pass over the documents for each block. An item is never split.

Words: lower case, runs of digits, letters and everything beyond ASCII, so
punctuation, case and line breaks do not hide a copy. Items of fewer than five
words allow no edit: their windows are compared whole.

Defined results: null and empty texts and items never match. Repeated rows
each give their rows. Extra columns are ignored by ``leaks`` and kept by
``clean``. Empty tables give an empty result, or for ``clean`` all documents.
"""

from __future__ import annotations

import functools
import math
import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import bounded_batches

SIMILARITY = 0.8
TARGET_RECALL = 0.98
MAX_REPETITIONS = 96  # beyond it a size is searched without keys
BLOCK_WORDS = 500_000
_EARLY_STEPS, _STEP_GAP = 40, 4
_AREA = 8  # item sizes that the windows verified at once may span
_CALIBRATION = 200  # edited copies of each kind on which the repetitions are measured
_KINDS = ("delete", "insert", "substitute", "mixed", "crowded")
_WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")
_MIX = tuple(map(np.uint64, (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)))


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _bits(step: int, symbols: np.ndarray, seed: int) -> np.ndarray:
    """A random bit for each symbol at a step of the walk (a mixing hash)."""
    x = symbols.astype(np.uint64) * _MIX[0] + np.uint64((step * 0x632BE59BD9B4E019 + seed * 0x8CB92BA72F3D8DD7) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return ((x >> np.uint64(63)) & np.uint64(1)).astype(np.int64)


def embed(tokens: np.ndarray, starts: np.ndarray, size: int, steps: list[int], seed: int) -> np.ndarray:
    """Keys of the windows of ``size`` tokens at ``starts``: what the walk writes at ``steps``.

    One row for each window. Past its end a window writes 0, as for a word of
    no item (these are 0 in ``tokens``).
    """
    pointer = np.zeros(len(starts), dtype=np.int64)
    out = np.zeros((len(starts), len(steps)), dtype=np.int64)
    column = {s: i for i, s in enumerate(steps)}
    for step in range(max(steps) + 1):
        inside = pointer < size
        symbol = np.where(inside, tokens[np.minimum(starts + pointer, len(tokens) - 1)], 0)
        if step in column:
            out[:, column[step]] = symbol
        pointer += np.where(inside, _bits(step, symbol, seed), 0)
    return out


def distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least word edits between ``item`` and any stretch of ``text``; where that stretch ends."""
    row = np.zeros(len(text) + 1, dtype=np.int64)
    index = np.arange(len(text) + 1)
    for i, word in enumerate(item, start=1):
        # a word of no item (0) differs from every word of one
        step = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.concatenate(([i], step))
        row = np.minimum.accumulate(row - index) + index
    best = int(row.argmin())
    return int(row[best]), best


def sampled_steps(size: int, repetition: int, seed: int) -> list[int]:
    """The two sampled steps. The walk passes a window's end after about twice its size."""
    rng = random.Random(f"{seed}:{repetition}:{size}")
    reach = 2 * size
    first = rng.randrange(min(reach, _EARLY_STEPS) if repetition % 2 == 0 else reach)
    return sorted({first, min(first + 1 + rng.randrange(_STEP_GAP), reach - 1)})


def edited_copy(words: list[int], edits: int, kind: str, rng: random.Random) -> list[int]:
    """A copy with ``edits`` random word edits; new words are 0, a word of no item."""
    out = list(words)
    for _ in range(edits):
        at = rng.randrange(max(1, len(out) // 3) if kind == "crowded" else len(out))
        what = kind if kind in _KINDS[:3] else rng.choice(_KINDS[:3])
        out[at : at + (what != "insert")] = [] if what == "delete" else [0]
    return out


def _rung(size: int) -> int:
    """The next size of a ladder with steps of a tenth: sizes between share a measurement."""
    rung = 5
    while rung < size:
        rung = max(rung + 1, rung * 11 // 10)
    return rung


@functools.lru_cache(maxsize=None)
def _repetitions_at(size: int, edits: int, target_recall: float, seed: int) -> int | None:
    """Repetitions that catch ``target_recall`` of the edited copies of every kind; ``None``: too many."""
    rng = random.Random(f"{seed}:{size}")
    words = rng.sample(range(1, 100 * size), size)
    copies = [edited_copy(words, edits, kind, rng) for kind in _KINDS for _ in range(_CALIBRATION)]
    rows = np.array([(c + [0] * size)[:size] for c in copies], dtype=np.int64).ravel()
    starts, caught = np.arange(len(copies)) * size, np.zeros(len(copies), dtype=bool)
    for repetition in range(MAX_REPETITIONS):
        steps = sampled_steps(size, repetition, seed)
        own = embed(np.array(words, dtype=np.int64), np.array([0]), size, steps, seed + repetition)
        caught |= (embed(rows, starts, size, steps, seed + repetition) == own).all(axis=1)
        if caught.reshape(len(_KINDS), -1).mean(axis=1).min() >= target_recall:
            return repetition + 1
    return None


def repetitions(size: int, edits: int, target_recall: float, seed: int) -> int | None:
    """Repetitions for items of ``size`` words; one for exact copies, ``None`` for a search without keys."""
    if edits == 0:
        return 1
    rung = _rung(size)
    return _repetitions_at(rung, max(edits, edits * rung // size), target_recall, seed)


Leak = tuple[int, int, int, int, float]


@dataclass
class LeakIndex:
    """Benchmark items of one block, ready to be looked up in texts."""

    similarity: float
    items: list[tuple[int, np.ndarray]]  # (item id, word numbers)
    vocabulary: dict[str, int]  # from 1; 0 is any other word
    seed: int = 11
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    usable: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))  # times an item has it, at most
    by_size: dict[int, np.ndarray] = field(default_factory=dict)  # places in ``pairs``, for each item size
    tables: dict[int, list[tuple[int, list[int], np.ndarray, list[list[int]]]]] = field(default_factory=dict)
    whole: dict[int, list[int]] = field(default_factory=dict)  # sizes that are searched without keys: their items

    @classmethod
    def build(
        cls, items: list[tuple[int, list[str]]], similarity: float = SIMILARITY, target_recall: float = TARGET_RECALL
    ) -> LeakIndex:
        names = sorted({w for _, words in items for w in words})
        vocabulary = {w: i for i, w in enumerate(names, start=1)}
        numbered = [(i, np.array([vocabulary[w] for w in words], dtype=np.int64)) for i, words in items]
        index = cls(similarity, numbered, vocabulary)
        wide = len(names) + 1
        index.pairs = np.unique(np.concatenate([a[:-1] * wide + a[1:] for _, a in numbered] or [index.pairs]))
        index.usable = np.zeros(len(index.pairs), dtype=np.int64)
        for _, a in numbered:
            own, times = np.unique(a[:-1] * wide + a[1:], return_counts=True)
            at = np.searchsorted(index.pairs, own)
            index.usable[at] = np.maximum(index.usable[at], times)
        by_size = defaultdict(list)
        for number, (_, words) in enumerate(numbered):
            by_size[len(words)].append(number)
        for size, numbers in by_size.items():
            joined = np.concatenate([numbered[n][1] for n in numbers])
            inner = np.concatenate([a[:-1] * wide + a[1:] for a in (numbered[n][1] for n in numbers)])
            index.by_size[size] = np.unique(np.searchsorted(index.pairs, inner))
            starts = np.arange(len(numbers)) * size
            index.tables[size] = []
            needed = repetitions(size, index.edits(size), target_recall, index.seed)
            if needed is None:
                index.whole[size] = numbers
            for repetition in range(needed or 0):
                # an item without edits is its own key
                steps = sampled_steps(size, repetition, index.seed) if index.edits(size) else []
                table = defaultdict(list)
                codes = index.window_codes(joined, starts, size, steps, index.seed + repetition)
                for number, code in zip(numbers, codes.tolist()):
                    table[code].append(number)
                keys = np.array(sorted(table), dtype=np.int64)
                index.tables[size].append(
                    (index.seed + repetition, steps, keys, [table[k] for k in keys.tolist()])
                )
        return index

    def codes(self, keys: np.ndarray) -> np.ndarray:
        """Keys as one number each (two keys may share one; candidates are verified)."""
        code = np.zeros(len(keys), dtype=np.int64)
        for i in range(keys.shape[1]):
            code = code * np.int64(len(self.vocabulary) + 1) + keys[:, i]
        return code

    def edits(self, size: int) -> int:
        return int(math.floor((1 - self.similarity) * size + 1e-9))

    def window_codes(self, tokens: np.ndarray, starts: np.ndarray, size: int, steps: list[int], seed: int) -> np.ndarray:
        """Keys of windows: the words at the sampled steps, or without steps all words of the window."""
        if steps:
            return self.codes(embed(tokens, starts, size, steps, seed))
        inside = starts[:, None] + np.arange(size)
        return self.codes(np.where(inside < len(tokens), tokens[np.minimum(inside, len(tokens) - 1)], 0))

    def find(self, text: str | None) -> list[Leak]:
        return self.find_all([text])[0]

    def find_all(self, texts: list[str | None]) -> list[list[Leak]]:
        """For each text ``(item id, first word, words, edits, similarity)`` of each item that leaks into it.

        Of an item's stretches the one with the fewest edits, then the first.
        The texts are searched as one row of words with a 0 after each.
        """
        get = self.vocabulary.get
        numbered = [[get(w, 0) for w in words_of(t)] for t in texts]
        edges = np.cumsum([0, *(len(n) + 1 for n in numbered)])
        tokens = np.array([n for words in numbered for n in (*words, 0)], dtype=np.int64)
        best: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        for number, start, stop in self._areas(tokens, edges):
            item = self.items[number][1]
            size, limit = len(item), self.edits(len(item))
            doc = int(np.searchsorted(edges, start, side="right")) - 1
            if number in best[doc] and best[doc][number][0] == 0:
                continue  # an exact copy, and the first
            first, last = int(edges[doc]), int(edges[doc + 1]) - 1
            around = max(first, start - limit)
            stretch = tokens[around : min(last, stop + size + limit)]
            # all but ``limit`` words of the item must be in the stretch
            if sum((Counter(item.tolist()) & Counter(stretch.tolist())).values()) < size - limit:
                continue
            edits, end = distance(item, stretch)
            if edits > limit:
                continue
            _, length = distance(item[::-1], stretch[:end][::-1])
            found = (edits, around + end - length - first, length)
            if number not in best[doc] or found < best[doc][number]:
                best[doc][number] = found
        return [
            [
                (self.items[n][0], first, length, edits, 1 - edits / len(self.items[n][1]))
                for n, (edits, first, length) in sorted(leaks.items())
            ]
            for leaks in best
        ]

    def _areas(self, tokens: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(item number, first window, last window)``: candidates of one item and text that overlap, verified at once."""
        area: tuple[int, int, int] | None = None
        text = -1
        for number, start in self._candidates(tokens):
            size, doc = len(self.items[number][1]), int(np.searchsorted(edges, start, side="right"))
            if area and area[0] == number and doc == text and start - area[2] <= size and start - area[1] <= _AREA * size:
                area = (number, area[1], start)
                continue
            if area:
                yield area
            area, text = (number, start, start), doc
        if area:
            yield area

    def _starts(self, tokens: np.ndarray) -> dict[int, np.ndarray]:
        """For each item size the windows with enough word pairs of the items.

        A pair counts in a window as often as the item that has it most often
        can use it: an occurrence counts if the one ``usable`` places before
        it lies outside the window.
        """
        pair = tokens[:-1] * (len(self.vocabulary) + 1) + tokens[1:]
        if not len(self.pairs):
            return {1: np.flatnonzero(tokens)} if 1 in self.tables else {}
        both = np.flatnonzero((tokens[:-1] > 0) & (tokens[1:] > 0))
        place = np.minimum(np.searchsorted(self.pairs, pair[both]), len(self.pairs) - 1)
        known = self.pairs[place] == pair[both]
        both, place = both[known], place[known]
        # the earlier occurrence that decides, -1 if there is none
        order = np.argsort(place, kind="stable")
        group = place[order]
        rank = np.arange(len(group)) - np.searchsorted(group, group)
        back = self.usable[group]
        decides = np.full(len(tokens), len(tokens), dtype=np.int64)  # no pair: never counts
        decides[both[order]] = np.where(rank >= back, both[order][np.maximum(np.arange(len(group)) - back, 0)], -1)
        # first by running counts: of a run of one pair as many as any item can use
        fresh = np.ones(len(both), dtype=bool)
        fresh[1:] = (np.diff(both) != 1) | (place[1:] != place[:-1])
        at = np.arange(len(both))
        runs = both[at - np.maximum.accumulate(np.where(fresh, at, 0)) < self.usable[place]]
        before = np.zeros(len(tokens) + 1, dtype=np.int64)  # pairs that begin before each word
        before[runs + 1] = 1
        before = np.cumsum(before)
        most = int(self.usable.max(initial=1))  # a window that begins inside a run misses its counted pairs
        need = {size: size - 1 - 2 * self.edits(size) for size in self.tables if size > 1}
        found = {1: np.flatnonzero(tokens)} if 1 in self.tables else {}
        if not need:
            return found
        pairs_in = lambda at, size: before[np.minimum(at + size - 1, len(tokens))] - before[at]
        every = np.arange(len(tokens))
        every = every[pairs_in(every, max(need)) >= min(need.values()) - most]
        number = np.full(len(tokens), len(self.pairs), dtype=np.int64)
        number[both] = place
        own = np.zeros(len(self.pairs) + 1, dtype=bool)
        for size, least in need.items():
            starts = every[pairs_in(every, size) >= least - most]
            own[:] = False
            own[self.by_size[size]] = True  # only pairs of items of this size help
            counted = np.zeros(len(starts), dtype=np.int64)
            for step in range(size - 1):
                inside = np.minimum(starts + step, len(tokens) - 1)
                counted += (decides[inside] < starts) & own[number[inside]] & (starts + step < len(tokens))
            found[size] = starts[counted >= least]
        return found

    def _candidates(self, tokens: np.ndarray) -> list[tuple[int, int]]:
        """``(item number, first word)`` of windows that share a key with an item of their size."""
        found = set()
        if not self.items:
            return []
        for size, starts in self._starts(tokens).items():
            for number in self.whole.get(size, ()):
                found.update((number, int(start)) for start in starts)
            for seed, steps, keys, numbers in self.tables[size] if len(starts) else ():
                codes = self.window_codes(tokens, starts, size, steps, seed)
                place = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
                for at in np.flatnonzero(keys[place] == codes).tolist():
                    found.update((number, int(starts[at])) for number in numbers[place[at]])
        return sorted(found)


def indexes(
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    target_recall: float = TARGET_RECALL,
    block_words: int = BLOCK_WORDS,
) -> Iterator[LeakIndex]:
    """The benchmark as indexes of at most ``block_words`` words each (an item alone may have more)."""
    block: list[tuple[int, list[str]]] = []
    held = 0
    for row in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        words = words_of(row["text"])
        if row["item_id"] is None or not words:
            continue
        if block and held + len(words) > block_words:
            yield LeakIndex.build(block, similarity, target_recall)
            block, held = [], 0
        block.append((row["item_id"], words))
        held += len(words)
    if block:
        yield LeakIndex.build(block, similarity, target_recall)


LEAK_ARRAY = "array<struct<item_id:long,start_word:long,n_words:long,edits:long,similarity:double>>"


def _find_all(shared, text: pd.Series) -> pd.Series:
    return pd.Series(
        [
            [dict(zip(("item_id", "start_word", "n_words", "edits", "similarity"), leak)) for leak in leaks]
            for leaks in shared.value.find_all(list(text))
        ],
        dtype=object,
    )


def found_in(text: Column, shared) -> Column:
    """The leaks of one block in each text, as an array of structs."""

    @F.pandas_udf(LEAK_ARRAY)
    def find(texts: pd.Series) -> pd.Series:
        return _find_all(shared, texts)

    return find(text)


def leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row for each document and item that leaks into it, with the closest stretch."""
    spark = docs.sparkSession
    bounded_batches(spark)
    parts = [
        docs.select("doc_id", F.inline(found_in(F.col("text"), spark.sparkContext.broadcast(index))))
        for index in indexes(benchmark, **options)
    ]
    if not parts:
        nothing = F.from_json(F.lit(None).cast("string"), LEAK_ARRAY)
        return docs.select("doc_id", F.inline(nothing))
    return functools.reduce(DataFrame.unionByName, parts)


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` into which no item leaks, all columns kept."""
    spark = docs.sparkSession
    bounded_batches(spark)
    for index in indexes(benchmark, **options):
        docs = docs.filter(F.size(found_in(F.col("text"), spark.sparkContext.broadcast(index))) == 0)
    return docs
