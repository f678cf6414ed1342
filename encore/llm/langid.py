"""Language identification by words, backing off to character n-grams.

A model has the log frequency of known words in each language and of the
character n-grams (5 down to 1, with word ends marked) of all training words.
A known word scores by its frequencies; an unseen one is covered by n-grams,
at each place the longest known one. A text's score is the sum over all its
words; the result is the language with the highest posterior under equal
priors, the posterior of the mean word (tempered by the root of the number of
words) being the score.

Training: a sample of about ``max_rows`` labelled rows for each language, those
with the smallest hash of id and text; all words and n-grams of the sample are
kept. That bound is a parameter and bounds what is broadcast: an entry holds
its counts in the languages where it occurs only. Prediction reads every whole
text. Words are runs of letters (``\\p{L}``) on both sides.

Defined results: null texts and texts without a letter are ``und`` with score
0. With no labelled row at all, every text is ``und``. Each input row gives
its own row. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import bounded_batches, materialize

UNKNOWN = "und"
MAX_ROWS = 1000
LONGEST = 5
_MEMO = 200_000
_WORD = re.compile(r"[^\W\d_]+")  # letters, and numerals such as U+00B2
_LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    lower = text.lower()
    found = _WORD.findall(lower)
    return found if "".join(found).isalpha() else _LETTERS.findall(lower)


class SparseTable:
    """Log frequencies of entries, stored for the languages in which they occur.

    ``classes`` numbers the entries' groups; ``absent`` has a row for each
    group, the log frequency of an entry where it does not occur.
    """

    def __init__(self, counted: pd.DataFrame, languages: list[str], group):
        place = {name: i for i, name in enumerate(languages)}
        counted = counted.sort_values("entry", kind="stable")
        codes, entries = pd.factorize(counted["entry"])
        self.rows = {e: i for i, e in enumerate(entries)}
        self.starts = np.searchsorted(codes, np.arange(len(entries) + 1))
        self.langs = counted["lang"].astype(str).map(place).to_numpy(dtype=np.int32)
        groups = np.array([group(e) for e in entries], dtype=np.int64)
        names, self.classes = np.unique(groups, return_inverse=True)
        n = counted["n"].to_numpy(dtype=np.float64)
        totals = np.zeros((len(names), len(languages)))
        np.add.at(totals, (self.classes[codes], self.langs), n)
        # half a count is added to each entry of a group, and to one unseen entry
        share = totals + 0.5 * (np.bincount(self.classes, minlength=len(names)) + 1)[:, None]
        self.absent = np.log(0.5 / share)
        self.logs = np.log((n + 0.5) / share[self.classes[codes], self.langs])

    def __len__(self) -> int:
        return len(self.rows)

    def get(self, entry: str) -> np.ndarray | None:
        row = self.rows.get(entry)
        if row is None:
            return None
        out = self.absent[self.classes[row]].copy()
        held = slice(self.starts[row], self.starts[row + 1])
        out[self.langs[held]] = self.logs[held]
        return out


@dataclass
class Model:
    languages: list[str]
    words: SparseTable | dict[str, np.ndarray]  # log frequency in each language
    grams: SparseTable | dict[str, np.ndarray]

    def unseen(self, word: str) -> np.ndarray:
        """Mean log frequency of the longest known n-grams that cover a word."""
        marked = f"<{word}>"
        total, count, at = np.zeros(len(self.languages)), 0, 0
        while at < len(marked):
            for size in range(min(LONGEST, len(marked) - at), 0, -1):
                found = self.grams.get(marked[at : at + size])
                if found is not None:
                    total += found
                    count += 1
                    break
            at += max(1, size - 1) if found is not None else 1
        return total / count if count else total

    def score(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        return known if known is not None else self.unseen(word)


class Scorer:
    """Predicts texts with a model, remembering words' scores."""

    def __init__(self, model: Model):
        self.model = model
        self.rows: dict[str, int] = {}
        self.matrix = np.zeros((1024, len(model.languages)))

    def _learn(self, words: set[str]) -> None:
        if len(self.rows) + len(words) > _MEMO:
            self.rows.clear()
        need = len(self.rows) + len(words)
        if need > len(self.matrix):
            grown = np.zeros((max(need, 2 * len(self.matrix)), self.matrix.shape[1]))
            grown[: len(self.matrix)] = self.matrix
            self.matrix = grown
        for w in words:
            self.matrix[len(self.rows)] = self.model.score(w)
            self.rows[w] = len(self.rows)

    def predict(self, text: str | None) -> tuple[str, float]:
        found = words_of(text)
        if not found or not self.model.languages:
            return UNKNOWN, 0.0
        rows = self.rows
        missing = {w for w in found if w not in rows}
        if missing:
            if len(rows) + len(missing) > _MEMO:
                missing = set(found)
            self._learn(missing)
        total = self.matrix[np.fromiter(map(rows.__getitem__, found), dtype=np.int64, count=len(found))].sum(axis=0)
        tempered = total / math.sqrt(len(found))
        shares = np.exp(tempered - tempered.max())
        best = int(total.argmax())
        return self.model.languages[best], float(shares[best] / shares.sum())


def _grams(marked: Column, size: int) -> Column:
    """All runs of ``size`` characters of a marked word."""
    places = F.sequence(F.lit(1), F.length(marked) - (size - 1))
    runs = F.transform(places, lambda at: F.substring(marked, at, F.lit(size)))
    return F.when(F.length(marked) >= size, runs).otherwise(F.array().cast("array<string>"))


def _collected(counted: DataFrame, key: str) -> pd.DataFrame:
    """Counts of the sample's entries, as compact columns."""
    return counted.select("lang", F.col(key).alias("entry"), "n").toArrow().to_pandas(categories=["lang"])


def train(labelled: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """A model from ``labelled(doc_id, text, lang)``."""
    usable = labelled.filter("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], {}, {})
    # the smallest hashes of each language, about max_rows of them, by one scan
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, min(1.0, max_rows / n)).otherwise(share)
    point = F.pmod(F.xxhash64("doc_id", "text", F.lit(1)), F.lit(1 << 40)) / float(1 << 40)
    sample = usable.filter(point < share)
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    by_word = materialize(
        sample.select("lang", word.alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n")), "words"
    )
    marked = F.concat(F.lit("<"), "word", F.lit(">"))
    pieces = F.flatten(F.array(*(_grams(marked, size) for size in range(1, LONGEST + 1))))
    by_gram = by_word.select("lang", "n", F.explode(pieces).alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # words share out one mass in each language, n-grams of one length another
    words = SparseTable(_collected(by_word, "word"), languages, lambda e: 0)
    grams = SparseTable(_collected(by_gram, "gram"), languages, len)
    return Model(languages, words, grams)


_SCORERS: dict[int, Scorer] = {}  # of this worker process, by broadcast


def predicted(text: Column, shared) -> Column:
    """``struct<lang_pred, score>`` of each text under a broadcast model."""

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        scorer = _SCORERS.get(id(model))
        if scorer is None or scorer.model is not model:
            _SCORERS.clear()
            scorer = _SCORERS[id(model)] = Scorer(model)
        for texts in batches:
            yield pd.DataFrame([scorer.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(text)


def identify(docs: DataFrame, labelled: DataFrame, **bounds) -> DataFrame:
    """``doc_id, lang_pred, score`` for each row of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(train(labelled, **bounds))
    return docs.select("doc_id", predicted(F.col("text"), shared).alias("found")).select("doc_id", "found.*")


def held_out() -> Column:
    """The fold that training never sees, by the id alone."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
