"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a boolean column over measures of the text; a document is kept if
no rule rejects it. The rules are tried one after the other and the first
rejection ends the cascade for that document. Their order comes from a sample:
each rule's cost is the time of a job that evaluates it alone over the sample,
its selectivity the share of the sample it rejects, and rules run by rejection
per cost. All rules are deterministic and rejection is an OR of them, so the
order changes the time and never the verdict.

Sample: rows whose hash of the text falls below ``sample_rows / count`` (about
``sample_rows`` rows whatever the size; default 2,000). It decides the order
only; measures and verdicts cover every row and every whole text.

Defined results: a null text has no words and counts as an empty text, which
the word count rule rejects. Each input row gives its own row, repeated or
not; a null id stays null. Extra columns are ignored by ``measure`` and kept
by ``keep``. An empty table gives an empty result (rules in listed order).
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import SPACE, let, materialize, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
# Letters and marks of scripts written without spaces between words, as a character class body.
UNSPACED = (
    r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsBopomofo}\p{IsYi}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}"
    r"\p{IsJavanese}\p{IsBalinese}\p{IsTai_Le}\p{IsNew_Tai_Lue}\p{IsTai_Tham}\p{IsTai_Viet}"
)


def n_symbols(text: Column) -> Column:
    """Characters of ``#*$%&|<>``."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{SYMBOLS}]+", "")).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))
    return let(lines, lambda found: (F.size(found) - F.size(F.array_distinct(found))).cast("long"))


def n_repeat_words(tokens: Column, window: int = WINDOW) -> Column:
    """Words covered by windows of ``window`` words that occur twice or more.

    Texts whose window hashes are all different (most) end at a distinct
    count. In the others a sort brings equal windows together; their
    positions in order give the covered words.
    """
    long = F.lit(0).cast("long")

    def covered(prints: Column) -> Column:
        placed = F.sort_array(F.transform(prints, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(by_hash: Column) -> Column:
            last = F.size(by_hash) - 1
            again = F.filter(
                by_hash,
                lambda x, k: ((k > 0) & (F.get(by_hash, k - 1)["h"] == x["h"]))
                | ((k < last) & (F.get(by_hash, k + 1)["h"] == x["h"])),
            )
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        start = F.struct(F.lit(-window).alias("at"), long.alias("n"))
        return F.aggregate(
            let(placed, positions),
            start,
            lambda so_far, p: F.struct(
                p.alias("at"), (so_far["n"] + F.least(F.lit(window), p - so_far["at"])).alias("n")
            ),
            lambda end: end["n"],
        )

    def from_hashes(hashes: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (window - 1)), lambda i: F.xxhash64(F.slice(hashes, i, window))
        )
        return F.when(F.size(hashes) < window, long).otherwise(
            let(
                windows,
                lambda prints: F.when(F.size(F.array_distinct(prints)) == F.size(prints), long).otherwise(
                    covered(prints)
                ),
            )
        )

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), from_hashes)


def measure(docs: DataFrame, passthrough: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The base measures of each row, beside ``passthrough`` columns and ``text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select(*passthrough, text.alias("text"), words(F.col("text")).alias("tokens"))
    counted = out.select(
        *passthrough,
        "text",
        F.size("tokens").cast("long").alias("n_words"),
        F.length(F.array_join("tokens", "")).cast("long").alias("word_chars"),
        n_repeat_words(F.col("tokens")).alias("n_repeat_words"),
    )
    return counted.select(
        *passthrough,
        "text",
        "n_words",
        "word_chars",
        n_symbols(F.col("text")).alias("n_symbols"),
        n_dup_lines(F.col("text")).alias("n_dup_lines"),
        "n_repeat_words",
    )


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true where the rule rejects; built over a text column."""

    name: str
    rejects: Column


def _share(pattern: str, text: Column) -> Column:
    """Characters of a class, as a number."""
    return F.length(F.regexp_replace(text, pattern, ""))


def unspaced(text: Column) -> Column:
    """Whether at least half of a text's letters and marks are of scripts written without spaces."""
    return _share(f"[^{UNSPACED}]+", text) * 2 >= _share(r"[^\p{L}\p{M}]+", text)


def rules(text: Column | None = None) -> list[Rule]:
    """The default rules over a text. The first two are the base rules.

    Each is self-contained (it computes what it needs from the text), so that
    a later rule's cost is not paid for a document an earlier one rejects.
    """
    text = F.coalesce(F.col("text") if text is None else text, F.lit(""))
    n_words = F.size(words(text))
    return [
        Rule("few_words", n_words < 20),
        Rule(
            "repeated_windows",
            let(words(text), lambda w: 100 * n_repeat_words(w) > 30 * F.size(w)),
        ),
        # more than one symbol to ten words
        Rule("symbols", let(n_words, lambda n: 10 * n_symbols(text) > n)),
        # words of under 2 or over 15 characters on average; a text that is mostly in scripts
        # without spaces has no words between them, so no upper bound
        Rule(
            "word_length",
            let(
                words(text),
                lambda w: (F.length(F.array_join(w, "")) < 2 * F.size(w))
                | ((F.length(F.array_join(w, "")) > 15 * F.size(w)) & ~unspaced(text)),
            ),
        ),
        # three lines or more, and over three in ten, repeat an earlier line
        Rule(
            "repeated_lines",
            let(
                n_dup_lines(text),
                lambda n: (n >= 3)
                & (10 * n > 3 * F.size(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE}]")))),
            ),
        ),
        # at least half of the letters are capitals
        Rule("capitals", (_share(r"[^\p{Lu}]+", text) * 2 >= _share(r"[^\p{L}]+", text)) & text.rlike(r"\p{L}")),
        # fewer than six characters in ten of the words are letters or their combining marks
        Rule("letters", 10 * _share(r"[^\p{L}\p{M}]+", text) < 6 * _share(f"[{SPACE}]+", text)),
    ]


def plan_cascade(docs: DataFrame, chosen: list[Rule], sample_rows: int = 2000) -> list[tuple[Rule, float, float]]:
    """Rules by rejection per cost: ``(rule, rejected share, seconds)``."""
    total = docs.count()
    if not total:
        return [(r, 0.0, 0.0) for r in chosen]
    share = min(1.0, sample_rows / total)
    point = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
    sample = materialize(docs.select("text").filter(point), "sample")
    size = max(1, sample.count())

    def timed(column: Column) -> tuple[float, float]:
        begin = time.perf_counter()
        found = sample.agg(F.sum(F.when(column, 1).otherwise(0)).alias("n")).first()["n"] or 0
        return found / size, time.perf_counter() - begin

    floor = timed(F.col("text").isNull() & F.lit(False))[1]
    found = []
    for rule in chosen:
        rejected, seconds = timed(rule.rejects)
        found.append((rule, rejected, max(seconds - floor, 1e-3)))
    return sorted(found, key=lambda x: (-x[1] / x[2], x[0].name))


def rejected_by_any(ordered: list[Rule]) -> Column:
    """True where a rule rejects; a later rule is evaluated only if the earlier ones pass."""
    verdict = F.lit(False)
    for rule in reversed(ordered):
        verdict = F.when(rule.rejects, True).otherwise(verdict)
    return verdict


def keep(docs: DataFrame, chosen: list[Rule] | None = None, sample_rows: int = 2000) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns kept."""
    ordered = [r for r, _, _ in plan_cascade(docs, chosen or rules(), sample_rows)]
    return docs.filter(~rejected_by_any(ordered))


def report(docs: DataFrame, sample_rows: int = 2000) -> DataFrame:
    """Measures and verdicts: one row for each row of ``docs``.

    The two base rules are read off the measures that each row returns
    anyway; the cascade over the other rules is entered only where they pass.
    """
    extra = rules()[2:]
    ordered = [r for r, _, _ in plan_cascade(docs, extra, sample_rows)]
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measure(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.when(failed, False).when(rejected_by_any(ordered), False).otherwise(True).alias("kept"),
    )
