"""Token counts by a compiled finite-state tokenizer.

For byte-level BPE tokenizers. A deterministic transducer reads a pre-token
byte by byte; each transition is annotated with the change in the number of
emitted tokens. Its states follow from two facts about BPE: the encoding of a
text is the one token sequence whose neighbours are all compatible, and the
last token of a prefix's encoding decides which tokens can follow. A state
holds, for each suffix that a token may still continue, the place in the
token trie, the last token before the suffix and the count there relative to
the present one: finite, and all that later bytes can ask. States and
transitions are compiled when first met, and the machine starts anew when it
holds ``MAX_TRANSITIONS`` (memory is bounded, results are the same).

Long texts are cut into chunks. White space after anything else always ends a
pre-token, so a chunk's map from the state it is entered in is three values:
the text up to its first such boundary, the tokens between its first and last
boundary, and the text after the last. Maps compose associatively, so the
maps of a text's chunks are folded pairwise, as a parallel prefix scan does.

The library's own pre-tokenizer splits each distinct segment, and added
tokens' strings inside a text count as one token each, as by its default.

Defined results: a null text has 0 bytes and 0 tokens. Each input row gives
its own row. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator


import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import bounded_batches

MAX_TRANSITIONS = 400_000
MAX_SEGMENTS = 500_000
CHUNK = 1 << 15  # code points


class Transducer:
    """Counts the BPE tokens of a pre-token written in the tokenizer's byte alphabet."""

    def __init__(self, model: dict):
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        letters = sorted({c for t in model["vocab"] for c in t})
        # rank: letters first, then merges in order; a token is known by its rank
        self.rank = {c: i for i, c in enumerate(letters)}
        base = len(letters)
        self.parts: list[tuple[int, int]] = [(i, i) for i in range(base)]
        self.pairs: dict[tuple[int, int], int] = {}
        for left, right in merges:
            made = left + right
            pair = (self.rank[left], self.rank[right])
            if made not in self.rank:
                self.rank[made] = len(self.parts)
                self.parts.append(pair)
            self.pairs.setdefault(pair, self.rank[made])
        # trie: node -> {letter: node}; a node's token, or -1
        self.children: list[dict[str, int]] = [{}]
        self.token: list[int] = [-1]
        for text, rank in self.rank.items():
            node = 0
            for c in text:
                below = self.children[node]
                if c not in below:
                    below[c] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = below[c]
            self.token[node] = rank
        self.fits: dict[tuple[int, int], bool] = {}
        # a token counts only if its own text encodes to it alone
        self._reset()
        for text, rank in self.rank.items():
            if len(text) > 1 and not self._stands(rank):
                self.token[self._node(text)] = -1
        self._reset()

    def _node(self, text: str) -> int:
        node = 0
        for c in text:
            node = self.children[node][c]
        return node

    def _stands(self, rank: int) -> bool:
        left, right = self.parts[rank]
        return self.pairs.get((left, right)) == rank and self._compatible(left, right, rank)

    def _reset(self) -> None:
        self.states: dict[tuple, int] = {((0, -1, 0),): 0}
        self.keys: list[tuple] = [((0, -1, 0),)]
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.compiled = 0

    def _compatible(self, a: int, b: int, limit: int | None = None) -> bool:
        """Whether ``a`` then ``b`` is the encoding of their joined text.

        With ``limit``: whether no merge across the seam comes before it.
        Undoes the later of the two outer merges step by step, looking for a
        merge across the seam that would have come earlier.
        """
        key = (a, b)
        if limit is None:
            known = self.fits.get(key)
            if known is not None:
                return known
        bound, first = (limit if limit is not None else 1 << 60), True
        answer = True
        while True:
            merged = self.pairs.get((a, b))
            if merged is not None and merged < bound and not (first and limit == merged):
                answer = False
                break
            first = False
            base_a, base_b = self.parts[a][0] == a, self.parts[b][0] == b
            if base_a and base_b:
                break
            if not base_a and (base_b or a > b):
                # a was made by merge number a: before it, its right part stood at the seam
                bound, a = min(bound, a), self.parts[a][1]
            else:
                bound, b = min(bound, b + 1), self.parts[b][0]
        if limit is None:
            if len(self.fits) > MAX_TRANSITIONS:
                self.fits.clear()
            self.fits[key] = answer
        return answer

    def _compile(self, state: int, letter: str) -> tuple[int, int]:
        """The transition out of ``state`` on ``letter``."""
        reached, last, change = [], -1, None
        for node, before, rel in self.keys[state]:
            below = self.children[node].get(letter)
            if below is None:
                continue
            token = self.token[below]
            if token >= 0 and change is None and (before < 0 or self._compatible(before, token)):
                last, change = token, rel + 1
            if self.children[below]:
                reached.append((below, before, rel))
        if change is None:
            raise ValueError(f"no token ends with {letter!r}")
        key = (*((n, b, r - change) for n, b, r in reached), (0, last, 0))
        target = self.states.get(key)
        if target is None:
            target = self.states[key] = len(self.keys)
            self.keys.append(key)
            self.moves.append({})
        self.moves[state][letter] = (target, change)
        self.compiled += 1
        return target, change

    def count(self, text: str) -> int:
        if self.compiled > MAX_TRANSITIONS:
            self._reset()
        state = total = 0
        moves = self.moves
        for letter in text:
            step = moves[state].get(letter) or self._compile(state, letter)
            state = step[0]
            total += step[1]
        return total


# A line end, a space and letters, punctuation without the apostrophe (which
# may begin a contraction): the pre-tokenizer parts these in any such segment.
_PLAIN = re.compile(r"(\n?)( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")


def byte_letters() -> dict[int, str]:
    """Letter of each byte in the byte-level alphabet: printable Latin-1 stands for itself, the rest follows U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class Counter:
    """Token counts of whole texts or of chunks, for one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["normalizer"]:
            raise ValueError("token counts are compiled for byte-level BPE without a normalizer")
        if model.get("ignore_merges") or model.get("dropout") or any(t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("this tokenizer's options are not compiled")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip or need word ends are not compiled")
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.machine = Transducer(model)
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.strings = tuple(added)
        # white space as the library's pattern sees it: it splits off a symbol
        doubtful = [c for c in map(chr, range(0x3001)) if c.isspace() or c in "​᠎"]
        self.space = "".join(c for c in doubtful if len(self.split("!" + c)) == 2)
        body = re.escape(self.space)
        self.segments = re.compile(f"[{body}]*[^{body}]+|[{body}]+").findall
        self.boundary = re.compile(f"(?<=[^{body}])(?=[{body}])")
        self.alphabet = byte_letters()
        self.known: dict[str, int] = {}
        self.parts: dict[str, int] = {}

    def _segment(self, segment: str) -> int:
        plain = _PLAIN.fullmatch(segment)
        if plain:  # a line end, a word of plain letters, punctuation: three pre-tokens at most
            return sum(self._plain(p) for p in plain.groups() if p)
        total = 0
        pieces = [segment]
        if self.added and any(s in segment for s in self.strings):
            pieces = self.added.split(segment)
            total = len(pieces) - 1
        for piece in pieces:
            for token, _ in self.split(piece) if piece else ():
                total += self.machine.count(token)
        return total

    def _plain(self, token: str) -> int:
        n = self.parts.get(token)
        if n is None:
            if len(self.parts) >= MAX_SEGMENTS:
                self.parts.clear()
            n = self.parts[token] = self.machine.count(token.encode().decode("latin-1").translate(self.alphabet))
        return n

    def count(self, text: str) -> int:
        found = self.segments(text)
        known = self.known
        try:
            return sum(map(known.__getitem__, found))
        except KeyError:
            missing = {s for s in found if s not in known}
        if len(known) + len(missing) > MAX_SEGMENTS:
            known.clear()
            missing = set(found)
        for s in missing:
            known[s] = self._segment(s)
        return sum(map(known.__getitem__, found))

    def chunk_map(self, chunk: str) -> tuple[bool, str, int, str]:
        """``(closed, head, tokens, tail)``; without a boundary the whole chunk is the head."""
        first = self.boundary.search(chunk)
        if first is None:
            return False, chunk, 0, ""
        body = self.segments(chunk)
        tail = body[-1]  # the last boundary lies before the last segment
        if self.boundary.search(tail):
            raise AssertionError("a segment holds a boundary")
        head = chunk[: first.start()]
        return True, head, self.count(chunk[first.start() : len(chunk) - len(tail)]), tail

    def compose(self, a: tuple[bool, str, int, str], b: tuple[bool, str, int, str]) -> tuple[bool, str, int, str]:
        """The map of two neighbouring chunks, first ``a``."""
        if not a[0]:
            # the seam may itself be a boundary
            if not b[0]:
                return self.chunk_map(a[1] + b[1])
            joined = self.chunk_map(a[1] + b[1])
            if not joined[0]:
                return True, joined[1], b[2], b[3]
            return True, joined[1], joined[2] + self.count(joined[3]) + b[2], b[3]
        if not b[0]:
            joined = self.chunk_map(a[3] + b[1])
            if not joined[0]:
                return True, a[1], a[2], joined[1]
            return True, a[1], a[2] + self.count(joined[1]) + joined[2], joined[3]
        return True, a[1], a[2] + self.count(a[3] + b[1]) + b[2], b[3]

    def fold(self, maps: list[tuple[bool, str, int, str]]) -> int:
        """Tokens of a text from the maps of its chunks, composed pairwise."""
        while len(maps) > 1:
            pairs = [maps[i : i + 2] for i in range(0, len(maps), 2)]
            maps = [self.compose(*p) if len(p) == 2 else p[0] for p in pairs]
        if not maps:
            return 0
        _, head, tokens, tail = maps[0]
        return self.count(head) + tokens + self.count(tail)

    def count_chunked(self, text: str, size: int) -> int:
        return self.fold([self.chunk_map(text[i : i + size]) for i in range(0, len(text), size)])


_COUNTERS: dict[str, Counter] = {}  # of this worker process, kept from task to task


def counter_of(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


MAPS = "struct<closed:boolean,head:string,tokens:long,tail:string>"


def chunk_maps(chunks: Column, path: str) -> Column:
    """The map of each chunk; a text's only chunk is counted whole (``tokens``)."""

    @F.pandas_udf(MAPS)
    def maps(chunk: pd.Series, only: pd.Series) -> pd.DataFrame:
        counter = counter_of(path)
        rows = [
            (True, "", counter.count(c), "") if alone else counter.chunk_map(c) for c, alone in zip(chunk, only)
        ]
        return pd.DataFrame(rows, columns=["closed", "head", "tokens", "tail"])

    return maps(chunks, F.col("n_chunks") == 1)


def folded(maps: Column, path: str) -> Column:
    """Tokens of a text from its chunks' maps in order."""

    @F.pandas_udf("long")
    def fold(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = counter_of(path)
        for rows in batches:
            yield pd.Series(
                [
                    counter.fold([(m["closed"], m["head"], m["tokens"], m["tail"]) for m in found])
                    for found in rows
                ],
                dtype="int64",
            )

    return fold(maps)


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs``.

    Chunks of one text are mapped one by one and meet again by row: only the
    maps (a count and two short ends each) are shuffled, never text.
    """
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    n_chunks = F.greatest(F.lit(1), F.ceil(F.length(text) / chunk)).cast("int")
    cut = F.when(n_chunks == 1, F.array(text)).otherwise(
        F.transform(F.sequence(F.lit(0), n_chunks - 1), lambda i: F.substring(text, i * chunk + 1, F.lit(chunk)))
    )
    rows = docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        n_chunks.alias("n_chunks"),
        cut.alias("chunks"),
    ).select("doc_id", "row", "n_bytes", "n_chunks", F.posexplode("chunks").alias("number", "chunk"))
    mapped = rows.select("doc_id", "row", "n_bytes", "n_chunks", "number", chunk_maps(F.col("chunk"), path).alias("m"))
    whole = mapped.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_bytes").alias("n_bytes"),
        F.sum("m.tokens").alias("tokens"),
        F.sort_array(
            F.collect_list(F.when(F.col("n_chunks") > 1, F.struct("number", "m.closed", "m.head", "m.tokens", "m.tail")))
        ).alias("maps"),
    )
    counted = whole.select(
        "doc_id",
        "n_bytes",
        F.when(F.size("maps") == 0, F.col("tokens")).otherwise(folded(F.col("maps"), path)).cast("long").alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
