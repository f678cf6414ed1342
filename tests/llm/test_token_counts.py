"""Compiled token counts against the library."""

import random

import pytest
from tokenizers import Tokenizer

from encore.llm import token_counts
from encore.llm.queries import op8_token_counts, tokenizer
from util import ODD, SF, docs, rows, table

PATH = tokenizer("byte_bpe_50k.json")
PIECES = ["<|endoftext|>", "<|startoftext|>", "'s", "'ll", " ", "  ", "\n\n", "\t", "\x1c", "\x85", "\xa0", "　", "​",
          "a", "the", " house", "É", "é", "²", "12", "漢字", "🙂", "!!", ".", "_", "\x00", "K", "ſ"]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    return lambda text: len(found.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(PATH)


def test_every_token_and_random_joins(counter):
    model = Tokenizer.from_file(PATH).model
    tokens = [t for t in Tokenizer.from_file(PATH).get_vocab() if t in counter.machine.rank]
    rng = random.Random(4)
    joins = ["".join(rng.choice(tokens) for _ in range(rng.randrange(1, 5))) for _ in range(20_000)]
    for text in tokens[::3] + joins:
        assert counter.machine.count(text) == len(model.tokenize(text)), text


def test_random_texts_whole_and_in_chunks(counter, library):
    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(15)))
        assert counter.count(text) == library(text), repr(text)
        assert counter.count_chunked(text, rng.randrange(1, 7)) == library(text), repr(text)


def test_chunk_maps_compose_in_any_grouping(counter, library):
    text = "  one two\n\n three'll <|endoftext|> four   " * 5
    maps = [counter.chunk_map(text[i : i + 3]) for i in range(0, len(text), 3)]
    left = maps[0]
    for m in maps[1:]:
        left = counter.compose(left, m)
    right = maps[-1]
    for m in maps[-2::-1]:
        right = counter.compose(m, right)
    assert counter.fold([left]) == counter.fold([right]) == counter.fold(maps) == library(text)


def test_a_bounded_machine_gives_the_same(monkeypatch, library):
    monkeypatch.setattr(token_counts, "MAX_TRANSITIONS", 50)
    monkeypatch.setattr(token_counts, "MAX_SEGMENTS", 10)
    small = token_counts.Counter(PATH)
    for row in table("documents")[:20]:
        assert small.count(row["text"]) == library(row["text"])


def test_whole_table(spark, library):
    found = {r["doc_id"]: r for r in op8_token_counts(spark, SF).collect()}
    for r in table("documents"):
        n = library(r["text"])
        assert tuple(found[r["doc_id"]]) == (r["doc_id"], len(r["text"].encode()), n, n > 1024)


def test_odd_rows_and_chunks(spark, library):
    frame = docs(spark, ODD, extra=True)
    wanted = sorted(
        ((i, len((t or "").encode()), library(t or ""), library(t or "") > 1024) for i, t in ODD), key=repr
    )
    assert rows(token_counts.count_tokens(frame, PATH)) == wanted
    assert rows(token_counts.count_tokens(frame, PATH, chunk=5)) == wanted
    assert token_counts.count_tokens(docs(spark, []), PATH).count() == 0
