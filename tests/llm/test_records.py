"""Token records: round trip, checksums, and the library's ids."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from encore.llm import records
from encore.llm.queries import op5_token_records, tokenizer
from encore.session import scratch_path
from test_token_counts import PIECES
from util import ODD, SF, docs, table

PATH = tokenizer("word_bpe_49k.json")


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [records.END_ID]


def expected(given):
    start, out = 0, []
    for doc_id, text in sorted(given, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = ids_of(text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_table_from_the_files(spark):
    found = sorted(tuple(r)[:4] for r in op5_token_records(spark, SF).collect())
    assert found == expected([(r["doc_id"], r["text"]) for r in table("documents")])


def test_odd_rows(spark):
    found = records.encode_documents(docs(spark, ODD, extra=True).repartition(3), PATH).collect()
    assert sorted((tuple(r)[:4] for r in found), key=lambda r: r[1]) == expected(ODD)
    assert records.encode_documents(docs(spark, []), PATH).count() == 0


def test_words_are_encoded_as_whole_texts():
    import random

    rng = random.Random(6)
    encoder, library = records.WordEncoder(PATH), Tokenizer.from_file(PATH)
    pieces = [*PIECES, "J̌", "İ", "ẞ", "Σ", "word,", "don't", "x--y"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(15))) for _ in range(4000)]
    for text in texts + [r["text"] for r in table("documents")[:50]]:
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_unseen_words_of_many_texts_are_learnt_together(monkeypatch):
    monkeypatch.setattr(records, "_WORDS_A_TEXT", 7)
    monkeypatch.setattr(records, "_WORDS_KEPT", 60)
    encoder, library = records.WordEncoder(PATH), Tokenizer.from_file(PATH)
    texts = [r["text"] or "" for r in table("documents")[:40]] + ["", "İx ½ 1\u0301 don't!", "a <|endoftext|> b", "x\x1cy"]
    for at in range(0, len(texts), 9):
        for text, ids in zip(texts[at : at + 9], encoder.encode_many(texts[at : at + 9])):
            assert np.frombuffer(ids, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_another_order_of_the_files(spark):
    from pyspark.sql import functions as F

    given = [(i, f"text number {i}") for i in range(40)]
    found = records.encode_documents(docs(spark, given), PATH, order=[-F.col("doc_id")]).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == list(range(39, -1, -1))


def test_reads_in_any_order_by_the_index(spark):
    folder = scratch_path(spark, "records-test")
    given = [(i, f"text number {i} " * (i % 5)) for i in range(50)]
    manifest = records.write(docs(spark, given), folder, PATH).collect()
    found = {}
    for shard in manifest:
        with open(shard["records"].removeprefix("file:"), "rb") as f:
            data = f.read()
        with open(shard["offsets"].removeprefix("file:"), "rb") as f:
            index = np.frombuffer(f.read()[8:], dtype="<u8").reshape(-1, 2)
        for offset, length in index[::-1].tolist():
            doc_id, ids = records.unpack(data[offset + 12 : offset + 12 + length])
            found[doc_id] = ids.tolist()
    assert found == {i: ids_of(t) for i, t in given}


@pytest.mark.parametrize("where", ["length", "payload", "cut", "more", "index"])
def test_damage_is_found(tmp_path, where):
    payloads = [records.pack(i, np.arange(5 + i, dtype="<u2").tobytes(), 2) for i in range(3)]
    frames = [records.frame(p) for p in payloads]
    at = np.cumsum([8, *map(len, frames)])[:3]
    data = bytearray(records.RECORD_MAGIC + b"".join(frames))
    index = bytearray(records.INDEX_MAGIC + np.array(list(zip(at, map(len, payloads))), dtype="<u8").tobytes())
    files = [str(tmp_path / "a.rec"), str(tmp_path / "a.idx")]

    def load():
        for name, content in zip(files, (data, index)):
            with open(name, "wb") as f:
                f.write(content)
        return [records.unpack(p)[0] for _, p in records.read_records(str(tmp_path), *files)]

    assert load() == [0, 1, 2]
    if where == "length":
        data[at[1]] ^= 1
    elif where == "payload":
        data[at[1] + 20] ^= 1
    elif where == "cut":
        del data[-3:]
    elif where == "more":
        data += frames[0]
    else:
        index[8] ^= 1
    with pytest.raises(records.RecordError):
        load()
