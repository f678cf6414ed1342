"""Token ids as length-delimited binary records with a separate offset index.

Format, little-endian throughout:

* record file: the 8 bytes ``ENCREC01``, then records. A record is its
  payload's length (u64), the masked CRC-32 of those 8 bytes (u32), the
  payload, and the payload's masked CRC-32 (u32). A payload is one byte
  (1: the id is present), the document id (i64), the bytes of an id (u8: 2 or
  4), then the ids.
* index file: the 8 bytes ``ENCIDX01``, then for each record its offset in the
  record file (u64) and the length of its payload (u64): any order of reading
  seeks by it.

The mask rotates a checksum right by 15 bits and adds a constant, so that a
checksum of data that holds checksums stays useful.

Documents are range-partitioned by id, or by an order the caller names, and each partition writes one record
file and one index file into a folder that all executors share, through
pyarrow's file systems (local mounts, HDFS, object stores). A task writes
under a name of its own attempt and renames at the end; its content depends on
its input only, so an attempt that runs again after a lost executor leaves the
same files. The manifest (one row for each file) is written as a table.

Defined results: null text gives the end id only; null ids come first. Rows
with equal ids are ordered by text, both kept. Extra columns are ignored. An
empty table writes no file and gives an empty result.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import bounded_batches, materialize
from encore.session import scratch_path

RECORD_MAGIC, INDEX_MAGIC = b"ENCREC01", b"ENCIDX01"
END_ID = 1
_MASK_DELTA = 0xA282EAD8  # fixed value of the masking rule
_HEAD, _PAYLOAD = "<QI", "<BqB"
_HEAD_BYTES, _PAYLOAD_BYTES = struct.calcsize(_HEAD), struct.calcsize(_PAYLOAD)
_OVERHEAD = _HEAD_BYTES + 4  # bytes of a record beside its payload
_WORDS_KEPT = 1_000_000  # entries of a worker's word memo before it starts anew
_WORDS_A_TEXT = 256  # unseen words that are handed to the library as one text


class RecordError(ValueError):
    """A record or index file that does not hold what its lengths and checksums say."""


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """One record."""
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def pack(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """A payload from ids that are already ``width`` bytes each."""
    return struct.pack(_PAYLOAD, doc_id is not None, doc_id or 0, width) + ids


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    present, doc_id, width = struct.unpack_from(_PAYLOAD, payload)
    ids = np.frombuffer(payload, dtype=f"<u{width}", offset=_PAYLOAD_BYTES)
    return (doc_id if present else None), ids.astype("<u4")


# Letters whose lower case and composed form need no context, then a run of
# punctuation without the apostrophe (which may begin a contraction).
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")
# White space for str.split() that the library's pattern may not count as such.
_DOUBTFUL = ("\x1c", "\x1d", "\x1e", "\x1f", "\x85")


class WordEncoder:
    """Ids of whole texts by the library, each distinct word encoded once.

    For a tokenizer whose normalizer works character by character and turns
    white space into a separator that its pre-tokenizer never joins across:
    then the ids of a text are the ids of its words in a row. Words are
    remembered for as long as the memo has room. A word of plain letters and
    a tail of punctuation is two pre-tokens and is put together from the two.
    Texts that hold an added token's string, or characters whose role as white
    space is in doubt, go to the library whole.
    """

    def __init__(self, path: str):
        import json
        import os

        # a task has one core: the library's own threads would only compete with other tasks
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.whole = (*(t["content"] for t in spec["added_tokens"]), *_DOUBTFUL)
        top = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
        self.width = 2 if top < 1 << 16 else 4
        self.type = f"<u{self.width}"
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.ends_word = np.zeros(top + 1, dtype=bool)  # tokens that end a pre-token
        self.ends_word[[i for t, i in spec["model"]["vocab"].items() if suffix and t.endswith(suffix)]] = True
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.type).tobytes()

    def _encode_all(self, texts: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _pre_tokens(self, names: list[str]) -> list[bytes]:
        """Ids of strings that are one pre-token each: many in one text, cut behind each word's last token."""
        out: list[bytes] = []
        for group, ids in self._in_groups(names, lambda texts: self.library.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(ids.ids, dtype=self.type)
            stops = (np.flatnonzero(self.ends_word[ids]) + 1) * self.width
            if len(stops) != len(group):  # not one pre-token each after all
                out += self._encode_all(group)
                continue
            raw, begin = ids.tobytes(), 0
            for stop in stops.tolist():
                out.append(raw[begin:stop])
                begin = stop
        return out

    def _whole_words(self, names: list[str]) -> list[bytes]:
        """Ids of any words: many in one text, cut by where in it a token begins."""
        out: list[bytes] = []
        for group, found in self._in_groups(names, lambda texts: self.library.encode_batch(texts, add_special_tokens=False)):
            begins = np.cumsum([0, *(len(w) + 1 for w in group)])
            at = np.array([o[0] for o in found.offsets], dtype=np.int64)
            cuts = (np.searchsorted(at, begins) * self.width).tolist()
            raw = self._bytes(found.ids)
            out += [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        return out

    def _in_groups(self, names: list[str], encode) -> Iterator[tuple[list[str], Any]]:
        groups = [names[i : i + _WORDS_A_TEXT] for i in range(0, len(names), _WORDS_A_TEXT)]
        return zip(groups, encode([" ".join(g) for g in groups]))

    def _learn(self, fresh: list[str]) -> None:
        split = [_PLAIN.fullmatch(w) for w in fresh]
        parts = {p for m in split if m for p in (m[1].lower(), m[2]) if p not in self.parts}
        if len(self.parts) + len(parts) > _WORDS_KEPT:
            self.parts.clear()
            parts = {p for m in split if m for p in (m[1].lower(), m[2])}
        self.parts[""] = b""
        names = [p for p in parts if p]
        self.parts.update(zip(names, self._pre_tokens(names)))
        others = [w for w, m in zip(fresh, split) if not m]
        self.known.update(zip(others, self._whole_words(others)))
        self.known.update((w, self.parts[m[1].lower()] + self.parts[m[2]]) for w, m in zip(fresh, split) if m)

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; the unseen words of all of them are learnt together."""
        whole = {i for i, text in enumerate(texts) if any(t in text for t in self.whole)}
        split = [[] if i in whole else text.split() for i, text in enumerate(texts)]
        known = self.known
        missing = set().union(*split).difference(known)
        if len(known) + len(missing) > _WORDS_KEPT:
            known.clear()
            missing = set().union(*split)
        self._learn(list(missing))
        out = [b"".join([known[w] for w in found]) for found in split]
        for i, ids in zip(sorted(whole), self._encode_all([texts[i] for i in sorted(whole)])):
            out[i] = ids
        return out


_ENCODERS: dict[str, WordEncoder] = {}  # of this worker process, kept from task to task


def encoder_of(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _open(uri: str):
    """File system and path of a shared folder (a plain path is a local mount)."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri if not uri.startswith("file:/") or uri.startswith("file:///") else "file://" + uri[5:])


MANIFEST = "shard int, records string, offsets string, n_docs long, n_tokens long, n_bytes long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long, shard int, record_offset long, record_bytes long"


def _save(batches: Iterator[pd.DataFrame], folder: str, tokenizer: str, end_id: int) -> Iterator[pd.DataFrame]:
    """Write one partition's two files; returns their manifest row (none if there are no rows)."""
    from pyspark import TaskContext

    task = TaskContext.get()
    system, base = _open(folder)
    shard, attempt = task.partitionId(), task.taskAttemptId()
    names = [f"{base}/part-{shard:06d}.{kind}" for kind in ("rec", "idx")]
    drafts = [f"{base}/.draft-{attempt}-part-{shard:06d}.{kind}" for kind in ("rec", "idx")]
    encoder = encoder_of(tokenizer)
    end = np.array([end_id], dtype=encoder.type).tobytes()
    streams: list = []
    n_docs = n_tokens = 0
    at = len(RECORD_MAGIC)
    try:
        for batch in batches:
            if len(batch) and not streams:
                system.create_dir(base, recursive=True)
                streams = [system.open_output_stream(d, buffer_size=1 << 20) for d in drafts]
                for stream, magic in zip(streams, (RECORD_MAGIC, INDEX_MAGIC)):
                    stream.write(magic)
            texts = [text if isinstance(text, str) else "" for text in batch["text"]]
            for doc_id, ids in zip(batch["doc_id"], encoder.encode_many(texts)):
                ids += end
                payload = pack(None if pd.isna(doc_id) else int(doc_id), ids, encoder.width)
                streams[0].write(frame(payload))
                streams[1].write(struct.pack("<QQ", at, len(payload)))
                at += _OVERHEAD + len(payload)
                n_docs += 1
                n_tokens += len(ids) // encoder.width
    finally:
        for stream in streams:
            stream.close()
    if n_docs:
        for draft, name in zip(drafts, names):
            if system.get_file_info(name).is_file:  # an earlier attempt's, the same
                system.delete_file(name)
            system.move(draft, name)
        yield pd.DataFrame(
            [(shard, names[0], names[1], n_docs, n_tokens, at)],
            columns=["shard", "records", "offsets", "n_docs", "n_tokens", "n_bytes"],
        )


def write(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, order: list[Column] | None = None
) -> DataFrame:
    """Encode ``docs(doc_id, text)`` into record files in ``folder``; returns the written manifest.

    ``order``: expressions over ``docs`` that put its rows in a total, rising order (default:
    by id, equal ids by text); the files follow it.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", *[c.alias(f"__{i}") for i, c in enumerate(order or [])]
    )
    if order:
        keys = [f"__{i}" for i in range(len(order))]
        ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    else:
        ordered = rows.repartitionByRange("doc_id")
        ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return materialize(
        ordered.mapInPandas(lambda batches: _save(batches, folder, tokenizer, end_id), MANIFEST), "manifest"
    )


def read_records(folder: str, records: str, offsets: str) -> Iterator[tuple[int, bytes]]:
    """``(offset, payload)`` of each record of a file, lengths and checksums verified."""
    system, _ = _open(folder)
    with system.open_input_file(offsets) as f:
        raw = f.read()
    if raw[:8] != INDEX_MAGIC or (len(raw) - 8) % 16:
        raise RecordError(f"{offsets} is not an index file")
    where = np.frombuffer(raw, dtype="<u8", offset=8).reshape(-1, 2)
    with system.open_input_stream(records, buffer_size=1 << 20) as f:
        if f.read(8) != RECORD_MAGIC:
            raise RecordError(f"{records} is not a record file")
        at = 8
        for offset, length in where.tolist():
            head = f.read(_HEAD_BYTES)
            if len(head) != _HEAD_BYTES:
                raise RecordError(f"{records} ends at {at}")
            found, crc = struct.unpack(_HEAD, head)
            if at != offset or found != length or masked_crc(head[:8]) != crc:
                raise RecordError(f"{records}: bad record length at {at}")
            payload, crc = f.read(length), f.read(4)
            if len(payload) != length or struct.pack("<I", masked_crc(payload)) != crc:
                raise RecordError(f"{records}: bad record at {at}")
            yield at, payload
            at += _OVERHEAD + length
        if f.read(1):
            raise RecordError(f"{records}: records without an index entry")


def _load(batches: Iterator[pd.DataFrame], folder: str) -> Iterator[pd.DataFrame]:
    columns = ["doc_id", "start", "n_tokens", "ids_crc32", "shard", "record_offset", "record_bytes"]
    frame_of = lambda rows: pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})
    for batch in batches:
        for shard, records, offsets, start in zip(batch["shard"], batch["records"], batch["offsets"], batch["start"]):
            rows, start = [], int(start)
            for at, payload in read_records(folder, records, offsets):
                doc_id, ids = unpack(payload)
                rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), shard, at, len(payload)))
                start += len(ids)
                if len(rows) == 10_000:
                    yield frame_of(rows)
                    rows = []
            if rows:
                yield frame_of(rows)


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """One row for each record, from the files: its place, id, token count and checksum of the ids."""
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    placed = materialize(
        manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))), "placed"
    )
    files = max(1, placed.count())
    return placed.repartition(files).mapInPandas(lambda batches: _load(batches, folder), READ)


def stored_order() -> list[Column]:
    """The order of the rows of a table as it was written: by task, file and row in the file."""
    name = F.col("_metadata.file_name")
    return [F.regexp_extract(name, r"part-(\d+)", 1).try_cast("long"), name, F.col("_metadata.row_index")]


def encode_documents(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, order: list[Column] | None = None
) -> DataFrame:
    """Write the record files into a fresh folder of the shared one and read them back."""
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = scratch_path(spark, "records")
    return read(write(docs, folder, tokenizer, end_id, order), folder)
