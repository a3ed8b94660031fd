"""Token ids as length-delimited binary records with an offset index.

Writing: rows are range-partitioned by id and sorted, so the files, in order,
hold ascending ids. A task encodes its rows and writes one record file and one
index file to the shared folder. A record is

    u64 payload length | u32 masked crc32 of those 8 bytes |
    payload            | u32 masked crc32 of the payload

(little-endian), and the payload is the document id (i64), the number of ids
(u32), the width of an id in bytes (u8) and the ids themselves. A
checksum is masked as ``rotate_right(crc, 15) + 0xA282EAD8``, so a checksum of
data that holds checksums stays sound. The index file is one u64 per record:
where the record starts. Any record can so be read by itself, in any order
(``read_record``).

A task writes under a name of its own and reports it in a manifest row; only
files in the manifest (one Parquet table, written once) count, so a retried
or doubled task leaves a file that nothing reads.

Reading: each task takes manifest rows and streams their files, checking both
checksums of every record. The start of a file among all ids is a running sum
over the manifest, one row per file.

Defined results: a null text is an empty one (only the end id); repeated ids
are written in an order by text; a null id comes first and stays null; an
empty table gives an empty manifest; other columns are ignored. A text of any
length is one record.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferry.llm.common import arrow_map, materialise
from ferry.llm.wordids import UnitTable, chunks, only
from ferry.session import scratch_path

# The mask of a checksum and the markers of a missing id.
MASK = 0xA282EAD8
NO_ID = -(1 << 63)
HEAD = struct.Struct("<QI")
ITEM = struct.Struct("<qIB")
READ_BYTES = 8 << 20

_TABLES: dict[str, Words] = {}


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload,
                     struct.pack("<I", masked(payload))))


def record(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """The record of ids packed in ``width`` bytes each."""
    key = NO_ID if doc_id is None else doc_id
    return frame(ITEM.pack(key, len(ids) // width, width) + ids)


def pack_record(doc_id: int | None, ids: np.ndarray) -> bytes:
    return record(doc_id, ids.tobytes(), ids.dtype.itemsize)


def unpack_payload(payload: bytes) -> tuple[int | None, np.ndarray]:
    key, n, width = ITEM.unpack_from(payload)
    ids = np.frombuffer(payload, f"<u{width}", offset=ITEM.size)
    if len(ids) != n:
        raise ValueError(f"record of document {key}: {len(ids)} ids, {n} announced")
    return (None if key == NO_ID else key), ids


def read_frame(stream) -> bytes | None:
    """The next payload of a stream, None at its end; raises on damage."""
    head = stream.read(HEAD.size)
    if not head:
        return None
    if len(head) < HEAD.size or masked(head[:8]) != HEAD.unpack(head)[1]:
        raise ValueError("damaged record length")
    size = HEAD.unpack(head)[0]
    body = stream.read(size + 4)
    if len(body) < size + 4 or masked(body[:-4]) != struct.unpack("<I", body[-4:])[0]:
        raise ValueError("damaged record")
    return body[:-4]


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path)


def read_record(path: str, index_path: str, k: int) -> tuple[int | None, np.ndarray]:
    """Record ``k`` of a file, through its index."""
    f, p = _open(index_path)
    with f.open_input_file(p) as x:
        x.seek(8 * k)
        at = struct.unpack("<Q", x.read(8))[0]
    f, p = _open(path)
    with f.open_input_file(p) as x:
        x.seek(at)
        return unpack_payload(read_frame(x))


# The normaliser and splitter of the tokenizer file for which
# texts of Latin-1 characters are cut here, by the same rule written out.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "behavior": "Removed", "invert": True, "pattern": {
    "Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}}
_L, _N, _S = "a-zA-ZªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
PIECES = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")


class Words:
    """The worker's tables for one tokenizer file, whose pre-tokenizer drops
    white space and never joins across it.

    Latin-1 characters are in composed form and lower-case one by one, so if
    the file has ``NORMALIZER`` and ``SPLIT`` (followed by the byte level), the
    pieces that its model gets from such a text are those of ``PIECES`` over
    the lower-cased text: they are the units and go straight to the model. Of
    all other texts, and of those that may hold a special token, the units are
    words, which take the library's whole way.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(tokenizer_file)
        with open(tokenizer_file, encoding="utf-8") as f:
            plan = json.load(f)
        split = plan.get("pre_tokenizer") or {}
        steps = split.get("pretokenizers") or [split]
        self.by_piece = (plan.get("normalizer") == NORMALIZER and steps[0] == SPLIT
                         and [(s["type"], s.get("use_regex"), s.get("add_prefix_space"))
                              for s in steps[1:]] == [("ByteLevel", False, False)])
        self.special = [t["content"] for t in plan.get("added_tokens", ())]
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.pieces = UnitTable(self._piece_ids, self.dtype)
        self.words = UnitTable(self._word_ids, self.dtype)

    def _piece_ids(self, pieces: list[str]) -> tuple[list, list]:
        tokenize, level = self.tok.model.tokenize, self.bytes.pre_tokenize_str
        found = [[t.id for t in tokenize(p if p.isascii() and p.isprintable()
                                         else level(p)[0][0])] for p in pieces]
        return list(chain.from_iterable(found)), [len(x) for x in found]

    def _word_ids(self, words: list[str]) -> tuple[list, list]:
        found = [e.ids for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]
        return list(chain.from_iterable(found)), [len(x) for x in found]

    def pack(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        plain = [self.by_piece and _latin(t) and not any(s in t for s in self.special)
                 for t in texts]
        fast = iter(self.pieces.pack([PIECES.findall(t.lower())
                                      for t, p in zip(texts, plain, strict=True) if p]))
        # White space of one byte: what the library splits at is a superset.
        slow = iter(self.words.pack([[w.decode() for w in t.encode().split()]
                                     for t, p in zip(texts, plain, strict=True) if not p]))
        return [next(fast) if p else next(slow) for p in plain]


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def word_table(tokenizer_file: str) -> Words:
    """The worker's tables for one tokenizer file; those of others are emptied."""
    if tokenizer_file not in _TABLES:
        _TABLES[tokenizer_file] = Words(tokenizer_file)
    found = _TABLES[tokenizer_file]
    only(found.pieces, found.words)
    return found


def _writer(folder: str, tokenizer_file: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(tokenizer_file)
        width = table.dtype.itemsize
        end = np.asarray([end_id], table.dtype).tobytes()
        name = f"{folder}/records-{uuid.uuid4().hex}"
        filesystem, path = _open(name)
        n = total = at = 0
        first = last = None
        out = index = None
        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = (t.as_py() or "" for t in batch.column(1))
            for start, run in chunks(texts):
                if out is None:
                    filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out = filesystem.open_output_stream(path + ".bin")
                    index = filesystem.open_output_stream(path + ".idx")
                    first = keys[0]
                # One write a chunk, of records and of offsets.
                records, starts = [], []
                for key, packed in zip(keys[start:start + len(run)], table.pack(run), strict=True):
                    records.append(record(key, packed + end, width))
                    starts.append(at)
                    at += len(records[-1])
                    n += 1
                    total += len(packed) // width + 1
                out.write(b"".join(records))
                index.write(np.array(starts, "<u8").tobytes())
                last = keys[start + len(run) - 1]
        if out is not None:
            out.close()
            index.close()
            yield pa.RecordBatch.from_pydict(
                {"path": [name + ".bin"], "index_path": [name + ".idx"], "first_id": [first],
                 "last_id": [last], "n_docs": [n], "n_ids": [total], "n_bytes": [at]},
                schema=pa.schema([("path", pa.string()), ("index_path", pa.string()),
                                  ("first_id", pa.int64()), ("last_id", pa.int64()),
                                  ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                                  ("n_bytes", pa.int64())]))
    return write


def write_records(docs: DataFrame, tokenizer_file: str, end_id: int, folder: str | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as record files; return the manifest, one row per file,
    with ``start``, the number of ids in all files before it."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "records")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.col(f"`{text_col}`").alias("text"))
    ordered = rows.repartitionByRange(F.asc_nulls_first("id")).sortWithinPartitions(
        F.asc_nulls_first("id"), "text")
    manifest = materialise(
        arrow_map(ordered, _writer(folder, tokenizer_file, end_id),
                  "path string, index_path string, first_id long, last_id long, "
                  "n_docs long, n_ids long, n_bytes long"), "records-manifest")
    # One row per file: the window sees the manifest only.
    before = (Window.orderBy(F.asc_nulls_first("first_id"), F.asc_nulls_first("last_id"), "path")
              .rowsBetween(Window.unboundedPreceding, -1))
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])
    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                               strict=True):
            f, p = _open(path)
            rows = {c: [] for c in schema.names}
            with f.open_input_stream(p, buffer_size=READ_BYTES) as x:
                while (payload := read_frame(x)) is not None:
                    key, ids = unpack_payload(payload)
                    rows["doc_id"].append(key)
                    rows["start"].append(start)
                    rows["n_tokens"].append(len(ids))
                    rows["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                    start += len(ids)
                    if len(rows["doc_id"]) >= 10_000:
                        yield pa.RecordBatch.from_pydict(rows, schema=schema)
                        rows = {c: [] for c in schema.names}
            yield pa.RecordBatch.from_pydict(rows, schema=schema)


def read_records(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """One row per record of the manifest's files: ``doc_id``, ``start`` (ids
    of all records before it), ``n_tokens``, ``ids_crc32``."""
    # A fixed number, so that adaptive execution does not merge these tiny rows
    # (each stands for a whole file) into one task.
    files = manifest.select("path", "start").repartition(max(1, manifest.count()), "path")
    return arrow_map(files, _reader, "doc_id long, start long, n_tokens long, ids_crc32 long")
