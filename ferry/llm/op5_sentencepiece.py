"""SentencePiece models on the tokenizers library.

The model protobuf is parsed here (pieces with score and type, trainer and
normaliser settings) and rebuilt as a tokenizers pipeline: the precompiled
normaliser map if the model has one, the metaspace marker for spaces, the
vocabulary with unigram scores (``Unigram``) or with the merges that the
scores of a BPE model imply (``BPE``), byte fallback, and the matching
decoder.

No piece of these models holds a metaspace marker after another character, so
merges never cross the start of a run of markers; nor a line break if no
piece holds one. A text is cut there, each worker encodes distinct units in
multithreaded batches with the rebuilt tokenizer, whose ids are the result, and
decodes them again. Every distinct unit is also encoded by the sentencepiece
library: where the two differ the library's ids are used and the document is
marked ``parity = false``. Texts of a model whose pieces do cross such a border
are encoded and compared whole.

Defined results: a null or empty text has no ids and decodes to ''; rows are
encoded one by one, so repeated rows give repeated rows; a null id stays null;
other columns are ignored; an empty table gives an empty result. Texts of any
length are cut into units, some 1 MB of characters at a time.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import arrow_map
from ferry.llm.wordids import UnitTable, chunks, cut_words, only

MARK = "▁"
# Piece types and model types of the protobuf.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int, object]]:
    """``(field number, wire type, value)`` of one protobuf message."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return value

    while at < end:
        key = varint()
        number, wire = key >> 3, key & 7
        if wire == 0:
            yield number, wire, varint()
        elif wire == 2:
            size = varint()
            yield number, wire, data[at:at + size]
            at += size
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            yield number, wire, data[at:at + size]
            at += size
        else:
            raise ValueError(f"wire type {wire} in the model file")


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True
    charsmap: bytes = b""


def parse_model(data: bytes) -> Model:
    m = Model()
    for number, _, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, _, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            m.pieces.append((piece, score, kind))
        elif number == 2:
            for n, _, v in _fields(value):
                if n == 3:
                    m.kind = v
                elif n == 35:
                    m.byte_fallback = bool(v)
        elif number == 3:
            for n, _, v in _fields(value):
                if n == 2:
                    m.charsmap = v
                elif n == 3:
                    m.dummy_prefix = bool(v)
                elif n == 4:
                    m.squeeze = bool(v)
                elif n == 5:
                    m.escape = bool(v)
    return m


def _merges(m: Model) -> list[tuple[str, str]]:
    """Merges of a BPE model: every way to cut a piece into two pieces, the
    best-scored piece first."""
    score = {p: s for p, s, k in m.pieces if k in (NORMAL, USER_DEFINED, UNUSED)}
    number = {p: i for i, (p, _, _) in enumerate(m.pieces)}
    ranked = sorted((p for p in score if len(p) > 1), key=lambda p: (-score[p], number[p]))
    out = []
    for p in ranked:
        cuts = [(p[:i], p[i:]) for i in range(1, len(p)) if p[:i] in score and p[i:] in score]
        out += sorted(cuts, key=lambda c: (number[c[0]], number[c[1]]))
    return out


def build_tokenizer(m: Model):
    """The tokenizers pipeline without normaliser and pre-tokenizer (texts
    come normalised, see ``SentencePiece.normalise``)."""
    from tokenizers import Tokenizer, decoders, models

    unk = next(i for i, (_, _, k) in enumerate(m.pieces) if k == UNKNOWN)
    if m.kind == UNIGRAM:
        model = models.Unigram([(p, s) for p, s, _ in m.pieces], unk, m.byte_fallback)
    elif m.kind == BPE:
        model = models.BPE({p: i for i, (p, _, _) in enumerate(m.pieces)}, _merges(m),
                           unk_token=m.pieces[unk][0], fuse_unk=True,
                           byte_fallback=m.byte_fallback)
    else:
        raise ValueError(f"model type {m.kind} has no tokenizers counterpart")
    tok = Tokenizer(model)
    steps = [decoders.Replace(MARK, " ")]
    if m.byte_fallback:
        steps.append(decoders.ByteFallback())
    tok.decoder = decoders.Sequence([*steps, decoders.Fuse()])
    return tok


class SentencePiece:
    """One model file: normalise, encode, decode, and parity by unit."""

    def __init__(self, model_file: str, threads: int = 2):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece
        from tokenizers import normalizers

        with open(model_file, "rb") as f:
            self.model = m = parse_model(f.read())
        self.tokenizer = build_tokenizer(m)
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.threads = threads
        self.charsmap = normalizers.Precompiled(m.charsmap) if m.charsmap else None
        # Whether units are exact, and whether a line break ends one.
        free = all(MARK not in p.lstrip(MARK) for p, _, k in m.pieces if k not in (CONTROL, BYTE))
        self.by_unit = free and m.escape and not m.squeeze
        self.cut_lines = all("\n" not in p for p, _, _ in m.pieces)
        # Whether ordinary texts can be cut into words before normalisation.
        self.by_word = (self.by_unit and self.cut_lines and m.dummy_prefix
                        and self.charsmap is None)
        line = r"\n" if self.cut_lines else ""
        self.unit = re.compile(rf"{MARK}*[^{MARK}{line}]+|{MARK}+" + (r"|\n" if line else ""))
        # The ids of "one marker, one line break", which stand before a unit
        # that opens with another character when the library encodes it.
        self.lead = self.library.encode("\n") if self.cut_lines else []
        self.differing: set[str] = set()  # units whose ids the libraries see differently
        self.lossy: set[str] = set()  # units that do not come back
        dtype = "<u2" if len(m.pieces) <= 1 << 16 else "<u4"
        self.table = UnitTable(self._encode_units, dtype)
        self.words = UnitTable(self._encode_words, dtype)

    def normalise(self, text: str) -> str:
        m = self.model
        if self.charsmap is not None:
            text = self.charsmap.normalize_str(text)
        if m.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        if not text:
            return ""
        if m.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK) if m.escape else text

    def units(self, normal: str) -> list[str]:
        return self.unit.findall(normal) if self.by_unit else [normal] if normal else []

    def _library_ids(self, units: list[str]) -> list[list[int]]:
        if not self.by_unit:
            raise ValueError("parity by unit needs a model whose units are exact")
        plain = [u[1:].replace(MARK, " ") if u[0] == MARK else "\n" + u for u in units]
        if not self.model.dummy_prefix:
            plain = [u.replace(MARK, " ") if u[0] == MARK else "\n" + u for u in units]
        found = self.library.encode(plain, num_threads=self.threads)
        skip = len(self.lead)
        return [self._bare(u) if u == MARK else ids if u[0] == MARK else ids[skip:]
                for u, ids in zip(units, found, strict=True)]

    def _bare(self, unit: str) -> list[int]:
        return [self.library.piece_to_id(unit)]

    def _runs(self, units: list[str], most: int = 32) -> list[list[str]]:
        """Units side by side that the tokenizer cuts again where they meet."""
        runs, open_run = [], False
        for u in units:
            opens = u[0] == MARK or (self.cut_lines and u[0] == "\n")
            if open_run and opens and len(runs[-1]) < most:
                runs[-1].append(u)
            else:
                runs.append([u])
            open_run = u[-1] != MARK
        return runs

    def _encode_units(self, units: list[str], names: list[str] | None = None) -> tuple:
        """Ids of all units, and how many each has. The rebuilt tokenizer's ids
        count; the library's take their place only where they differ, and the
        unit (by its name in the table) is noted."""
        runs = self._runs(units)
        texts = ["".join(r) for r in runs]
        own = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        theirs = self._library_ids(units)
        flat = list(chain.from_iterable(own))
        names = names or units
        if flat != list(chain.from_iterable(theirs)):
            each = [e.ids for e in self.tokenizer.encode_batch_fast(units,
                                                                    add_special_tokens=False)]
            self.differing.update(n for n, a, b in zip(names, each, theirs, strict=True) if a != b)
            flat = list(chain.from_iterable(theirs))
        counts = [len(x) for x in theirs]
        back = self.tokenizer.decode_batch(own, skip_special_tokens=False)
        if flat and back != [t.replace(MARK, " ") for t in texts]:
            back = self.tokenizer.decode_batch(theirs, skip_special_tokens=False)
            self.lossy.update(n for n, u, b in zip(names, units, back, strict=True)
                              if b != u.replace(MARK, " "))
        return flat, counts

    def _encode_words(self, words: list[str]) -> tuple:
        units = [w if w[0] == "\n" else MARK + w for w in words]
        if any(" " in u for u in units):
            units = [u.replace(" ", MARK) for u in units]
        return self._encode_units(units, words)

    def code_batch(self, texts: list[str]) -> list[tuple[np.ndarray, bool, bool]]:
        """Ids of each text, whether both libraries agree on all of it, and
        whether it comes back from its ids."""
        if not self.by_unit:
            return self._code_whole(texts)
        words = [cut_words(t) if self.by_word and MARK not in t else [] for t in texts]
        units = [[] if w else self.units(self.normalise(t))
                 for t, w in zip(texts, words, strict=True)]
        packed = [a or b for a, b in zip(self.words.pack(words), self.table.pack(units),
                                         strict=True)]
        clean = lambda bad, k: not bad or (bad.isdisjoint(words[k])
                                           and bad.isdisjoint(units[k]))
        return [(np.frombuffer(p, self.table.dtype), clean(self.differing, k),
                 clean(self.lossy, k)) for k, p in enumerate(packed)]

    def _code_whole(self, texts: list[str]) -> list[tuple[np.ndarray, bool, bool]]:
        normal = [self.normalise(t) for t in texts]
        own = [e.ids for e in self.tokenizer.encode_batch_fast(normal, add_special_tokens=False)]
        theirs = self.library.encode(texts, num_threads=self.threads)
        ids = [np.asarray(x, self.table.dtype) for x in theirs]
        back = self.decode_batch(ids)
        return [(x, a == b, self.normalise(t) == n) for x, a, b, t, n
                in zip(ids, own, theirs, back, normal, strict=True)]

    def encode_batch(self, texts: list[str]) -> list[tuple[np.ndarray, bool]]:
        """Ids of each text, and whether both libraries agree on all of it."""
        return [(ids, same) for ids, same, _ in self.code_batch(texts)]

    def decode_batch(self, ids: list[np.ndarray]) -> list[str]:
        texts = self.tokenizer.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)
        cut = 1 if self.model.dummy_prefix else 0
        return [t[cut:] for t in texts]


_MODELS: dict[tuple[str, int], SentencePiece] = {}


def load(model_file: str, threads: int) -> SentencePiece:
    if (model_file, threads) not in _MODELS:
        _MODELS[model_file, threads] = SentencePiece(model_file, threads)
    only(_MODELS[model_file, threads].table, _MODELS[model_file, threads].words)
    return _MODELS[model_file, threads]


def _coder(model_file: str, threads: int, keep_ids: bool):
    schema = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                        ("parity", pa.bool_()), ("round_trip", pa.bool_())]
                       + [("ids", pa.list_(pa.int32()))] * keep_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = load(model_file, threads)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = (t.as_py() or "" for t in batch.column(1))
            for first, part in chunks(texts):
                coded = sp.code_batch(part)
                ids = [x for x, _, _ in coded]
                rows = {
                    "id": keys[first:first + len(part)],
                    "n_tokens": [len(x) for x in ids],
                    "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
                    "parity": [same for _, same, _ in coded],
                    "round_trip": [back for _, _, back in coded]}
                if keep_ids:
                    rows["ids"] = [x.astype(np.int32) for x in ids]
                yield pa.RecordBatch.from_pydict(rows, schema=schema)
    return run


def encode_documents(docs: DataFrame, model_file: str, id_col: str = "doc_id",
                     text_col: str = "text", threads: int = 2,
                     keep_ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, number and crc32 of its ids (as
    little-endian unsigned 32-bit integers), whether both libraries agree on
    it (``parity``), whether its ids decode to the normalised text
    (``round_trip``), and with ``keep_ids`` the ids themselves."""
    out = arrow_map(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                                F.col(f"`{text_col}`").alias("text")),
                    _coder(model_file, threads, keep_ids),
                    "id long, n_tokens long, ids_crc32 long, parity boolean, round_trip boolean"
                    + ", ids array<int>" * keep_ids)
    return out.withColumnRenamed("id", id_col)


def decode_documents(coded: DataFrame, model_file: str, id_col: str = "doc_id",
                     ids_col: str = "ids", threads: int = 2) -> DataFrame:
    """``(id, text)`` from rows that hold ids (null or empty: '')."""
    schema = pa.schema([("id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = load(model_file, threads)
        for batch in batches:
            ids = [np.asarray(x.as_py() or [], np.int32) for x in batch.column(1)]
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column(0), "text": sp.decode_batch(ids)}, schema=schema)

    out = arrow_map(coded.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                                 F.col(f"`{ids_col}`").alias("ids")), run, "id long, text string")
    return out.withColumnRenamed("id", id_col)
