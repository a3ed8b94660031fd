"""Alignment of two tokenizers and corpus-wide counts of linked token pairs.

A is a byte-level BPE file of the tokenizers library, B a SentencePiece model
that puts a space before a text. Both cut the bytes of ``space + text``; byte
offsets where tokens of both end cut them into groups, and two tokens whose
bytes overlap are linked.

Words. No piece of B holds a marker or line break behind another character,
and A's pattern starts a new part at a space before a word and at a line break
behind one. So a text is cut there (``cut_words``), neither tokenizer's tokens
nor groups cross such a cut, and a word's tokens, groups and links are worked
out once per distinct word, for thousands of words in one sweep of numpy. Both
conditions are read from the files; where they do not hold, or a word's bytes
do not come back, whole texts are aligned.

First pass: each task counts the pairs of its words and writes them by bucket
(hash of the pair). Per bucket, the distinct pairs, gathered in a tree, get a
minimal perfect hash: levels of bit arrays, a pair's bit is set on the first
level where it collides with none, and its index is the rank of that bit. The
tasks' counts become dense vectors indexed by that hash and are summed in a
tree; the pair stored at an index is compared on every use.

Second pass: documents are aligned again; a word's pairs are looked up in
bucket files that a worker reads when it needs them and holds up to
``HELD_BYTES``. Every table is bounded by the vocabularies, none by the corpus.

Defined results: a text that is null or empty, or whose joined tokens of A or
B differ from ``space + text`` (a text with U+2581), has no tokens: zeros and
an empty digest, and it adds to no count; repeated rows count each; a null id
stays null; an empty table gives an empty result; other columns are ignored.
Texts of any length are cut into words; only a text that cannot be cut is
aligned in one piece.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm.common import arrow_map, materialise
from ferry.llm.op5_sentencepiece import BYTE, MARK, parse_model
from ferry.llm.wordids import cut_words
from ferry.session import scratch_path, ship_package

# Buckets of pairs, children of a node of the trees, words a
# worker's table may hold, bytes of texts handled at once, bytes of bucket
# files a worker may hold, bits per key of a level of the hash.
BUCKETS, FAN = 256, 16
MAX_WORDS, CHUNK_BYTES, HELD_BYTES = 400_000, 2 << 20, 512 << 20
SPREAD = 1.5

_LEAF = pa.schema([("bucket", pa.int32()), ("leaf", pa.int64()), ("keys", pa.binary()),
                   ("counts", pa.binary())])
_LEAF_SQL = "bucket int, leaf long, keys binary, counts binary"


# --- minimal perfect hash -------------------------------------------------

def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def bucket_of(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 255) % np.uint64(BUCKETS)).astype(np.int32)


class PerfectHash:
    """Distinct 32-bit keys to 0 .. n - 1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, before = [], 0
        for bits in levels:
            self.ranks.append(np.where(bits, np.cumsum(bits) - 1 + before, -1).astype(np.int64))
            before += int(bits.sum())
        self.n = before

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = max(64, int(SPREAD * len(keys)))
            at = _mix(keys, len(levels)) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[at.astype(np.int64)]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is; keys outside the set get any index, or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for n, rank in enumerate(self.ranks):
            if not len(left):
                break
            found = rank[(_mix(keys[left], n) % np.uint64(len(rank))).astype(np.int64)]
            out[left] = found
            left = left[found < 0]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(b) for b in self.levels], "<u4")
        return b"".join([np.array([len(sizes)], "<u4").tobytes(), sizes.tobytes(),
                         *(np.packbits(b).tobytes() for b in self.levels)])

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, "<u4", 1)[0])
        at, levels = 4 + 4 * n, []
        for size in np.frombuffer(data, "<u4", n, 4).tolist():
            held = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, held, at),
                                        count=size).astype(bool))
            at += held
        return cls(levels)


def checked_index(h: PerfectHash, stored: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key is stored, -1 for a key that is not."""
    at = h.index(keys)
    if not len(stored):
        return np.full(len(keys), -1, np.int64)
    return np.where(stored[at] == keys, at, -1)


# --- the two tokenizers ---------------------------------------------------

def _runs(words: list[str], spaced: list[str], most: int = 32) -> list[str]:
    """Words joined for A, which encodes few texts faster than many words. A
    word with more white space than the character it starts with stands alone:
    it could not be cut off again."""
    out: list[str] = []
    run: list[str] = []
    for w, s in zip(words, spaced, strict=True):
        bare = w[1:] if w[:1] == "\n" else w
        if bare and bare.isprintable() and " " not in bare:
            run.append(s)
            if len(run) < most:
                continue
            out.append("".join(run))
        else:
            out += ["".join(run), s] if run else [s]
        run = []
    return [*out, "".join(run)] if run else out


class Aligned:
    """Tokens, groups and links of several words laid end to end. ``n_a``,
    ``n_b``, ``n_groups``, ``n_links`` and ``good`` per word; ``pairs`` of all
    links in order; ``groups`` per word as text, each ended by ';'."""


class Aligner:
    def __init__(self, byte_file: str, piece_file: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        with open(piece_file, "rb") as f:
            model = parse_model(f.read())
        with open(byte_file, encoding="utf-8") as f:
            plan = json.load(f)
        split = plan.get("pre_tokenizer") or {}
        n_a, n_b = self.a.get_vocab_size(), len(model.pieces)
        if max(n_a, n_b) > 1 << 16:
            raise ValueError("ids of both tokenizers must fit 16 bits")
        # Whether words are exact for A and for B.
        self.by_word = (
            split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not split.get("add_prefix_space", True) and not plan.get("normalizer")
            and model.dummy_prefix and model.escape and not model.squeeze and not model.charsmap
            and all(MARK not in p.lstrip(MARK) and "\n" not in p for p, _, _ in model.pieces))
        # The byte that each character of A's entries stands for (byte-level
        # rule: printable Latin-1 as it is, the others from U+0100 on).
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in set(shown)]
        byte = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(hidden)}
        self.bytes_a = [b""] * n_a
        for entry, i in self.a.get_vocab().items():
            self.bytes_a[i] = (bytes(byte[c] for c in entry) if all(c in byte for c in entry)
                               else entry.encode())
        self.bytes_b = [bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARK, " ").encode()
                        for p, _, k in model.pieces]
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # The text of an id in a group, by what follows it.
        self.shown = ([f"{i}," for i in range(1 << 16)] + [f"{i}|" for i in range(1 << 16)]
                      + [f"{i};" for i in range(1 << 16)])

    def align(self, words: list[str], whole: bool = False, groups: bool = True) -> Aligned:
        """``whole``: each word is a text of its own, else as ``cut_words``
        gives them; ``groups``: whether their text is wanted."""
        spaced = [w if w[:1] == "\n" and not whole else " " + w for w in words]
        ids_b = self.b.encode(words, num_threads=1)
        if not whole:  # the marker that B puts before a line break
            ids_b = [x[1:] if w[:1] == "\n" else x for w, x in zip(words, ids_b, strict=True)]
        runs = spaced if whole else _runs(words, spaced)
        flat_a = self._flat(e.ids for e in self.a.encode_batch_fast(runs, add_special_tokens=False))
        flat_b = self._flat(ids_b)
        size = np.fromiter((len(w) if w.isascii() else len(w.encode()) for w in spaced), np.int64,
                           len(spaced))
        text = "".join(spaced).encode()
        stop = np.cumsum(size)
        good = np.ones(len(words), bool)
        if not (self._gives(flat_a, self.bytes_a, self.len_a, text, stop)
                and self._gives(flat_b, self.bytes_b, self.len_b, text, stop)):
            ids_a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
            for k, x in enumerate(spaced):
                raw = x.encode()
                if (b"".join(map(self.bytes_a.__getitem__, ids_a[k])) != raw
                        or b"".join(map(self.bytes_b.__getitem__, ids_b[k])) != raw):
                    good[k], size[k] = False, 0
                    ids_a[k] = ids_b[k] = []
            flat_a, flat_b = self._flat(ids_a), self._flat(ids_b)
        return self._lay_out(flat_a, flat_b, size, good, groups)

    @staticmethod
    def _flat(ids) -> np.ndarray:
        return np.array(list(chain.from_iterable(ids)), np.int64)

    @staticmethod
    def _gives(flat: np.ndarray, entry: list[bytes], length: np.ndarray, text: bytes,
               stop: np.ndarray) -> bool:
        """Whether the tokens are the bytes of ``text`` and end where words do."""
        if b"".join(map(entry.__getitem__, flat.tolist())) != text:
            return False
        ends = np.cumsum(length[flat])
        at = np.searchsorted(ends, stop)
        return bool((ends[at] == stop).all()) if len(ends) else not len(text)

    def _lay_out(self, a, b, size, good, groups: bool) -> Aligned:
        out = Aligned()
        out.good = good
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        start_a = end_a - self.len_a[a]
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        word_end = np.cumsum(size)
        word_of = lambda ends: np.searchsorted(word_end, ends)
        n = len(size)
        word_a = word_of(end_a)
        out.n_a = np.bincount(word_a, minlength=n)
        out.n_b = np.bincount(word_of(end_b), minlength=n)
        out.n_groups = np.bincount(word_of(cuts), minlength=n)
        # A token of A overlaps the tokens of B from the one that holds its
        # first byte to the one that holds its last.
        from_b = np.searchsorted(end_b, start_a, side="right")
        links = np.searchsorted(end_b, end_a, side="left") - from_b + 1
        linked_a = np.repeat(np.arange(len(a)), links)
        step = np.arange(len(linked_a)) - np.repeat(np.cumsum(links) - links, links)
        linked_b = np.repeat(from_b, links) + step
        out.pairs = (a[linked_a].astype(np.uint32) << np.uint32(16)) | b[linked_b].astype(np.uint32)
        out.n_links = np.bincount(word_a[linked_a], minlength=n)
        if not groups:
            out.groups = [""] * n
            return out
        # Text: A's ids of a group, a bar, B's ids, a semicolon.
        last_a = np.append(group_a[1:] != group_a[:-1], True) if len(a) else np.zeros(0, bool)
        last_b = np.append(group_b[1:] != group_b[:-1], True) if len(b) else np.zeros(0, bool)
        items = np.concatenate((a + (last_a << 16), b + (last_b.astype(np.int64) << 17)))
        order = np.lexsort((np.repeat([0, 1], [len(a), len(b)]),
                            np.concatenate((group_a, group_b))))
        shown = list(map(self.shown.__getitem__, items[order].tolist()))
        stop = np.cumsum(out.n_a + out.n_b).tolist()
        out.groups = ["".join(shown[i:j]) for i, j in zip([0, *stop], stop)]
        return out


class _Numbers(dict):
    """Words by number; one that is asked for the first time gets the next and
    is noted in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class WordTable:
    """Words a worker has met, by number, with arrays of what is known of each.
    ``learn`` gives the columns of new words; full tables start anew."""

    def __init__(self, aligner: Aligner, look_up=None):
        self.aligner, self.look_up = aligner, look_up
        self.clear()

    def clear(self) -> None:
        self.number = _Numbers()
        self.groups: list[str] = []
        # good, n_a, n_b, groups, links, best, sum of counts, links not counted
        self.columns = np.zeros((8, 0), np.int64)
        self.pairs: list[np.ndarray] = []

    def numbers(self, words: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        new, self.number.new = self.number.new, []
        if new:
            self._add(new, self.aligner.align(new, groups=self.look_up is not None))
        return found

    def _add(self, new: list[str], found: Aligned) -> None:
        first = len(self.groups)
        self.groups += found.groups
        block = columns_of(found, self.look_up)
        need = first + len(new)
        if need > self.columns.shape[1]:
            grown = np.zeros((8, max(need, 2 * self.columns.shape[1])), np.int64)
            grown[:, :first] = self.columns[:, :first]
            self.columns = grown
        self.columns[:, first:need] = block
        if not self.look_up:
            self.pairs.append(found.pairs)

    def full(self) -> bool:
        return len(self.groups) > MAX_WORDS


def columns_of(found: Aligned, look_up) -> np.ndarray:
    n = len(found.good)
    block = np.zeros((8, n), np.int64)
    block[:5] = found.good, found.n_a, found.n_b, found.n_groups, found.n_links
    if look_up:
        count, best = look_up(found.pairs)
        word = np.repeat(np.arange(n), found.n_links)
        np.add.at(block[5], word, best.astype(np.int64))
        np.add.at(block[6], word, count)
        # Words that only stand in texts without tokens were not counted.
        block[7] = np.bincount(word[count == 0], minlength=n)
    return block


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py() or ""
            keys.append(key)
            texts.append(text)
            size += len(text)
            if size >= CHUNK_BYTES:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


_HELD: dict = {}


def _table(role: str, byte_file: str, piece_file: str, look_up=None) -> WordTable:
    """The worker's table for one role and its files; tables of others go."""
    key = (role, byte_file, piece_file)
    if key not in _HELD:
        aligner = next((t.aligner for k, t in _HELD.items() if k[1:] == key[1:]), None)
        table = WordTable(aligner or Aligner(byte_file, piece_file), look_up)
        _HELD.clear()
        _HELD[key] = table
    return _HELD[key]


def _cut(table: WordTable, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All words of the texts, how many each text has, and which texts have to
    be aligned whole."""
    by_word = table.aligner.by_word
    words = [cut_words(t) if by_word else [] for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    whole = (lengths == 0) & np.array([bool(t) for t in texts])
    return list(chain.from_iterable(words)), lengths, whole


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros((len(values), 1), np.int64),
                            np.cumsum(values, axis=1)), axis=1)
    ends = np.cumsum(lengths)
    return total[:, ends] - total[:, ends - lengths]


# --- first pass -----------------------------------------------------------

def _count_task(byte_file: str, piece_file: str):
    def pairs_of(found: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        return (np.fromiter(found.keys(), np.uint32, len(found)),
                np.fromiter(found.values(), np.int64, len(found)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        table = _table("count", byte_file, piece_file)
        uses = np.zeros(0, np.int64)
        whole: dict[int, int] = {}

        def leaf() -> Iterator[pa.RecordBatch]:
            nonlocal uses, whole
            n = len(uses)
            links = np.concatenate(table.pairs) if table.pairs else np.zeros(0, np.uint32)
            per_word = table.columns[4, :len(table.groups)]
            weight = np.repeat(np.pad(uses, (0, len(per_word) - n)), per_word)
            more, more_weight = pairs_of(whole)
            links, weight = np.concatenate((links, more)), np.concatenate((weight, more_weight))
            links, weight = links[weight > 0], weight[weight > 0]
            if len(links):
                order = np.argsort(links, kind="stable")
                links, weight = links[order], weight[order]
                first = np.flatnonzero(np.append(True, links[1:] != links[:-1]))
                keys, sums = links[first], np.add.reduceat(weight, first)
                bucket = bucket_of(keys)
                order = np.argsort(bucket, kind="stable")
                edge = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
                name = uuid.uuid4().int >> 65
                held = [b for b in range(BUCKETS) if edge[b + 1] > edge[b]]
                cut = [order[edge[b]:edge[b + 1]] for b in held]
                wide = "<u4" if sums.max() < 1 << 32 else "<u8"
                yield pa.RecordBatch.from_pydict(
                    {"bucket": held, "leaf": [name] * len(held),
                     "keys": [keys[c].astype("<u4").tobytes() for c in cut],
                     "counts": [sums[c].astype(wide).tobytes() for c in cut]}, schema=_LEAF)
            uses, whole = np.zeros(0, np.int64), {}

        for _, texts in _chunks(batches):
            words, lengths, odd = _cut(table, texts)
            if table.full():
                yield from leaf()
                table.clear()
            numbers = table.numbers(words)
            bad_words = table.columns[0, numbers] == 0
            if bad_words.any():  # words whose bytes do not come back
                odd |= _sums(bad_words[None, :].astype(np.int64), lengths)[0] > 0
                numbers = numbers[~np.repeat(odd, lengths)]
            for k in np.flatnonzero(odd):
                for pair in table.aligner.align([texts[k]], whole=True).pairs.tolist():
                    whole[pair] = whole.get(pair, 0) + 1
            seen = np.bincount(numbers, minlength=len(table.groups))
            seen[:len(uses)] += uses
            uses = seen
        yield from leaf()
    return run


def _decoded(counts: bytes, n: int) -> np.ndarray:
    return np.frombuffer(counts, "<u4" if len(counts) == 4 * n else "<u8").astype(np.int64)


def _merge_keys(table: pa.Table) -> pa.Table:
    keys = np.unique(np.concatenate([np.frombuffer(k.as_py(), "<u4")
                                     for k in table.column("keys")]))
    return pa.table({"bucket": [table.column("bucket")[0].as_py()],
                     "node": [table.column("node")[0].as_py()], "keys": [keys.tobytes()]},
                    schema=pa.schema([("bucket", pa.int32()), ("node", pa.int64()),
                                      ("keys", pa.binary())]))


def _build_hash(table: pa.Table) -> pa.Table:
    keys = np.frombuffer(_merge_keys(table).column("keys")[0].as_py(), "<u4")
    h = PerfectHash.build(keys)
    stored = np.zeros(h.n, "<u4")
    stored[h.index(keys)] = keys
    return pa.table({"bucket": [table.column("bucket")[0].as_py()], "hash": [h.dump()],
                     "keys": [stored.tobytes()]},
                    schema=pa.schema([("bucket", pa.int32()), ("hash", pa.binary()),
                                      ("keys", pa.binary())]))


_VECTOR = pa.schema([("bucket", pa.int32()), ("node", pa.int64()), ("vector", pa.binary())])


def _dense(_, leaves: pa.Table, hashes: pa.Table) -> pa.Table:
    """The counts of some leaves as one vector indexed by the bucket's hash."""
    if not len(leaves):
        return _VECTOR.empty_table()
    h = PerfectHash.load(hashes.column("hash")[0].as_py())
    stored = np.frombuffer(hashes.column("keys")[0].as_py(), "<u4")
    vector = np.zeros(h.n, "<i8")
    for k, c in zip(leaves.column("keys"), leaves.column("counts"), strict=True):
        keys = np.frombuffer(k.as_py(), "<u4")
        at = checked_index(h, stored, keys)
        if at.min() < 0:
            raise ValueError("a counted pair is not in its bucket's hash")
        vector[at] += _decoded(c.as_py(), len(keys))
    return pa.table({"bucket": [leaves.column("bucket")[0].as_py()],
                     "node": [leaves.column("node")[0].as_py()],
                     "vector": [vector.tobytes()]}, schema=_VECTOR)


def _add_vectors(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v.as_py(), "<i8") for v in table.column("vector"))
    return pa.table({"bucket": [table.column("bucket")[0].as_py()],
                     "node": [table.column("node")[0].as_py()],
                     "vector": [total.astype("<i8").tobytes()]}, schema=_VECTOR)


def _best_of_bucket(size: int):
    schema = pa.schema([("node", pa.int32()), ("vector", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        best = np.zeros(size, "<i8")
        if "keys" in table.column_names:
            for k, v in zip(table.column("keys"), table.column("counts"), strict=True):
                keys = np.frombuffer(k.as_py(), "<u4")
                np.maximum.at(best, keys & np.uint32(0xFFFF), np.frombuffer(v.as_py(), "<i8"))
        else:
            for v in table.column("vector"):
                best = np.maximum(best, np.frombuffer(v.as_py(), "<i8"))
        return pa.table({"node": [table.column("node")[0].as_py()], "vector": [best.tobytes()]},
                        schema=schema)
    return run


def count_pairs(docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id",
                text_col: str = "text") -> str:
    """Count the linked pairs of all ``docs``; returns the folder of the
    result: ``counts`` (one row per bucket: hash, pairs and counts by index)
    and ``best`` (the highest count of each id of B)."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                        F.col(f"`{text_col}`").alias("text"))
    leaves = materialise(arrow_map(texts, _count_task(byte_file, piece_file), _LEAF_SQL),
                         "pairs-leaves")
    n_leaves = leaves.agg(F.approx_count_distinct("leaf")).first()[0]
    node = lambda width, of="leaf": F.pmod(F.col(of), F.lit(width)).cast("long")
    # Distinct pairs of a bucket, FAN children at a time.
    keys = leaves.select("bucket", F.col("leaf").alias("node"), "keys")
    width = n_leaves
    while width > FAN:
        width = -(-width // FAN)
        keys = (keys.withColumn("node", node(width, "node")).groupBy("bucket", "node")
                .applyInArrow(_merge_keys, "bucket int, node long, keys binary"))
    hashes = materialise(keys.groupBy("bucket").applyInArrow(
        _build_hash, "bucket int, hash binary, keys binary"), "pairs-hash")
    # Dense vectors, summed in a tree.
    width = max(1, -(-n_leaves // FAN))
    sent = hashes.withColumn("node", F.explode(F.sequence(F.lit(0).cast("long"),
                                                          F.lit(width - 1).cast("long"))))
    vectors = (leaves.withColumn("node", node(width)).groupBy("bucket", "node")
               .cogroup(sent.groupBy("bucket", "node"))
               .applyInArrow(_dense, "bucket int, node long, vector binary"))
    while width > 1:
        width = -(-width // FAN)
        vectors = (vectors.withColumn("node", node(width, "node")).groupBy("bucket", "node")
                   .applyInArrow(_add_vectors, "bucket int, node long, vector binary"))
    folder = scratch_path(spark, "pairs")
    (hashes.join(vectors.select("bucket", F.col("vector").alias("counts")), "bucket")
     .write.partitionBy("bucket").parquet(f"{folder}/counts"))
    counts = spark.read.schema("hash binary, keys binary, counts binary, bucket int").parquet(
        f"{folder}/counts")
    size = 1 << 16
    best = counts.select(F.pmod("bucket", F.lit(FAN)).cast("int").alias("node"), "keys", "counts")
    for last in (False, True):
        best = best.groupBy("node").applyInArrow(_best_of_bucket(size), "node int, vector binary")
        if not last:
            best = best.withColumn("node", F.lit(0))
    best.write.parquet(f"{folder}/best")
    return folder


def pair_counts(spark: SparkSession, folder: str) -> DataFrame:
    """``(a_id, b_id, n_links)`` of every pair that ``count_pairs`` found."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, c in zip(batch.column(0), batch.column(1), strict=True):
                keys = np.frombuffer(k.as_py(), "<u4").astype(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "a_id": keys >> 16, "b_id": keys & 0xFFFF,
                    "n_links": np.frombuffer(c.as_py(), "<i8")})
    held = spark.read.schema("keys binary, counts binary").parquet(f"{folder}/counts")
    return arrow_map(held, rows, "a_id long, b_id long, n_links long")


# --- second pass ----------------------------------------------------------

def _rows_in(folder: str, columns: list[str]) -> list[dict]:
    """Rows of a small Parquet folder, none if it is not there."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    files, path = fs.FileSystem.from_uri(folder if "://" in folder
                                         else "file://" + folder.removeprefix("file:"))
    found = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return [r for f in found if f.path.endswith(".parquet")
            for r in pq.ParquetFile(files.open_input_file(f.path)).read(columns).to_pylist()]


class Counts:
    """Bucket files of one folder, read when needed; the longest unused ones
    go when more than ``HELD_BYTES`` are held."""

    def __init__(self, folder: str):
        self.folder = folder
        self.held: dict[int, tuple] = {}
        best = _rows_in(f"{folder}/best", ["vector"])
        self.best = np.frombuffer(best[0]["vector"], "<i8") if best else np.zeros(1 << 16)

    def bucket(self, b: int) -> tuple:
        if b in self.held:
            self.held[b] = self.held.pop(b)  # last used, last to go
        else:
            found = _rows_in(f"{self.folder}/counts/bucket={b}", ["hash", "keys", "counts"])
            row = found[0] if found else {"hash": PerfectHash([]).dump(), "keys": b"",
                                          "counts": b""}
            h = PerfectHash.load(row["hash"])
            size = 12 * h.n + sum(9 * len(x) for x in h.levels)
            while self.held and size + sum(x[3] for x in self.held.values()) > HELD_BYTES:
                del self.held[next(iter(self.held))]
            self.held[b] = (h, np.frombuffer(row["keys"], "<u4"),
                            np.frombuffer(row["counts"], "<i8"), size)
        return self.held[b]

    def __call__(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count of each pair, and whether it is the best of its B id; 0
        for a pair that was not counted."""
        keys, back = np.unique(pairs, return_inverse=True)
        count = np.zeros(len(keys), np.int64)
        bucket = bucket_of(keys)
        order = np.argsort(bucket, kind="stable")
        edge = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
        for b in np.flatnonzero(edge[1:] > edge[:-1]).tolist():
            mine = order[edge[b]:edge[b + 1]]
            h, stored, counts, _ = self.bucket(b)
            at = checked_index(h, stored, keys[mine])
            count[mine[at >= 0]] = counts[at[at >= 0]]
        best = (count > 0) & (count == self.best[keys & np.uint32(0xFFFF)])
        return count[back], best[back]


def _align_task(byte_file: str, piece_file: str, folder: str, keep_groups: bool):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = pa.schema([("id", pa.int64()), *((c, pa.int64()) for c in names),
                        ("groups_sha256", pa.string())] + [("groups", pa.string())] * keep_groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for keys, texts in _chunks(batches):
            if table is None:
                held = _HELD.get((folder, byte_file, piece_file))
                table = held or _table(folder, byte_file, piece_file, Counts(folder))
            if table.full():
                table.clear()
            words, lengths, odd = _cut(table, texts)
            numbers = table.numbers(words)
            values = table.columns[:, numbers]
            values[0] = 1 - values[0]  # words whose bytes do not come back
            sums = _sums(values, lengths)
            listed, at, groups = numbers.tolist(), 0, []
            shown = table.groups.__getitem__
            for n in lengths.tolist():
                groups.append("".join(map(shown, listed[at:at + n])))
                at += n
            for k in np.flatnonzero(odd | (sums[0] > 0)):
                found = table.aligner.align([texts[k]], whole=True)
                sums[:, k] = columns_of(found, table.look_up)[:, 0]
                groups[k] = found.groups[0]
            if sums[7].any():
                raise ValueError("a document holds a pair that the first pass did not count")
            groups = [g[:-1] for g in groups]
            rows = {"id": keys, **{c: sums[n] for n, c in enumerate(names, 1)},
                    "groups_sha256": [hashlib.sha256(g.encode()).hexdigest() if g else ""
                                      for g in groups]}
            if keep_groups:
                rows["groups"] = groups
            yield pa.RecordBatch.from_pydict(rows, schema=schema)
    return run


def align_documents(docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id",
                    text_col: str = "text", folder: str | None = None,
                    keep_groups: bool = False) -> DataFrame:
    """One row per row of ``docs``: numbers of tokens of A and B, groups and
    links; ``n_best`` (links whose pair's count is the highest of its B id),
    ``count_sum`` (counts summed over links) and ``groups_sha256``; with
    ``keep_groups`` the groups themselves. ``folder``: counts of an earlier
    ``count_pairs`` over these documents, by default made here."""
    folder = folder or count_pairs(docs, byte_file, piece_file, id_col, text_col)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                        F.col(f"`{text_col}`").alias("text"))
    out = arrow_map(texts, _align_task(byte_file, piece_file, folder, keep_groups),
                    "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                    "count_sum long, groups_sha256 string" + ", groups string" * keep_groups)
    return out.withColumnRenamed("id", id_col)
