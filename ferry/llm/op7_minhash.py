"""Near-duplicates by circulant MinHash.

A document's set holds the distinct shingles of its words (lower-cased A-Z),
each a 64-bit hash. Two permutations make all coordinates of a signature: the
first, s, scatters an element over [0, 2**32); the second, p, is read
circularly shifted by k for coordinate k, which is ``min p(s(x) + k)``.
``bands`` bands of ``rows`` coordinates make the keys under which documents
meet (at similarity 0.8 and the defaults, two meet with probability
1 - 3e-6).

Documents with the same set are one class, and only its smallest id goes on.
No pairs are listed for a key. Links are found in three rounds:

1. every document is compared with the smallest centre among its keys;
2. keys that still hold several components are worked off in blocks of some
   ``BLOCK`` documents, those of the largest component on one side, all others
   paired with them and with each other (at most about twice the pairs that
   have to be looked at): documents of different components whose signatures
   agree in ``PROMISE`` of the coordinates (six standard deviations below 0.8)
   may link; two documents are looked at in the first band in which they meet.
   A task returns a spanning forest of that relation, and its components are
   groups outside of which there is no link left;
3. inside a group all full sets are compared, block by block, with the sizes
   of all intersections of two blocks from one matrix product. A task returns
   a spanning forest of the links.

So every link is confirmed on the full sets, what a task returns is no more
than its documents, and pairs inside a component need no look, as they cannot
change it.

Defined results: a null or empty text, or one without a word, has an empty
set, links with nothing and is kept; with fewer words than a shingle the whole
sequence is the one shingle; rows that share an id are one node (its links are
those of all its rows); a row without an id has no component and is kept;
an empty table gives an empty result; other columns are ignored. Texts of any
length are read whole; a document's set is one value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import arrow_map, materialise
from ferry.llm.components import components
from ferry.llm.wordids import UnitTable, chunks, only

# Bands and coordinates per band, documents per block of a key,
# parts in which a group is given its blocks, shingles per block, the part of agreeing coordinates that makes a
# pair worth a full comparison, columns of one matrix product.
BANDS, ROWS = 32, 5
BLOCK = 128
SALTS = 16
SHINGLES = 1 << 17
PROMISE = 0.6
COLUMNS = 1 << 14
# Odd multipliers of the mixers.
M64 = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB,
                              0xD6E8FEB86659FD93)]
M32 = [np.uint32(x) for x in (0x7FEB352D, 0x846CA68B)]

_WORDS: list[UnitTable] = []


def _words() -> UnitTable:
    if not _WORDS:
        _WORDS.append(UnitTable(lambda ws: [xxhash.xxh3_64_digest(w) for w in ws], "<u8"))
    only(_WORDS[0])
    return _WORDS[0]


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M64[1]
    x = (x ^ (x >> np.uint64(27))) * M64[2]
    return x ^ (x >> np.uint64(31))


def _mix32(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """A permutation of [0, 2**32), in place."""
    for shift, mult in ((16, M32[0]), (15, M32[1])):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        np.multiply(x, mult, out=x)
    np.right_shift(x, np.uint32(16), out=spare)
    return np.bitwise_xor(x, spare, out=x)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each (encoded) text."""
    out = []
    for packed in _words().pack([t.lower().split() for t in texts]):
        w = np.frombuffer(packed, np.uint64)
        k = min(width, len(w))
        if k == 0:
            out.append(w)
            continue
        n = len(w) - k + 1
        h = np.full(n, k, np.uint64)
        for i in range(k):
            h = (h ^ w[i:i + n]) * M64[0]
            h ^= h >> np.uint64(32)
        out.append(np.unique(_mix64(h)))
    return out


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """``(len(sets), size)`` circulant MinHash coordinates; sets not empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    x = (flat >> np.uint64(32)).astype(np.uint32) ^ flat.astype(np.uint32)
    spare = np.empty_like(x)
    x = _mix32(x * M32[1] + M32[0], spare)  # the first permutation
    out = np.empty((size, len(sets)), np.uint32)
    v = np.empty_like(x)
    for k in range(size):
        np.add(x, np.uint32(k), out=v)  # the circular shift
        out[k] = np.minimum.reduceat(_mix32(v, spare), starts)
    return np.ascontiguousarray(out.T)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """``(n, bands)`` signed 64-bit keys; the band number is part of a key."""
    s = sig.reshape(len(sig), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), s.shape[:2]).copy()
    for r in range(rows):
        key = (key ^ s[:, :, r]) * M64[3]
        key ^= key >> np.uint64(29)
    return _mix64(key).view(np.int64)


def jaccard_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a & b| >= percent * |a | b| for sorted distinct arrays."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)) or not len(a):
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")  # two sorted runs
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _sign(width: int, bands: int, rows: int):
    schema = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("same", pa.binary()),
                        ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = ((t.as_py() or "").encode() for t in batch.column(1))
            for first, part in chunks(texts):
                sets = shingle_sets(part, width)
                full = [i for i, s in enumerate(sets) if len(s)]
                same, keys = [None] * len(sets), [None] * len(sets)
                if full:
                    sigs = signatures([sets[i] for i in full], bands * rows)
                    for i, k in zip(full, band_keys(sigs, bands, rows), strict=True):
                        same[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                        keys[i] = k
                yield pa.RecordBatch.from_pydict(
                    {"id": ids[first:first + len(part)], "n_shingles": [len(s) for s in sets],
                     "same": same, "keys": keys}, schema=schema)
    return run


def _describe(width: int, size: int, full_sets: bool):
    """``(id, n_shingles, data)``: the signature or the full set of a text."""
    schema = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = ((t.as_py() or "").encode() for t in batch.column(1))
            for first, part in chunks(texts):
                sets = shingle_sets(part, width)
                keep = [i for i, s in enumerate(sets) if len(s)]
                sets = [sets[i] for i in keep]
                data = sets if full_sets else signatures(sets, size) if sets else []
                yield pa.RecordBatch.from_pydict(
                    {"id": [ids[first + i] for i in keep], "n_shingles": [len(s) for s in sets],
                     "data": [d.tobytes() for d in data]}, schema=schema)
    return run


def _confirm(width: int, percent: int):
    """Rows come as (centre, part), the centre first: yield linked pairs."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, centre = None, []
        for batch in batches:
            ids, centres, parts = (batch.column(c).to_pylist() for c in range(3))
            texts = ((t.as_py() or "").encode() for t in batch.column(3))
            found = {"u": [], "v": []}
            for first, run_ in chunks(texts):
                for i, s in enumerate(shingle_sets(run_, width), first):
                    if group != (centres[i], parts[i]):
                        group, centre = (centres[i], parts[i]), []
                    if ids[i] == centres[i]:  # several rows may share its id
                        centre.append(s)
                    elif any(jaccard_at_least(c, s, percent) for c in centre):
                        found["u"].append(ids[i])
                        found["v"].append(centres[i])
            yield pa.RecordBatch.from_pydict(found, schema=schema)
    return run


def _confirmed(texts: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``(centre, id)`` that are links. A centre with many partners
    is split into parts of about ``BLOCK``, the centre's text in each."""
    parts = pairs.groupBy("centre").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    split = pairs.join(parts, "centre").select(
        "id", "centre", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"))
    heads = split.select(F.col("centre").alias("id"), "centre", "part").distinct()
    rows = split.unionByName(heads).join(texts, "id")
    dealt = (rows.select("id", "centre", "part", "text")
             .repartition("centre", "part")
             .sortWithinPartitions("centre", "part", F.col("id") != F.col("centre")))
    return arrow_map(dealt, _confirm(width, percent), "u long, v long")


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position reachable from each of ``n``, links being (a, b)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new


LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _forest_rows(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> dict:
    low = _forest(len(ids), a, b)
    some = np.flatnonzero(low != np.arange(len(ids)))
    return {"u": ids[some], "v": ids[low[some]]}


def _sizes_fit(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    small, large = np.minimum(n[:, None], m), np.maximum(n[:, None], m)
    return 100 * small >= percent * large


def _promising(percent: int, rows: int):
    """Documents of two blocks of a key (or of one) that may link."""
    def block(xs) -> tuple[np.ndarray, ...]:
        return (*(np.array([x[c] for x in xs], np.int64)
                  for c in ("id", "component", "n_shingles")),
                np.array([np.frombuffer(x["data"], np.uint32) for x in xs]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right, band in zip(*batch.columns, strict=True):
                (i, ic, n, isig), (j, jc, m, jsig) = block(left.as_py()), block(right.as_py())
                fit = (ic[:, None] != jc) & _sizes_fit(n, m, percent)
                before = band.as_py() * rows
                for k in np.flatnonzero(fit.any(axis=1)):
                    same = jsig == isig[k]
                    fit[k] &= same.sum(axis=1) >= PROMISE * isig.shape[1]
                    if before:
                        earlier = same[:, :before].reshape(len(j), -1, rows).all(axis=2)
                        fit[k] &= ~earlier.any(axis=1)
                a, b = np.nonzero(fit)
                ids, place = np.unique(np.concatenate((i, j)), return_inverse=True)
                yield pa.RecordBatch.from_pydict(
                    _forest_rows(ids, place[a], place[len(i) + b]), schema=LINKS)
    return run


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of their
    incidence matrices over ``COLUMNS`` shared elements at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    for lo in range(0, len(shared), COLUMNS):
        part = shared[lo:lo + COLUMNS]
        sides = []
        for sets in (left, right):
            m = np.zeros((len(sets), len(part)), np.float32)
            for row, s in zip(m, sets, strict=True):
                s = s[np.searchsorted(s, part[0]):np.searchsorted(s, part[-1], "right")]
                at = np.searchsorted(part, s)
                row[at[part[at] == s]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return np.rint(out).astype(np.int64)


def _compare(percent: int):
    """Links between two blocks of a group, on full sets."""
    def run(table: pa.Table) -> pa.Table:
        x, y = (table.column(c)[0].as_py() for c in ("x", "y"))
        blocks = table.column("block").to_numpy()
        data = [np.frombuffer(d.as_py(), np.uint64) for d in table.column("data")]
        i, j = np.flatnonzero(blocks == x), np.flatnonzero(blocks == y)
        if not len(i) or not len(j):
            return LINKS.empty_table()
        common = intersections([data[k] for k in i], [data[k] for k in j])
        n = np.array([len(d) for d in data])
        a, b = np.nonzero(100 * common >= percent * (n[i][:, None] + n[j] - common))
        ids, place = np.unique(table.column("id").to_numpy(), return_inverse=True)
        return pa.Table.from_pydict(_forest_rows(ids, place[i[a]], place[j[b]]), schema=LINKS)
    return run


def _sides(node: DataFrame) -> DataFrame:
    """Rows ``(key, band, id, component)`` of keys that hold several components,
    dealt into blocks of about ``BLOCK``. The largest component of a key is its
    ``main`` side: its documents need no look among themselves, so only the
    others are paired, with each other and with the main side."""
    counted = node.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = (counted.groupBy("key").agg(F.max(F.struct("n", "component")).alias("top"),
                                        F.sum("n").alias("n"), F.count("*").alias("c"))
             .filter("c > 1")
             .select("key", F.col("top.component").alias("largest"),
                     F.ceil(F.col("top.n") / BLOCK).cast("int").alias("n_main"),
                     F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("n_other")))
    main = F.col("component") == F.col("largest")
    parts = F.when(main, F.col("n_main")).otherwise(F.col("n_other"))
    return node.join(mixed, "key").select(
        "key", "band", "id", "component", main.alias("main"),
        F.pmod(F.xxhash64("id"), parts).cast("int").alias("block"), "n_main", "n_other")


def _block_pairs(blocks: DataFrame) -> DataFrame:
    """``(key, block, main, to)``: which other block of its key each block of
    other documents meets; itself among them."""
    others = blocks.filter(~F.col("main"))
    to_main = others.select("*", F.lit(True).alias("to_main"), F.explode(
        F.expr("sequence(0, n_main - 1)")).alias("to"))
    to_other = others.select("*", F.lit(False).alias("to_main"), F.explode(
        F.expr("sequence(block, n_other - 1)")).alias("to"))
    return to_main.unionByName(to_other)


def _groups(keys: DataFrame, texts: DataFrame, comp: DataFrame, width: int, bands: int,
            coordinates: int, percent: int) -> DataFrame:
    """``(id, component)``: documents that may still link, by group."""
    node = (keys.join(comp, "id", "left")
            .select("key", "band", "id", F.coalesce("component", "id").alias("component")))
    rows = materialise(_sides(node), "minhash-mixed")
    sigs = arrow_map(texts.join(rows.select("id").distinct(), "id", "left_semi"),
                     _describe(width, bands * coordinates, False), "id long, n_shingles long, data binary")
    blocks = materialise(
        rows.join(sigs, "id").groupBy("key", "band", "main", "block", "n_main", "n_other")
        .agg(F.collect_list(F.struct("id", "component", "n_shingles", "data")).alias("xs")),
        "minhash-blocks")
    met = blocks.select("key", F.col("main").alias("to_main"), F.col("block").alias("to"),
                        F.col("xs").alias("r"))
    pairs = (_block_pairs(blocks).join(met, ["key", "to_main", "to"])
             .select(F.col("xs").alias("l"), "r", "band"))
    may = materialise(arrow_map(pairs, _promising(percent, coordinates),
                                "u long, v long").distinct(), "minhash-may")
    found = components(may)
    return found.unionByName(found.select(F.col("component").alias("id"), "component").distinct())


def _group_links(groups: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """All links inside groups, as spanning forests of pairs of blocks."""
    sets = arrow_map(texts.join(groups.select("id"), "id", "left_semi"),
                     _describe(width, 0, True), "id long, n_shingles long, data binary")
    member = materialise(sets.join(groups, "id"), "minhash-groups")
    parts = member.groupBy("component").agg(
        F.ceil(F.sum("n_shingles") / SHINGLES).cast("int").alias("nb"))
    # Blocks are given to ids, a large group's by several tasks; the sets
    # themselves only meet theirs by id.
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    block = (member.select("id", "component", F.pmod(F.xxhash64("id"), F.lit(SALTS))
                           .cast("int").alias("salt"))
             .join(parts.select("component", "nb", salt), ["component", "salt"])
             .select("id", "component", "nb", F.pmod(F.xxhash64(F.col("id") + 1), F.col("nb"))
                     .cast("int").alias("block")).distinct())
    placed = member.join(block, ["id", "component"])
    dealt = (placed.withColumn("to", F.explode(F.expr("sequence(0, nb - 1)")))
             .select("component", F.least("block", "to").alias("x"),
                     F.greatest("block", "to").alias("y"), "block", "id", "data"))
    return dealt.groupBy("component", "x", "y").applyInArrow(_compare(percent), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 5, percent: int = 80, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``
    (smallest id reachable by links) and ``kept`` (id = component_id)."""
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                         F.col(f"`{text_col}`").alias("text"))
    signed = materialise(arrow_map(
        source, _sign(width, bands, rows),
        "id long, n_shingles long, same binary, keys array<long>"), "minhash")
    named = signed.filter("id IS NOT NULL AND same IS NOT NULL")
    classes = materialise(named.groupBy("same").agg(F.min("id").alias("id")), "minhash-classes")
    # Rows that share an id but not a text: their classes are linked by hand.
    shared = (named.select("id", "same").distinct().groupBy("id").agg(
        F.count("*").alias("n")).filter("n > 1"))
    by_id = (named.join(shared, "id").select(F.col("id").alias("row_id"), "same").distinct()
             .join(classes, "same").select(F.col("row_id").alias("u"), F.col("id").alias("v")))
    reps = named.join(classes, ["same", "id"], "left_semi")
    keys = reps.select("id", F.posexplode("keys").alias("band", "key"))
    centres = (keys.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("last"))
               .filter("centre <> last").select("key", "centre"))
    # Only keys that two documents share are kept from here on.
    met = materialise(keys.join(centres, "key").select("key", "band", "id", "centre").distinct(),
                      "minhash-met")
    members = met.select("id").distinct()
    # A merge join at every size: the members grow with the documents.
    texts = materialise(source.join(members.hint("merge"), "id", "left_semi"), "minhash-texts")
    first = (met.filter("id <> centre").groupBy("id").agg(F.min("centre").alias("centre")))
    comp = components(_confirmed(texts, first, width, percent).unionByName(by_id))
    groups = _groups(met.select("key", "band", "id"), texts, comp, width, bands, rows, percent)
    comp = components(_group_links(groups, texts, width, percent), comp)
    named_comp = classes.join(comp, "id", "left").select(
        "same", F.coalesce("component", "id").alias("component"))
    return (signed.select("id", "n_shingles", "same").join(named_comp, "same", "left")
            .select(F.col("id").alias(id_col), "n_shingles",
                    F.coalesce("component", "id").alias("component_id"),
                    F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True))
                    .alias("kept")))
