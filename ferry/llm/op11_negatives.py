"""Hard negatives by an inverted multi-index.

Every component x counts as floor(256 * x); the score of a row is its integer
inner product with the anchor. Anchors are the rows whose id is divisible by
``every``. An anchor's positives are its best ``n_positives`` other rows of
its label; for each of them the ``n_negatives`` best rows of another label are
returned whose score lies between ``floor_percent`` of the positive's score
and that score.

Rows are dealt into shards of about ``SHARD`` rows. A shard's vectors are cut
into two halves; each half has its own codebook (k-means on at most ``SAMPLE``
rows of the shard; every row is then indexed), and a pair of codewords is a
cell. For an anchor, half h of a row in codeword c scores at most
``<a_h, c> + |a_h| * radius_c``. Both lists of bounds are sorted, and a heap
walks the cells by falling sum of both (multi-sequence). Since no row of an
unvisited cell scores above the next sum, the walk ends once it is below the
last wanted score of every window, or below the window itself: the result is
exact, and the codebooks only decide how soon the walk ends.

Two passes over the shards: best positives of each shard, merged per anchor;
then, with the windows known, best negatives of each shard, merged per window.
Anchors travel to the shards in slices, so a task holds one shard and one
slice.

Defined results: rows with a null label, a null or empty vector, or a null or
non-finite component take no part; vectors of different lengths are never
compared; a null id is no anchor and comes last among ties; rows that repeat
(id or vector) are rows of their own, an anchor's own row is the only one left
out of its positives; a positive with a negative score has an empty window;
scores beyond 2^53 are computed exactly in Python integers and end at the
range of a long; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import materialise
from ferry.session import ship_package

# Rows of a shard, anchors of a slice, rows a codebook is fitted
# on, rows a cell should hold, most codewords of a half, rounds of k-means,
# rows scored at once while walking.
SHARD, SLICE, SAMPLE = 1 << 17, 1 << 14, 4096
CELL_ROWS, CODES, ROUNDS, BATCH = 64, 64, 5, 2048
NO_ID = (1 << 63) - 1

_FOUND = pa.schema([("row", pa.int64()), ("slot", pa.int32()), ("low", pa.int64()),
                    ("high", pa.int64()), ("found_id", pa.int64()), ("score", pa.int64())])
_FOUND_SQL = "row long, slot int, low long, high long, found_id long, score long"


def quantised(flat: np.ndarray, dim: int) -> np.ndarray:
    """Rows of floor(256 * x), as doubles (whole numbers)."""
    return np.floor(256.0 * flat.reshape(-1, dim))


def _matrix(table: pa.Table, name: str, dim: int) -> np.ndarray:
    return quantised(table.column(name).combine_chunks().flatten().to_numpy(), dim)


class Half:
    """Codewords of one half: for each its centre and its radius over all rows."""

    def __init__(self, part: np.ndarray, codes: int):
        n = len(part)
        sample = part[np.linspace(0, n - 1, min(n, SAMPLE)).astype(np.int64)]
        centre = sample[np.linspace(0, len(sample) - 1, min(codes, len(sample))).astype(np.int64)]
        for _ in range(ROUNDS):
            near = self._nearest(sample, centre)
            size = np.bincount(near, minlength=len(centre))
            total = np.zeros_like(centre)
            np.add.at(total, near, sample)
            centre = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centre)
        self.centre = centre
        self.code = self._nearest(part, centre)
        away = np.sqrt(((part - centre[self.code]) ** 2).sum(axis=1))
        self.radius = np.zeros(len(centre))
        np.maximum.at(self.radius, self.code, away)

    @staticmethod
    def _nearest(part: np.ndarray, centre: np.ndarray) -> np.ndarray:
        length = (centre * centre).sum(axis=1)
        return np.concatenate([
            np.argmin(length - 2 * (part[i:i + 8192] @ centre.T), axis=1)
            for i in range(0, len(part), 8192)])

    def bounds(self, anchors: np.ndarray) -> np.ndarray:
        """The most that a row in each codeword can add to each anchor's score."""
        long = np.sqrt((anchors * anchors).sum(axis=1))[:, None]
        most = anchors @ self.centre.T + long * self.radius
        slack = long * (np.sqrt((self.centre ** 2).sum(axis=1)) + self.radius)
        # Components whose squares leave the doubles bound nothing.
        return np.nan_to_num(most + 1e-9 * slack + 1e-6, nan=np.inf, posinf=np.inf, neginf=-np.inf)


class MultiIndex:
    """The cells of one shard: rows sorted by (first code, second code)."""

    def __init__(self, vectors: np.ndarray):
        n, dim = vectors.shape
        codes = int(min(CODES, max(1, (n / CELL_ROWS) ** 0.5)))
        cut = dim // 2
        self.cut = cut
        self.halves = [Half(vectors[:, :cut], codes), Half(vectors[:, cut:], codes)]
        self.width = len(self.halves[1].centre)
        cell = self.halves[0].code * self.width + self.halves[1].code
        self.order = np.argsort(cell, kind="stable")
        self.start = np.searchsorted(cell[self.order],
                                     np.arange(len(self.halves[0].centre) * self.width + 1))
        # Products of whole numbers are exact in doubles below 2^53.
        most = float(np.abs(vectors).max()) if vectors.size else 0.0
        self.most, self.dim = most, dim
        self.vectors = vectors[self.order]

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (self.halves[0].bounds(anchors[:, :self.cut]),
                self.halves[1].bounds(anchors[:, self.cut:]))

    def scores(self, at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        top = float(np.abs(anchor).max()) if anchor.size else 0.0
        if self.most * top * max(self.dim, 1) < 2.0 ** 53:
            return (self.vectors[at] @ anchor).astype(np.int64)
        whole = [int(x) for x in anchor]
        exact = (sum(int(a) * b for a, b in zip(v, whole, strict=True)) for v in self.vectors[at])
        return np.array([max(-NO_ID, min(NO_ID, x)) for x in exact], np.int64)

    def walk(self, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """``(bound of everything not yet given, positions)``, cells by falling
        bound, about ``BATCH`` rows at a time; the last bound is -inf."""
        p, q = np.argsort(-first), np.argsort(-second)
        f, s = first[p].tolist(), second[q].tolist()
        p, q = p.tolist(), q.tolist()
        start = self.start
        heap = [(-(f[0] + s[0]), 0, 0)]
        spans, held = [], 0
        while heap:
            _, i, j = heapq.heappop(heap)
            if j == 0 and i + 1 < len(f):
                heapq.heappush(heap, (-(f[i + 1] + s[0]), i + 1, 0))
            if j + 1 < len(s):
                heapq.heappush(heap, (-(f[i] + s[j + 1]), i, j + 1))
            cell = p[i] * self.width + q[j]
            a, b = start[cell], start[cell + 1]
            if b > a:
                spans.append(np.arange(a, b))
                held += b - a
            if held >= BATCH or (spans and not heap):
                yield (-heap[0][0] if heap else -np.inf), np.concatenate(spans)
                spans, held = [], 0


def best_in_window(index: MultiIndex, ids: np.ndarray, allowed, anchor: np.ndarray,
                   first: np.ndarray, second: np.ndarray, windows: list[tuple[int, int]],
                   k: int) -> list[list[tuple[int, int]]]:
    """For each window ``(low, high)`` the ``k`` best allowed rows in it, as
    ``(-score, id)``. ``allowed(positions)`` is a mask."""
    best: list[list] = [[] for _ in windows]
    least = min(low for low, _ in windows)
    for bound, at in index.walk(first, second):
        at = at[allowed(at)]
        score = index.scores(at, anchor)
        near = score >= least
        at, score = at[near], score[near]
        for n, (low, high) in enumerate(windows):
            inside = (score >= low) & (score <= high)
            if len(best[n]) == k:
                inside &= score >= -best[n][-1][0]
            if inside.any():
                s, i = score[inside], ids[at[inside]]
                top = np.lexsort((i, -s))[:k]
                best[n] = sorted(best[n] + list(zip((-s[top]).tolist(), i[top].tolist(),
                                                    strict=True)))[:k]
        # Certified: nothing left reaches the window, or its last place.
        if all(bound < low or (len(b) == k and bound < -b[-1][0])
               for b, (low, _) in zip(best, windows, strict=True)):
            break
    return best


def _search(k: int, same: bool):
    """Task of one shard and one slice of anchors."""

    def run(_, shard: pa.Table, anchors: pa.Table) -> pa.Table:
        with np.errstate(over="ignore", invalid="ignore"):
            return found(shard, anchors)

    def found(shard: pa.Table, anchors: pa.Table) -> pa.Table:
        rows: dict[str, list] = {c: [] for c in _FOUND.names}
        if len(shard) and len(anchors):
            dim = shard.column("dim")[0].as_py()
            order = np.argsort(shard.column("row").to_numpy(), kind="stable")
            index = MultiIndex(_matrix(shard, "vector", dim)[order])
            order = order[index.order]
            ids = shard.column("id").fill_null(NO_ID).to_numpy()[order]
            labels = shard.column("label").to_numpy()[order]
            own = shard.column("row").to_numpy()[order]
            asked = _matrix(anchors, "vector", dim)
            first, second = index.bounds(asked)
            windows = anchors.column("windows").to_pylist()
            for n, (row, label) in enumerate(zip(anchors.column("row").to_pylist(),
                                                 anchors.column("label").to_pylist(),
                                                 strict=True)):
                if same:
                    allowed = lambda at: (labels[at] == label) & (own[at] != row)
                else:
                    allowed = lambda at: labels[at] != label
                spans = [(w["low"], w["high"]) for w in windows[n]]
                for slot, ((low, high), best) in enumerate(zip(spans, best_in_window(
                        index, ids, allowed, asked[n], first[n], second[n], spans, k),
                        strict=True)):
                    for minus, found_id in best:
                        for c, v in zip(_FOUND.names, (row, slot, low, high, found_id, -minus),
                                        strict=True):
                            rows[c].append(v)
        return pa.Table.from_pydict(rows, schema=_FOUND)
    return run


def _ask(shards: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """Every anchor of a dimension against every shard of it: the ``k`` best of
    each shard and window."""
    key = ["dim", "part", "slice"]
    sent = (anchors.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("slice", F.pmod("row", "slices").cast("int")))
    held = shards.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    # Both sides come from the same rows: one gets columns of its own.
    asked = [*key, "row", "label", "vector", "windows"]
    return (held.select(*key, "row", "id", "label", "vector").groupBy(*key)
            .cogroup(sent.select(*asked).toDF(*asked).groupBy(*key))
            .applyInArrow(_search(k, same), _FOUND_SQL))


def _first(df: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "found_id")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                   label: Column | None = None, every: int = 100, n_positives: int = 5,
                   n_negatives: int = 5, floor_percent: int = 80) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)`` for every anchor and each of its positives; ``label``
    defaults to the column of that name."""
    spark = vectors.sparkSession
    ship_package(spark)
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    usable = (F.col("label").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
              & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x)
                          | (F.abs(x) == F.lit(float("inf")))))
    rows = (vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                           (F.col("label") if label is None else label).cast("long").alias("label"),
                           vector.alias("vector"))
            .filter(F.coalesce(usable, F.lit(False)))
            .select(F.monotonically_increasing_id().alias("row"), "id", "label", "vector",
                    F.size("vector").alias("dim")))
    # Written once, so a row's number is the same in both passes.
    rows = materialise(rows, "negatives-rows")
    is_anchor = F.coalesce(F.col("id") % every == 0, F.lit(False))
    # One row per vector length.
    dims = rows.groupBy("dim").agg(
        F.ceil(F.count(F.lit(1)) / SHARD).cast("int").alias("parts"),
        F.greatest(F.lit(1), F.ceil(F.count_if(is_anchor) / SLICE)).cast("int").alias("slices"))
    # Small at any size: D different lengths take D * D / 2 components.
    rows = rows.join(F.broadcast(dims), "dim")
    part = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    shards = rows.withColumn("part", part)
    anchors = rows.filter(is_anchor)
    everything = F.array(F.struct(F.lit(-(1 << 63)).cast("long").alias("low"),
                                  F.lit((1 << 63) - 1).cast("long").alias("high")))
    positives = materialise(_first(
        _ask(shards, anchors.withColumn("windows", everything), n_positives, True),
        ["row"], n_positives).select(
            "row", F.col("score").alias("positive_score"), F.col("found_id").alias("positive_id"),
            F.col("rank").alias("place")), "negatives-positives")
    # One window per score: at most n_positives of them per anchor.
    high = F.col("positive_score")
    low = F.ceil(high.cast("decimal(38,0)") * floor_percent / 100).cast("long")
    windows = (positives.filter("positive_score >= 0").groupBy("row")
               .agg(F.array_sort(F.collect_set(F.struct(low.alias("low"), high.alias("high"))))
                    .alias("windows")))
    negatives = _first(_ask(shards, anchors.join(windows, "row"), n_negatives, False),
                       ["row", "high"], n_negatives).select(
        "row", F.col("high").alias("positive_score"), "rank", F.col("found_id").alias("negative"),
        F.col("score").alias("negative_score"))
    ids = anchors.select("row", F.col("id").alias("anchor_id"))
    unnamed = lambda c: F.nullif(F.col(c), F.lit(NO_ID).cast("long"))
    return (positives.join(negatives, ["row", "positive_score"]).join(ids, "row")
            .select("anchor_id", unnamed("positive_id").alias("positive_id"),
                    F.col("rank").cast("int").alias("rank"),
                    unnamed("negative").alias("negative_id"), "positive_score", "negative_score"))
