"""Shards of nearly equal bytes: minimax contiguous partition of copy groups.

Documents with equal texts form one atomic group. Groups are put in an order
(those of at least an even share of all bytes first, the largest first; the
others by the digest of their text), and the smallest capacity is searched for
which the ordered sizes can be cut into ``n_shards`` runs of at most that many
bytes. A capacity is checked greedily: each run ends at the last group end
within reach. The cuts are then made under that capacity, each as near to an
even share of what remains as it allows, so that one large group does not
leave the last shards empty.

Only functions of Spark touch rows. Prefix sums come from three levels of the
digest's leading bits, each a small window. The search itself needs no rows:
the driver holds spans ``(first end, last end, ends)`` of the prefix sums,
at first some thousand for the whole range. A lookup that falls inside a span
with unknown ends notes it; noted spans are replaced by finer ones in one
aggregation, and the search is repeated until no lookup was in doubt. What
reaches the driver is bounded by ``SPANS`` a round, whatever the input.

Copies of one text are spread over salts, as many as the table needs, so a
text that a third of all rows hold is numbered by many tasks; a salt's rows of
one id are a count until the last step.

Defined results: a null text counts as an empty one (both form one group); a
null or repeated id keeps all its rows; equal rows get slots of their own; an
empty table gives an empty result; with fewer groups than shards some shards
stay empty; other columns are ignored. Texts of any length are only hashed and
measured.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import materialise

# Bytes a document counts beside its text, spans a round,
# rows that one salt or one bucket of groups should hold, fewest salts.
EXTRA = 16
SPANS = 8192
ROWS = 1 << 16
SALTS = 64
TOP_BITS, MAX_BITS = 10, 40
UNROLL = 4096


class Ends:
    """The ends of the ordered groups, as far as the driver knows them.

    ``read(width, within)`` returns ``(first end, last end, ends)`` of every
    cell of ``width`` bytes that holds an end; ``within`` is None or a pair
    ``(coarser width, cells of it)`` to look into.
    """

    def __init__(self, total: int, read: Callable):
        self.read = read
        width = max(1, math.ceil(total / SPANS))
        self.spans = sorted((a, b, n, width) for a, b, n in read(width, None))
        self.doubt: set[tuple[int, int, int, int]] = set()
        self._index()

    def _index(self) -> None:
        self.first = [s[0] for s in self.spans]
        self.last = [s[1] for s in self.spans]

    def upto(self, p: int) -> int:
        """The last end not beyond ``p`` (0 if none); a lower one in doubt."""
        k = bisect_right(self.first, p) - 1
        if k < 0:
            return 0
        a, b, n, _ = span = self.spans[k]
        if p >= b:
            return b
        if n > 2:
            self.doubt.add(span)
        return a

    def onward(self, p: int) -> int:
        """The first end not before ``p`` > 0; a higher one in doubt."""
        k = bisect_left(self.last, p)
        a, b, n, _ = span = self.spans[k]
        if p <= a:
            return a
        if n > 2:
            self.doubt.add(span)
        return b

    def settle(self, search: Callable):
        """``search()`` over known ends: repeated until nothing was in doubt."""
        while True:
            self.doubt.clear()
            found = search()
            if not self.doubt:
                return found
            kept = [s for s in self.spans if s not in self.doubt]
            parts = max(16, SPANS // len(self.doubt))
            for width in {s[3] for s in self.doubt}:
                finer = max(1, width // parts)
                cells = sorted({(s[0] - 1) // width for s in self.doubt if s[3] == width})
                kept += [(a, b, n, finer) for a, b, n in self.read(finer, (width, cells))]
            self.spans = sorted(kept)
            self._index()


def minimax_cuts(ends: Ends, total: int, largest: int, n_shards: int) -> tuple[int, list[int]]:
    """The smallest capacity and the ends of the first ``n_shards - 1`` runs."""

    def fits(capacity: int) -> bool:
        at = 0
        for _ in range(n_shards):
            at = ends.upto(at + capacity)
            if at == total:
                return True
        return False

    def smallest() -> int:
        low = max(largest, -(-total // n_shards))
        high = -(-total // n_shards) + largest
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if fits(mid) else (mid + 1, high)
        return low

    capacity = ends.settle(smallest)

    def cuts() -> list[int]:
        # What each run has to reach at least, so that the rest still fits.
        least = [0] * n_shards + [total]
        for i in range(n_shards - 1, 0, -1):
            need = least[i + 1] - capacity
            least[i] = ends.onward(need) if need > 0 else 0
        out = [0]
        for i in range(1, n_shards):
            aim = out[-1] + (total - out[-1]) // (n_shards - i + 1)
            below = max(out[-1], ends.upto(aim))
            above = ends.onward(aim) if aim > 0 else 0
            near = below if aim - below <= above - aim and below > out[-1] else above
            out.append(min(max(near, least[i]), max(out[-1], ends.upto(out[-1] + capacity))))
        return out[1:]

    return capacity, ends.settle(cuts)


def _spans_of(placed: DataFrame) -> Callable:
    def read(width: int, within: tuple[int, list[int]] | None) -> list[tuple[int, int, int]]:
        rows = placed.select("end")
        if within:
            coarse, cells = within
            rows = rows.filter(F.col("end").between(cells[0] * coarse + 1, (cells[-1] + 1) * coarse)
                               & F.expr(f"(end - 1) div {coarse}L").isin(cells))
        return [tuple(r) for r in
                rows.groupBy(F.expr(f"(end - 1) div {width}L").alias("cell"))
                .agg(F.min("end"), F.max("end"), F.count(F.lit(1))).drop("cell").collect()]
    return read


def _running(df: DataFrame, within: list[str], order: list, names: dict[str, Column]) -> DataFrame:
    """Sums over the rows before each one (not itself) inside ``within``."""
    w = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({n: F.coalesce(F.sum(c).over(w), F.lit(0)) for n, c in names.items()})


def _place(groups: DataFrame, n_groups: int, share: int) -> DataFrame:
    """Groups with ``end`` (bytes up to and with them) and ``rows_before``."""
    low_bits = min(MAX_BITS - TOP_BITS, max(0, (n_groups // ROWS).bit_length()))
    lead = F.conv(F.substring(F.hex("digest"), 1, MAX_BITS // 4), 16, 10).cast("long")
    # Groups of an even share or more (at most as many as shards) lead: top -1.
    large = F.col("bytes") >= share
    tagged = groups.withColumns({
        "top": F.when(large, F.lit(-1)).otherwise(F.shiftright(lead, MAX_BITS - TOP_BITS)),
        "low": F.when(large, F.lit(0)).otherwise(
            F.shiftright(lead, MAX_BITS - TOP_BITS - low_bits)),
        "lead_bytes": F.when(large, -F.col("bytes")).otherwise(F.lit(0))})
    sums = {"low_bytes": F.sum("bytes"), "low_rows": F.sum("rows")}
    low = tagged.groupBy("top", "low").agg(*(c.alias(n) for n, c in sums.items()))
    top = low.groupBy("top").agg(F.sum("low_bytes").alias("top_bytes"),
                                 F.sum("low_rows").alias("top_rows"))
    # One row per leading bit pattern (at most 1,025), whatever the input.
    top = _running(top, [], ["top"], {"b0": F.col("top_bytes"), "r0": F.col("top_rows")})
    low = _running(low, ["top"], ["low"], {"b1": F.col("low_bytes"), "r1": F.col("low_rows")})
    low = low.join(F.broadcast(top.select("top", "b0", "r0")), "top").select(
        "top", "low", (F.col("b0") + F.col("b1")).alias("b1"),
        (F.col("r0") + F.col("r1")).alias("r1"))
    inner = _running(tagged, ["top", "low"], ["lead_bytes", "digest"],
                     {"b2": F.col("bytes"), "r2": F.col("rows")})
    return inner.join(low, ["top", "low"]).select(
        "digest", "bytes", (F.col("b1") + F.col("b2") + F.col("bytes")).alias("end"),
        (F.col("r1") + F.col("r2")).alias("rows_before"))


def shard_documents(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``size`` (bytes of the text and 16),
    ``text_crc32``, ``law`` ('bytes'), ``shard`` from 0, ``slot`` (gapless from
    0 in a shard, in the order of groups and ids) and ``grown_shard`` (null:
    the law says nothing of other shard counts)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    n_rows = docs.select(F.lit(1)).count()
    salts = max(SALTS, n_rows // ROWS)
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"),
        (F.octet_length(text) + EXTRA).cast("long").alias("size"), F.crc32(text).alias("crc"))
    salt = F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt")
    copies = materialise(rows.groupBy("digest", salt, "id", "size", "crc")
                         .agg(F.count(F.lit(1)).alias("n")), "shard-copies")
    salted = copies.groupBy("digest", "salt", "size").agg(F.sum("n").alias("n"))
    group = Window.partitionBy("digest")
    salted = materialise(
        _running(salted, ["digest"], ["salt"], {"before": F.col("n")})
        .withColumn("rows", F.sum("n").over(group)), "shard-salts")
    groups = materialise(salted.filter("before = 0").select(
        "digest", "rows", (F.col("rows") * F.col("size")).alias("bytes")), "shard-groups")
    n_groups, total, largest = groups.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0)),
        F.coalesce(F.max("bytes"), F.lit(0))).first()
    placed = materialise(_place(groups, n_groups, max(1, total // n_shards)), "shard-placed")
    cuts: list[int] = []
    if n_groups:
        _, cuts = minimax_cuts(Ends(total, _spans_of(placed)), total, largest, n_shards)
    start = F.col("end") - F.col("bytes")
    edges = F.array(*(F.lit(c).cast("long") for c in cuts)) if cuts else F.array().cast("array<long>")
    dealt = placed.select("digest", "rows_before",
                          F.size(F.filter(edges, lambda c: c <= start)).alias("shard"))
    # One row per shard, so small enough to broadcast at any size of input.
    opening = dealt.groupBy("shard").agg(F.min("rows_before").alias("rows_at"))
    spots = (salted.join(dealt, "digest").join(F.broadcast(opening), "shard")
             .select("digest", "salt", "shard",
                     (F.col("rows_before") - F.col("rows_at") + F.col("before")).alias("base")))
    in_salt = _running(copies, ["digest", "salt"], [F.asc_nulls_first("id")],
                       {"ahead": F.col("n")})
    # Equal rows are a count so far; unrolled in two steps, no long array.
    last = F.col("n") - 1
    unrolled = (in_salt.join(spots, ["digest", "salt"])
                .withColumn("part", F.explode(F.sequence(
                    F.lit(0).cast("long"), F.expr(f"(n - 1) div {UNROLL}"))))
                .withColumn("k", F.explode(F.sequence(
                    F.col("part") * UNROLL,
                    F.least(last, F.col("part") * UNROLL + UNROLL - 1)))))
    return unrolled.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.col("ahead") + F.col("k")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
