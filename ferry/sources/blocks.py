"""Large text files in byte blocks.

Spark splits a text file at line breaks. A JSON array, a column-oriented
hand-over text or a CSV whose cells hold line breaks has no byte at which a
reader that starts in the middle could be sure where it is. Here the file is
cut into blocks regardless of content, and two narrow passes find out:

1. each block is scanned once and reduced to a few numbers (parity of its
   quotes, change of nesting depth under either state it may start in);
2. a running sum over those rows, one per block, gives the state at the start
   of every block, and each block is read again from that state.

What belongs to a block is decided by where it starts; a task reads on beyond
its block to the end of its last piece, in chunks, so it never holds more than
a chunk and one piece. Only block rows are shuffled, never text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferry.session import scratch_path, ship_package

CHUNK = 4 << 20
LEAST_BLOCK = 64 << 10
QUOTE, BACKSLASH, NEWLINE, COMMA = b'"'[0], b"\\"[0], b"\n"[0], b","[0]
# +1 for an opening bracket, -1 for a closing one; commas are kept with 0.
_STEP = np.zeros(256, np.int64)
_STEP[list(b"[{")] = 1
_STEP[list(b"]}")] = -1
_MARK = _STEP != 0
_MARK[COMMA] = True
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\r\n")] = True


def file_blocks(spark: SparkSession, path: str, block_bytes: int | None = None) -> DataFrame:
    """``path, start, end, size`` of every block of the files at ``path``, one
    task each. ``block_bytes``: by default what Spark would choose for a
    splittable file of this size."""
    ship_package(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    total, largest = files.agg(F.coalesce(F.sum("length"), F.lit(0)),
                               F.coalesce(F.max("length"), F.lit(0))).first()
    if block_bytes is None:
        most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
        per_core = -(-total // spark.sparkContext.defaultParallelism)
        block_bytes = min(most, max(LEAST_BLOCK, per_core))
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1,
                              F.lit(block_bytes).cast("long")))
    blocks = files.filter("length > 0").select("path", at.alias("start"), "length")
    # A fixed number: adaptive execution would merge these tiny rows, each of
    # which stands for a whole block, into one task.
    n = max(1, -(-total // block_bytes))
    return blocks.select("path", "start",
                         F.least("length", F.col("start") + block_bytes).alias("end"),
                         F.col("length").alias("size")).repartition(n)


class Scanner:
    """Marks of JSON text, chunk by chunk: brackets and commas outside strings,
    with the depth before each. ``depth`` and ``inside`` are the state."""

    def __init__(self, inside: int = 0, depth: int = 0, run: int = 0):
        self.inside, self.depth, self.run = inside, depth, run

    def quotes(self, a: np.ndarray) -> np.ndarray:
        """Positions of quotes that are not escaped."""
        q = np.flatnonzero(a == QUOTE)
        slashes = np.flatnonzero(a == BACKSLASH)
        if self.run or len(slashes):
            # Length of the run of backslashes that ends right before a quote.
            other = np.flatnonzero(a != BACKSLASH)
            before = np.searchsorted(other, q) - 1
            last = np.where(before >= 0, other[np.maximum(before, 0)], -1)
            length = q - 1 - last + np.where(last < 0, self.run, 0)
            q = q[length % 2 == 0]
            tail = len(a) - 1 - (other[-1] if len(other) else -1)
            self.run = tail + (self.run if tail == len(a) else 0)
        return q

    def feed(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(positions, depths before them)`` of the chunk's marks."""
        q = self.quotes(a)
        at = np.flatnonzero(_MARK[a])
        at = at[(np.searchsorted(q, at) + self.inside) % 2 == 0]
        after = self.depth + np.cumsum(_STEP[a[at]])
        before = after - _STEP[a[at]]
        if len(at):
            self.depth = int(after[-1])
        self.inside = (self.inside + len(q)) % 2
        return at, before


def _chunks(f, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    for at in range(start, end, CHUNK):
        yield at, f.read_at(min(CHUNK, end - at), at)


def _slashes_before(f, start: int) -> int:
    """Length of the run of backslashes that ends right before ``start``."""
    run, width = 0, 64
    while run < start:
        seen = f.read_at(min(width, start - run), max(0, start - run - width))
        bare = len(seen.rstrip(b"\\"))
        run += len(seen) - bare
        if bare:
            break
    return run


def map_blocks(blocks: DataFrame, read: Callable, schema: str) -> DataFrame:
    """``read(file, row)`` yields record batches for each block row; ``file``
    is open for reading at any offset."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ferry.sources.assets import file_system

        for batch in batches:
            for row in batch.to_pylist():
                files, path = file_system(row["path"])
                with files.open_input_file(path) as f:
                    yield from read(f, row)
    return blocks.mapInArrow(run, schema)


# ------------------------------------------------------------------------ JSON

_STATE = "path string, start long, end long, size long, quotes int, open0 long, open1 long, " \
         "blank boolean"


def _json_summary(f, row: dict) -> Iterator[pa.RecordBatch]:
    run = _slashes_before(f, row["start"])
    states = Scanner(0, 0, run), Scanner(1, 0, run)
    blank = True
    for _, data in _chunks(f, row["start"], row["end"]):
        a = np.frombuffer(data, np.uint8)
        for s in states:
            s.feed(a)
        blank = blank and bool(_BLANK[a].all())
    yield pa.RecordBatch.from_pylist([{
        **row, "quotes": states[0].inside, "open0": states[0].depth, "open1": states[1].depth,
        "blank": blank}], schema=_arrow(_STATE))


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in ddl.split(", "))])


def json_blocks(spark: SparkSession, path: str, block_bytes: int | None = None) -> DataFrame:
    """Blocks of JSON files with the state each starts in: ``inside`` a string
    (0 or 1), ``depth`` and whether anything stands ``before`` it. A file whose
    quotes or brackets do not close fails the query."""
    found = map_blocks(file_blocks(spark, path, block_bytes), _json_summary, _STATE)
    ahead = (Window.partitionBy("path").orderBy("start")
             .rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy("path")
    opened = F.when(F.col("inside") == 0, F.col("open0")).otherwise(F.col("open1"))
    states = (found.withColumn("inside", (F.coalesce(F.sum("quotes").over(ahead), F.lit(0)) % 2)
                               .cast("int"))
              .withColumn("opened", opened)
              .withColumn("depth", F.coalesce(F.sum("opened").over(ahead), F.lit(0)))
              .withColumn("before", F.coalesce(F.bool_or(~F.col("blank")).over(ahead),
                                               F.lit(False)))
              .withColumn("closed", (F.sum("quotes").over(whole) % 2 == 0)
                          & (F.sum("opened").over(whole) == 0)
                          & F.bool_or(~F.col("blank")).over(whole)))
    sound = F.when(F.col("closed"), F.col("path")).otherwise(
        F.raise_error(F.concat(F.lit("JSON text is empty or does not close: "), F.col("path"))))
    return _dealt(states.select(sound.alias("path"), "start", "end", "size", "inside", "depth",
                                "before"), "json-blocks")


def _dealt(states: DataFrame, name: str) -> DataFrame:
    """The block rows with their states, written once (so the first pass runs
    once) and dealt to one task each for the second pass."""
    spark = states.sparkSession
    folder = scratch_path(spark, name)
    states.write.parquet(folder)
    rows = spark.read.schema(states.schema).parquet(folder)
    return rows.repartition(max(1, rows.count()))


def pieces(f, row: dict, level: int, brackets: bytes) -> Iterator[tuple[int, int | None, bytes | None]]:
    """What stands at nesting depth ``level`` of a JSON file, as far as it
    begins in the block: ``(offset of the mark before it, offset of its end,
    text)``; an opening bracket to that level comes first, without an end.
    ``brackets``: those of the root. Anything but white space outside the root
    fails, and so does another bracket around ``level``."""
    s = Scanner(row["inside"], row["depth"], _slashes_before(f, row["start"]))
    begun = row["before"]
    held: list[bytes] = []
    since = None  # offset of the mark whose piece is being gathered
    for at, data in _chunks(f, row["start"], row["size"]):
        a = np.frombuffer(data, np.uint8)
        state = Scanner(s.inside, s.depth, s.run)
        marks, depth = s.feed(a)
        if state.depth == 0 or (depth + _STEP[a[marks]] <= 0).any():
            _check_outside(a, state, begun, brackets, row["path"])
        begun = begun or not _BLANK[a].all()
        here = ((depth == level) & (_STEP[a[marks]] <= 0)) | \
               ((depth == level - 1) & (_STEP[a[marks]] > 0))
        low = 0
        for m, d in zip(marks[here].tolist(), depth[here].tolist(), strict=True):
            if since is not None:
                held.append(data[low:m])
                yield since, at + m, b"".join(held)
                held, since = [], None
            if at + m >= row["end"]:
                return
            low = m + 1
            if d == level - 1:
                yield at + m, None, data[m:m + 1]
            if data[m] not in b"]}":
                since = at + m
            elif data[m] != brackets[1]:
                raise ValueError(f"brackets do not match at byte {at + m} of {row['path']}")
        if since is not None:
            held.append(data[low:])
        elif at + len(data) >= row["end"]:
            return
    if since is not None:
        raise ValueError(f"JSON text does not close: {row['path']}")


def _check_outside(a: np.ndarray, s: Scanner, begun: bool, brackets: bytes, path: str) -> None:
    """The root may open once, after white space only, and nothing follows it."""
    marks, depth = s.feed(a)
    step = _STEP[a[marks]]
    opens = marks[(depth == 0) & (step > 0)]
    closes = marks[(depth == 1) & (step < 0)]
    first = np.flatnonzero(~_BLANK[a])
    bad = len(opens) > 1 or (len(opens) and (begun or first[0] != opens[0])) \
        or (not len(opens) and len(first) and (not begun or not len(closes))) \
        or (len(closes) and not _BLANK[a[closes[-1] + 1:]].all()) \
        or bool((depth < 0).any()) \
        or bytes(a[opens]) not in (b"", brackets[:1]) \
        or bytes(a[closes]) not in (b"", brackets[1:])
    if bad:
        raise ValueError(f"not one JSON array or object: {path}")


_PIECE = "path string, block long, number long, text string"


def array_elements(spark: SparkSession, path: str, block_bytes: int | None = None) -> DataFrame:
    """The elements of JSON array files as text: ``path, block, number`` (in
    its block) and ``text``. ``[]`` has none; ``[1,]`` fails."""
    def read(f, row: dict) -> Iterator[pa.RecordBatch]:
        texts, number, size = [], 0, 0

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"path": [row["path"]] * len(texts), "block": [row["start"]] * len(texts),
                 "number": range(number - len(texts), number), "text": texts},
                schema=_arrow(_PIECE))

        for since, end, text in pieces(f, row, 1, b"[]"):
            if end is None:
                continue
            if not text.strip():
                if f.read_at(1, since) == b"[" and f.read_at(1, end) == b"]":
                    continue
                raise ValueError(f"empty element at byte {since} of {row['path']}")
            texts.append(text.decode())
            number, size = number + 1, size + len(text)
            if size >= CHUNK:
                yield full()
                texts, size = [], 0
        yield full()
    return map_blocks(json_blocks(spark, path, block_bytes), read, _PIECE)


def _key_before(f, at: int) -> str:
    """The object key that stands, with its colon, right before ``at``."""
    width = 256
    while True:
        seen = f.read_at(min(width, at), max(0, at - width)).rstrip(b" \t\r\n")
        if seen[-1:] == b":":
            seen = seen[:-1].rstrip(b" \t\r\n")
            low = seen.rfind(b'"', 0, len(seen) - 1)
            while low > 0:
                run = low - len(seen[:low].rstrip(b"\\"))
                if run < low and run % 2 == 0:
                    return json.loads(seen[low:])
                low = seen.rfind(b'"', 0, low)
        if width >= at:
            raise ValueError("a value without a key")
        width *= 4


_OPENING = "path string, at long, name string"
_ENTRY = "column string, text string"


def column_entries(spark: SparkSession, path: str, block_bytes: int | None = None) -> DataFrame:
    """The entries of column-oriented JSON files ``{"column": {"label":
    value}}``: ``column`` and ``text`` (``"label": value``)."""
    blocks = json_blocks(spark, path, block_bytes)

    def openings(f, row: dict) -> Iterator[pa.RecordBatch]:
        found = []
        for since, end, text in pieces(f, row, 2, b"{}"):
            if end is None:
                if text != b"{":
                    raise ValueError(f"a column that is no object: {row['path']}")
                found.append({"path": row["path"], "at": since, "name": _key_before(f, since)})
        yield pa.RecordBatch.from_pylist(found, schema=_arrow(_OPENING))

    # One row per column of a file, so an array of them stays small.
    heads = map_blocks(blocks, openings, _OPENING).groupBy("path").agg(
        F.array_sort(F.collect_list(F.struct("at", "name"))).alias("heads"))

    def read(f, row: dict) -> Iterator[pa.RecordBatch]:
        at = [h["at"] for h in row["heads"]]
        names = [h["name"] for h in row["heads"]]
        rows: tuple[list, list] = ([], [])
        size = 0
        for since, end, text in pieces(f, row, 2, b"{}"):
            if end is None:
                continue
            if not text.strip():
                if f.read_at(1, since) == b"{" and f.read_at(1, end) == b"}":
                    continue
                raise ValueError(f"empty entry at byte {since} of {row['path']}")
            rows[0].append(names[int(np.searchsorted(at, since, side="right")) - 1])
            rows[1].append(text.decode())
            size += len(text)
            if size >= CHUNK:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in rows],
                                                 names=["column", "text"])
                rows, size = ([], []), 0
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in rows],
                                         names=["column", "text"])

    return map_blocks(_dealt(blocks.join(heads, "path"), "column-blocks"), read, _ENTRY)


# ------------------------------------------------------------------------- CSV

_PARITY = "path string, start long, end long, size long, quotes int"


def _quote_parity(f, row: dict) -> Iterator[pa.RecordBatch]:
    quotes = sum(data.count(b'"') for _, data in _chunks(f, row["start"], row["end"]))
    yield pa.RecordBatch.from_pylist([{**row, "quotes": quotes % 2}], schema=_arrow(_PARITY))


def csv_records(spark: SparkSession, path: str, block_bytes: int | None = None) -> DataFrame:
    """The records of CSV files as text, ``path``, ``start`` (its offset) and
    ``text``: a line break inside quotes does not end one, ``\\r\\n`` ends one
    as ``\\n`` does, blank lines are none. Quotes inside quoted cells are
    doubled, so every quote changes the state; a file with an odd number of
    them fails."""
    found = map_blocks(file_blocks(spark, path, block_bytes), _quote_parity, _PARITY)
    ahead = (Window.partitionBy("path").orderBy("start")
             .rowsBetween(Window.unboundedPreceding, -1))
    even = F.sum("quotes").over(Window.partitionBy("path")) % 2 == 0
    sound = F.when(even, F.col("path")).otherwise(
        F.raise_error(F.concat(F.lit("CSV with an open quote: "), F.col("path"))))
    blocks = found.select(
        sound.alias("path"), "start", "end", "size",
        (F.coalesce(F.sum("quotes").over(ahead), F.lit(0)) % 2).cast("int").alias("inside"))
    schema = _arrow("path string, start long, text string")

    def read(f, row: dict) -> Iterator[pa.RecordBatch]:
        starts: list[int] = []
        texts: list[str] = []
        size = 0
        inside = row["inside"]
        # A record starts where the file does, or behind a break outside quotes.
        first = row["start"] == 0 or (not inside and f.read_at(1, row["start"] - 1) == b"\n")
        since = row["start"] if first else None
        held: list[bytes] = []

        def add(text: bytes) -> None:
            nonlocal size
            text = text.removesuffix(b"\r")
            if text:
                starts.append(since)
                texts.append(text.decode())
                size += len(text)

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"path": [row["path"]] * len(texts),
                                               "start": starts, "text": texts}, schema=schema)

        for at, data in _chunks(f, row["start"], row["size"]):
            a = np.frombuffer(data, np.uint8)
            q = np.flatnonzero(a == QUOTE)
            breaks = np.flatnonzero(a == NEWLINE)
            breaks = breaks[(np.searchsorted(q, breaks) + inside) % 2 == 0]
            inside = (inside + len(q)) % 2
            low = 0
            for b in breaks.tolist():
                if since is not None:
                    add(b"".join((*held, data[low:b])))
                held, low, since = [], b + 1, at + b + 1
                if since >= row["end"]:
                    yield full()
                    return
                if size >= CHUNK:
                    yield full()
                    starts, texts, size = [], [], 0
            if since is not None:
                held.append(data[low:])
            elif at + len(data) >= row["end"]:
                break
        if since is not None:
            add(b"".join(held))
        yield full()
    return map_blocks(_dealt(blocks, "csv-blocks"), read, "path string, start long, text string")
