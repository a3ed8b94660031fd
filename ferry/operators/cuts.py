"""Ordered rows cut into bounded values.

A value that holds many rows -- a page of a document, a chunk of a hand-over
text -- is bounded by bytes, not only by rows: a hundred rows of 20 KB are
2 MB. Rows that carry their position already lie side by side in the table
that ``with_ordinal`` wrote, so they are cut where they lie: a task streams its
rows and closes a value before the next row would take it over the budget. No
shuffle; a value never spans two read tasks, so at most one short value per
task comes on top of what a sequential cut would give. A single row larger
than the budget is a value by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.operators.project import quoted
from ferry.session import ship_package

CUT_BYTES = 16 << 20
CUTS = "first_row long, n_rows long, n_bytes long, text string"
_SCHEMA = pa.schema([("first_row", pa.int64()), ("n_rows", pa.int64()), ("n_bytes", pa.int64()),
                     ("text", pa.string())])


def joined(rows: list[tuple]) -> str:
    """The texts of the first column, one after the other."""
    return "".join(r[1] for r in rows)


def cut_rows(pos: DataFrame, columns: list[str], budget: int = CUT_BYTES,
             max_rows: int | None = None, render: Callable[[list[tuple]], str] = joined,
             overhead: int = 0) -> DataFrame:
    """Values over rows with an ``ordinal``: ``first_row``, ``n_rows``,
    ``n_bytes`` and ``text``, the ``render`` of ``(ordinal, *columns)`` rows. A
    row counts the bytes of its columns and ``overhead``."""
    ship_package(pos.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def full() -> pa.RecordBatch:
            text = render(held)
            return pa.RecordBatch.from_pydict(
                {"first_row": [held[0][0]], "n_rows": [len(held)],
                 "n_bytes": [len(text.encode())], "text": [text]}, schema=_SCHEMA)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                more = overhead + sum(len(x.encode()) for x in row[1:])
                if held and (size + more > budget or len(held) == max_rows
                             or row[0] != held[-1][0] + 1):
                    yield full()
                    held, size = [], 0
                held.append(row)
                size += more
        if held:
            yield full()
    return pos.select("ordinal", *[F.coalesce(quoted(c), F.lit("")) for c in columns]
                      ).mapInArrow(run, CUTS)
