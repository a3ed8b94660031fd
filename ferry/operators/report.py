"""Report shaping: sheet extent, positioned rows, chart series, HTML (SURVEY
A2, K5, W1, X10, P5, P6, P7, A3).

A report sheet is a table with a header in row 1 and data from row 2; an
object anchored next to data row ``i`` (0-based) sits at ``<letter>{i + 2}``.
The workbook file itself is not drawn (single-machine library); the sheet
*table* is what Spark produces and writes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.functions.text import html_escape, py_str
from ferry.operators.cuts import CUT_BYTES, cut_rows
from ferry.operators.ordinal import with_ordinal

HEADER_ROWS = 1
FIRST_DATA_ROW = HEADER_ROWS + 1


def sheet_extent(df: DataFrame) -> DataFrame:
    """Rows of data and the last sheet row they occupy.

    A global count: partial counts per partition, one tiny final merge.
    """
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", (F.col("n_rows") + HEADER_ROWS).alias("last_sheet_row"))


def sheet_rows(df: DataFrame, order_by: Sequence[str], keep: Sequence[str],
               anchor_column: str | None = None) -> DataFrame:
    """Data rows placed on a sheet (K5, W1, X10), in ``order_by`` order; see
    :func:`placed` for rows that already carry their position."""
    return placed(with_ordinal(df.select(*keep), order_by), keep, anchor_column)


def placed(pos: DataFrame, keep: Sequence[str], anchor_column: str | None = None) -> DataFrame:
    """Rows with an ``ordinal`` placed on a sheet: ``sheet_row`` is the 1-based
    sheet row (header is row 1); with ``anchor_column`` (a column letter)
    ``anchor_cell`` names the cell an image for that row is anchored to, e.g.
    ``D7``."""
    row = F.col("ordinal") + FIRST_DATA_ROW
    cols = [row.alias("sheet_row"), *[F.col(c) for c in keep]]
    if anchor_column:
        cols.append(F.concat(F.lit(anchor_column), row.cast("string")).alias("anchor_cell"))
    return pos.select(*cols)


def series(pos: DataFrame, value_columns: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Chart series of rows that already carry their ``ordinal``."""
    return pos.unpivot(["ordinal", *carry], list(value_columns), "series", "value")


def chart_series(df: DataFrame, order_by: Sequence[str], value_columns: Sequence[str],
                 carry: Sequence[str] = ()) -> DataFrame:
    """Sheet columns -> named chart series, one row per (point, series).

    The chart has no category axis, so x is the data row position
    (``ordinal``, 0-based); ``carry`` columns (e.g. the date) ride along.
    The header cell names the series. NULL cells stay as NULL points.
    """
    return series(with_ordinal(df, order_by), value_columns, carry)


# ----------------------------------------------------------------------- HTML

def html_row(df: DataFrame, fields: Sequence[str], out: str = "row_html",
             keep: Sequence[str] = (), escape: bool = False) -> DataFrame:
    """One ``<tr>`` per row, one ``<td>`` per field, Python-style text (P5).

    A missing value prints ``None``, booleans ``True``/``False``. Like the
    reference's template, nothing is escaped unless ``escape=True``.
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cells = []
    for f in fields:
        txt = py_str(f, types[f])
        cells += [F.lit("<td>"), html_escape(txt) if escape else txt, F.lit("</td>")]
    return df.select(*[F.col(k) for k in keep],
                     F.concat(F.lit("<tr>"), *cells, F.lit("</tr>")).alias(out))


def html_pages(rows: DataFrame, order_by: Sequence[str], page_rows: int,
               header: str, footer: str, row_col: str = "row_html") -> DataFrame:
    """One HTML document in pages: ordered concatenation of rendered rows (A3).

    All rows are kept; they are cut into pages of ``page_rows`` so no single
    value (and no single aggregation group) grows with the data. Page ``p``
    holds rows ``p*page_rows .. (p+1)*page_rows - 1`` in ``order_by`` order.
    The first page opens with ``header`` and the last one ends with
    ``footer``, so the pages put one after the other are the document.
    """
    pos = with_ordinal(rows, order_by)
    body = F.expr(f"listagg({row_col}, '') WITHIN GROUP (ORDER BY ordinal)")
    pages = (pos.groupBy(F.expr(f"ordinal div {int(page_rows)}").alias("page_no"))
             .agg(F.count(F.lit(1)).alias("n_rows"), body.alias("_body")))
    last = pos.agg(F.expr(f"max(ordinal) div {int(page_rows)}")).scalar()
    none = F.lit("")
    return pages.select("page_no", "n_rows", F.concat(
        F.when(F.col("page_no") == 0, F.lit(header)).otherwise(none), F.col("_body"),
        F.when(F.col("page_no") == last, F.lit(footer)).otherwise(none)).alias("html"))


def html_cuts(rows: DataFrame, order_by: Sequence[str], header: str, footer: str,
              row_col: str = "row_html", page_bytes: int = CUT_BYTES) -> DataFrame:
    """One HTML document in pages bounded by bytes (A3): ``first_row`` (the
    position of its first row), ``n_rows``, ``html``. In the order of
    ``first_row`` the pages are the document. One shuffle, the sort's."""
    pos = with_ordinal(rows, order_by)
    last = pos.agg(F.max("ordinal")).scalar()
    pages = cut_rows(pos, [row_col], page_bytes)
    none = F.lit("")
    return pages.select("first_row", "n_rows", F.concat(
        F.when(F.col("first_row") == 0, F.lit(header)).otherwise(none), F.col("text"),
        F.when(F.col("first_row") + F.col("n_rows") - 1 == last, F.lit(footer)).otherwise(none))
        .alias("html"))
