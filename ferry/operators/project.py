"""Projection, computed columns and ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.dates import parse_yyyymmdd


def quoted(name: str) -> Column:
    """A top-level column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def keep_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep the named columns in the given order.

    A missing column fails analysis (``AnalysisException``), as indexing a
    missing column fails in the reference. Pruning reaches the scan.
    """
    return df.select(*[quoted(c) for c in cols])


def replace_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Replace ``name`` by a computed column, keeping its position."""
    return df.withColumn(name, expr)


def parse_date_column(df: DataFrame, name: str, strict: bool = True) -> DataFrame:
    """``yyyyMMdd`` int/text column -> ``timestamp_ntz`` in place (P2 + X1)."""
    return replace_column(df, name, parse_yyyymmdd(name, strict))


def as_record(df: DataFrame, **fields) -> DataFrame:
    """Build output records from named expressions, e.g. key/value -> name/url."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k)
                       for k, v in fields.items()])


def sort_nulls_last(df: DataFrame, *cols: str) -> DataFrame:
    """Ascending global sort with NULLs last (O1).

    Spark's default puts NULLs first; the reference's sort puts them last.
    The sort is a range-partitioned shuffle: it scales, but keep it as the
    last step before a writer, since later steps may reshuffle. Rows that tie
    are ordered by a hash of all their columns and then by the columns, so the
    order is the same on every run and a key that holds a large share of the
    rows is still split over many ranges.
    """
    return df.orderBy(*[quoted(c).asc_nulls_last() for c in cols], *tie_breakers(df))


def tie_breakers(df: DataFrame) -> list[Column]:
    """Sort keys that depend on nothing but the row: a hash of all columns,
    then every column that can be sorted."""
    texts = [F.to_json(F.struct(quoted(f.name))) if _unsortable(f.dataType) else quoted(f.name)
             for f in df.schema.fields]
    return [F.xxhash64(*texts), *texts] if texts else []


def _unsortable(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _unsortable(t.elementType)
    if isinstance(t, T.StructType):
        return any(_unsortable(f.dataType) for f in t.fields)
    return isinstance(t, (T.MapType, T.VariantType))


def first_rows(df: DataFrame, n: int, order_by: Sequence[str] | None = None) -> DataFrame:
    """``LIMIT n`` (O2). With a key it is a per-partition top-n then a merge."""
    if order_by:
        df = df.orderBy(*[F.asc_nulls_last(c) for c in order_by])
    return df.limit(n)
