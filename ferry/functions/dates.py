"""Date functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferry.functions.cols import as_col


def parse_yyyymmdd(c, strict: bool = True) -> Column:
    """An int or text ``yyyyMMdd`` value -> ``timestamp_ntz``.

    Strict (default): a value that does not parse fails the query, the way
    the reference's step fails. ``strict=False`` gives NULL instead.
    """
    txt = as_col(c).cast("string")
    fmt = F.lit("yyyyMMdd")
    if strict:
        return F.to_timestamp_ntz(txt, fmt)
    return F.try_to_timestamp(txt, fmt).cast("timestamp_ntz")


def now_local() -> Column:
    """Current wall-clock time without zone."""
    return F.localtimestamp()
