"""Row counts of a Parquet table from its file footers.

Spark pushes aggregates into a Parquet scan of its newer (v2) reader only: one
footer is read per file, no row. ``read_table_footers`` loads a table through
that reader; a count over it without filters then shows ``PushedAggregation``
in its plan. The high-water mark is not taken from footers: Spark does not push
the extremes of timestamps, and a pushed minimum or maximum of numbers fails on
a file that holds nothing but nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

V1 = "spark.sql.sources.useV1SourceList"
PUSH = "spark.sql.parquet.aggregatePushdown"


def read_table_footers(spark: SparkSession, path: str) -> DataFrame:
    """The table through the v2 reader; the session's settings stay as they
    are, but for ``PUSH``, which changes plans and no result."""
    before = spark.conf.get(V1)
    spark.conf.set(V1, ",".join(x for x in before.split(",") if x.strip() != "parquet"))
    try:
        table = spark.read.parquet(path)
    finally:
        spark.conf.set(V1, before)
    spark.conf.set(PUSH, "true")
    return table


def table_extent(table: DataFrame, column: str) -> DataFrame:
    """``n_rows`` and ``n_values`` (rows with a value in ``column``): one row."""
    # The pushed counts of a table without row groups add up to null, which the
    # optimizer, for which counts have a value, would not let ``coalesce`` see.
    count = lambda c, name: F.greatest(F.count(c), F.lit(0)).alias(name)
    return table.agg(count(F.lit(1), "n_rows"), count(column, "n_values"))
