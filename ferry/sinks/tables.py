"""Table sinks: append a query result to a table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def create_table(spark: SparkSession, name: str, ddl: str, location: str,
                 fmt: str = "parquet") -> str:
    """A catalog table at an explicit (shared) location."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING {fmt} LOCATION '{location}'")
    return name


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def insert_select(spark: SparkSession, target: str, source: DataFrame,
                  columns: Sequence[str], order_by: Sequence[str] = (),
                  limit: int | None = None, descending: bool = False) -> None:
    """``INSERT INTO target SELECT columns FROM source [ORDER BY ..] [LIMIT n]``.

    With ``limit`` and a key, Spark plans a per-partition top-n and a
    single small merge (``TakeOrderedAndProject``); without a key the
    limit is unordered (``CollectLimit``), as in the reference's SQL.
    """
    view = f"_ferry_src_{uuid.uuid4().hex[:8]}"
    source.createOrReplaceTempView(view)
    try:
        sql = f"INSERT INTO {target} SELECT {', '.join(map(_name, columns))} FROM {view}"
        if order_by:
            way = " DESC" if descending else ""
            sql += f" ORDER BY {', '.join(_name(c) + way for c in order_by)}"
        if limit is not None:
            sql += f" LIMIT {int(limit)}"
        spark.sql(sql)
    finally:
        spark.catalog.dropTempView(view)
