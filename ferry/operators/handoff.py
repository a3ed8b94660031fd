"""High-water mark and value hand-over between steps.

In the reference one step computes a scalar and a later step pulls it from
a key-value store. In one Spark plan the scalar is an uncorrelated scalar
subquery: computed once (partial aggregates on every partition, one tiny
merge) and broadcast as a single value to the consuming step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def high_water_mark(df: DataFrame, column: str, alias: str = "high_water_mark") -> DataFrame:
    """``SELECT max(column)`` -- one row (A1). On a JDBC catalog table the
    aggregate is pushed into the database."""
    return df.agg(F.max(column).alias(alias))


def with_high_water_mark(df: DataFrame, column: str,
                         alias: str = "high_water_mark") -> DataFrame:
    """Every row, plus the table's high-water mark as a column.

    ``DataFrame.scalar()`` plans an uncorrelated scalar subquery; no join,
    no collect.
    """
    mark = high_water_mark(df, column, alias).scalar()
    return df.withColumn(alias, mark)


def with_parameters(spark: SparkSession, sql: str, params: dict,
                    **tables: DataFrame) -> DataFrame:
    """Run user SQL with named parameters bound (E3, E4): ``:ds`` etc., and
    DataFrames under the names of ``{table}`` slots.

    Values are bound as typed literals, never spliced into the text.
    """
    return spark.sql(sql, args=params, **tables)
