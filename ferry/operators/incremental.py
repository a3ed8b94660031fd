"""Incremental extract behind a high-water mark that is kept.

The reference computes ``max(load_datetime)`` and hands it to a step of the
same run. Here the mark outlives the run: each run extracts what is newer than
the last committed mark, writes it, and only then commits the new mark.

A folder per extract holds ``runs/run=<n>`` (rows, Parquet) and ``marks/<n>``
(one small JSON object: the mark and its run). The highest committed number is
the state. A run that dies before its commit leaves a folder without a mark;
the next run has the same number and overwrites it, so a replay neither loses
nor doubles rows. Rows are read back by committed runs only.

Ties. Rows that share the mark's value may arrive after the mark was taken, so
a run reads ``column >= mark`` (pushed to the scan) and takes off the rows that
earlier runs wrote with that very value -- as a multiset, so repeated rows are
rows of their own. Rows whose mark column is null are never above any mark;
they are extracted by the same rule. What the source adds later *below* a
committed mark is not new by this definition and is not seen.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.operators.project import quoted
from ferry.session import _file_system


def _marks(spark: SparkSession, folder: str) -> list[int]:
    fs, path = _file_system(spark, f"{folder}/marks")
    if not fs.exists(path):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(path))
    return sorted(int(n) for n in names if n.isdigit())


def _read_mark(spark: SparkSession, folder: str, run: int) -> dict:
    (row,) = spark.read.text(f"{folder}/marks/{run}", wholetext=True).collect()
    return json.loads(row[0])


def last_mark(spark: SparkSession, folder: str) -> dict | None:
    """``{"run": n, "mark": text or None}`` of the last committed run."""
    runs = _marks(spark, folder)
    return _read_mark(spark, folder, runs[-1]) if runs else None


def _committed(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame | None:
    runs = _marks(spark, folder)
    if not runs:
        return None
    base = f"{folder}/runs"
    full = T.StructType([*schema.fields, T.StructField("run", T.IntegerType())])
    return (spark.read.schema(full).option("basePath", base)
            .parquet(*[f"{base}/run={n}" for n in runs]))


def extracted(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All rows of committed runs, with the ``run`` that wrote each."""
    found = _committed(spark, folder, schema)
    if found is None:
        return spark.createDataFrame([], schema).withColumn("run", F.lit(None).cast("int"))
    return found


def newer_rows(source: DataFrame, column: str, folder: str) -> DataFrame:
    """Rows of ``source`` that no committed run has extracted."""
    spark = source.sparkSession
    state = last_mark(spark, folder)
    if state is None:
        return source
    c = quoted(column)
    if state["mark"] is None:  # so far rows without a value only
        above, at_mark = c.isNotNull(), c.isNull()
    else:
        mark = F.lit(state["mark"]).cast(source.schema[column].dataType)
        above, at_mark = c > mark, (c == mark) | c.isNull()
    before = _committed(spark, folder, source.schema).drop("run")
    ties = source.filter(at_mark).exceptAll(before.filter(at_mark).select(source.columns))
    return source.filter(above).unionByName(ties)


def extract_new(source: DataFrame, column: str, folder: str) -> int:
    """Extract what is new by ``column`` and commit; the number of the run.

    ``source`` needs columns that can be compared (no map or variant); a
    column named ``run`` would clash with the run number and is refused.
    Returns the same number, and writes the same rows, when it is repeated
    after a failure. A run without new rows commits an empty one.
    """
    spark = source.sparkSession
    if "run" in (c.lower() for c in source.columns):
        raise ValueError("the source has a column named run")
    done = _marks(spark, folder)
    run = done[-1] + 1 if done else 1
    seen = Observation()
    rows = newer_rows(source, column, folder).observe(seen, F.max(quoted(column)).alias("mark"))
    # Rows first; an uncommitted attempt of this run is overwritten.
    rows.write.mode("overwrite").parquet(f"{folder}/runs/run={run}")
    kind = source.schema[column].dataType
    highest = [F.lit(seen.get["mark"]).cast(kind).cast("string")]
    if done:
        highest.append(F.lit(_read_mark(spark, folder, done[-1])["mark"]))
    marks = [m.cast(kind) for m in highest]
    top = F.greatest(*marks) if len(marks) > 1 else marks[0]
    (mark,) = spark.range(1).select(top.cast("string")).first()
    _commit(spark, folder, run, {"run": run, "mark": mark})
    return run


def _commit(spark: SparkSession, folder: str, run: int, state: dict) -> None:
    """One small object under a name that is taken once: written aside, then
    renamed, so a reader sees all of it or none."""
    fs, target = _file_system(spark, f"{folder}/marks/{run}")
    _, aside = _file_system(spark, f"{folder}/marks/.{run}-{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    out = fs.create(aside, True)
    try:
        out.write(bytearray(json.dumps(state).encode()))
    finally:
        out.close()
    if fs.exists(target) or not fs.rename(aside, target):
        raise RuntimeError(f"run {run} was committed by another writer")
