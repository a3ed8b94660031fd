"""Earliest failure per key on a stream, with corrections.

``first_failure`` sends one notice per key and never looks back, so the notice
can name no run: a run that failed earlier may still land later. Here
``transformWithState`` keeps, per notice key, the earliest failure seen so far
and the number of failures. Every batch that touches a key emits one row with
its state: revision 0 is the notice, a later revision corrects it (an earlier
run arrived, or more failures). The last revision of every key equals the batch
answer for any order of files and any batch size.

A batch is first combined per Arrow batch, so a key that holds a third of all
failures reaches its task as a few rows. Rows go to a Parquet file sink with a
checkpoint, which writes every batch's rows once. ``keep_ms``: state of a key
that has not changed for so long is dropped (a later failure then is a first
one again); by default it is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ferry.operators.alerts import NOTICE_KEYS, failed_runs, notice_columns
from ferry.session import path_exists, ship_package
from ferry.streaming.first_failure import TASK_RUN_SCHEMA

_KEYS = list(NOTICE_KEYS)
_KEY_SCHEMA = "dag_id STRING, task_id STRING, execution_date DATE"
_RUN = "run_id BIGINT, ts TIMESTAMP_NTZ, log_url STRING, n_failures BIGINT"
_OUT = (f"{_KEY_SCHEMA}, run_id BIGINT, first_ts TIMESTAMP_NTZ, log_url STRING, "
        "n_failures BIGINT, revision BIGINT")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The earliest failure and the number of failures of each key of a batch."""
    for rows in batches:
        if rows.empty:
            continue
        ordered = rows.sort_values(["ts", "run_id"], na_position="first", kind="stable")
        groups = ordered.groupby(_KEYS, dropna=False, sort=False)
        first = ordered[groups.cumcount() == 0].copy()
        first["n_failures"] = groups["ts"].transform("size")[first.index]
        yield first[[*_KEYS, "run_id", "ts", "log_url", "n_failures"]]


def _order(run: tuple) -> tuple:
    """Runs by time, then number; a missing value first, as in the batch form."""
    run_id, ts = run[0], run[1]
    return (ts is not None, ts, run_id is not None, run_id)


def _earlier(a: tuple, b: tuple) -> bool:
    for x, y in zip(_order(a), _order(b), strict=True):
        if x is None or y is None or x == y:
            continue
        return x < y
    return False


class EarliestFailure(StatefulProcessor):
    """Per key: earliest run, number of failures, revision."""

    def __init__(self, keep_ms: int | None = None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("earliest", f"{_RUN}, revision BIGINT", self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.state.get() if self.state.exists() else None
        best, count = (tuple(held[:3]), held[3]) if held else (None, 0)
        for r in rows:
            run = (r.run_id, r.ts, r.log_url)
            if best is None or _earlier(run, best):
                best = run
            count += r.n_failures
        revision = held[4] + 1 if held else 0
        self.state.update((*best, count, revision))
        yield Row(**dict(zip(_KEYS, key, strict=True)), run_id=best[0], first_ts=best[1],
                  log_url=best[2], n_failures=count, revision=revision)

    def close(self) -> None:
        pass


def run_failure_state(spark: SparkSession, source: str, out: str, files_per_batch: int = 1000,
                      keep_ms: int | None = None) -> DataFrame:
    """Drain every file now at ``source``; return all revisions so far. Run it
    again when more files have landed: state and offsets are in the checkpoint
    under ``out``."""
    ship_package(spark)
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)  # the only store of typed state
    try:
        runs = (spark.readStream.schema(TASK_RUN_SCHEMA)
                .option("maxFilesPerTrigger", files_per_batch).parquet(source))
        combined = failed_runs(runs).select(*_KEYS, "run_id", "ts", "log_url").mapInPandas(
            _combine, f"{_KEY_SCHEMA}, {_RUN}")
        states = combined.groupBy(*_KEYS).transformWithState(
            EarliestFailure(keep_ms), _OUT, "Append", "ProcessingTime" if keep_ms else "None")
        q = (states.writeStream.format("parquet").outputMode("append")
             .option("path", f"{out}/revisions").option("checkpointLocation", f"{out}/checkpoint")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    finally:
        spark.conf.set(name, before)
    return read_revisions(spark, out)


def read_revisions(spark: SparkSession, out: str) -> DataFrame:
    if not path_exists(spark, f"{out}/revisions"):
        return spark.createDataFrame([], _OUT)
    return spark.read.schema(_OUT).parquet(f"{out}/revisions")


def latest_failures(revisions: DataFrame, style: str = "styled") -> DataFrame:
    """The last revision of every key, as the notice of its earliest run."""
    last = Window.partitionBy(*_KEYS).orderBy(F.desc("revision"))
    rows = (revisions.withColumn("_n", F.row_number().over(last)).filter("_n = 1")
            .drop("_n", "revision"))
    return rows.select("run_id", *_KEYS, "first_ts", "n_failures", *notice_columns(style))
