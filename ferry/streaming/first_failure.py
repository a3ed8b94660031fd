"""First-failure notices on a stream of task runs.

``readStream`` over landed run files, ``foreachBatch``: each micro-batch is
reduced to its notice keys (map-side, so a hot key costs one row per task),
keys already notified are dropped by an anti-join, and the rest are written.

A notice goes out when the first failure of a key *arrives*; which run that is
depends on the order in which files land, so a notice holds the key and the
subject and nothing of the run. The set of notices is then the same for any
arrival order and any batch size, and nothing is ever dropped as late.

State is the notices table itself, in the shared folder, partitioned by
execution date. A batch reads the folders of its own dates only and writes one
file into each of them, named by the batch; a replayed batch ignores what it
wrote before and writes the same rows again. ``compact_notices`` merges the
files of dates that have gathered many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.operators.alerts import NOTICE_KEYS, failed_runs, notice_columns
from ferry.session import path_exists, scratch_path

TASK_RUN_SCHEMA = ("run_id BIGINT, ts TIMESTAMP_NTZ, dag_id STRING, task_id STRING, "
                   "execution_date DATE, state STRING, log_url STRING")
NOTICE_SCHEMA = ("dag_id STRING, task_id STRING, subject STRING, recipients STRING, "
                 "execution_date DATE, batch_id BIGINT")


def read_notices(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], NOTICE_SCHEMA)
    return spark.read.schema(NOTICE_SCHEMA).parquet(path)


def _notify_batch(path: str):
    keys = list(NOTICE_KEYS)

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        firsts = failed_runs(batch).select(*keys).distinct().persist()
        try:
            # The dates of one batch: as many as the days it spans.
            row = firsts.agg(F.collect_set("execution_date").alias("dates"),
                             F.count_if(F.col("execution_date").isNull()).alias("nulls")).first()
            dates = [*row.dates, *[None] * bool(row.nulls)]
            folders = [f for f in (_folder(path, d) for d in dates) if path_exists(spark, f)]
            new = firsts
            if folders:
                done = (spark.read.schema(NOTICE_SCHEMA).option("basePath", path)
                        .parquet(*folders).where(F.col("batch_id") != batch_id).select(*keys))
                new = firsts.join(done, [firsts[k].eqNullSafe(done[k]) for k in keys],
                                  "left_anti")
            subject, _, recipients = notice_columns("styled")
            (new.select(*keys, subject, recipients, F.lit(batch_id).cast("long").alias("batch_id"))
             .repartition("execution_date")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("execution_date", "batch_id").parquet(path))
        finally:
            firsts.unpersist()
    return process


def _folder(path: str, date) -> str:
    return f"{path}/execution_date={date if date is not None else '__HIVE_DEFAULT_PARTITION__'}"


def compact_notices(spark: SparkSession, path: str, dates, before_batch: int) -> None:
    """Merge the files of the given dates into one each. Run it between
    batches; ``before_batch`` is the id of the next one, and merged rows carry
    the id before it, so that no replay of theirs is expected any more."""
    folders = [f for f in (_folder(path, d) for d in dates) if path_exists(spark, f)]
    if not folders:
        return
    held = scratch_path(spark, "notices-merge")
    (spark.read.schema(NOTICE_SCHEMA).option("basePath", path).parquet(*folders)
     .withColumn("batch_id", F.lit(before_batch - 1).cast("long")).distinct()
     .write.parquet(held))
    # The merged copy stands in the shared folder before anything is replaced.
    merged = spark.read.schema(NOTICE_SCHEMA).parquet(held)
    old = [f"{f}/batch_id={b}" for f, b in _batches(spark, path, folders) if b != before_batch - 1]
    (merged.repartition("execution_date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("execution_date", "batch_id").parquet(path))
    from ferry.session import delete_path

    for f in old:
        delete_path(spark, f)


def _batches(spark: SparkSession, path: str, folders: list[str]) -> list[tuple[str, int]]:
    row = (spark.read.schema(NOTICE_SCHEMA).option("basePath", path).parquet(*folders)
           .agg(F.collect_set(F.struct("execution_date", "batch_id")).alias("x")).first())
    return [(_folder(path, r.execution_date), r.batch_id) for r in row.x]


def run_first_failure_batches(spark: SparkSession, source: str, out: str,
                              files_per_batch: int = 1000) -> DataFrame:
    """Drain every file now at ``source``; one notice per key, ever; return
    the notices as a batch DataFrame. ``files_per_batch`` bounds a batch and
    changes nothing else."""
    runs = (spark.readStream.schema(TASK_RUN_SCHEMA)
            .option("maxFilesPerTrigger", files_per_batch).parquet(source))
    q = (runs.writeStream.foreachBatch(_notify_batch(f"{out}/data"))
         .option("checkpointLocation", f"{out}/checkpoint")
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return read_notices(spark, f"{out}/data")
