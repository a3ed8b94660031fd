"""Global row position without a single-task window.

``row_number() OVER (ORDER BY k)`` has no partition key, so Spark moves
every row into one task. Instead:

1. range-partition on the key and sort within partitions (one shuffle);
2. tag each row with its partition id and in-partition position
   (``monotonically_increasing_id`` = partition id << 33 | row index) and
   write the tagged rows once as a Parquet table in the shared folder;
3. count rows per partition -- one row per partition, so its size is
   bounded by the partition count, not the data -- and turn the counts
   into start offsets;
4. broadcast the offsets (bounded as above) and add them.

Writing the tagged rows (rather than caching them) means both later steps
read the same rows, a lost executor re-reads files instead of recomputing
the sort, and nothing stays pinned in executor memory after the query.
Rows with equal keys are ordered by a hash of all their columns and then by
the columns: the same order on every run, also when a lost task is repeated,
and a key that holds a third of all rows is still spread over many ranges.
The number of ranges follows the size of the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.operators.project import quoted, tie_breakers
from ferry.session import scratch_path

_PID, _MID, _OFF, _N = "_ferry_pid", "_ferry_mid", "_ferry_off", "_ferry_n"
RANGE_BYTES = 128 << 20


def range_count(df: DataFrame) -> int:
    """Ranges of about ``RANGE_BYTES`` by the optimizer's estimate of ``df``,
    and at least the session's shuffle partitions (AQE merges small ones)."""
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A join of unknown size is estimated as a product; such a guess is no size.
    return max(least, -(-size // RANGE_BYTES)) if size < 1 << 57 else least


def with_ordinal(df: DataFrame, order_by: Sequence[str], name: str = "ordinal",
                 num_partitions: int | None = None) -> DataFrame:
    """Add ``name``: the 0-based position of each row in ``order_by`` order
    (ascending, nulls last). Runs the sort eagerly (one write job)."""
    keys = [quoted(c).asc_nulls_last() for c in order_by] + tie_breakers(df)
    # Without an explicit count AQE may merge adjacent ranges to its target
    # size; ids are taken after that, so offsets stay consistent.
    n = num_partitions or range_count(df)
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *keys) if num_partitions or n > least
              else df.repartitionByRange(*keys))
    tagged = _tagged(ranged.sortWithinPartitions(*keys))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
               .select(_PID, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF)))
    in_part = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    return (tagged.join(F.broadcast(offsets), _PID)
            .select(*[quoted(c) for c in df.columns],
                    (F.col(_OFF) + in_part).alias(name)))


def _tagged(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, "ordinal")
    (df.withColumn(_PID, F.spark_partition_id())
     .withColumn(_MID, F.monotonically_increasing_id()).write.parquet(path))
    return spark.read.parquet(path)


def with_payload_ordinal(positioned: DataFrame, name: str = "ordinal") -> DataFrame:
    """Add ``name``: the 0-based position of each record in the landed payload
    -- files by path, records as they stand in them -- from
    ``sources.json_records.payload_positions``. No sort: the rows are written
    once as scanned, and each read block gets its offset. That
    table has one row per block, so it grows with the payload: it is written
    before the join, and Spark broadcasts it only while its size is below the
    session's threshold."""
    spark = positioned.sparkSession
    path = scratch_path(spark, "payload")
    positioned.write.parquet(path)
    rows = spark.read.parquet(path)
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    (rows.groupBy("_file", "_block")
     .agg(F.count(F.lit(1)).alias(_N), F.min("_mid").alias("_first"))
     .select("_file", "_block", "_first",
             F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF))
     .write.parquet(f"{path}-offsets"))
    offsets = spark.read.parquet(f"{path}-offsets")
    keep = [c for c in positioned.columns if c not in ("_file", "_block", "_mid")]
    return (rows.join(offsets, ["_file", "_block"])
            .select(*[quoted(c) for c in keep],
                    (F.col(_OFF) + F.col("_mid") - F.col("_first")).alias(name)))
