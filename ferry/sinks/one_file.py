"""One ordered object written by many tasks.

The reference writes a report, a CSV or an HTML document under the name it was
asked for. A Spark writer leaves a folder of parts instead. Here

1. rows are range-partitioned and sorted, each task writes its texts to a part
   of its own and reports ``(partition, path, bytes)``: one small row a part;
2. a running sum over those rows gives every part's offset;
3. on a mounted file system (a local or shared path) a file of the final size
   is made under a temporary name, each task copies its part to its offset,
   and the file is renamed to its name; a store without random writes gets the
   parts one after the other through one task that holds one buffer.

Readers see the old object or the whole new one. Parts have names of their
own, so a retried task leaves a part that nothing reads; copying twice writes
the same bytes to the same place.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.operators.project import quoted, tie_breakers
from ferry.session import _file_system, scratch_path, ship_package

BUFFER = 8 << 20
_PART = "part int, path string, bytes long, pieces long"


def _part_writer(folder: str):
    schema = pa.schema([("part", pa.int32()), ("path", pa.string()), ("bytes", pa.int64()),
                        ("pieces", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from ferry.sources.assets import file_system

        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
        files, path = file_system(name)
        out, size, pieces = None, 0, 0
        for batch in batches:
            for text in batch.column(0):
                if out is None:
                    files.create_dir(os.path.dirname(path), recursive=True)
                    out = files.open_output_stream(path, buffer_size=BUFFER)
                size += out.write(text.as_py().encode())
                pieces += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [name], "bytes": [size],
                                              "pieces": [pieces]}, schema=schema)
    return write


def _copy(source: str, out) -> int:
    from ferry.sources.assets import file_system

    files, path = file_system(source)
    size = 0
    with files.open_input_stream(path) as f:
        while data := f.read(BUFFER):
            out.write(data)
            size += len(data)
    return size


def _place(target: str):
    """Copy each part to its offset in the file at ``target``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open(target, "r+b") as out:
                    out.seek(row["at"])
                    if _copy(row["path"], out) != row["bytes"]:
                        raise OSError(f"part changed while it was copied: {row['path']}")
                    out.flush()
                    os.fsync(out.fileno())
                yield pa.RecordBatch.from_pydict({"n": pa.array([row["bytes"]], pa.int64())})
    return run


def _stream(target: str, head: bytes, tail: bytes):
    """All parts in order to a store that only appends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ferry.sources.assets import file_system

        files, path = file_system(target)
        files.create_dir(os.path.dirname(path), recursive=True)
        n = 0
        with files.open_output_stream(path, buffer_size=BUFFER) as out:
            out.write(head)
            for batch in batches:
                for source in batch.column(0):
                    n += _copy(source.as_py(), out)
            out.write(tail)
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})
    return run


def _mounted(path: str) -> str | None:
    """The plain path of a mounted file system, None for any other store."""
    if "://" not in path:
        return path.removeprefix("file:")
    return path.removeprefix("file://") if path.startswith("file://") else None


def write_one_file(df: DataFrame, column: str, order_by: Sequence[str], path: str,
                   head: str = "", tail: str = "", empty: str | None = None,
                   random_writes: bool = True) -> str:
    """``head``, the texts of ``column`` in the order of ``order_by`` (ascending,
    nulls last; ties by the row), ``tail`` as one object at ``path``. ``empty``:
    the whole content if there is no row. ``random_writes=False`` appends the
    parts through one task even on a mounted path."""
    spark = df.sparkSession
    ship_package(spark)
    keys = [quoted(c).asc_nulls_last() for c in order_by] + tie_breakers(df)
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys).select(quoted(column))
    manifest = scratch_path(spark, "one-file")
    (rows.mapInArrow(_part_writer(scratch_path(spark, "parts")), _PART)
     .write.parquet(manifest))
    parts = spark.read.schema(_PART).parquet(manifest)
    # One row per part, so one task holds them.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    n, total = parts.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    first, last = head.encode(), tail.encode()
    if not n and empty is not None:
        first, last = empty.encode(), b""
    plain = _mounted(path) if random_writes else None
    temporary = f"{os.path.dirname(path.rstrip('/'))}/.{uuid.uuid4().hex}.tmp"
    if plain:
        os.makedirs(os.path.dirname(plain), exist_ok=True)
        with open(_mounted(temporary), "wb") as out:
            out.write(first)
            out.truncate(len(first) + total)
            out.seek(0, os.SEEK_END)
            out.write(last)
        placed = parts.withColumn("at", F.coalesce(F.sum("bytes").over(ahead), F.lit(0))
                                  + len(first)).repartition(max(1, n), "part")
        copied = placed.mapInArrow(_place(_mounted(temporary)), "n long")
    else:
        copied = (parts.repartition(1).sortWithinPartitions("part").select("path")
                  .mapInArrow(_stream(temporary, first, last), "n long"))
    done = copied.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if done != total:
        raise OSError(f"{done} of {total} bytes reached {path}")
    files, source = _file_system(spark, temporary)
    _, target = _file_system(spark, path)
    if files.exists(target):
        files.delete(target, False)
    if not files.rename(source, target):
        raise OSError(f"could not rename {temporary} to {path}")
    return path
