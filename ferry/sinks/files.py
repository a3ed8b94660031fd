"""File sinks.

Every writer produces a folder of part files, one per partition, written
in parallel by the executors; the path's scheme (local, ``s3a://``,
``hdfs://``...) picks the file system, so K1 and K2 are the same writer.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.operators.project import quoted
from ferry.sinks.one_file import write_one_file
from ferry.sources.blocks import csv_records

# CSV as a dataframe library writes it: header, no row label, an empty
# field for both NULL and empty text, quotes doubled inside quoted fields,
# white space kept.
CSV_OPTIONS = {
    "header": "true",
    "emptyValue": "",
    "nullValue": "",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _csv_text(df: DataFrame) -> DataFrame:
    """Booleans as ``True``/``False`` and timestamps as ``2024-01-01
    00:00:07.179575`` (fraction only when present, never dropped)."""
    cols = []
    for f in df.schema.fields:
        c = quoted(f.name)
        if isinstance(f.dataType, T.BooleanType):
            c = F.when(c, F.lit("True")).when(~c, F.lit("False")).alias(f.name)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string").alias(f.name)
        cols.append(c)
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> str:
    """Table -> CSV with header, no index (K1 local path, K2 object store)."""
    _csv_text(df).write.mode(mode).options(**{**CSV_OPTIONS, **options}).csv(path)
    return path


def read_csv(spark, path: str, schema, multi_line: bool = True, **options) -> DataFrame:
    """Read back what :func:`write_csv` wrote, with a declared schema.

    A cell may hold line breaks, so a file is read as a whole by one task (the
    writer makes one file per partition); :func:`read_csv_blocks` splits it.
    ``multi_line=False`` splits files, for tables known to hold no line break;
    a broken record then fails.
    """
    return (spark.read.schema(schema).options(**{**CSV_OPTIONS, **options})
            .option("multiLine", multi_line).option("mode", "FAILFAST").csv(path))


def read_csv_blocks(spark, path: str, schema: T.StructType, block_bytes: int | None = None,
                    header: bool = True) -> DataFrame:
    """The same rows, each file read in byte blocks by many tasks, line breaks
    in cells included (quotes inside quoted cells doubled). A first pass over
    the file runs at once."""
    records = csv_records(spark, path, block_bytes)
    if header:
        records = records.filter("start > 0")
    ddl = ", ".join(f"{c} {f.dataType.simpleString()}" for c, f in
                    (("`" + f.name.replace("`", "``") + "`", f) for f in schema.fields))
    options = {**CSV_OPTIONS, "multiLine": "true", "mode": "FAILFAST"}
    options.pop("header")
    return records.select(F.from_csv("text", ddl, options).alias("_r")).select("_r.*")


def write_csv_file(df: DataFrame, path: str, order_by) -> str:
    """Table -> one CSV object at ``path`` (header, no index), rows in the order
    of ``order_by`` (ascending, nulls last): byte-equal to a sequential write,
    written by many tasks (K1, K2, K5)."""
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    text = _csv_text(df)
    buffer = io.StringIO()
    csv.writer(buffer, lineterminator="\n").writerow(df.columns)
    line = F.concat(F.to_csv(F.struct(*[quoted(c) for c in text.columns]), options), F.lit("\n"))
    keyed = df.withColumns({f"_k{n}": quoted(c) for n, c in enumerate(order_by)})
    rows = _csv_text(keyed).withColumn("_line", line)
    return write_one_file(rows, "_line", [f"_k{n}" for n in range(len(order_by))], path,
                          head=buffer.getvalue())


def write_json_records(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Table -> JSON lines, one record per row (K4: the hand-over as records)."""
    df.write.mode(mode).json(path)
    return path


def json_lines(df: DataFrame, keep=(), out: str = "line") -> DataFrame:
    """Each row as one JSON text (K6: one log line per document), NULL columns
    as explicit nulls."""
    return df.select(*[quoted(k) for k in keep],
                     F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(out))


def document_lines(docs: DataFrame, doc: str = "doc", out: str = "line") -> DataFrame:
    """Each whole document (a ``VARIANT``) as one JSON text: every field it
    has, explicit nulls included, and no others."""
    return docs.select(F.to_json(quoted(doc)).alias(out))


def write_lines(df: DataFrame, path: str, column: str = "line", mode: str = "overwrite") -> str:
    df.select(column).write.mode(mode).text(path)
    return path


def write_report_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """A report sheet table -> CSV, replacing the previous report (K5)."""
    return write_csv(df, path, mode=mode)
