"""Landed JSON payloads and exported document collections.

Always read with a declared schema: no inference pass over the data, a
stable result type, and a field that a document lacks reads as NULL
(``read_required`` fails where no document has it).
``FAILFAST`` makes a malformed record fail the job, as the reference's step
fails when the payload cannot be parsed.

Two layouts:

* JSON lines (one record per line) -- splittable, the layout to land
  large payloads in;
* JSON arrays (``array=True``, one array of records per file, what an
  HTTP API returns) -- each file is parsed whole by one task. A huge one is
  read in blocks by many tasks with ``read_json_array``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.json import parse_strict
from ferry.operators.project import keep_columns, quoted
from ferry.session import scratch_path
from ferry.sources.blocks import array_elements
from ferry.sources.json_http import check_present


def read_json_records(spark: SparkSession, path, schema: T.StructType | str,
                      array: bool = False, strict: bool = True,
                      fmt: str = "json", **options) -> DataFrame:
    """JSON records at ``path`` (file, folder or glob) as a DataFrame.

    ``fmt`` lets a document-store connector take the place of landed files
    (e.g. ``fmt="mongodb"`` when that connector's jar is on the classpath);
    its options are passed through.
    """
    reader = spark.read.format(fmt).schema(schema)
    if fmt == "json":
        reader = (reader.option("multiLine", array)
                  .option("mode", "FAILFAST" if strict else "PERMISSIVE"))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def read_required(spark: SparkSession, path, schema: T.StructType | str,
                  required: Sequence[str], array: bool = False) -> DataFrame:
    """The ``required`` columns of landed JSON records, in that order; one that
    no record has fails the read (P1).

    The records are read once: values are counted while the rows are written
    to the shared folder, and what is returned reads the written table. Only a
    column without any value is looked for again, by its key, as explicit
    nulls are present.
    """
    seen = Observation()
    rows = keep_columns(read_json_records(spark, path, schema, array=array), required)
    landed = scratch_path(spark, "records")
    (rows.observe(seen, F.count(F.lit(1)).alias("n"),
                  *[F.count(quoted(c)).alias(f"c{k}") for k, c in enumerate(required)])
     .write.parquet(landed))
    counts = seen.get
    bare = [c for k, c in enumerate(required) if counts["n"] and not counts[f"c{k}"]]
    if bare:
        text = spark.read.text(path, wholetext=array)
        record = F.explode(parse_strict("value", "array<string>")) if array else F.col("value")
        check_present(text.select(record.alias("value")), "value", bare)
    return spark.read.schema(rows.schema).parquet(landed)


def read_json_array(spark: SparkSession, path, schema: T.StructType | str,
                    block_bytes: int | None = None, positions: bool = False) -> DataFrame:
    """JSON array files (S1), each read in byte blocks by many tasks; the same
    rows as ``read_json_records(array=True)``. Malformed text fails the query.
    A first pass over the file runs at once. ``positions``: also the columns of
    :func:`payload_positions`."""
    found = array_elements(spark, path, block_bytes)
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    where = [F.col("path").alias("_file"), F.col("block").alias("_block"),
             F.col("number").alias("_mid")] if positions else []
    return found.select(parse_strict("text", ddl).alias("_r"), *where).select(
        "_r.*", *(["_file", "_block", "_mid"] if positions else []))


def read_documents(spark: SparkSession, path, schema: T.StructType | str,
                   **options) -> DataFrame:
    """Full scan of an exported document collection, match-all filter (S5,
    F5), as the declared fields. ``read_whole_documents`` keeps every field."""
    return read_json_records(spark, path, schema, array=False, **options)


def read_whole_documents(spark: SparkSession, path, out: str = "doc") -> DataFrame:
    """Every document of a JSON-lines export as one ``VARIANT`` value: all
    fields, declared or not, explicit nulls included (S5). Malformed text
    fails the query."""
    text = spark.read.text(path).where(F.trim("value") != "")
    return text.select(F.parse_json("value").alias(out))


def payload_positions(df: DataFrame) -> DataFrame:
    """A scan of landed JSON lines plus where each record stood: ``_file``,
    ``_block`` (start of the read block) and ``_mid`` (ascending inside it).
    Take it before any shuffle; ``operators.ordinal.with_payload_ordinal``
    turns it into positions."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_mid"))
