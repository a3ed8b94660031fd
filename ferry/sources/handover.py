"""Column-oriented hand-over JSON reader.

Reads ``{"col": {"row label": value}}`` objects -- one per line (chunks
written by ``ferry.sinks.handover``) or one per file (``whole_files=True``,
e.g. a single document a pandas step wrote) -- back into rows.

Narrow: no shuffle. Each object is parsed once; rows are rebuilt by
position inside the object. When the columns list their row labels in the
same order (our writer, a pandas document) positions line up as they are;
otherwise each column's entries are sorted by label first. Every column
must hold the same set of labels -- a table has a value, possibly null,
for every row and column -- else the read fails.

One text too large for one task (the reference hands a table over as a single
string) is read by ``read_column_text``: byte blocks give its entries, which
are put together by label in one shuffle, as a column-oriented text has to be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.json import parse_strict
from ferry.sources.blocks import column_entries


def read_column_json(spark: SparkSession, path: str, schema: T.StructType | str,
                     label: str = "row_label", whole_files: bool = False) -> DataFrame:
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    names = [f.name for f in st.fields]
    txt = spark.read.text(path, wholetext=whole_files)
    parsed = F.from_json("value", "map<string, map<string, string>>", {"mode": "FAILFAST"})
    docs = txt.select(parsed.alias("_m"))

    def entries(c):
        return F.map_entries(F.coalesce(F.try_element_at(F.col("_m"), F.lit(c)),
                                        F.create_map().cast("map<string,string>")))

    def keys(e):
        return F.transform(e, lambda x: x["key"])

    raw = {c: entries(c) for c in names}
    first = keys(raw[names[0]])
    in_order = F.lit(True)
    for c in names[1:]:
        in_order = in_order & (keys(raw[c]) == first)
    cols = {c: F.when(in_order, raw[c]).otherwise(F.array_sort(raw[c])) for c in names}
    labels = keys(cols[names[0]])
    same_set = F.lit(True)
    for c in names[1:]:
        same_set = same_set & (keys(cols[c]) == labels)
    # One zip of whole arrays (a lambda that indexed the column arrays
    # would re-evaluate them per element).
    rows = F.arrays_zip(labels, *[F.transform(cols[c], lambda e: e["value"]) for c in names])
    checked = F.when(same_set, rows).otherwise(
        F.raise_error(F.lit("hand-over JSON: columns hold different row labels")))
    wide = docs.select(F.explode(checked).alias("_r")).select("_r.*").toDF("_label", *names)
    return wide.select(F.col("_label").cast("long").alias(label),
                       *[_typed(F.col(f.name), f.dataType).alias(f.name) for f in st.fields])


def read_column_text(spark: SparkSession, path: str, schema: T.StructType | str,
                     label: str = "row_label", block_bytes: int | None = None) -> DataFrame:
    """The same rows from one large text (or several, with labels of their
    own), read in byte blocks by many tasks. A label that a column lacks or
    repeats fails the query; columns outside the schema are ignored."""
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    names = [f.name for f in st.fields]
    found = column_entries(spark, path, block_bytes).filter(F.col("column").isin(names))
    one = F.map_entries(parse_strict(F.concat(F.lit("{"), F.col("text"), F.lit("}")),
                                     "map<string,string>"))
    entries = found.select("column", F.element_at(one, 1).alias("e")).select(
        "column", F.col("e.key").alias("label"), F.col("e.value").alias("value"))
    wide = entries.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("column").alias("columns"),
        *[F.max(F.when(F.col("column") == n, F.col("value"))).alias(f"c{k}")
          for k, n in enumerate(names)])
    whole = (F.col("n") == len(names)) & (F.col("columns") == len(names))
    key = F.when(whole, F.col("label")).otherwise(F.raise_error(F.concat(
        F.lit("hand-over JSON: columns hold different or repeated row labels: "),
        F.col("label"))))
    return wide.select(key.cast("long").alias(label),
                       *[_typed(F.col(f"c{k}"), f.dataType).alias(f.name)
                         for k, f in enumerate(st.fields)])


def _typed(v, dtype: T.DataType):
    """Cast a value's JSON text to its declared type. Timestamps may also be
    epoch milliseconds (what a pandas step writes by default), read as
    wall-clock time so the session time zone does not shift them."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        from_ms = F.timestamp_add("MILLISECOND", v.cast("long"), epoch)
        return F.when(v.rlike(r"^-?[0-9]+$"), from_ms).otherwise(v.cast("timestamp_ntz")) \
            .cast(dtype)
    if isinstance(dtype, T.IntegralType):
        # An integer column with nulls arrives as floats ("3.0") from pandas;
        # accept integral values, refuse fractions.
        d = v.cast("double")
        as_float = F.when(d == F.floor(d), d.cast(dtype)).otherwise(
            F.raise_error(F.concat(F.lit("not an integer: "), v)))
        return F.when(v.rlike(r"[.eE]"), as_float).otherwise(v.cast(dtype))
    return v.cast(dtype)
