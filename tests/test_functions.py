"""Scalar functions (X1-X11) and calling conventions."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ferry.functions import (is_object, is_text, join_list, json_lookup, map_lookup,
                             now_local, parse_strict, parse_yyyymmdd, py_str, starts_with)
from ferry.operators.handoff import with_parameters
from ferry.operators.nested import text_leaves
from ferry.operators.project import as_record, first_rows, keep_columns, replace_column
from ferry.session import scratch_path
from ferry.sinks.tables import create_table, insert_select


def test_now_local_is_a_timestamp_without_zone(spark):
    row = spark.range(1).select(now_local().alias("t")).first()
    assert isinstance(row.t, dt.datetime) and row.t.tzinfo is None


def test_parse_yyyymmdd_int_and_text(spark):
    df = spark.createDataFrame([(20240131, "20240229")], "i int, s string")
    r = df.select(parse_yyyymmdd("i").alias("a"), parse_yyyymmdd("s").alias("b")).first()
    assert (r.a, r.b) == (dt.datetime(2024, 1, 31), dt.datetime(2024, 2, 29))


def test_prefix_is_case_sensitive(spark):
    df = spark.createDataFrame([("http://x",), ("HTTP://x",), ("httpfoo",), (None,)], "u string")
    assert [r[0] for r in df.select(starts_with("u", "http")).collect()] == [True, False, True, None]


def test_lookups_with_default(spark):
    df = spark.createDataFrame([('{"a": {"b": 1}}', {"k": "v"})], "j string, m map<string,string>")
    r = df.select(json_lookup("j", "$.a.b").alias("x"), json_lookup("j", "$.z", "dflt").alias("y"),
                  map_lookup("m", "k").alias("p"), map_lookup("m", "q", "").alias("q")).first()
    assert (r.x, r.y, r.p, r.q) == ("1", "dflt", "v", "")


def test_variant_type_tests(spark):
    df = spark.createDataFrame([('{"s": "t", "o": {}, "n": 1}',)], "j string")
    m = df.select(F.explode(parse_strict("j", "map<string,variant>")).alias("k", "v"))
    got = {r.k: (r.t, r.o) for r in m.select("k", is_text("v").alias("t"), is_object("v").alias("o")).collect()}
    assert got == {"s": (True, False), "o": (False, True), "n": (False, False)}


def test_join_list_and_py_str(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([(None, True, 3)], "a string, b boolean, c int")
    r = df.select(join_list(["x@example.com", "y@example.com"]).alias("j"),
                  py_str("a").alias("a"), py_str("b", T.BooleanType()).alias("b"),
                  py_str("c").alias("c")).first()
    assert (r.j, r.a, r.b, r.c) == ("x@example.com, y@example.com", "None", "True", "3")


def test_transform_calling_convention(spark):
    """A step is a DataFrame function; bound arguments via transform."""
    df = spark.createDataFrame([(1, "a", "x")], "id long, t string, z string")
    out = (df.transform(keep_columns, ["t", "id"])
           .transform(replace_column, "t", F.upper("t"))
           .transform(as_record, name="t", key="id"))
    assert out.columns == ["name", "key"] and tuple(out.first()) == ("A", 1)


def test_unordered_and_ordered_limit(spark):
    df = spark.range(0, 1000).repartition(7)
    assert first_rows(df, 1).count() == 1
    assert first_rows(df, 3, order_by=["id"]).collect()[2].id == 2


def test_insert_select_unordered_limit(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    create_table(spark, name, "id BIGINT", scratch_path(spark, "t"))
    insert_select(spark, name, spark.range(0, 50), ["id"], limit=1)
    insert_select(spark, name, spark.range(0, 50), ["id"], order_by=["id"], descending=True, limit=2)
    assert sorted(r.id for r in spark.table(name).collect())[1:] == [48, 49]


def test_bound_parameters(spark):
    df = with_parameters(spark, "SELECT CAST(:ds AS DATE) AS d, :v + 1 AS w",
                         {"ds": "2024-01-10", "v": 2}).first()
    assert (df.d, df.w) == (dt.date(2024, 1, 10), 3)


def test_no_leaves_gives_empty_table_with_schema(spark):
    docs = spark.createDataFrame([(1, '{"s": {"n": 1, "l": ["http://x"]}}')], "doc_id long, doc string")
    out = text_leaves(docs, "doc_id", "doc", root="$.s", key_name="sprite_name",
                      value_name="sprite_url")
    assert out.count() == 0
    assert out.columns == ["doc_id", "leaf_pos", "sprite_name", "sprite_url"]


def test_py_str_timestamps_like_python(spark):
    from pyspark.sql import types as T
    vals = [dt.datetime(2024, 1, 1, 0, 1), dt.datetime(2024, 1, 1, 0, 0, 7, 179500),
            dt.datetime(1969, 12, 31, 23, 59, 59, 5), None]
    df = spark.createDataFrame([(v,) for v in vals], "t timestamp_ntz")
    got = [r[0] for r in df.select(py_str("t", T.TimestampNTZType())).collect()]
    assert got == [str(v) for v in vals]
