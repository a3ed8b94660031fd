"""Incremental extract: successive runs over growing data equal one full run."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import ferry.operators.incremental as I

SCHEMA = "id LONG, at TIMESTAMP_NTZ, note STRING"


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "id LONG, at STRING, note STRING").withColumn(
        "at", F.col("at").cast("timestamp_ntz"))


T = "2024-01-01 00:00:0{}".format
FIRST = [(1, T(1), "a"), (2, T(2), "b"), (3, T(2), "b"), (None, None, None), (9, None, "n")]
SECOND = FIRST + [(4, T(2), "tie"), (3, T(2), "b"), (5, T(5), "c"), (9, None, "n")]
THIRD = SECOND + [(6, T(5), None), (6, T(5), None), (7, T(7) + ".123456", "d")]


def test_three_runs_equal_one_full_run(spark, tmp_dir):
    folder = f"{tmp_dir}/x"
    for n, rows in enumerate((FIRST, SECOND, THIRD), 1):
        df = frame(spark, rows)
        assert I.extract_new(df, "at", folder) == n
        got = I.extracted(spark, folder, df.schema)
        assert rows_of(got.drop("run")) == rows_of(df)
    assert I.last_mark(spark, folder) == {"run": 3, "mark": T(7) + ".123456"}
    by_run = Counter(r.run for r in got.collect())
    assert by_run == {1: 5, 2: 4, 3: 3}
    assert I.extract_new(df, "at", folder) == 4  # nothing new
    assert Counter(r.run for r in I.extracted(spark, folder, df.schema).collect()) == by_run


def test_replayed_run_is_harmless(spark, tmp_dir, monkeypatch):
    folder = f"{tmp_dir}/x"
    I.extract_new(frame(spark, FIRST), "at", folder)
    df = frame(spark, SECOND)

    def dies(*a):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(I, "_commit", dies)
        with pytest.raises(OSError):
            I.extract_new(df, "at", folder)
    assert rows_of(I.extracted(spark, folder, df.schema).drop("run")) == Counter(
        rows_of(frame(spark, FIRST)))
    third = frame(spark, THIRD)
    assert I.extract_new(third, "at", folder) == 2
    assert rows_of(I.extracted(spark, folder, df.schema).drop("run")) == rows_of(third)


def test_second_writer_of_a_run_fails(spark, tmp_dir):
    folder = f"{tmp_dir}/x"
    I.extract_new(frame(spark, FIRST), "at", folder)
    with pytest.raises(RuntimeError):
        I._commit(spark, folder, 1, {"run": 1, "mark": None})


def test_mark_is_pushed_into_the_scan(spark, tmp_dir):
    folder = f"{tmp_dir}/x"
    frame(spark, FIRST).write.parquet(f"{tmp_dir}/src")
    I.extract_new(spark.read.parquet(f"{tmp_dir}/src"), "at", folder)
    frame(spark, SECOND[5:]).write.mode("append").parquet(f"{tmp_dir}/src")
    new = I.newer_rows(spark.read.parquet(f"{tmp_dir}/src"), "at", folder)
    plan = new._jdf.queryExecution().toString()
    assert "GreaterThan(at,2024-01-01T00:00:02)" in plan
    assert "EqualTo(at,2024-01-01T00:00:02)" in plan


def test_empty_source_and_nulls_only(spark, tmp_dir):
    folder = f"{tmp_dir}/x"
    none = frame(spark, [])
    assert I.extracted(spark, folder, none.schema).collect() == []
    assert I.extract_new(none, "at", folder) == 1
    nulls = frame(spark, [(1, None, "x")])
    I.extract_new(nulls, "at", folder)
    assert I.last_mark(spark, folder)["mark"] is None
    I.extract_new(frame(spark, [(1, None, "x"), (2, T(1), "y")]), "at", folder)
    assert len(I.extracted(spark, folder, none.schema).collect()) == 2
    with pytest.raises(ValueError):
        I.extract_new(none.withColumn("Run", F.lit(1)), "at", folder)
