"""Plan shape: pushdown, pruning, no single-task window over the data."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_daily_report_prunes_the_scan(spark):
    df = E.queries()["daily_report"](spark, SF_SMALL)
    f = formatted(df)
    assert "ReadSchema: struct<date:int,positive:bigint,death:bigint,hospitalizedCurrently:bigint>" in f


@pytest.mark.parametrize("name", ["daily_report_series", "users_html_doc"])
def test_ordinal_has_no_global_window_over_rows(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    f = formatted(df)
    # Rows come from the range-sorted table written by with_ordinal ...
    assert "/ferry/ordinal-" in f
    # ... and the only window is over one count per partition.
    windows = [ln for ln in f.splitlines() if ln.startswith("Arguments:") and "windowspec" in ln]
    assert windows and all("_ferry_n" in ln for ln in windows)
    assert "ReadSchema: struct<_ferry_pid:int>" in f


def test_first_failure_uses_partial_aggregation(spark):
    df = E.queries()["first_failure"](spark, SF_SMALL)
    p = plan(df)
    assert "partial_min" in p and "Window" not in p


def test_failure_alerts_is_narrow(spark):
    df = E.queries()["failure_alerts"](spark, SF_SMALL)
    assert "Exchange" not in plan(df)


def test_no_driver_side_collection_in_the_library():
    """Operators must not pull rows to the driver."""
    import os
    import re
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "ferry")
    banned = re.compile(r"\.(collect|toPandas|toLocalIterator|localCheckpoint)\(|\.rdd\b")
    hits = []
    for d, _, files in os.walk(root):
        for f in files:
            # The optional subpackage has tests of its own.
            if f.endswith(".py") and os.path.basename(d) != "llm":
                for i, line in enumerate(open(os.path.join(d, f)), 1):
                    if banned.search(line):
                        hits.append(f"{f}:{i}: {line.strip()}")
    assert hits == []


def test_flatten_of_shallow_documents_has_no_shuffle(spark):
    assert "Exchange" not in plan(E.queries()["sprite_urls"](spark, SF_SMALL))


def test_image_audit_opens_manifest_paths_without_a_join(spark):
    p = plan(E.queries()["image_audit"](spark, SF_SMALL))
    assert "Join" not in p and "Exchange" not in p


def test_sort_keys_depend_on_the_row_only(spark):
    f = formatted(E.queries()["daily_report"](spark, SF_SMALL))
    assert "rand(" not in f and "_nondeterministic" not in f


def test_range_count_follows_the_input_size(spark):
    from ferry.operators.ordinal import RANGE_BYTES, range_count
    small = spark.range(10)
    assert range_count(small) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert range_count(spark.range(RANGE_BYTES * 100 // 8)) == 100


def test_table_extent_is_read_from_footers(spark, tmp_dir):
    from ferry.sources.footers import V1, read_table_footers, table_extent

    before = spark.conf.get(V1)
    assert "PushedAggregation: [COUNT(*), COUNT(p_partkey)]" in plan(
        E.queries()["table_extent"](spark, SF_SMALL))
    assert spark.conf.get(V1) == before
    spark.createDataFrame([(3, "a"), (None, "b"), (-7, None)], "k int, s string").repartition(
        3).write.parquet(f"{tmp_dir}/t")
    table = read_table_footers(spark, f"{tmp_dir}/t")
    assert tuple(table_extent(table, "k").first()) == (3, 2)
    assert tuple(table_extent(table, "s").first()) == (3, 2)
    spark.createDataFrame([], "k int").write.parquet(f"{tmp_dir}/e")
    assert tuple(table_extent(read_table_footers(spark, f"{tmp_dir}/e"), "k").first()) == (0, 0)
