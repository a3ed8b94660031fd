"""Ordinal, sheets, series, HTML rendering, pages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ferry.operators.ordinal import with_ordinal
from ferry.operators.report import chart_series, html_cuts, html_pages, html_row, sheet_extent, sheet_rows


def test_ordinal_equals_row_number(spark):
    df = spark.range(0, 15_000).select(((F.col("id") * 7919) % 15_000).alias("k"),
                                       F.col("id").alias("v")).repartition(7)
    got = with_ordinal(df, ["k"], num_partitions=5)
    want = df.withColumn("ordinal", F.row_number().over(Window.orderBy("k")) - 1)
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert got.count() == 15_000


def test_ordinal_nulls_last(spark):
    df = spark.createDataFrame([(3,), (None,), (1,)], "k int")
    rows = {r.ordinal: r.k for r in with_ordinal(df, ["k"]).collect()}
    assert rows == {0: 1, 1: 3, 2: None}


def test_sheet_rows_and_anchor(spark):
    df = spark.createDataFrame([(20, "b"), (10, "a")], "id long, title string")
    rows = sorted(sheet_rows(df, ["id"], ["id", "title"], anchor_column="D").collect())
    assert [(r.sheet_row, r.id, r.anchor_cell) for r in rows] == [(2, 10, "D2"), (3, 20, "D3")]


def test_sheet_extent(spark):
    r = spark.range(5).transform(sheet_extent).first()
    assert (r.n_rows, r.last_sheet_row) == (5, 6)


def test_chart_series_keeps_null_points(spark):
    df = spark.createDataFrame([(1, 5, None), (2, 6, 7)], "d int, a long, b long")
    rows = sorted(chart_series(df, ["d"], ["a", "b"]).collect(),
                  key=lambda r: (r.ordinal, r.series))
    assert [(r.ordinal, r.series, r.value) for r in rows] == [
        (0, "a", 5), (0, "b", None), (1, "a", 6), (1, "b", 7)]


def test_html_row_python_style_values(spark):
    df = spark.createDataFrame([("1", None, True, "<b>&"), ("2", 30, False, None)],
                               "_id string, age int, disabled boolean, name string")
    rows = dict(html_row(df, ["_id", "age", "disabled", "name"], keep=["_id"]).collect())
    assert rows["1"] == "<tr><td>1</td><td>None</td><td>True</td><td><b>&</td></tr>"
    assert rows["2"] == "<tr><td>2</td><td>30</td><td>False</td><td>None</td></tr>"
    esc = dict(html_row(df, ["name"], keep=["_id"], escape=True).collect())
    assert esc["1"] == "<tr><td>&lt;b&gt;&amp;</td></tr>"


def test_html_pages_keep_every_row_in_order(spark):
    df = spark.range(0, 250).select(F.format_string("%03d", "id").alias("k"),
                                    F.format_string("<r%d>", "id").alias("row_html"))
    pages = sorted(html_pages(df, ["k"], 100, "<h>", "</h>").collect())
    assert [(p.page_no, p.n_rows) for p in pages] == [(0, 100), (1, 100), (2, 50)]
    # The pages, one after the other, are one document.
    assert "".join(p.html for p in pages) == (
        "<h>" + "".join(f"<r{i}>" for i in range(250)) + "</h>")


def test_payload_ordinal_follows_the_payload(spark, tmp_dir):
    import json
    import os

    from ferry.operators.ordinal import with_payload_ordinal
    from ferry.sources.json_records import payload_positions, read_json_records
    ids = [7, 3, 9, 1, 4, 4, 0]
    for k, part in enumerate((ids[:3], ids[3:5], ids[5:])):
        with open(os.path.join(tmp_dir, f"part-{k}.json"), "w") as f:
            f.write("".join(json.dumps({"id": i}) + "\n" for i in part))
    df = read_json_records(spark, tmp_dir, "id long")
    got = sorted(with_payload_ordinal(payload_positions(df)).collect(), key=lambda r: r.ordinal)
    assert [(r.ordinal, r.id) for r in got] == list(enumerate(ids))


def test_ordinal_spreads_a_hot_key(spark):
    hot = spark.range(0, 20_000).select(F.when(F.col("id") % 3 == 0, F.lit(5))
                                        .otherwise(F.col("id")).alias("k"), "id")
    got = with_ordinal(hot, ["k"], num_partitions=8)
    rows = got.collect()
    assert sorted(r.ordinal for r in rows) == list(range(20_000))
    by_pos = [r.k for r in sorted(rows, key=lambda r: r.ordinal)]
    assert by_pos == sorted(by_pos)
    # the ~6,667 rows of key 5 are spread over several range partitions
    import os
    import pyarrow.parquet as pq
    path = got.inputFiles()[0].removeprefix("file:")
    pids = pq.read_table(os.path.dirname(path), columns=["_ferry_pid"]).column(0).to_pylist()
    sizes = sorted(pids.count(p) for p in set(pids))
    assert len(sizes) == 8 and sizes[-1] < 2 * 20_000 / 8


def test_report_table_and_json_lines_sinks(spark, tmp_dir):
    import os

    from ferry.sinks.files import json_lines, read_csv, write_lines, write_report_table
    df = spark.createDataFrame([(20, "b"), (10, "a")], "id long, title string")
    sheet = sheet_rows(df, ["id"], ["id", "title"], anchor_column="D")
    p = write_report_table(sheet, os.path.join(tmp_dir, "sheet"))
    back = read_csv(spark, p, "sheet_row long, id long, title string, anchor_cell string")
    assert sorted(map(tuple, back.collect())) == [(2, 10, "a", "D2"), (3, 20, "b", "D3")]
    p2 = write_lines(json_lines(df), os.path.join(tmp_dir, "lines"))
    assert sorted(r.value for r in spark.read.text(p2).collect()) == [
        '{"id":10,"title":"a"}', '{"id":20,"title":"b"}']


def test_html_cuts_hold_the_byte_budget(spark):
    df = spark.range(0, 300).select(
        F.format_string("%03d", "id").alias("k"),
        F.concat(F.format_string("<r%d>", "id"), F.expr("repeat('é', id * 40 % 10000)"))
        .alias("row_html"))  # rows of up to 20 KB
    want = "<h>" + "".join(r.row_html for r in df.orderBy("k").collect()) + "</h>"
    pages = sorted(html_cuts(df.repartition(6), ["k"], "<h>", "</h>", page_bytes=50_000).collect())
    assert "".join(p.html for p in pages) == want
    assert max(len(p.html.encode()) for p in pages) <= 50_000 + len("<h></h>")
    assert sum(p.n_rows for p in pages) == 300 and len(pages) < 120
    small = html_cuts(df, ["k"], "", "", page_bytes=10).collect()
    assert len(small) == 300  # a row beyond the budget stands alone


def test_cuts_need_one_shuffle(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("k"), F.col("id").cast("string")
                                     .alias("row_html"))
    plan = html_cuts(df, ["k"], "", "")._jdf.queryExecution().executedPlan().toString()
    # What is still dealt are counts per written part, never rows.
    dealt = [x for x in plan.splitlines() if "partitioning(" in x and "_ferry_pid" not in x]
    assert dealt == []


def test_hand_over_chunks_hold_the_byte_budget(spark, tmp_dir):
    from ferry.sinks.handover import column_json_chunks, write_column_json
    from ferry.sources.handover import read_column_json

    df = spark.range(0, 200).select(F.col("id"), F.repeat(F.lit('x"é'), (F.col("id") % 50 * 100).cast("int")).alias("t"),
                                    F.when(F.col("id") % 3 > 0, F.col("id") / 4).alias("d"))
    values = [r.value for r in column_json_chunks(df, ["id"], chunk_bytes=60_000).collect()]
    assert len(values) > 10 and max(len(v.encode()) for v in values) <= 60_000 + 100
    path = write_column_json(df, f"{tmp_dir}/h", ["id"], chunk_bytes=60_000)
    back = read_column_json(spark, path, df.schema)
    assert sorted(map(tuple, back.drop("row_label").collect()), key=lambda r: r[0]) == sorted(
        map(tuple, df.collect()), key=lambda r: r[0])
