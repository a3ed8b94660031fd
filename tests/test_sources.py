"""Sources and sinks: JSON layouts, strictness, CSV quirks, hand-over, HTTP."""

from __future__ import annotations

import json
import os

import pandas as pd
import pytest
from pyspark.errors import AnalysisException

from ferry.operators.project import keep_columns, parse_date_column, sort_nulls_last
from ferry.sinks.files import read_csv, write_csv, write_json_records
from ferry.sinks.handover import write_column_json
from ferry.sources.handover import read_column_json
from ferry.sources.json_http import read_json_http
from ferry.sources.json_records import read_json_records

SCHEMA = "date INT, positive BIGINT, death BIGINT"


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_json_array_payload_sorted_nulls_last(spark, tmp_dir):
    recs = [{"date": 20200103, "positive": 3}, {"date": None, "positive": 1},
            {"date": 20200101, "positive": 2, "death": 7, "extra": "x"}]
    p = _write(os.path.join(tmp_dir, "page1.json"), json.dumps(recs))
    df = read_json_records(spark, p, SCHEMA, array=True)
    out = (df.transform(keep_columns, ["date", "positive", "death"])
           .transform(parse_date_column, "date").transform(sort_nulls_last, "date").collect())
    assert [r.positive for r in out] == [2, 3, 1]
    assert out[0].date.isoformat() == "2020-01-01T00:00:00"
    assert out[1].death is None and out[2].date is None


def test_missing_column_is_an_error(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "a.json"), '{"date": 20200101}\n')
    with pytest.raises(AnalysisException):
        read_json_records(spark, p, "date INT").transform(keep_columns, ["date", "positive"])


def test_bad_date_fails_the_query(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "a.json"), '{"date": 20201399}\n')
    with pytest.raises(Exception):
        read_json_records(spark, p, "date INT").transform(parse_date_column, "date").collect()
    tolerant = read_json_records(spark, p, "date INT").transform(
        parse_date_column, "date", strict=False).first()
    assert tolerant.date is None


def test_malformed_payload_fails(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "a.json"), '{"date": 2020\n')
    with pytest.raises(Exception):
        read_json_records(spark, p, "date INT").collect()


def test_csv_like_a_spreadsheet_writer(spark, tmp_dir):
    df = spark.createDataFrame([(1, None, 'q"x'), (2, "", "plain")], "a int, b string, c string")
    path = write_csv(df.coalesce(1), os.path.join(tmp_dir, "out"))
    text = "".join(open(os.path.join(path, f)).read()
                   for f in sorted(os.listdir(path)) if f.endswith(".csv"))
    assert text.splitlines() == ["a,b,c", '1,,"q""x"', "2,,plain"]
    back = read_csv(spark, path, "a int, b string, c string").orderBy("a").collect()
    assert back[0].c == 'q"x'


def test_handover_reads_a_pandas_style_document(spark, tmp_dir):
    pdf = pd.DataFrame({"id": [1, 2], "title": ["a", None]})
    p = _write(os.path.join(tmp_dir, "h.json"), pdf.to_json())
    back = read_column_json(spark, p, "id BIGINT, title STRING", whole_files=True)
    assert sorted(map(tuple, back.collect())) == [(0, 1, "a"), (1, 2, None)]


def test_handover_chunks_roundtrip(spark, tmp_dir):
    df = spark.range(0, 1000).selectExpr("id", "cast(id * 2 as string) AS t")
    p = write_column_json(df, os.path.join(tmp_dir, "chunks"), ["id"], chunk_rows=64)
    back = read_column_json(spark, p, "id BIGINT, t STRING")
    assert back.count() == 1000
    assert back.where("row_label != id OR t != cast(id * 2 as string)").count() == 0


def test_json_records_sink(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "id long, t string")
    p = write_json_records(df, os.path.join(tmp_dir, "recs"))
    assert read_json_records(spark, p, "id long, t string").collect()[0].t == "a"


def test_json_http_source_on_file_urls(spark, tmp_dir):
    p1 = _write(os.path.join(tmp_dir, "p1.json"), json.dumps([{"id": 1, "t": "a"}, {"id": 2}]))
    p2 = _write(os.path.join(tmp_dir, "p2.json"), json.dumps([{"id": 3, "t": "c"}]))
    urls = [f"file://{p1}", f"file://{p2}"]
    df = read_json_http(spark, urls, "id BIGINT, t STRING", keep_source=True)
    rows = sorted((r.id, r.t) for r in df.collect())
    assert rows == [(1, "a"), (2, None), (3, "c")]
    grouped = read_json_http(spark, urls, "id BIGINT, t STRING", urls_per_partition=2)
    assert grouped.count() == 3
    doc = _write(os.path.join(tmp_dir, "d.json"), json.dumps({"sprites": {"a": "http://x"}}))
    one = read_json_http(spark, [f"file://{doc}"], "sprites map<string,string>", layout="document")
    assert one.first().sprites == {"a": "http://x"}


def test_json_http_missing_url_fails(spark, tmp_dir):
    with pytest.raises(Exception):
        read_json_http(spark, [f"file://{tmp_dir}/nope.json"], "id BIGINT").collect()


def test_handover_reordered_labels(spark, tmp_dir):
    doc = '{"id": {"0": 1, "1": 2}, "t": {"1": "b", "0": "a"}}\n{"id": {"5": 9}, "t": {"5": "z"}}\n'
    p = _write(os.path.join(tmp_dir, "m.json"), doc)
    back = read_column_json(spark, p, "id BIGINT, t STRING")
    assert sorted(map(tuple, back.collect())) == [(0, 1, "a"), (1, 2, "b"), (5, 9, "z")]


def test_handover_different_label_sets_fail(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "bad.json"), '{"id": {"0": 1, "1": 2}, "t": {"0": "a"}}\n')
    with pytest.raises(Exception):
        read_column_json(spark, p, "id BIGINT, t STRING").collect()


def test_jdbc_mod_split_covers_every_row(spark):
    import uuid as _uuid

    from ferry.sources.jdbc import read_table, write_table
    url = f"jdbc:derby:memory:t{_uuid.uuid4().hex[:8]};create=true"
    df = spark.createDataFrame([(k, f"v{k}") for k in [-7, -1, 0, 3, 5, 5, 5, 5, 12]]
                               + [(None, "null")], "k bigint, v string")
    write_table(df, url, "T", mode="overwrite")
    back = read_table(spark, url, "T", partition_column="k", num_partitions=4, split="mod")
    assert back.rdd.getNumPartitions() == 4
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    ranged = read_table(spark, url, "T", partition_column="k", num_partitions=3)
    assert sorted(ranged.collect(), key=str) == sorted(df.collect(), key=str)


def test_json_from_url_column(spark, tmp_dir):
    from ferry.sources.json_http import read_json_from_urls
    p1 = _write(os.path.join(tmp_dir, "a.json"), json.dumps([{"id": 1}, {"id": 2}]))
    p2 = _write(os.path.join(tmp_dir, "b.json"), json.dumps([{"id": 3}]))
    urls = spark.createDataFrame([(f"file://{p1}",), (f"file://{p2}",)], "u string")
    got = sorted(r.id for r in read_json_from_urls(urls, "u", "struct<id:bigint>").collect())
    assert got == [1, 2, 3]
    bad = spark.createDataFrame([(f"file://{tmp_dir}/none.json",)], "u string")
    with pytest.raises(Exception):
        read_json_from_urls(bad, "u", "struct<id:bigint>").collect()


def test_csv_booleans_and_timestamps_like_pandas(spark, tmp_dir):
    import datetime as dt
    rows = [(True, dt.datetime(2024, 1, 1, 0, 0, 7, 179575)), (False, dt.datetime(2024, 1, 1, 0, 1)),
            (None, None)]
    df = spark.createDataFrame(rows, "b boolean, t timestamp_ntz")
    path = write_csv(df.coalesce(1), os.path.join(tmp_dir, "bt"))
    text = "".join(open(os.path.join(path, f)).read()
                   for f in sorted(os.listdir(path)) if f.endswith(".csv"))
    assert text.splitlines() == ["b,t", "True,2024-01-01 00:00:07.179575",
                                 "False,2024-01-01 00:01:00", ","]
    back = read_csv(spark, path, "b boolean, t timestamp_ntz").collect()
    assert sorted(map(tuple, back), key=str) == sorted(rows, key=str)


def test_handover_reads_pandas_epoch_dates(spark, tmp_dir):
    pdf = pd.DataFrame({"date": pd.to_datetime(["2020-01-02 00:00:00.000", "2020-01-01 00:00:01.500"], format="ISO8601"),
                        "positive": [3, None]})
    p = _write(os.path.join(tmp_dir, "d.json"), pdf.to_json())
    back = read_column_json(spark, p, "date TIMESTAMP_NTZ, positive BIGINT", whole_files=True)
    got = sorted((r.row_label, r.date.isoformat(), r.positive) for r in back.collect())
    assert got == [(0, "2020-01-02T00:00:00", 3), (1, "2020-01-01T00:00:01.500000", None)]


def test_jdbc_pushes_the_max_and_splits_the_scan(spark):
    import uuid as _uuid

    from ferry.operators.handoff import high_water_mark
    from ferry.sources.jdbc import read_table, register_catalog, write_table
    from test_plans import formatted

    name = f"t{_uuid.uuid4().hex[:8]}"
    url = f"jdbc:derby:memory:{name};create=true"
    write_table(spark.range(1000).selectExpr("id AS K"), url, "T", mode="overwrite")
    mark = high_water_mark(spark.table(f"{register_catalog(spark, name, url)}.APP.T"), "K")
    assert "PushedAggregates: [MAX(" in formatted(mark)
    mark.write.format("noop").mode("overwrite").save()
    assert mark.first()[0] == 999
    assert read_table(spark, url, "T", partition_column="K",
                      num_partitions=8).rdd.getNumPartitions() == 8


def test_csv_keeps_white_space_and_line_breaks(spark, tmp_dir):
    rows = [(1, "  pad  "), (2, "two\nlines, \"quoted\""), (3, "\ttab\t"), (4, None),
            (5, " lead"), (6, "trail ")]
    df = spark.createDataFrame(rows, "my_id long, `a text.x` string")
    path = write_csv(df, os.path.join(tmp_dir, "ws"))
    assert sorted(map(tuple, read_csv(spark, path, df.schema).collect())) == rows


def test_dotted_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "`x.y` int, z int")
    assert df.transform(keep_columns, ["x.y"]).first()[0] == 1
    assert [r[0] for r in df.transform(sort_nulls_last, "x.y").collect()] == [1]


def test_insert_select_quotes_names_and_sorts_both_ways(spark):
    from ferry.session import scratch_path
    from ferry.sinks.tables import create_table, insert_select

    src = spark.createDataFrame([(1, "a"), (2, "b")], "id int, `my col` string")
    for descending, want in ((False, "a"), (True, "b")):
        name = f"ferry_t_{descending}"
        create_table(spark, name, "`my col` STRING", scratch_path(spark, "t"))
        insert_select(spark, name, src, ["my col"], order_by=["id"], limit=1,
                      descending=descending)
        assert [r[0] for r in spark.table(name).collect()] == [want]
        spark.sql(f"DROP TABLE {name}")


def test_json_http_array_items_are_streamed():
    from ferry.sources.json_http import array_items

    text = ' [ {"a": [1, "]"]} , 12 ,"x,y", null,{"b":{}} ] '
    want = ['{"a": [1, "]"]}', "12", '"x,y"', "null", '{"b":{}}']
    for n in (1, 2, 3, 7, 100):
        assert list(array_items(text[i:i + n] for i in range(0, len(text), n))) == want
    assert list(array_items(iter(["[]"]))) == []
    for bad in ("{}", "[1", "[1 2]", "[1] x", "", '[{"a":]'):
        with pytest.raises(ValueError):
            list(array_items(iter([bad])))


def test_json_http_comma_in_url_one_read_and_required_columns(spark, tmp_dir, monkeypatch):
    reads = os.path.join(tmp_dir, "reads")
    p = _write(os.path.join(tmp_dir, "a,b.json"), json.dumps([{"id": i} for i in range(50)]))
    import ferry.sources.json_http as J

    # Count reads where they happen: on the executors, one line each.
    class Counting(J.JsonHttpReader):
        def _records(self, url):
            with open(reads, "a") as f:
                f.write(url + "\n")
            yield from super()._records(url)

    class Source(J.JsonHttpDataSource):
        def reader(self, schema):
            return Counting(self.options)

    monkeypatch.setattr(J, "register", lambda s: s.dataSource.register(Source))
    df = read_json_http(spark, [f"file://{p}"], "id BIGINT, x STRING", required=["id"])
    rows = df.transform(sort_nulls_last, "id").collect()
    assert [r.id for r in rows] == list(range(50))
    assert len(open(reads).read().splitlines()) == 1
    with pytest.raises(ValueError):
        read_json_http(spark, [f"file://{p}"], "id BIGINT, x STRING", required=["id", "x"])


def test_json_http_document_into_leaves(spark, tmp_dir):
    from ferry.operators.nested import text_leaves
    p = _write(os.path.join(tmp_dir, "d.json"), json.dumps(
        {"sprites": {"a": "http://1", "o": {"b": "http://2"}, "n": None}}, indent=1))
    doc = read_json_http(spark, [f"file://{p}"], "sprites VARIANT", layout="document",
                         keep_source=True)
    text = doc.selectExpr("url", "to_json(sprites) AS doc")
    got = text_leaves(text, "url", "doc").orderBy("leaf_pos").collect()
    assert [(r.key, r.value) for r in got] == [("a", "http://1"), ("b", "http://2")]


def test_whole_documents_keep_undeclared_fields_and_nulls(spark, tmp_dir):
    from ferry.sinks.files import document_lines, write_lines
    from ferry.sources.json_records import read_whole_documents
    rows = ['{"_id":"1","extra":"kept?","age":null}', '{"_id":"2","deep":{"a":[1,null]}}']
    p = _write(os.path.join(tmp_dir, "docs.json"), "\n".join(rows) + "\n")
    out = write_lines(document_lines(read_whole_documents(spark, p)), os.path.join(tmp_dir, "o"))
    got = sorted((json.loads(r.value) for r in spark.read.text(out).collect()),
                 key=lambda d: d["_id"])
    assert got == [json.loads(r) for r in rows]
    bad = _write(os.path.join(tmp_dir, "bad.json"), '{"_id": \n')
    with pytest.raises(Exception):
        read_whole_documents(spark, bad).collect()


def test_scratch_root_needs_shared_storage_on_a_cluster(monkeypatch):
    from ferry import session

    class Sc:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    with pytest.raises(ValueError):
        session.scratch_root(type("S", (), {"sparkContext": Sc()})())


def test_column_that_no_record_has_fails(spark, tmp_dir):
    from ferry.sources.json_records import read_required

    schema, columns = "date INT, positive BIGINT, death BIGINT", ["death", "date"]

    def payload(name, text):
        path = os.path.join(tmp_dir, name)
        with open(path, "w") as f:
            f.write(text)
        return path

    lines = payload("a.json", '{"date": 1, "positive": 2}\n{"date": 2, "positive": 3}\n')
    with pytest.raises(ValueError, match="death"):
        read_required(spark, lines, schema, columns)
    array = payload("b.json", '[{"date": 1, "positive": 2},\n{"date": 2}]')
    with pytest.raises(ValueError, match="death"):
        read_required(spark, array, schema, columns, array=True)
    for text, want in (('{"date": 1}\n{"date": 2, "death": 5}\n', {(None, 1), (5, 2)}),
                       ('{"date": 1}\n{"date": 2, "death": null}\n', {(None, 1), (None, 2)}),
                       ("", set())):
        df = read_required(spark, payload("c.json", text), schema, columns)
        assert df.columns == columns and {tuple(r) for r in df.collect()} == want
    nulls = payload("d.json", '[{"date": 1, "death": null}]')
    assert read_required(spark, nulls, schema, columns, array=True).collect()[0].date == 1
    with pytest.raises(Exception):
        read_required(spark, nulls, "date INT", columns, array=True)


def test_whole_documents_do_not_depend_on_an_earlier_flatten(spark, tmp_dir):
    from ferry.operators.nested import text_leaves
    from ferry.sources.json_records import read_whole_documents

    path = os.path.join(tmp_dir, "d.json")
    with open(path, "w") as f:
        f.write('{"a": 1, "a": 2}\n')
    df = spark.createDataFrame([(0, '{"s": {"a": "http://x", "a": "http://y"}}')], "i INT, d STRING")
    for _ in range(2):
        with pytest.raises(Exception):
            read_whole_documents(spark, path).selectExpr("to_json(doc)").collect()
        assert text_leaves(df, "i", "d", root="$.s").collect()[0].value == "http://y"


def test_handover_document_over_several_lines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "h.json")
    with open(path, "w") as f:
        f.write(json.dumps({"a": {"0": 1, "1": 2}, "b": {"0": "x", "1": None}}, indent=1))
    got = read_column_json(spark, path, "a INT, b STRING", whole_files=True).collect()
    assert sorted(map(tuple, got)) == [(0, 1, "x"), (1, 2, None)]
