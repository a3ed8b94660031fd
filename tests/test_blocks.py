"""One large text read in byte blocks, one ordered object written by many
tasks: against whole-file reads and sequential writes."""

from __future__ import annotations

import csv
import io
import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import ferry.sources.blocks as B
from ferry.sinks.files import read_csv, read_csv_blocks, write_csv, write_csv_file
from ferry.sinks.handover import write_column_text
from ferry.sinks.one_file import write_one_file
from ferry.sources.handover import read_column_json, read_column_text
from ferry.sources.json_records import read_json_array, read_json_records

SCHEMA = "id BIGINT, text STRING, sub STRUCT<a: ARRAY<INT>, b: STRING>"
ODD = ["plain", "", 'quo"te', "back\\slash", "\\\\", '\\"', "[{,}]", "line\nbreak", "ünï €𐍈",
       "\\" * 9, '"' * 5, "]", "x" * 300, None]


def records(n, seed=0):
    rnd = random.Random(seed)
    return [{"id": i, "text": rnd.choice(ODD),
             "sub": {"a": [1] * rnd.randrange(4), "b": rnd.choice(ODD)}} for i in range(n)]


def put(tmp_dir, name, text):
    path = os.path.join(tmp_dir, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def counted(df):
    return Counter(json.dumps(r.asDict(recursive=True), sort_keys=True, default=str)
                   for r in df.collect())


@pytest.mark.parametrize("indent,ascii_only", [(None, True), (2, False)])
@pytest.mark.parametrize("block", [64, 1000, 1 << 20])
def test_array_equals_the_whole_file_read(spark, tmp_dir, block, indent, ascii_only):
    rows = records(60)
    path = put(tmp_dir, "a.json", json.dumps(rows, indent=indent, ensure_ascii=ascii_only))
    want = counted(read_json_records(spark, path, SCHEMA, array=True))
    got = read_json_array(spark, path, SCHEMA, block_bytes=block)
    assert counted(got) == want and sum(want.values()) == len(rows)
    if block == 64:
        assert got.rdd.getNumPartitions() > 4


def test_chunks_smaller_than_a_piece(tmp_dir):
    """The scanners themselves, with chunks that cut escapes and texts."""
    rows = records(60, seed=3)
    path = put(tmp_dir, "a.json", "  " + json.dumps(rows) + "\n ")
    size = os.path.getsize(path)
    import pyarrow.fs as fs
    old = B.CHUNK
    try:
        for B.CHUNK in (1, 2, 3, 5, 17, 4096):
            for block in (3, 11, 50, size):
                with fs.LocalFileSystem().open_input_file(path) as f:
                    quotes, depth, before, found = 0, 0, False, []
                    for start in range(0, size, block):
                        row = {"path": path, "start": start, "end": min(size, start + block),
                               "size": size}
                        (out,) = B._json_summary(f, row)
                        s = out.to_pylist()[0]
                        state = {**row, "inside": quotes, "depth": depth, "before": before}
                        found += [t for _, e, t in B.pieces(f, state, 1, b"[]") if e is not None]
                        depth += s["open1"] if quotes else s["open0"]
                        quotes = (quotes + s["quotes"]) % 2
                        before = before or not s["blank"]
                assert [json.loads(t) for t in found] == rows
                assert (quotes, depth) == (0, 0)
    finally:
        B.CHUNK = old


@pytest.mark.parametrize("text", ["", "  ", "[", '[{"id": 1}', '[{"id": 1}]]', '[{"id": 1},]',
                                  '[{"id": 1}] x', '[1}', '{"id": 1}', '[{"id": 1}] [{"id": 2}]',
                                  'x [{"id": 1}]', '[{"id": "open}]', '[{"id": 1,}]', '[,]',
                                  '"text"', '[{"id": 1}}'])
@pytest.mark.parametrize("block", [4])
def test_malformed_array_fails(spark, tmp_dir, text, block):
    path = put(tmp_dir, "bad.json", text)
    if not text:
        assert read_json_array(spark, path, "id BIGINT", block_bytes=block).collect() == []
        return
    with pytest.raises(Exception):
        read_json_array(spark, path, "id BIGINT", block_bytes=block).collect()


def test_array_odds(spark, tmp_dir):
    assert read_json_array(spark, put(tmp_dir, "e.json", " [ ] "), SCHEMA).collect() == []
    deep = '[{"id": 1, "text": ' + "[" * 200 + "]" * 200 + '}, {"id": 2}]'
    path = put(tmp_dir, "d.json", deep)
    got = read_json_array(spark, path, "id BIGINT", block_bytes=50).collect()
    assert sorted(r.id for r in got) == [1, 2]
    where = read_json_array(spark, path, "id BIGINT", block_bytes=50, positions=True)
    assert set(where.columns) == {"id", "_file", "_block", "_mid"}


@pytest.mark.parametrize("block", [9, 100, 1 << 20])
def test_column_text_equals_the_whole_read(spark, tmp_dir, block):
    rows = [(i, ODD[i % len(ODD)], None if i % 5 == 0 else i * 1.5) for i in range(60)]
    df = spark.createDataFrame(rows, "id BIGINT, text STRING, x DOUBLE").repartition(3)
    path = write_column_text(df, os.path.join(tmp_dir, "t.json"), ["id"])
    with open(path, encoding="utf-8") as f:
        doc = json.loads(f.read())
    assert list(doc) == ["id", "text", "x"] and list(doc["x"]) == [str(i) for i in range(60)]
    assert [doc["text"][str(i)] for i in range(60)] == [r[1] for r in rows]
    schema = df.schema
    want = counted(read_column_json(spark, path, schema, whole_files=True))
    got = read_column_text(spark, path, schema, block_bytes=block)
    assert counted(got) == want and len(want) == 60


def test_column_text_of_a_dataframe_library(spark, tmp_dir):
    pd = pytest.importorskip("pandas")
    frame = pd.DataFrame({"id": range(30), "te\"xt": [ODD[i % len(ODD)] for i in range(30)]})
    path = put(tmp_dir, "p.json", frame.to_json())
    got = read_column_text(spark, path, "id BIGINT, `te\"xt` STRING", block_bytes=40).collect()
    assert sorted((r.row_label, r.id, r[2]) for r in got if r[2] is not None) == sorted(
        (i, i, t) for i, t in enumerate(frame['te"xt']) if t is not None)
    assert len(got) == 30


def test_column_text_odds(spark, tmp_dir):
    empty = spark.createDataFrame([], "a INT, b STRING")
    path = write_column_text(empty, os.path.join(tmp_dir, "e.json"), ["a"])
    assert open(path).read() == '{"a":{},"b":{}}'
    assert read_column_text(spark, path, empty.schema).collect() == []
    for bad in ('{"a":{"0":1},"b":{}}', '{"a":{"0":1},"b":{"1":"x"}}', '{"a":[1],"b":{}}',
                '{"a":{"0":1,"0":2},"b":{"0":"x"}}', '{"a":{"0":1}', '{"a":{"0":1,},"b":{"0":"x"}}'):
        with pytest.raises(Exception):
            read_column_text(spark, put(tmp_dir, "bad.json", bad), empty.schema,
                             block_bytes=6).collect()


CELLS = ["plain", " padded ", 'a "quoted" b', "line\nbreak", "crlf\r\nin", "cr\rin", "comma, x",
         "", None, "#no", '"', '""\n""', "ünï\n€", "\n\n", "\\", "\\\"", "\r"]


def odd_table(spark, n=120):
    return spark.createDataFrame(
        [(i, CELLS[i % len(CELLS)], CELLS[(i * 7 + 3) % len(CELLS)], i % 3 == 0) for i in range(n)],
        "id BIGINT, t STRING, u STRING, flag BOOLEAN")


@pytest.mark.parametrize("block", [64, 700, 1 << 20])
def test_csv_blocks_equal_the_whole_file_read(spark, tmp_dir, block):
    df = odd_table(spark)
    path = write_csv_file(df.repartition(5), os.path.join(tmp_dir, "t.csv"), ["id"])
    want = counted(read_csv(spark, path, df.schema))
    got = read_csv_blocks(spark, path, df.schema, block_bytes=block)
    assert counted(got) == want and sum(want.values()) == df.count()
    if block == 64:
        assert got.rdd.getNumPartitions() > 10


def test_csv_of_other_writers(spark, tmp_dir):
    buffer = io.StringIO()
    w = csv.writer(buffer)  # \r\n line ends
    rows = [["a", "b"]] + [[str(i), CELLS[i % 8] or ""] for i in range(50)]
    w.writerows(rows)
    path = put(tmp_dir, "o.csv", buffer.getvalue().removesuffix("\r\n"))
    schema = spark.createDataFrame([], "a STRING, b STRING").schema
    for block in (6, 100):
        got = read_csv_blocks(spark, path, schema, block_bytes=block).collect()
        assert sorted((r.a, r.b or "") for r in got) == sorted(tuple(r) for r in rows[1:])
    with pytest.raises(Exception):
        read_csv_blocks(spark, put(tmp_dir, "b.csv", 'a,b\n1,"x\n2,y\n'), schema).collect()


@pytest.mark.parametrize("random_writes", [True, False])
def test_one_csv_file_is_byte_equal(spark, tmp_dir, random_writes):
    df = odd_table(spark)
    one = write_csv(df.orderBy("id").coalesce(1), os.path.join(tmp_dir, "parts"))
    (part,) = [f for f in os.listdir(one) if f.endswith(".csv")]
    path = write_csv_file(df.repartition(7), os.path.join(tmp_dir, "t.csv"), ["id"])
    with open(path, "rb") as a, open(os.path.join(one, part), "rb") as b:
        assert a.read() == b.read()
    again = write_one_file(df.select("id", F.concat(F.col("id").cast("string"), F.lit(";"))
                                     .alias("x")).repartition(4), "x", ["id"], path, "<", ">",
                           random_writes=random_writes)
    assert open(again).read() == "<" + "".join(f"{i};" for i in range(120)) + ">"
    assert [f for f in os.listdir(tmp_dir) if f.endswith(".tmp")] == []


def test_one_file_of_an_empty_table(spark, tmp_dir):
    none = spark.createDataFrame([], "id BIGINT, x STRING")
    path = write_one_file(none, "x", ["id"], os.path.join(tmp_dir, "e.txt"), "<", ">")
    assert open(path).read() == "<>"
    path = write_csv_file(none, os.path.join(tmp_dir, "e.csv"), ["id"])
    assert open(path).read() == "id,x\n"
    assert read_csv_blocks(spark, path, none.schema).collect() == []
