"""The pipeline against a brute-force run of its stages."""

from __future__ import annotations

import glob
import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from ferry.llm.op3_quality import quality_rules
from ferry.llm.op4_mixing import source_plan
from ferry.llm.op5_sentencepiece import SentencePiece
from ferry.llm.registry import MIX, tokenizer_path
from test_dedup import brute_components, brute_lines, brute_sets

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, SF)
        path = __import__("ferry.session", fromlist=["x"]).scratch_path(spark, "test-stage")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_quality(stages):
    judged = {r.doc_id: r for r in quality_rules(stages[0]).collect()}
    got = {r.doc_id: r for r in stages[1].collect()}
    assert set(got) == {i for i, r in judged.items() if r.kept}
    assert all(got[i].text == judged[i].cleaned and got[i].n_chars == len(got[i].text) for i in got)


def test_lines(stages):
    want = [(i, t) for i, t in brute_lines([(r.doc_id, r.text) for r in stages[1].collect()])
            if t.split()]
    assert sorted((r.doc_id, r.text) for r in stages[2].collect()) == sorted(want)


def test_near_duplicates(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    comp = brute_components(brute_sets(rows, 5))
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(i for i in comp if comp[i] == i)


def test_mixing(stages):
    before = {r.doc_id: r for r in stages[3].collect()}
    after = Counter(r.doc_id for r in stages[4].collect())
    assert set(after) == set(before)
    plan = {r.source: r for r in source_plan(stages[3], **MIX).collect()}
    for i, n in after.items():
        assert n - plan[before[i].source].whole in (0, 1)


def test_encoding(stages):
    sp = SentencePiece(tokenizer_path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    rows = stages[5].collect()
    assert len(rows) == stages[4].count()
    for r in rows:
        ids = sp.library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.parity and r.round_trip
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_run_equals_the_stages(spark, stages):
    a = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert a == sorted(tuple(r) for r in stages[5].collect())


def test_odd_documents(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0),
            (2, "x " * 100_000, "en", None, 1)]
    good = "\n".join(" ".join(f"w{k}x{i}" for i in range(30)) + "." for k in range(5))
    rows += [(3, good, "en", "a", 1), (3, good, "en", "a", 1), (4, good, "en", "b", 1),
             (None, good + "\nMore.", None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, f in corpus_pipeline.STAGES:
            docs = f(spark, docs, SF)
        got = sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect())
        assert got == ([(False, 3), (True, 0)] if data else [])


def test_near_dedup_decides_per_id_and_text(spark):
    text = lambda k: " ".join(f"{chr(97 + k)}{chr(97 + i // 26)}{chr(97 + i % 26)}"
                              for i in range(120)) + "."
    rows = [(1, text(0), "b"), (1, text(0), "a"), (1, text(1), "a"), (1, text(2), "a"),
            (2, text(1) + " more", "a"), (2, text(3), "a"), (3, text(3) + " more", "a"),
            (3, text(4), "a"), (3, text(4) + " more", "a"), (4, None, "a"), (4, text(5), "a")]
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text, r.source) for r in
           corpus_pipeline.near_dedup(spark, docs.repartition(3), SF).collect()]
    assert len(got) == len(set(got)) == 7
    # One text of each linked group stays, and every text that links with none.
    stem = Counter((t or "")[:100] for _, t, _ in got)
    assert stem == Counter([text(k)[:100] for k in range(6)] + [""])
    assert (1, text(0), "a") in got and (1, text(2), "a") in got
    assert {(4, None, "a"), (4, text(5), "a")} <= set(got)


def test_mixing_writes_the_permutation(spark, tmp_dir):
    docs = spark.createDataFrame([(i, f"w{i} x y", "en", "ab"[i % 10 == 0], 0) for i in range(500)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    corpus_pipeline.mixing(spark, docs.repartition(5), SF).write.parquet(f"{tmp_dir}/mixed")
    ids = [i for f in sorted(glob.glob(f"{tmp_dir}/mixed/part-*.parquet"))
           for i in pq.read_table(f).column("doc_id").to_pylist()]
    seen, keys = Counter(), []
    for i in ids:
        keys.append((seen[i], hashlib.md5(f"{MIX['seed']}:{seen[i]}:{i}".encode()).hexdigest()))
        seen[i] += 1
    assert len(seen) == 500 and len(ids) > 500 and keys == sorted(keys)
