"""Every operator and the pipeline on empty tables."""

from __future__ import annotations

import pytest

import corpus_pipeline
from ferry.llm.op2_html import extract_pages
from ferry.llm.op3_quality import clean_documents, quality_rules
from ferry.llm.op4_mixing import mix_documents
from ferry.llm.op5_sentencepiece import decode_documents, encode_documents
from ferry.llm.op6_pii import personal_data
from ferry.llm.op9_license import license_scan
from ferry.llm.op10_lines import dedup_lines, line_report
from ferry.llm.registry import tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")
OPERATORS = {
    "op3": quality_rules, "op3 clean": clean_documents, "op6": personal_data, "op9": license_scan,
    "op10": dedup_lines, "op10 report": line_report,
    "op4": lambda d: mix_documents(d, target_entropy=0.9),
    "op5": lambda d: encode_documents(d, MODEL, keep_ids=True),
    "op5 back": lambda d: decode_documents(encode_documents(d, MODEL, keep_ids=True), MODEL)}


@pytest.mark.parametrize("name", OPERATORS)
def test_no_documents(spark, name):
    docs = spark.createDataFrame(
        [], "doc_id long, text string, lang string, source string, n_chars long")
    assert OPERATORS[name](docs).collect() == []


def test_no_pages(spark):
    assert extract_pages(spark.createDataFrame(
        [], "page_id long, url string, html string")).collect() == []


def test_pipeline_of_no_documents(spark, tmp_dir):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{tmp_dir}/documents.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).collect() == []


def test_pipeline_stages_with_a_map_and_clashing_names(spark):
    words = " ".join(f"word{i}" for i in range(70))
    rows = [(i, f"Line {i} of a text that is long enough, {words} {i}.", "en", "ab"[i % 2], 0,
             {"k": i}, "b", "k") for i in range(4)]
    docs = spark.createDataFrame(
        rows + rows[:1], "doc_id long, text string, lang string, source string, n_chars long, "
        "meta map<string,int>, mix_block string, MIX_KEY string")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "meta", "mix_block",
                                "MIX_KEY"]
    found = docs.collect()
    assert {r.mix_block for r in found} == {"b"} and {r.meta["k"] for r in found} == {r.doc_id
                                                                                     for r in found}
