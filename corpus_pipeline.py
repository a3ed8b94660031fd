"""Corpus pipeline: raw documents to encoded training documents.

``STAGES`` lists ``(name, function)``; every function takes
``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``. All but the last return the
columns of ``docs``. ``run`` applies them to ``documents``.

Defined results beyond those of the operators: a document that line
deduplication leaves without a word goes; near-deduplication decides per id and
text, so an id with several texts keeps those that link with nothing, and of
rows with the same id and text the first by (a hash of) the other columns stays; rows
without an id all stay; a document that the mix repeats is there once per
block, and the mixed rows are written in the order of block and key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferry.llm.common import fresh, materialise, table
from ferry.llm.op3_quality import clean_documents
from ferry.llm.op4_mixing import mix_documents
from ferry.llm.op5_sentencepiece import encode_documents
from ferry.llm.op7_minhash import near_duplicates
from ferry.llm.op10_lines import dedup_lines
from ferry.llm.registry import MIX, tokenizer_path
from ferry.operators.project import tie_breakers


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: failing lines are cut, rejected documents go."""
    return clean_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: repeated chunks go, and documents left without a word."""
    return dedup_lines(docs).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each group stays (shingles of five
    words, similarity 0.8)."""
    node, first, row = (fresh(docs, n) for n in ("node", "node_first", "node_row"))
    digest = F.md5(F.coalesce("text", F.lit("")))
    # Of the texts of one id the first by digest goes by the id, every other
    # one by a number of its own above the ids.
    several = materialise(
        docs.filter("doc_id IS NOT NULL").select("doc_id", digest.alias("digest"))
        .groupBy("doc_id").agg(F.min("digest").alias(first), F.max("digest").alias("last"))
        .filter(F.col(first) < F.col("last")).select("doc_id", first), "several-texts")
    own = F.xxhash64("doc_id", digest).bitwiseAND(F.lit((1 << 61) - 1)) + F.lit(1 << 62)
    named = docs.filter("doc_id IS NOT NULL").join(several, "doc_id", "left").withColumn(
        node, F.when(digest != F.col(first), own).otherwise(F.col("doc_id").cast("long")))
    kept = (near_duplicates(named, id_col=node, width=5, percent=80)
            .filter("kept").select(node).distinct().hint("merge"))
    # By the columns themselves (without the hash before them); maps and
    # variants cannot be sorted, their JSON text can.
    others = tie_breakers(docs.select(*[F.col(f"`{c}`") for c in docs.columns
                                        if c not in ("doc_id", "text")]))[1:] or [F.lit(0)]
    one = named.join(kept, node, "left_semi").withColumn(
        row, F.row_number().over(Window.partitionBy(node).orderBy(*others)))
    return (one.filter(F.col(row) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
            .unionByName(docs.filter("doc_id IS NULL")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: every document at least once, sources at their target weights,
    the rows of a block in the order of its permutation."""
    block, key = fresh(docs, "mix_block"), fresh(docs, "mix_key")
    mixed = mix_documents(docs, **MIX, block_col=block, key_col=key)
    return mixed.orderBy(block, key).select(*[F.col(f"`{c}`") for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids: count and checksum per document, parity, round trip."""
    return encode_documents(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources", mixing),
    ("SentencePiece encoding", encode),
]

# The stages beyond the first have no SQL form; tests/llm compares the
# pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = materialise(out, f"pipeline-{k}") if k < len(STAGES) - 1 else out
    return docs
