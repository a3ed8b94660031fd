"""Duplicate lines, removed as content-defined chunks.

A text is cut into chunks of whole lines. Every boundary depends on one line
alone: a line of at least ``MIN_WORDS`` words is a chunk by itself, and of the
shorter lines between two such lines a chunk ends after a line whose hash falls
in one residue class of ``DIVISOR``. So a passage is cut in the same places
whatever stands before or after it, and a shared run of long lines is cut at
its own two edges.

Chunks of at least ``MIN_WORDS`` words that occur more than once in the whole
table are removed everywhere but at their first place (the smallest id, and
there the first chunk). The chunks are grouped by hash and by the bytes of
their lines, so only equal bytes count as repeats; if two different chunks
share a hash, neither is removed. Counts are taken before the shuffle, so a
chunk in a third of all documents is one row per task.

Defined results: a null or empty text has no chunks and stays as it is; blank
lines belong to the chunk of the line before them and do not count in the
comparison; a text whose chunks all go becomes ''; rows that share an id count
as one document (a chunk repeated only among them stays in each); a row with a
null id is left as it is and not counted; an empty table gives an empty result;
other columns stay as they are. Texts of any length are cut whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ferry.llm.common import arrow_map, fresh, materialise

# Residue classes of the hash of a short line, words a chunk must
# have to be removed.
DIVISOR, MIN_WORDS = 3, 8

WORD = re.compile(r"[^\x20\x09-\x0D]")


def chunk_lines(text: str) -> list[str]:
    """The chunks of a text; joined they give the text again. Every line
    keeps its line break."""
    lines = text.split("\n")
    lines = [x + "\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
    out, chunk, closed = [], [], False
    for line in lines:
        if WORD.search(line):
            long = len(line.split(None, MIN_WORDS - 1)) == MIN_WORDS
            if closed or (long and any(map(WORD.search, chunk))):
                out.append("".join(chunk))
                chunk = []
            # The last line of a text may lack its break and is still the same line.
            closed = long or xxhash.xxh3_64_intdigest(line.rstrip("\n")) % DIVISOR == 0
        chunk.append(line)
    if chunk:
        out.append("".join(chunk))
    return out


def chunk_key(chunk: str) -> tuple[int, str] | None:
    """Hash and bytes under which a chunk is compared (without blank lines);
    None for a chunk that is not removable."""
    body = "\n".join(filter(WORD.search, chunk.split("\n")))
    if len(body.split(None, MIN_WORDS - 1)) < MIN_WORDS:
        return None
    return xxhash.xxh3_64_intdigest(body) - (1 << 63), body


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.int64()), ("hash", pa.int64()), ("chunk", pa.string())])
    for batch in batches:
        rows = {f: [] for f in schema.names}
        size = 0
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for found in map(chunk_key, chunk_lines(text.as_py() or "")):
                if found:
                    rows["id"].append(key)
                    rows["hash"].append(found[0])
                    rows["chunk"].append(found[1])
                    size += len(found[1])
            if size > 4 << 20:
                yield pa.RecordBatch.from_pydict(rows, schema=schema)
                rows, size = {f: [] for f in schema.names}, 0
        yield pa.RecordBatch.from_pydict(rows, schema=schema)


def _rewrite(schema: pa.Schema, text: int, size: int | None, flags: int):
    """Drop flagged chunks; the last column holds ``(hash, first)`` of the
    repeated chunks of the row, ``first`` where its first place is here."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns
            texts = columns[text].to_pylist()
            sizes = columns[size].to_pylist() if size is not None else None
            for i, repeated in enumerate(columns[flags].to_pylist()):
                if not repeated:
                    continue
                stays = {x["hash"]: x["first"] for x in repeated}
                keep = []
                for chunk in chunk_lines(texts[i]):
                    key = chunk_key(chunk)
                    if key and key[0] in stays:
                        if not stays[key[0]]:
                            continue
                        stays[key[0]] = False
                    keep.append(chunk)
                new = "".join(keep)
                if len(new) != len(texts[i]):
                    texts[i] = new.rstrip("\n")
                    if sizes is not None:
                        sizes[i] = len(texts[i])
            out = [c for k, c in enumerate(columns) if k != flags]
            out[text] = pa.array(texts, schema.field(text).type)
            if size is not None:
                out[size] = pa.array(sizes, schema.field(size).type)
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(out, schema, strict=True)], schema=schema)
    return run


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, repeated)``: for every id with repeated chunks an array of
    ``(hash, first)``, ``first`` true at the id that keeps the chunk."""
    found = arrow_map(docs.filter(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")),
        _chunks, "id long, hash long, chunk string")
    same = (found.groupBy("hash", "chunk").agg(F.min("id").alias("first_id"),
                                               F.count("*").alias("n")))
    repeated = materialise(
        same.groupBy("hash").agg(F.count("*").alias("texts"), F.min("first_id").alias("first_id"),
                                 F.max("n").alias("n"))
        .filter("texts = 1 AND n > 1").select("hash", "first_id"), "line-chunks")
    places = found.select("id", "hash").join(repeated, "hash").select(
        "id", F.struct("hash", (F.col("id") == F.col("first_id")).alias("first")).alias("x"))
    return places.groupBy("id").agg(F.collect_set("x").alias("repeated"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                size_col: str = "n_chars") -> DataFrame:
    """``docs`` with the repeated chunks gone from ``text_col``; ``size_col``
    (if there is one) holds the new length where a text changed."""
    marks = materialise(repeated_chunks(docs, id_col, text_col), "line-marks")
    key, flags = fresh(docs, "line_id"), fresh(docs, "line_repeats")
    joined = (docs.withColumn(key, F.col(f"`{id_col}`").cast("long"))
              # A merge join at every size: the marks grow with the documents.
              .join(marks.select(F.col("id").alias(key), F.col("repeated").alias(flags))
                    .hint("merge"), key, "left")
              .select(*[F.col(f"`{c}`") for c in docs.columns], F.col(flags)))
    schema = to_arrow_schema(docs.schema)
    size = docs.columns.index(size_col) if size_col in docs.columns else None
    return arrow_map(joined, _rewrite(schema, docs.columns.index(text_col), size,
                                      len(docs.columns)), docs.schema)


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, characters and lines before and after,
    and the SHA-256 of the new text."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    count = lambda c: F.size(F.split(c, "\n")).cast("long")
    base = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"),
                       F.length(text).cast("long").alias("n_chars_before"),
                       count(text).alias("n_lines_before"))
    return dedup_lines(base, id_col, text_col).select(
        F.col(f"`{id_col}`"), "n_chars_before", F.length(text).cast("long").alias("n_chars"),
        "n_lines_before", count(text).alias("n_lines"), F.sha2(text, 256).alias("text_sha256"))
