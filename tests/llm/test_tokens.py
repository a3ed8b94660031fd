"""SentencePiece and binary records: parity, round trips, damage."""

from __future__ import annotations

import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferry.llm import wordids
from ferry.llm.op5_sentencepiece import (SentencePiece, build_tokenizer, decode_documents,
                                         encode_documents, parse_model)
from ferry.llm.op8_records import (frame, masked, pack_record, read_frame, read_record,
                                   read_records, unpack_payload, word_table, write_records)
from ferry.llm.registry import END_ID, tokenizer_path

SF = "/root/testdata/sf0.001"
MODEL = tokenizer_path("piece_bpe_32k.model")
WORDS = tokenizer_path("word_bpe_49k.json")

TEXTS = ["", " ", "a", "  two  spaces  ", "line\nbreak\n\n x", "tab\tand\rmore", "Größe   naïve",
         "日本語 テキスト", "emoji 😀😀", "<s> </s> <unk> <0x0A>", "▁mark ▁▁", "​﻿x", "x" * 3000,
         "é combining", "1234567890 12.5%", "\x00\x01", "don't we'll I'm"]


@pytest.fixture(scope="module")
def sp():
    return SentencePiece(MODEL)


def test_parsed_model_matches_the_library(sp):
    m = sp.model
    assert len(m.pieces) == sp.library.get_piece_size()
    for i in (0, 1, 2, 3, 258, 259, 1000, 31_999):
        assert m.pieces[i][0] == sp.library.id_to_piece(i)
        assert m.pieces[i][1] == pytest.approx(sp.library.get_score(i))
    assert sp.by_unit and m.byte_fallback


def check_text(sp, text):
    (ids, _), = sp.encode_batch([text])
    assert ids.tolist() == sp.library.encode(text), text
    assert sp.normalise(sp.decode_batch([ids])[0]) == sp.normalise(text)


@pytest.mark.parametrize("text", TEXTS)
def test_encode_matches_the_library(sp, text):
    check_text(sp, text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_encode_any_text(sp, text):
    check_text(sp, text)


def test_own_pipeline_alone_agrees(sp, spark):
    """The rebuilt tokenizer, without the library's ids, on real texts."""
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(50).collect()]
    for t in texts:
        assert sp.tokenizer.encode(sp.normalise(t)).ids == sp.library.encode(t)
    assert not sp.differing


def test_unigram_model_is_rebuilt(tmp_path):
    """Scores and byte fallback of a unigram model, written by hand."""
    import struct

    def field(n, wire, body):
        key = bytes([n << 3 | wire]) if n < 16 else bytes([(n << 3 | wire) & 0x7F | 0x80, n >> 4])
        return key + body

    def text(n, s):
        return field(n, 2, bytes([len(s)]) + s)

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    pieces += [("▁", -3.0, 1), ("a", -3.0, 1), ("b", -3.0, 1), ("▁a", -2.0, 1), ("ab", -2.5, 1),
               ("▁ab", -2.2, 1)]
    data = b""
    for p, s, k in pieces:
        body = text(1, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k]))
        data += text(1, body)
    data += text(2, field(3, 0, bytes([1])) + field(35, 0, bytes([1])))
    norm = text(1, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x00") + field(5, 0, b"\x01")
    data += text(3, norm)
    m = parse_model(data)
    assert m.pieces[-1][0] == "▁ab" and m.kind == 1 and m.byte_fallback
    tok = build_tokenizer(m)
    assert tok.encode("▁ab").tokens == ["▁ab"]
    assert tok.encode("▁abab").tokens == ["▁ab", "ab"]
    assert tok.encode("é").tokens == ["<0xC3>", "<0xA9>"]
    path = tmp_path / "m.model"
    path.write_bytes(data)
    sp = SentencePiece(str(path))
    for t in ("ab", "ab ba", " a  b", "é"):
        check_text(sp, t)


def test_encode_documents(spark, sp):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, None), (-2, ""), (None, "x"), (-3, "x"), (-3, "x")],
                                  "doc_id long, text string")
    docs = docs.unionByName(extra).withColumn("ids", F.lit("clash"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = encode_documents(docs, MODEL, keep_ids=True)
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        ids = sp.library.encode(texts[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids) and r.parity and r.round_trip
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    back = {r.doc_id: r.text for r in decode_documents(got, MODEL).collect()}
    assert back == texts


def test_unit_table_stays_bounded(monkeypatch):
    monkeypatch.setattr(wordids, "MAX_UNITS", 10)
    table = wordids.UnitTable(lambda us: [[len(u)] for u in us], "<u2")
    for k in range(50):
        units = [f"{'x' * (k % 7)}{i}" for i in range(4)]
        assert table.pack([units, []]) == [np.array(list(map(len, units)), "<u2").tobytes(), b""]
        assert len(table.young) + len(table.old) <= 20


# ------------------------------------------------------------ binary records

def test_frames_detect_damage():
    data = frame(b"abc") + frame(b"")
    x = io.BytesIO(data)
    assert (read_frame(x), read_frame(x), read_frame(x)) == (b"abc", b"", None)
    for i in range(len(frame(b"abc"))):
        bad = bytearray(data)
        bad[i] ^= 1
        with pytest.raises(ValueError):
            read_frame(io.BytesIO(bytes(bad)))
    with pytest.raises(ValueError):
        read_frame(io.BytesIO(data[:14]))
    assert masked(b"") == 0xA282EAD8
    key, ids = unpack_payload(read_frame(io.BytesIO(pack_record(None, np.array([7], "<u2")))))
    assert key is None and ids.tolist() == [7]


def test_records_match_direct_encoding(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = [*TEXTS, "<|endoftext|> x<|startoftext|>y", "A\x1cB\x85C D", "́ ́a", None]
    extra = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(odd)] + [(None, "x")],
                                  "doc_id long, text string")
    docs = docs.unionByName(extra).withColumn("start", F.lit("clash"))
    manifest = write_records(docs, WORDS, END_ID)
    got = {r.doc_id: r for r in read_records(spark, manifest).collect()}
    at = 0
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    assert len(got) == len(rows)
    for r in rows:
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, END_ID]
        g = got[r.doc_id]
        assert (g.start, g.n_tokens) == (at, len(ids)), r
        assert g.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    # A shuffled read through the index.
    first = manifest.orderBy("start").first()
    key, ids = read_record(first.path, first.index_path, 1)
    assert key == rows[1].doc_id and len(ids) == got[key].n_tokens


def test_records_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    manifest = write_records(none, WORDS, END_ID)
    assert manifest.count() == 0 and read_records(spark, manifest).count() == 0


def test_word_table_packs_small_ids():
    assert word_table(WORDS).dtype == np.dtype("<u2")
