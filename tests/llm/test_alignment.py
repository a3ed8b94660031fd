"""Cross-tokenizer alignment against a walk over whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ferry.llm import op12_alignment as op
from ferry.llm.op12_alignment import (Aligner, PerfectHash, align_documents, checked_index,
                                      count_pairs, cut_words, pair_counts)

SF = "/root/testdata/sf0.01"
A = str(public_tokenizers.path("byte_bpe_50k.json"))
B = str(public_tokenizers.path("piece_bpe_32k.model"))

ODD = ["", " ", "\n", "a", "\nstart", "\n\n\nstart", " lead", "  two", "trail ", "trail\n", "a  b",
       "a   b\n\n c", "x\n y", "x \ny", "tab\there \t there", "nb sp", "a▁b", "▁",
       "\x1c a\x1cb \x85c", "don't can't I'll", "<|endoftext|> in <s> text </s> <unk> <0x41>",
       "ünï €𐍈 漢字かな", "é ́x", "\r\n line\r\n\r\nend", "1234 56,78.9", "a\x00b",
       "...!!! ???", "​ zero", "　wide　", "word " * 3000, "x" * 5000,
       "fiﬁ ﻿bom"]


class Brute:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        from tokenizers import decoders
        self.decode = decoders.ByteLevel()
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in shown]
        self.byte = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(hidden)}

    def groups(self, text):
        """[(A ids, B ids)] of a text, None where it has no tokens."""
        if not text:
            return None
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i)))
             for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                      else p.replace("▁", " ").encode()))
        want = (" " + text).encode()
        if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            return None
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((at, at + len(x), i))
                at += len(x)
            spans.append(out)
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        out, low = [], 0
        for e in ends:
            out.append([[s for s in side if low < s[1] <= e] for side in spans])
            low = e
        return out

    def documents(self, rows):
        all_groups = [(d, self.groups(t)) for d, t in rows]
        count = Counter()
        links_of = []
        for _, groups in all_groups:
            links = [(a[2], b[2]) for ga, gb in groups or [] for a in ga for b in gb
                     if a[0] < b[1] and b[0] < a[1]]
            links_of.append(links)
            count.update(links)
        best = defaultdict(int)
        for (_, b), n in count.items():
            best[b] = max(best[b], n)
        out = Counter()
        for (d, groups), links in zip(all_groups, links_of):
            text = ";".join(",".join(str(x[2]) for x in a) + "|" + ",".join(str(x[2]) for x in b)
                            for a, b in groups or [])
            out[d, sum(len(a) for a, _ in groups or []), sum(len(b) for _, b in groups or []),
                len(groups or []), len(links), sum(count[x] == best[x[1]] for x in links),
                sum(count[x] for x in links),
                hashlib.sha256(text.encode()).hexdigest() if groups else ""] += 1
        return out, count


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, count = Brute().documents(rows)
    folder = count_pairs(docs, A, B)
    got = Counter(tuple(r[c] for c in NAMES)
                  for r in align_documents(docs, A, B, folder=folder).collect())
    assert got == want
    pairs = {(r.a_id, r.b_id): r.n_links for r in pair_counts(spark, folder).collect()}
    assert pairs == dict(count)


def odd_rows():
    rnd = random.Random(5)
    bits = [" ", "  ", "\n", "\n\n", "\t", "a", "The", "ing", ".", "é", "▁", " ", "42"]
    made = ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 30))) for _ in range(300)]
    return ([(i, t) for i, t in enumerate(ODD + made)]
            + [(None, "no id"), (None, None), (7, "again"), (7, "again")])


def test_odd_texts(spark):
    rows = odd_rows()
    want, _ = Brute().documents(rows)
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows],
                               "doc_id long, text string, n_a int, groups string").repartition(5)
    got = Counter(tuple(r[c] for c in NAMES) for r in align_documents(df, A, B).collect())
    assert got == want


def test_words_give_the_tokens_of_the_text():
    one, brute = Aligner(A, B), Brute()
    assert one.by_word
    for _, text in odd_rows():
        words = cut_words(text or "")
        if not words:
            continue
        found = one.align(words)
        groups = brute.groups(text)
        if groups is None:
            assert not found.good.all()
            continue
        assert found.good.all()
        assert "".join(found.groups)[:-1] == ";".join(
            ",".join(str(x[2]) for x in a) + "|" + ",".join(str(x[2]) for x in b)
            for a, b in groups)


def test_small_tables_and_trees_give_the_same(spark, monkeypatch):
    # In this process: the tasks' generators are driven directly.
    import pyarrow as pa

    rows = odd_rows()
    batch = pa.RecordBatch.from_pydict({"id": [d for d, _ in rows], "text": [t for _, t in rows]})
    monkeypatch.setattr(op, "CHUNK_BYTES", 200)
    monkeypatch.setattr(op, "MAX_WORDS", 50)
    op._HELD.clear()
    total = Counter()
    for leaf in op._count_task(A, B)(iter([batch])):
        for k, c in zip(leaf.column(2).to_pylist(), leaf.column(3).to_pylist()):
            keys = np.frombuffer(k, "<u4")
            for key, n in zip(keys.tolist(), op._decoded(c, len(keys)).tolist()):
                total[key >> 16, key & 0xFFFF] += n
    op._HELD.clear()
    assert total == Brute().documents(rows)[1]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 50_000])
def test_perfect_hash(n):
    rnd = np.random.default_rng(n)
    keys = np.unique(rnd.integers(0, 1 << 32, size=n, dtype=np.uint32))
    h = PerfectHash.load(PerfectHash.build(keys).dump())
    assert sorted(h.index(keys).tolist()) == list(range(len(keys)))
    stored = np.zeros(len(keys), np.uint32)
    stored[h.index(keys)] = keys
    assert (checked_index(h, stored, keys) == h.index(keys)).all()
    others = np.setdiff1d(rnd.integers(0, 1 << 32, size=100, dtype=np.uint32), keys)
    assert (checked_index(h, stored, others) == -1).all()


def test_many_leaves(spark, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet")
            .limit(100).collect()]
    want, _ = Brute().documents(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(20)
    monkeypatch.setattr(op, "FAN", 3)
    assert Counter(tuple(r[c] for c in NAMES) for r in align_documents(docs, A, B).collect()) == want


def test_empty_tables(spark):
    schema = "doc_id long, text string"
    assert align_documents(spark.createDataFrame([], schema), A, B).collect() == []
    out = align_documents(spark.createDataFrame([(1, None), (2, "")], schema), A, B)
    assert sorted(tuple(r) for r in out.collect()) == [(d, 0, 0, 0, 0, 0, 0, "") for d in (1, 2)]
