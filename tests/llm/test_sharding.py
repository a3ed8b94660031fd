"""Minimax sharding against a brute-force cut of the same order."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from ferry.llm import op13_sharding as op
from ferry.llm.op13_sharding import Ends, minimax_cuts, shard_documents

SF = "/root/testdata/sf0.01"


def greedy(sizes, capacity, n):
    used, left = 1, capacity
    for s in sizes:
        if s > capacity:
            return False
        if s > left:
            used, left = used + 1, capacity
        left -= s
    return used <= n


def brute_capacity(sizes, n):
    low, high = 1, sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if greedy(sizes, mid, n) else (mid + 1, high)
    return low


def cells_of(sizes):
    ends, at = [], 0
    for s in sizes:
        at += s
        ends.append(at)

    def read(width, within):
        found = defaultdict(list)
        for e in ends:
            if within is None or (e - 1) // within[0] in within[1]:
                found[(e - 1) // width].append(e)
        return [(min(x), max(x), len(x)) for x in found.values()]
    return ends, read


@pytest.mark.parametrize("seed", range(12))
def test_capacity_is_the_smallest(seed, monkeypatch):
    monkeypatch.setattr(op, "SPANS", 32)  # many rounds of finer spans
    rnd = random.Random(seed)
    sizes = [rnd.choice([16, 17, rnd.randint(16, 5000), 200]) for _ in range(rnd.randint(1, 3000))]
    if seed % 3 == 0:
        sizes.insert(0, sum(sizes) // 2)
    n = rnd.choice([1, 2, 7, 40])
    ends, read = cells_of(sizes)
    capacity, cuts = minimax_cuts(Ends(ends[-1], read), ends[-1], max(sizes), n)
    assert capacity == brute_capacity(sizes, n)
    edges = [0, *cuts, ends[-1]]
    assert len(cuts) == n - 1 and edges == sorted(edges)
    assert set(cuts) <= {0, *ends}
    assert max(b - a for a, b in zip(edges, edges[1:])) <= capacity


def order_of(groups, share):
    return sorted(groups.items(), key=lambda g: (g[1] < share, -g[1] if g[1] >= share else 0,
                                                 g[0]))


def check(rows, out, n):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    groups, owner = Counter(), defaultdict(list)
    for _, t in rows:
        b = (t or "").encode()
        groups[hashlib.sha256(b).digest()] += len(b) + 16
    total = sum(groups.values())
    ordered = order_of(groups, max(1, total // n))
    capacity = brute_capacity([s for _, s in ordered], n)
    shards = defaultdict(list)
    for r in out:
        shards[r.shard].append(r)
    for k, found in shards.items():
        assert 0 <= k < n
        assert sum(r.size for r in found) <= capacity
        assert sorted(r.slot for r in found) == list(range(len(found)))
    # Each text in one shard, shards ascending in the order of the groups.
    by_id = defaultdict(set)
    for r in out:
        by_id[r.doc_id, r.size, r.text_crc32].add(r.shard)
    place = {}
    for d, t in rows:
        b = (t or "").encode()
        place.setdefault(hashlib.sha256(b).digest(), set()).update(
            by_id[d, len(b) + 16, zlib.crc32(b)])
    run = [place[g] for g, _ in ordered]
    assert all(len(s) == 1 for s in run)
    assert [min(s) for s in run] == sorted(min(s) for s in run)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = shard_documents(docs).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], out, 40)
    assert {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}


def test_odd_documents(spark, monkeypatch):
    monkeypatch.setattr(op, "UNROLL", 3)
    rows = [(1, "a"), (2, "a"), (2, "a"), (2, "a"), (2, "a"), (2, "a"), (2, "a"), (2, "a"),
            (3, None), (4, ""), (None, "b"), (None, None), (None, "b"),
            (5, "long " * 40_000), (6, "ü€𐍈")]
    schema = "doc_id long, text string, shard string, SALT int, digest string"
    for n in (1, 2, 40):
        out = shard_documents(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema),
                              n_shards=n)
        assert out.columns[:2] == ["doc_id", "size"]
        found = out.collect()
        by = Counter((r.doc_id, r.size) for r in found)
        assert by == Counter((d, len((t or "").encode()) + 16) for d, t in rows)
        assert len({r.shard for r in found if r.size == 16}) == 1
        assert len({r.shard for r in found if r.size == 17}) <= 2
        for k in {r.shard for r in found}:
            slots = sorted(r.slot for r in found if r.shard == k)
            assert slots == list(range(len(slots))) and 0 <= k < n


def test_hot_text(spark):
    rows = [(i, "same words again" if i % 3 else f"text {i} " * (i % 17)) for i in range(900)]
    check(rows, shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect(),
          40)


def test_empty_table(spark):
    out = shard_documents(spark.createDataFrame([], "doc_id long, text string"))
    assert out.collect() == [] and "slot" in out.columns
