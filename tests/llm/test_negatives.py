"""Hard negatives against brute force over all rows."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from ferry.llm import op11_negatives as op
from ferry.llm.op11_negatives import MultiIndex, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, windows string, row int"


def brute(rows, every=100, k=5):
    """rows: (id, vector, label). Result rows as tuples, counted."""
    good = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows
            if y is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    last = 1 << 63
    for n, (a, va, ya) in enumerate(good):
        if a is None or a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), last if i is None else i, y, m)
                        for m, (i, v, y) in enumerate(good) if m != n and len(v) == len(va))
        name = lambda i: None if i == last else i
        for p, pid, _, _ in [s for s in scored if s[2] == ya][:k]:
            inside = [s for s in scored if s[2] != ya and 80 * -p <= 100 * -s[0] <= 100 * -p]
            for r, s in enumerate(inside[:k], 1):
                out[a, name(pid), r, name(s[1]), -p, -s[0]] += 1
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, y, "w", 1) for i, v, y in rows], SCHEMA)
    return Counter(tuple(r) for r in hard_negatives(df, **kw).collect())


def made(rnd, n, dim, clusters=0):
    if clusters:
        centre = rnd.normal(size=(clusters, dim))
        v = centre[rnd.integers(clusters, size=n)] + 0.2 * rnd.normal(size=(n, dim))
    else:
        v = rnd.normal(size=(n, dim))
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
    return v


@pytest.mark.parametrize("clusters,dim", [(0, 64), (20, 16), (3, 1), (8, 5)])
def test_equals_brute_force(spark, monkeypatch, clusters, dim):
    rnd = np.random.default_rng(clusters)
    v = made(rnd, 700, dim, clusters)
    v[100:140] = v[0]  # ties
    rows = [(i, [float(x) for x in v[i]], int(rnd.integers(4))) for i in range(700)]
    want = brute(rows, every=20)
    assert run(spark, rows, every=20) == want
    monkeypatch.setattr(op, "SHARD", 100)
    monkeypatch.setattr(op, "SLICE", 9)
    assert run(spark, rows, every=20) == want
    assert len(want) > 100


def test_walk_gives_every_row_once_in_falling_bounds():
    rnd = np.random.default_rng(1)
    v = np.floor(256 * made(rnd, 5000, 24, 30).astype(np.float64))
    index = MultiIndex(v)
    for a in v[:20]:
        first, second = index.bounds(a[None, :])
        seen, last = [], np.inf
        for bound, at in index.walk(first[0], second[0]):
            scores = index.scores(at, a)
            assert scores.max() <= last  # what came before bounded these
            assert (scores == index.vectors[at] @ a).all()
            seen += at.tolist()
            last = bound
        assert sorted(seen) == list(range(5000))


def test_walk_ends_early_on_clustered_vectors():
    rnd = np.random.default_rng(2)
    v = np.floor(256 * made(rnd, 20000, 16, 40).astype(np.float64))
    index = MultiIndex(v)
    ids = np.arange(20000)
    asked = v[:10]
    first, second = index.bounds(asked)
    seen = 0

    def allowed(at):
        nonlocal seen
        seen += len(at)
        return np.ones(len(at), bool)

    for n in range(10):
        (found,) = op.best_in_window(index, ids[index.order], allowed, asked[n], first[n],
                                     second[n], [(-(1 << 63), (1 << 63) - 1)], 5)
        scores = v @ asked[n]
        want = sorted(zip((-scores).astype(int).tolist(), ids.tolist()))[:5]
        assert found == want
    assert seen < 10 * 20000 / 2


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (100, [1.0, 0.4], 2), (None, [0.9, 0.4], 2),
            (None, [0.9, 0.5], 1), (1, None, 1), (2, [nan, 1.0], 1), (3, [inf, 1.0], 2),
            (4, [None, 1.0], 1), (5, [], 1), (6, [0.9, 0.4], None), (8, [0.9, 0.4], 2),
            (9, [0.9, 0.4], 3), (9, [0.9, 0.4], 3), (200, [-1.0, 0.0], 1), (10, [1.0], 1),
            (11, [1.0], 2), (300, [1.0], 1), (400, [0.0, 0.0], 3), (12, [1e30, -1e30], 1),
            (500, [3e14, 1.0], 2)]
    rows = [(i, v and [x if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows]
    cap = (1 << 63) - 1
    want = Counter()
    for key, n in brute(rows).items():
        want[key] += n
    got = run(spark, rows)
    small = lambda c: {k: n for k, n in c.items() if max(map(abs, k[4:])) < cap}
    assert small(got) == small(want)


def test_empty_table(spark):
    out = hard_negatives(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))
    assert out.collect() == []
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
