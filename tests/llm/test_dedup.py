"""MinHash, embedding and line dedup against brute force, and odd inputs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferry.llm.components import components
from ferry.llm.op1_embeddings import near_vectors
from ferry.llm.op7_minhash import BLOCK, _block_pairs, _sides, near_duplicates
from ferry.llm.op10_lines import chunk_key, chunk_lines, dedup_lines

SF = "/root/testdata/sf0.01"


def groups(n, links):
    low = list(range(n))

    def find(x):
        while low[x] != x:
            low[x] = low[low[x]]
            x = low[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def brute_sets(rows, width):
    out = {}
    for doc_id, text in rows:
        w = (text or "").encode().lower().split()
        k = min(width, len(w))
        out[doc_id] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set()
    return out


def brute_components(sets, percent=80):
    ids = sorted(sets)
    at = {}
    for i in ids:
        for s in sets[i]:
            at.setdefault(s, []).append(i)
    pairs = {(a, b) for xs in at.values() for k, a in enumerate(xs) for b in xs[k + 1:]}
    place = {i: k for k, i in enumerate(ids)}
    links = [(place[a], place[b]) for a, b in pairs
             if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: ids[c] for i, c in zip(ids, groups(len(ids), links), strict=True)}


def test_minhash_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets = brute_sets([(r.doc_id, r.text) for r in docs.collect()], 4)
    want = brute_components(sets)
    got = near_duplicates(docs, width=4).collect()
    assert len(got) == len(sets)
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (
            len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert sum(not r.kept for r in got) > 50


def test_minhash_chain_large_group_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    vocab = [f"w{i}" for i in range(4000)]
    base = list(rng.choice(vocab, 120))
    rows = []
    for i in range(400):  # a chain of edits: the ends are not similar
        if i % 4 == 0 and i:
            base[int(rng.integers(0, 120))] = f"x{i}"
        rows.append((i, " ".join(base)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one two"), (1004, "One TWO"),
             (1005, "one two three"), (1006, "a b c d"), (None, "one two"), (1007, "a b c d"),
             (1007, "a b c d"), (1008, "é É"), (1009, "É é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn(
        "component_id", F.lit("clash"))
    got = near_duplicates(docs, width=4).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    want = brute_components(brute_sets([r for r in rows if r[0] is not None], 4))
    for i, r in by.items():
        if i is not None:
            assert r.component_id == want[i], i
    assert len({want[i] for i in range(400)}) < 40
    assert by[1000].n_shingles == by[1002].n_shingles == 0
    assert by[1004].component_id == 1003 and by[1005].component_id == 1005
    assert by[1009].component_id == 1009 and by[None].kept


def test_minhash_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).collect() == []


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)]
    got = {r.id: r.component for r in components(
        spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 200)}}


def brute_vectors(rows, threshold=0.93):
    ok = {}
    for i, v, label in rows:
        if label is not None and v is not None and len(v) and None not in v:
            a = np.array(v, float)
            if np.isfinite(a).all() and a.any():
                ok[i] = (label, a / np.abs(a).max())
    ids = sorted(i for i, _, _ in rows)
    links, n = [], dict.fromkeys(ids, 0)
    for a in ok:
        for b in ok:
            if a < b and ok[a][0] == ok[b][0] and len(ok[a][1]) == len(ok[b][1]):
                x, y = ok[a][1], ok[b][1]
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links.append((ids.index(a), ids.index(b)))
                    n[a] += 1
                    n[b] += 1
    return n, {i: ids[c] for i, c in zip(ids, groups(len(ids), links), strict=True)}


def test_vectors_match_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    n, comp = brute_vectors([tuple(r) for r in rows.collect()])
    got = near_vectors(rows).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {
        i: (n[i], comp[i], comp[i] == i) for i in n}


def test_vectors_large_groups_and_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = []
    centre = rng.normal(size=16)
    for i in range(300):  # one dense group: every beam starts full of links
        rows.append((i, (centre + rng.normal(size=16) * 0.05).tolist(), 1))
    for i in range(300, 700):
        rows.append((i, rng.normal(size=16).tolist(), i % 2 + 1))
    rows += [(800 + i, [1.0, 0.0], 1) for i in range(50)]  # equal vectors, another length
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [float("nan")] * 16, 1),
             (904, [float("inf")] + [1.0] * 15, 1), (905, [None] + [1.0] * 15, 1),
             (906, centre.tolist(), None), (907, (centre * 1e200).tolist(), 1),
             (908, (centre * 1e-200).tolist(), 1)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    n, comp = brute_vectors(rows)
    for shard in (8192, 200):  # one shard per label, and several
        monkeypatch.setattr("ferry.llm.op1_embeddings.SHARD", shard)
        got = near_vectors(data.withColumn("n_links", F.lit(0))).collect()
        assert len(got) == len(rows)
        found = sum(r.n_links for r in got)
        assert found >= 0.98 * sum(n.values()) and found <= sum(n.values())
        assert all(r.n_links <= n[r.vec_id] for r in got)
        assert {r.vec_id: r.component_id for r in got} == comp


def test_vectors_empty(spark):
    assert near_vectors(spark.createDataFrame(
        [], "vec_id long, embedding array<float>, label int")).collect() == []


def brute_lines(rows):
    first, count = {}, {}
    for i, text in rows:
        if i is None:
            continue
        for c in chunk_lines(text or ""):
            k = chunk_key(c)
            if k:
                count[k[1]] = count.get(k[1], 0) + 1
                first[k[1]] = min(first.get(k[1], i), i)
    out = []
    for i, text in rows:
        keep, seen = [], set()
        for c in chunk_lines(text or ""):
            k = chunk_key(c)
            if i is not None and k and count[k[1]] > 1:
                if first[k[1]] != i or k[1] in seen:
                    continue
                seen.add(k[1])
            keep.append(c)
        new = "".join(keep)
        out.append((i, text if len(new) == len(text or "") else new.rstrip("\n")))
    return sorted(out, key=repr)


def test_lines_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = dedup_lines(docs).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == brute_lines(rows)
    assert got[0].asDict().keys() == set(docs.columns)
    assert all(r.n_chars == len(r.text) for r in got)


def test_lines_shifted_passage_and_odd_rows(spark):
    rng = np.random.default_rng(8)
    line = lambda: " ".join(rng.choice([f"w{i}" for i in range(500)], 9)) + "."
    passage = [line() for _ in range(40)]
    rows = [(i, "\n".join([line() for _ in range(i % 7)] + passage + [line()]))
            for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "x"), (None, "\n".join(passage)),
             (104, "\n".join(passage) + "\n"), (104, "\n".join(passage) + "\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn(
        "line_id", F.lit(1)).withColumn("hash", F.lit("clash"))
    got = dedup_lines(docs).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == brute_lines(rows)
    left = {r.doc_id: r.text for r in got}
    assert len(left[0]) > 40 * 20
    # Everywhere else most of the passage is gone, wherever it began.
    assert all(sum(p in left[i] for p in passage) <= 8 for i in range(1, 60))
    assert left[None] == "\n".join(passage) and left[103] == "x"


@pytest.mark.parametrize("text", ["", "\n", "a", "a\n", "\n\na\n\n\nb\n", "a\nb\nc\nd\ne\nf"])
def test_chunks_join_to_the_text(text):
    assert "".join(chunk_lines(text)) == text


def test_lines_shared_runs_go_at_their_own_edges(spark):
    rng = np.random.default_rng(12)
    line = lambda n=12: " ".join(rng.choice([f"w{i}" for i in range(5000)], n)) + "."
    runs = [[line() for _ in range(2 + k % 3)] for k in range(60)]
    rows = []
    for i in range(240):  # every run in four texts, between other lines each time
        own = [[line(int(rng.integers(3, 15))) for _ in range(int(rng.integers(1, 4)))]
               for _ in range(2)]
        rows.append((i, "\n".join(own[0] + runs[i % 60] + own[1])))
    rows += [(r.doc_id + 1000, r.text) for r in
             spark.read.parquet(f"{SF}/documents.parquet").filter("text IS NOT NULL").collect()]
    # Runs of two or more lines that several texts share, found without chunks.
    where = {}
    for i, text in rows:
        lines = [x for x in text.split("\n") if x.strip()]
        for pair in zip(lines, lines[1:], strict=False):
            where.setdefault(pair, set()).add(i)
    shared = {x for pair, ids in where.items() if len(ids) > 1 for x in pair
              if len(x.split()) >= 8}
    assert len(shared) >= sum(map(len, runs))
    left = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    count = dict.fromkeys(shared, 0)
    for r in left:
        for x in r.text.split("\n"):
            if x in count:
                count[x] += 1
    assert set(count.values()) == {1}
    # A line that one text alone holds stays.
    texts = {r.doc_id: r.text for r in left}
    assert all(rows[i][1].split("\n")[0] in texts[i] for i in range(240))


# ------------------------------------------------ keys of one large component

def test_one_component_is_not_paired_with_itself(spark):
    n, few = 40 * BLOCK, 10
    node = spark.createDataFrame(
        [(k, 0, i, 0 if i < n else i) for k in range(3) for i in range(n + few)]
        + [(9, 0, i, 5) for i in range(200)], "key long, band int, id long, component long")
    rows = _sides(node)
    assert rows.filter("key = 9").count() == 0  # one component: nothing to do
    blocks = rows.select("key", "main", "block", "n_main", "n_other").distinct()
    pairs = _block_pairs(blocks)
    # Each of the outsiders' blocks (one a key) meets the main ones and itself.
    assert pairs.count() <= 3 * (40 + 1)
    assert pairs.filter("to_main").count() == 3 * 40
    # Many components: every pair of blocks is looked at once.
    node = spark.createDataFrame([(1, 0, i, i % 500) for i in range(8 * BLOCK)],
                                 "key long, band int, id long, component long")
    blocks = _sides(node).select("key", "main", "block", "n_main", "n_other").distinct()
    assert _block_pairs(blocks).count() <= 8 * 9 // 2 + 8


def test_near_template_documents_with_outsiders(spark):
    import random

    rnd = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(1500):
        t = list(words)
        t[rnd.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(t)))
    for i in range(1500, 1510):  # same keys, other documents
        rows.append((i, " ".join(words[:40] + [f"y{i}-{k}" for k in range(20)])))
    got = {r.doc_id: r.component_id for r in near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), width=1).collect()}
    sets = brute_sets(rows, 1)
    links = [(a, b) for a in range(1510) for b in range(max(a + 1, 1490), 1510)
             if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    links += [(0, b) for b in range(1, 1500)
              if 100 * len(sets[0] & sets[b]) >= 80 * len(sets[0] | sets[b])]
    assert [got[i] for i in range(1510)] == groups(1510, links)
