"""Near-duplicate vectors by HNSW graphs per shard.

Vectors are compared only inside their label (and length). Equal vectors are
one class with a count. The classes of a label are dealt by hash into shards
of about ``SHARD`` vectors; every shard builds one graph, and every shard is
searched by the vectors of every shard of its label (each two shards in one
direction, as a link counts for both ends). Queries travel in slices, so a
task holds one graph and one slice.

A search starts with a beam of ``BEAM``. A query whose beam is full of links
widens until its beam reaches below the threshold. Each task audits up to
``AUDIT`` of its queries against brute force and doubles all its beams until
the recall of links is at least ``RECALL``. Links are then verified by the
cosine in double precision. Tasks return, per class, the number of linked
vectors and, per task, a spanning forest of the links, whose union gives the
components.

Defined results: a vector that is null, empty, zero, or holds a null or
non-finite component links with nothing, nor does one with a null label; such
a row has no links and is its own component. Rows that share an id are
vectors of their own and the one component holds them if they link; a null id
has no component and is kept; an empty table gives an empty result; other columns
are ignored. There are no texts here; vectors of any length are compared within it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import materialise
from ferry.llm.components import components
from ferry.llm.hnsw import Graph
from ferry.session import ship_package

# Vectors per shard and slice, first beam, audited queries per
# task, least recall of an audit, slack of the search in single precision.
SHARD, SLICE = 8192, 2048
BEAM, AUDIT, RECALL = 32, 48, 0.999
SLACK = 1e-4


def _unit(v: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that very large or
    small components neither overflow nor vanish."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _build(table: pa.Table) -> pa.Table:
    label, dim, shard, shards = (table.column(c)[0].as_py() for c in ("label", "dim", "shard",
                                                                      "shards"))
    ids, keys, counts = (table.column(c).to_numpy() for c in ("id", "key", "copies"))
    order = np.lexsort((keys, ids))
    ids, keys, counts = ids[order], keys[order], counts[order]
    flat = table.column("vector").combine_chunks().flatten().to_numpy()
    vectors = _unit(flat.reshape(-1, dim).astype(np.float64)[order])
    g = Graph.build(vectors.astype(np.float32))
    rows = {name: [] for name in _SHARD_ARROW.names}

    def add(slice_, lo, hi, graph):
        rows["label"].append(label)
        rows["dim"].append(dim)
        rows["shard"].append(shard)
        rows["shards"].append(shards)
        rows["slice"].append(slice_)
        for name, xs in (("ids", ids), ("keys", keys), ("copies", counts)):
            rows[name].append(xs[lo:hi].astype(np.int64).tobytes())
        rows["vectors"].append(vectors[lo:hi].tobytes())
        rows["graph"].append([x.tobytes() for x in graph])
        rows["entry"].append(g.entry)

    add(-1, 0, len(ids), g.layers)  # the graph itself
    for k, lo in enumerate(range(0, len(ids), SLICE)):
        add(k, lo, min(lo + SLICE, len(ids)), [])
    return pa.Table.from_pydict(rows, schema=_SHARD_ARROW)


_SHARD_ARROW = pa.schema([
    ("label", pa.string()), ("dim", pa.int32()), ("shard", pa.int32()), ("shards", pa.int32()),
    ("slice", pa.int32()), ("ids", pa.binary()), ("keys", pa.binary()), ("copies", pa.binary()),
    ("vectors", pa.binary()), ("graph", pa.list_(pa.binary())), ("entry", pa.int32())])
_SHARD = ("label string, dim int, shard int, shards int, slice int, ids binary, "
          "keys binary, copies binary, vectors binary, graph array<binary>, entry int")


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position linked to each of ``n``, links being (a, b)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _search(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        graph = next(r for r in rows if r["slice"] < 0)
        query = next(r for r in rows if r["slice"] >= 0)
        dim = graph["dim"]
        read = lambda r: (*(np.frombuffer(r[x], np.int64)
                            for x in ("ids", "keys", "copies")),
                          np.frombuffer(r["vectors"], np.float64).reshape(-1, dim))
        (gi, gk, gc, gv), (qi, qk, qc, qv) = read(graph), read(query)
        g = Graph(gv.astype(np.float32),
                  [np.frombuffer(x, np.int32).reshape(len(gi), -1) for x in graph["graph"]],
                  graph["entry"])
        own = graph["shard"] == query["shard"]
        q = qv.astype(np.float32)
        floor = threshold - SLACK
        audit = np.unique(np.linspace(0, len(q) - 1, AUDIT).astype(int))
        truth = {(int(r), int(c)) for r, c in np.argwhere(q[audit] @ g.vectors.T >= floor)}
        ef = BEAM
        while True:
            found = set(zip(*(x.tolist() for x in g.within(q[audit], floor, ef)), strict=True))
            if len(found & truth) >= RECALL * len(truth) or ef >= len(gi):
                break
            ef *= 2
        r, c = g.within(q, floor, ef)
        other = qk[r] != gk[c]
        r, c = r[other], c[other]
        exact = np.einsum("xd,xd->x", qv[r], gv[c]) >= threshold
        r, c = r[exact], c[exact]
        # Inside a shard every vector asks for itself; across, both ends count.
        n_q = np.bincount(r, gc[c], len(qi)).astype(np.int64)
        n_g = np.zeros(len(gi), np.int64) if own else np.bincount(c, qc[r], len(gi)).astype(np.int64)
        ids = np.concatenate((qi, gi))
        keys, one, place = np.unique(np.concatenate((qk, gk)), return_index=True,
                                     return_inverse=True)
        links = np.bincount(place, np.concatenate((n_q, n_g)), len(keys)).astype(np.int64)
        low = _forest(len(keys), place[:len(qi)][r], place[len(qi):][c])
        some = links > 0
        return pa.Table.from_pydict({"key": keys[some], "id": ids[one][some], "links": links[some],
                                     "low": ids[one][low[some]]})
    return run


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", threshold: float = 0.93) -> DataFrame:
    """One row per row: id, ``n_links``, ``component_id``, ``kept``."""
    spark = rows.sparkSession
    ship_package(spark)
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall("vector", lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    usable = (F.col("label").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
              & finite & F.exists("vector", lambda x: x != 0))
    v = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                    F.col(f"`{label_col}`").cast("string").alias("label"), vector.alias("vector"))
    v = v.withColumn("usable", F.coalesce(usable, F.lit(False)) & F.col("id").isNotNull())
    classes = materialise(v.filter("usable").groupBy("label", "vector").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"))
        .withColumn("dim", F.size("vector")).withColumn("key", F.xxhash64("label", "vector")),
        "vector-classes")
    sizes = classes.groupBy("label", "dim").agg(
        F.ceil(F.count("*") / SHARD).cast("int").alias("shards"))
    dealt = classes.join(sizes, ["label", "dim"]).withColumn(
        "shard", F.pmod(F.xxhash64("key"), F.col("shards")).cast("int"))
    shards = materialise(dealt.groupBy("label", "dim", "shard").applyInArrow(_build, _SHARD),
                         "vector-shards")
    # Shard i searches shard j for (j - i) mod k up to k / 2, so each two meet
    # once; at exactly k / 2 only the lower one asks.
    step = F.expr("transform(sequence(0, shards div 2), d -> pmod(shard + d, shards))")
    asks = F.filter(step, lambda j: ~((F.pmod(j - F.col("shard"), F.col("shards")) * 2
                                       == F.col("shards")) & (j < F.col("shard"))))
    queries = shards.filter("slice >= 0").withColumn("asks", F.col("shard")).withColumn(
        "target", F.explode(F.array_distinct(asks))).withColumn("part", F.col("slice"))
    # A shard's graph goes wherever a slice asks for it.
    wanted = queries.select("label", "dim", "target", "asks", "part")
    graphs = (shards.filter("slice < 0").withColumn("target", F.col("shard"))
              .join(wanted, ["label", "dim", "target"]))
    both = graphs.unionByName(queries.select(graphs.columns))
    answers = materialise(both.groupBy("label", "dim", "target", "asks", "part").applyInArrow(
        _search(threshold), "key long, id long, links long, low long"), "vector-answers")
    links = answers.groupBy("key").agg(F.sum("links").alias("links"))
    comp = components(answers.filter("id <> low").select(F.col("id").alias("u"),
                                                         F.col("low").alias("v")))
    named = (classes.join(links, "key", "left").join(comp, "id", "left")
             .select("label", "vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0)))
                     .alias("n_links"), F.coalesce("component", "id").alias("component")))
    joined = v.join(named.withColumn("usable", F.lit(True)), ["label", "vector", "usable"], "left")
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
