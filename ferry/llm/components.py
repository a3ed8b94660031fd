"""Connected components of a link table, without ever gathering a group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import materialise


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(low, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _settled(e: DataFrame) -> bool:
    """Whether every node has one parent and no parent has one itself."""
    ends = (e.select(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("parent"))
            .unionByName(e.select(F.col("v").alias("x"), F.lit(0).alias("child"),
                                  F.lit(1).alias("parent"))))
    return (ends.groupBy("x").agg(F.sum("child").alias("c"), F.max("parent").alias("p"))
            .filter("c > 1 OR c > 0 AND p > 0").isEmpty())


def components(links: DataFrame, known: DataFrame | None = None,
               max_rounds: int = 60) -> DataFrame:
    """From links ``(u, v)`` (longs): one row ``(id, component)`` per node
    that is not itself the smallest of its component.

    Large-star and small-star steps alternate until every link points at its
    component's smallest node. Minima are aggregated before the shuffle, so a
    node with very many links costs no single task; each round is written to
    the shared folder and read back. ``known`` is an earlier result to which
    ``links`` are added: only the roots that they join are worked on.
    """
    if known is not None:
        for end in ("u", "v"):
            root = known.select(F.col("id").alias(end), F.col("component").alias("root"))
            links = links.join(root, end, "left").withColumn(
                end, F.coalesce("root", end)).drop("root")
    e = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    e = materialise(e.distinct(), "links")
    for _ in range(max_rounds):
        if _settled(e):
            break
        e = materialise(_small_star(_large_star(e)), "links")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    found = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    if known is None:
        return found
    moved = found.select(F.col("id").alias("component"), F.col("component").alias("to"))
    return materialise(known.join(moved, "component", "left").select(
        "id", F.coalesce("to", "component").alias("component"))
        .unionByName(found), "components")
