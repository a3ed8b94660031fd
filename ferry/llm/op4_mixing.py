"""Mixing sources to target weights by temperature.

Source ``s`` with token share ``p`` gets weight ``p ** a / sum(p ** a)``. The
exponent ``a`` in [0, 1] is bisected: it is the largest one whose weights have
at least the target entropy (a fraction of the entropy of equal weights), but
not below the one at which the most repeated source reaches the repetition
limit; with a limit alone it is that one, with neither 1 (the shares as they
are). Every bisection round is one aggregate over the source table that
evaluates a grid of exponents, so the table is never collected.

The weights are realised as block permutations under a token budget: a source
with quota ``q`` tokens and size ``n`` gives ``q div n`` whole blocks, each a
seeded permutation of all its documents, and one last block cut where its
running token sum reaches ``q mod n`` (the document that crosses it is in).
The order inside block ``b`` is that of ``md5(seed:b:id)``. Without a budget,
the budget is the smallest that uses every document at least once.

The cut of a last block is one key per source. It is found from token sums of
key prefixes, prefixes as long as the source is large (some thousand documents
each), and from the documents of one prefix; no source is ever in one task.

Defined results: a null source is a source of its own; a null text or one
without words has no tokens; a source without tokens has weight 0 and gives
one whole block; rows with the same id have the same key and are in or out
together; a null id is an empty one in the key; an empty table gives an empty
mix; other columns pass through ``mix_documents``, whose added columns take
the names asked for (columns with those names give way; the id, text or source
cannot). Texts of any length are only counted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import SPACE, fresh, materialise

# Documents aimed at in one key prefix; digits of the exponent.
PREFIX_DOCS = 4096
DIGITS = 6
GRID = 16
ROUNDS = 10


def count_words(text: Column) -> Column:
    """Words of a text (null: 0)."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    return (F.size(parts) - F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0)
            - F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
            ).cast("long")


def _key(seed: int, block: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), block.cast("string"),
                             F.coalesce(doc_id.cast("string"), F.lit(""))))


def _bisect(shares: DataFrame, keep_going) -> float:
    """The largest ``a`` in [0, 1] for which ``keep_going(a, row)`` holds,
    0 if none; ``row`` has z = sum(p**a), e = sum(p**a ln p), low, high."""
    lo, hi = 0.0, 1.0
    for k in range(ROUNDS):
        grid = [lo + (hi - lo) * i / GRID for i in range(1, GRID + (k == 0))]
        power = F.pow("p", "a")
        rows = (shares.select("p", F.explode(F.array(*map(F.lit, grid))).alias("a"))
                .groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.log("p")).alias("e"),
                                  F.min("p").alias("low"), F.max("p").alias("high")).collect())
        holds = {r.a: keep_going(r.a, r) for r in rows}
        if k == 0 and holds[1.0]:
            return 1.0
        step = (hi - lo) / GRID
        lo = max([lo, *(a for a in grid if holds[a])])
        hi = min(hi, lo + step)
    return lo


def mixing_weights(sizes: DataFrame, target_entropy: float | None = None,
                   max_repetition: float | None = None,
                   budget_tokens: int | None = None) -> DataFrame:
    """From ``(source, tokens, n_docs)``: the same with ``weight``, ``quota``
    (tokens), ``whole`` blocks and ``rest`` tokens of the last block."""
    total = sizes.agg(F.sum("tokens").alias("t"), F.count_if(F.col("tokens") > 0).alias("n"),
                      ).first()
    if not total.t:
        return sizes.withColumns({"weight": F.lit(0.0), "quota": F.lit(0).cast("long"),
                                  "whole": F.lit(1).cast("long"), "rest": F.lit(0).cast("long")})
    shares = sizes.filter("tokens > 0").select((F.col("tokens") / F.lit(float(total.t))).alias("p"))
    if target_entropy is None and max_repetition is None:
        a = 1.0
    else:
        a = 0.0
    if target_entropy is not None:
        aim = target_entropy * math.log(total.n) - 1e-12
        a = _bisect(shares, lambda x, r: math.log(r.z) - x * r.e / r.z >= aim)
    if max_repetition is not None:
        def over(x, r):
            if budget_tokens is None:
                return (r.high / r.low) ** (1 - x) > max_repetition
            return r.low ** (x - 1) / r.z * budget_tokens / total.t > max_repetition
        a = max(a, _bisect(shares, over))
    a = round(a, DIGITS)
    scaled = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / float(total.t), F.lit(a)))
    z = sizes.agg(F.sum(scaled).alias("z"), F.max(F.col("tokens") / scaled).alias("m")).first()
    weight = F.coalesce(scaled / z.z, F.lit(0.0))
    budget = float(budget_tokens) if budget_tokens is not None else z.m * z.z
    quota = F.round(weight * budget).cast("long")
    return (sizes.withColumn("weight", weight).withColumn("quota", quota)
            .withColumn("whole", F.when(F.col("tokens") > 0, F.expr("quota div tokens"))
                        .otherwise(1))
            .withColumn("rest", F.when(F.col("tokens") > 0, F.expr("quota % tokens"))
                        .otherwise(0)))


def _cutoffs(thin: DataFrame, weights: DataFrame, seed: int) -> DataFrame:
    """``weights`` with ``cutoff``: the last block holds the keys below it."""
    length = F.greatest(F.lit(0), F.ceil(F.log(F.col("n_docs") / PREFIX_DOCS)
                                         / math.log(16))).cast("int")
    need = weights.filter("rest > 0").select(
        F.col("source").alias("s"), "whole", "rest", length.alias("len"))
    keyed = thin.join(need, thin.source.eqNullSafe(need.s)).select(
        "s", "rest", "len", "tokens", _key(seed, F.col("whole"), F.col("id")).alias("key"))
    keyed = keyed.withColumn("prefix", F.substr("key", F.lit(1), F.col("len")))
    sums = keyed.groupBy("s", "prefix", "rest").agg(F.sum("tokens").alias("t"))
    run = Window.partitionBy("s").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    edge = (sums.withColumn("before", F.coalesce(F.sum("t").over(run), F.lit(0)))
            .filter("before < rest AND before + t >= rest")
            .select(F.col("s").alias("es"), F.col("prefix").alias("ep"), "before"))
    keys = (keyed.join(edge, keyed.s.eqNullSafe(edge.es) & (keyed.prefix == edge.ep))
            .groupBy("s", "prefix", "rest", "before", "key").agg(F.sum("tokens").alias("t")))
    inside = Window.partitionBy("s").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    cut = (keys.withColumn("at", F.col("before") + F.coalesce(F.sum("t").over(inside), F.lit(0)))
           .groupBy("s", "prefix").agg(F.min(F.when(F.col("at") >= F.col("rest"), F.col("key")))
                                       .alias("k"))
           # Keys are hexadecimal, so prefix || 'g' lies above all of them.
           .select("s", F.coalesce("k", F.concat("prefix", F.lit("g"))).alias("cutoff")))
    return weights.join(cut, weights.source.eqNullSafe(cut.s), "left").drop("s")


def source_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", target_entropy: float | None = None,
                max_repetition: float | None = None, budget_tokens: int | None = None,
                seed: int = 7) -> DataFrame:
    """One row per source: tokens, n_docs, weight, quota, whole, rest, cutoff."""
    thin = materialise(docs.select(
        F.col(f"`{source_col}`").alias("source"), F.col(f"`{id_col}`").alias("id"),
        count_words(F.col(f"`{text_col}`")).alias("tokens")), "mix-sizes")
    sizes = materialise(thin.groupBy("source").agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("n_docs")), "mix-sources")
    weights = materialise(mixing_weights(sizes, target_entropy, max_repetition, budget_tokens),
                          "mix-weights")
    return materialise(_cutoffs(thin, weights, seed), "mix-plan")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", target_entropy: float | None = None,
                  max_repetition: float | None = None, budget_tokens: int | None = None,
                  seed: int = 7, block_col: str = "block",
                  key_col: str = "order_key") -> DataFrame:
    """The rows of ``docs`` in the mix, once per block they are in, with the
    block's number and the key that orders a block (columns of ``docs`` with
    those names give way). Texts are not shuffled: the plan has one row per
    source and is joined to them."""
    taken = {block_col.lower(), key_col.lower()}
    if taken & {id_col.lower(), text_col.lower(), source_col.lower()}:
        raise ValueError(f"{block_col}, {key_col}: one is the id, text or source")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken])
    plan = source_plan(docs, id_col, text_col, source_col, target_entropy, max_repetition,
                       budget_tokens, seed)
    s, w, c = (fresh(docs, n) for n in ("mix_source", "mix_whole", "mix_cutoff"))
    plan = plan.select(F.col("source").alias(s), F.col("whole").alias(w),
                       F.col("cutoff").alias(c))
    doc_id = F.col(f"`{id_col}`")
    joined = docs.join(plan, F.col(f"`{source_col}`").eqNullSafe(F.col(s)))
    last = F.coalesce(_key(seed, F.col(w), doc_id) < F.col(c), F.lit(False))
    blocks = F.col(w) + last.cast("long")
    out = joined.withColumn(block_col, F.explode(F.when(
        blocks > 0, F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(
        F.array().cast("array<bigint>"))))
    return out.withColumn(key_col, _key(seed, F.col(block_col), doc_id)).drop(s, w, c)
