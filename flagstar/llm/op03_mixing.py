"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a word budget (its target); whole copies of all its documents
come first, and what is left of the budget is filled by a subset of documents
whose lengths add up to it as closely as possible:

1. documents are counted by exact length (words) per source;
2. a proportional share of every length count is taken, rounded down;
3. longer lengths first, one more document each while the budget allows;
4. the last stretch of budget (at most ``DP_WINDOW`` words) is filled by a
   bounded-knapsack dynamic programme over the counts still free;
5. from each length class, the documents that come first by a seeded hash
   are taken, as many as its count says.

Only the length histogram of a source (at most one row per distinct length)
meets in one task; documents never do. The order inside a length class is
found with salted hash buckets, so a class that holds a third of all rows is
ranked by many tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flagstar.llm.common import Saved, fresh, ship, table, word_count

ship(__name__)

SEED = 20240917
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_REPEAT = 2
DP_WINDOW = 1 << 16
BUCKETS = 256

COUNTS_SCHEMA = "_key string, size long, _all long, extra long"


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT
) -> DataFrame:
    """``source, source_size, ...`` -> the same with ``weight`` and ``target``.

    Sources in code-point order (null last) take the weights in turn. Each gets
    its weight's share of ``share`` times all sizes; targets stop at
    ``max_repeat`` times the source's size and the excess is shared again by
    weight until none is above. That fixed point is ``min(cap, level * weight)``
    for one level, found in one pass over sources sorted by cap / weight. The
    windows run over one row per source.
    """
    names = sizes.withColumn("_at", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_at") - 1, F.lit(len(weights))) + 1).cast("int"))
    caps = names.withColumn("weight", cycle).withColumn("_cap", F.col("source_size") * F.lit(float(max_repeat)))
    order = W.orderBy(F.col("_cap") / F.col("weight"), "_at")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(1))
    filled = (
        caps.withColumn("_budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("_left", F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        # the level if this source and all after it are uncapped; the first
        # source below its cap fixes the level of all
        .withColumn("_level", F.col("_left") / F.col("_open"))
        .withColumn("_fits", F.col("_level") * F.col("weight") <= F.col("_cap"))
        .withColumn("_final", F.min(F.when(F.col("_fits"), F.struct(F.col("_cap") / F.col("weight"), "_at", "_level"))).over(everything))
    )
    level = F.col("_final")["_level"]
    return filled.select(
        *sizes.columns,
        "weight",
        F.when(level.isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), level * F.col("weight"))).alias("target"),
    )


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int, window: int = DP_WINDOW) -> np.ndarray:
    """How many documents of each length to take so that their words add up to
    at most ``budget`` and as near to it as the programme finds.

    ``sizes`` are distinct and positive, ``counts`` their documents. Exact
    whenever what is left after the proportional and the greedy steps is at
    most ``window`` words and the reachable sums include it.
    """
    take = np.zeros(len(sizes), dtype=np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or total == 0:
        return take
    if budget >= total:
        return counts.astype(np.int64)
    take = np.array([int(c) * budget // total for c in counts.tolist()], dtype=np.int64)
    left = budget - int((sizes * take).sum())
    order = np.argsort(-sizes, kind="stable")
    # one more of each length, longest first, until the rest fits the window
    for i in order.tolist():
        if left <= window:
            break
        more = min(int(counts[i] - take[i]), (left - window // 2) // int(sizes[i]))
        if more > 0:
            take[i] += more
            left -= more * int(sizes[i])
    # bounded knapsack over sums 0..left: one bit per reachable sum, counts in
    # binary parts, smallest sizes last so that exact ends stay reachable
    goal = min(left, window)
    mask = (1 << (goal + 1)) - 1
    reach, steps = 1, []
    for i in order.tolist():
        size, free = int(sizes[i]), int(counts[i] - take[i])
        free = min(free, goal // size)
        part = 1
        while free > 0 and not reach >> goal & 1:
            n = min(part, free)
            grown = reach | (reach << (size * n)) & mask
            if grown != reach:
                steps.append((i, n, reach))
                reach = grown
            free -= n
            part *= 2
    at = reach.bit_length() - 1
    for i, n, earlier in reversed(steps):
        if not earlier >> at & 1:
            take[i] += n
            at -= n * int(sizes[i])
    return take


def _fit_group(pdf: pd.DataFrame) -> pd.DataFrame:
    sizes, counts = pdf["size"].to_numpy(np.int64), pdf["_all"].to_numpy(np.int64)
    target = float(pdf["target"].iloc[0])
    whole = int(pdf["source_size"].iloc[0])
    copies = int(target // whole) if whole else 0
    budget = int(round(target - copies * whole))
    extra = fit_counts(sizes, counts, budget)
    return pd.DataFrame({"_key": pdf["_key"], "size": sizes, "_all": counts, "extra": extra + copies * counts})


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = SEED,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    size: Callable[[Column], Column] = word_count,
) -> DataFrame:
    """Plan of the mix, one row per input row: id, source, size, source_size,
    target and ``copies`` (0 .. MAX_REPEAT times the document is taken).

    Null texts and texts without words have size 0 and are never taken; a null
    source is a source of its own, in last place. Rows that repeat count as
    documents of their own; among equal ids any of the equal rows may be the
    one taken. An empty table gives an empty plan. Extra columns are ignored.
    """
    spark = docs.sparkSession
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        size(F.col(text_col)).alias("size"),
    )
    # the only read of the texts; all that follows moves a few small columns.
    # Joins go by _key, which a null source has too
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    base = Saved(spark, sized.withColumn("_order", F.xxhash64("doc_id", F.lit(seed))).withColumn("_key", key), "op3-sizes").df
    base = base.withColumn("_bucket", F.pmod(F.col("_order"), F.lit(BUCKETS)).cast("int"))
    by_bucket = base.groupBy("_key", "size", "_bucket").agg(F.count("*").alias("n"), F.first("source").alias("source"))
    by_size = by_bucket.groupBy("_key", "size").agg(F.sum("n").alias("_all"), F.first("source").alias("source"))
    sources = by_size.groupBy("_key").agg(F.sum(F.col("size") * F.col("_all")).alias("source_size"), F.first("source").alias("source"))
    targets = Saved(spark, source_targets(sources, weights, share), "op3-targets").df
    lengths = by_size.where("size > 0").drop("source").join(targets, "_key")
    counts = lengths.groupBy("_key").applyInPandas(_fit_group, COUNTS_SCHEMA)
    fitted = Saved(spark, counts, "op3-counts").df
    # documents of a length class come in the order of (bucket, hash, id); a
    # bucket's documents start where the smaller buckets end
    ahead = W.partitionBy("_key", "size").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = by_bucket.drop("source").withColumn("_ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    quota = starts.join(fitted, ["_key", "size"])
    rank = F.row_number().over(W.partitionBy("_key", "size", "_bucket").orderBy("_order", "doc_id"))
    ranked = base.withColumn("_rank", rank).join(quota, ["_key", "size", "_bucket"], "left")
    # `extra` counts all copies of the class: whole rounds, then the first ones again
    rounds = F.floor(F.col("extra") / F.col("_all"))
    again = F.col("extra") - rounds * F.col("_all")
    copies = F.when(F.col("extra").isNull(), 0).otherwise(rounds + F.when(F.col("_ahead") + F.col("_rank") <= again, 1).otherwise(0))
    return ranked.join(targets.drop("source"), "_key", "left").select(
        "doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies")
    )


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document of ``documents``: the words the mix takes (``taken``)."""
    plan = mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, with their own columns.

    Rows that share id, source and size share what the plan takes of them.
    """
    key = lambda *c: F.xxhash64(*c)
    plan = mix(docs).groupBy(key("doc_id", "source", "size").alias("_k")).agg(F.sum("copies").alias("_sum"), F.count("*").alias("_rows"))
    k, at, n = fresh(docs, "_mix_key"), fresh(docs, "_mix_at"), fresh(docs, "_mix_n")
    plan = plan.where("_sum > 0").withColumnsRenamed({"_k": fresh(docs, "_plan_key"), "_sum": fresh(docs, "_plan_sum"), "_rows": fresh(docs, "_plan_rows")})
    plan_key, total, rows = (F.col(c) for c in plan.columns)
    keyed = docs.withColumn(k, key(F.col("doc_id"), F.col("source").cast("string"), word_count(F.col("text"))))
    numbered = keyed.withColumn(at, F.row_number().over(W.partitionBy(k).orderBy("doc_id")))
    taken = numbered.join(plan, F.col(k) == plan_key)
    copies = F.floor(total / rows) + F.when(F.col(at) <= total % rows, 1).otherwise(0)
    many = taken.where(copies > 0).withColumn(n, F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    return many.select(*docs.columns)
