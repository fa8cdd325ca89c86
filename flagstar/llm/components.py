"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstar.llm.common import Saved, ship

MAX_ROUNDS = 60  # the method needs about log2(longest path) squared at worst
CHUNK = 500_000  # nodes held at once by a task's union-find
PER_TASK = 200_000

ship(__name__)


def _mins(edges: DataFrame) -> DataFrame:
    """Every node's least neighbour, itself included: (u, m)."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _forest(batches):
    """Edges of a task as stars: union-find over at most CHUNK edges at a time."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def stars():
        rows = [(x, r) for x in parent if (r := root(x)) != x]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], names=["u", "v"])

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            parent.setdefault(u, u)
            parent.setdefault(v, v)
            a, c = root(u), root(v)
            if a != c:
                parent[max(a, c)] = min(a, c)
        if len(parent) >= CHUNK:
            yield stars()
    yield stars()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (node, label) for every node that has a link; the
    label is the least node of its component.

    Each round links every node to the least node it can see, first among its
    larger, then its smaller neighbours, so paths shorten and components end as
    stars; a union-find over what a task holds anyway (CHUNK nodes at most)
    shortens them further. Per-node minima are aggregated before the shuffle
    and joined back, so a node with very many links is never gathered in one
    place. Rounds are written tables, in tasks of about PER_TASK edges: no
    lineage grows, a lost executor costs one round at most.
    """
    plain = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    now = Saved(spark, plain.mapInArrow(_forest, "u long, v long"), "cc-0")
    before = None
    for i in range(1, MAX_ROUNDS):
        edges = now.df
        n = edges.count()
        few = lambda df: df.coalesce(1 + n // PER_TASK)  # noqa: B023, E731
        both = few(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        large = few(both.join(_mins(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = few(large.where("u <> v").distinct())
        mins = _mins(large)
        small = large.join(mins, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = few(small.unionByName(mins.select("u", F.col("m").alias("v"))).where("u <> v"))
        after = Saved(spark, few(small.mapInArrow(_forest, "u long, v long").distinct()), f"cc-{i}")
        mark = after.df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        now.drop()
        now = after
        if before == (mark["n"], mark["h"]):
            break
        before = (mark["n"], mark["h"])
    else:
        raise RuntimeError("components did not settle")
    stars = now.df.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())
