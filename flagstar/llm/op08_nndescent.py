"""Approximate nearest neighbours: NN-descent graph, greedy graph search.

Nearness is the inner product. Equal vectors are one node (a node keeps its
smallest ids, as many as a result can show). For the graph, a coordinate is
added that makes all norms equal, so that near in the graph means near in
angle; searches use the plain inner product.

* Start: nodes are dealt to blocks of about ``BLOCK`` by two random-projection
  trees fitted on a bounded sample (``TREE_SAMPLE``), leaves cut further by a
  hash where they are large; each node takes its best in either block. The
  first tree's blocks go on as units of work, the second's neighbours lead out
  of them.
* NN-descent: the neighbours of a node's neighbours (and of those it is a
  neighbour of) are its next candidates. The joins run by block: the distinct
  neighbours of a block's nodes, then their distinct neighbours, then these
  candidates' vectors, which meet the block's nodes in one matrix product. A
  node that very many others have as neighbour counts once per block.
* Search: each query starts from its own node's neighbours and moves to the
  neighbours of the best ``BEAM`` it has seen, until no query's ``k`` best
  change. Queries of a block move together and share what they look at.

Vectors travel as a direction in single precision and a norm in double, and are
compared in double precision; the graph's nearness is the (negative) distance
with the added coordinate taken in by differences, so that one very long vector
doesn't blur the others. The ``HUBS`` longest vectors are met by every query, as
they are near in inner product but far in angle or distance. The ``KEEP`` best
of each query are scored again on the original vectors. Every
block, candidate list and vector goes through joins; the driver only sees the
sample and counters. A block's candidates are at most BLOCK x SPREAD x 2 x SPREAD,
whatever the number of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flagstar.llm.common import Saved, ship, table

ship(__name__)

K = 24  # neighbours in the graph
SPREAD = 8  # of which so many lead on while the graph is built
BLOCK = 512
TREE_SAMPLE = 20_000
ROUNDS = 3
BEAM = 48
KEEP = 48
HUBS = 64
MAX_HOPS = 8
SEED = 13

_NEAR = "node long, ids array<long>, scores array<double>, changed int"


# ------------------------------------------------------------------- nodes


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and x (array of double) of rows that take part: id and vector not
    null, no null or non-finite component, not all zero, and of the length that
    most rows have (ties: the longer)."""
    x = F.col("x")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"))
    fine = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(F.coalesce(fine, F.lit(False)))
    top = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("x") == (top["d"] if top else 0)).distinct()


def _first_copies(rows: DataFrame, k: int) -> DataFrame:
    """(node, vec_id) for the k + 1 smallest ids of each node; ranked with a
    salt first, so that a vector that very many rows share is cut in parts."""
    parts = rows.withColumn("_salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    for keys in (["node", "_salt"], ["node"]):
        parts = parts.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy("vec_id"))).where(F.col("_r") <= k + 1).drop("_r")
    return parts.select("node", "vec_id")


# ---------------------------------------------------------------- projection


def _tree(sample: np.ndarray, depth: int, seed: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A direction per level and thresholds per inner node, medians of the sample."""
    directions = np.random.default_rng(seed).standard_normal((max(depth, 1), sample.shape[1]))
    codes, cuts = np.zeros(len(sample), dtype=np.int64), []
    for level in range(depth):
        z = sample @ directions[level]
        cut = np.zeros(1 << level)
        for c in range(1 << level):
            mine = z[codes == c]
            cut[c] = np.median(mine) if len(mine) else 0.0
        cuts.append(cut)
        codes = codes * 2 + (z > cut[codes])
    return directions, cuts


def _augmented(x: np.ndarray, top: float) -> np.ndarray:
    """Scaled to norms of at most 1, and a coordinate that makes them all 1,
    less 1 (which moves all cuts alike and keeps what is far below 1)."""
    x = x / np.sqrt(top)
    square = (x * x).sum(axis=1)
    return np.concatenate([x, (-square / (1 + np.sqrt(np.maximum(1 - square, 0))))[:, None]], axis=1)


def _packed(x: np.ndarray) -> list[bytes]:
    """Norm (double), then direction (single)."""
    norm = np.sqrt((x * x).sum(axis=1))
    return [n.astype("<f8").tobytes() + r.tobytes() for n, r in zip(norm, (x / norm[:, None]).astype("<f4"))]


def _leaves(trees: list, top: float, width: int):
    def run(pdfs):
        for pdf in pdfs:
            plain = np.stack(pdf["x"].to_numpy()).astype(float) if len(pdf) else np.zeros((0, width))
            x = _augmented(plain, top)
            out = {"node": pdf["node"]}
            for name, (directions, cuts) in zip(("leaf", "leaf2"), trees):
                codes = np.zeros(len(x), dtype=np.int64)
                for level, cut in enumerate(cuts):
                    codes = codes * 2 + (x @ directions[level] > cut[codes])
                out[name] = codes
            yield pd.DataFrame(out | {"v": _packed(plain / np.sqrt(top))})

    return run


# -------------------------------------------------------------- block search


def _matrix(raw: pd.Series) -> np.ndarray:
    if not len(raw):
        return np.zeros((0, 1))
    rows = np.frombuffer(b"".join(raw), dtype=np.uint8).reshape(len(raw), -1)
    norm = np.ascontiguousarray(rows[:, :8]).view("<f8")
    return np.ascontiguousarray(rows[:, 8:]).view("<f4").astype(float) * norm


def _nearness(mine: np.ndarray, theirs: np.ndarray, search: bool) -> np.ndarray:
    """Inner products; for the graph, with the added coordinate and less 1."""
    s = mine @ theirs.T
    if search:
        return s
    a, b = (mine * mine).sum(axis=1)[:, None], (theirs * theirs).sum(axis=1)[None, :]
    apart = np.sqrt(np.maximum(1 - a, 0)) + np.sqrt(np.maximum(1 - b, 0))
    added = np.divide(a - b, apart, out=np.zeros_like(s), where=apart > 0)
    return s - (a + b) / 2 - added * added / 2


def _best(nodes: np.ndarray, mine: np.ndarray, others: np.ndarray, theirs: np.ndarray, k: int, itself: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of each row's k best others, padded with -1."""
    ids, scores = np.full((len(nodes), k), -1, dtype=np.int64), np.full((len(nodes), k), -np.inf)
    if not len(others):
        return ids, scores
    for at in range(0, len(nodes), 128):
        s = _nearness(mine[at : at + 128], theirs, itself)
        if not itself:
            s[nodes[at : at + 128, None] == others[None, :]] = -np.inf
        n = min(k, s.shape[1])
        top = np.argpartition(-s, n - 1, axis=1)[:, :n]
        found = np.take_along_axis(s, top, axis=1)
        order = np.lexsort((others[top], -found), axis=1)
        ids[at : at + 128, :n] = others[np.take_along_axis(top, order, axis=1)]
        scores[at : at + 128, :n] = np.take_along_axis(found, order, axis=1)
    ids[np.isneginf(scores)] = -1
    return ids, scores


def _lists(nodes, ids, scores, changed) -> pd.DataFrame:
    keep = ids >= 0
    return pd.DataFrame({
        "node": nodes, "ids": [i[m] for i, m in zip(ids, keep)], "scores": [s[m] for s, m in zip(scores, keep)], "changed": np.asarray(changed, dtype="int32"),
    })


def _start(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes, x = pdf["node"].to_numpy(), _matrix(pdf["v"])
        ids, scores = _best(nodes, x, nodes, x, k, itself=False)
        return _lists(nodes, ids, scores, np.ones(len(nodes)))

    return run


def _merge(k: int, watch: int, search: bool):
    """Members of a block and their lists, and the candidates' vectors: the k
    best of both. ``changed``: the first ``watch`` are not what they were."""

    def run(members: pd.DataFrame, cands: pd.DataFrame) -> pd.DataFrame:
        if not len(members):
            return _lists(np.zeros(0, np.int64), np.zeros((0, k), np.int64), np.zeros((0, k)), [])
        cands = cands.drop_duplicates("cand")
        nodes = members["node"].to_numpy()
        ids, scores = _best(nodes, _matrix(members["v"]), cands["cand"].to_numpy(), _matrix(cands["v"]), k, itself=search)
        old_ids, old_scores = np.full_like(ids, -1), np.full_like(scores, -np.inf)
        for i, (a, s) in enumerate(zip(members["ids"], members["scores"])):
            a, s = a[:k], s[:k]
            old_ids[i, : len(a)], old_scores[i, : len(a)] = a, s
        # the old lists' members are no candidates again unless they were met
        fresh = np.array([np.isin(x, y, invert=True) for x, y in zip(ids, old_ids)]).reshape(ids.shape) & (ids >= 0)
        all_ids, all_scores = np.concatenate([old_ids, ids], axis=1), np.concatenate([old_scores, np.where(fresh, scores, -np.inf)], axis=1)
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
        out_ids, out_scores = np.take_along_axis(all_ids, order, axis=1), np.take_along_axis(all_scores, order, axis=1)
        out_ids[np.isneginf(out_scores)] = -1
        changed = (out_ids[:, :watch] != old_ids[:, :watch]).any(axis=1)
        return _lists(nodes, out_ids, out_scores, changed)

    return run


def _step(members: DataFrame, lists: DataFrame, nodes: DataFrame, leads: DataFrame, graph: DataFrame, k: int, watch: int, search: bool) -> DataFrame:
    """One move: (block, lead) -> neighbours of the leads -> merged lists."""
    onward = graph.select(F.col("node").alias("lead"), F.explode(F.slice("ids", 1, K if search else SPREAD)).alias("cand"))
    pairs = leads.distinct().join(onward, "lead").select("block", "cand")
    pairs = pairs.unionByName(leads.select("block", F.col("lead").alias("cand"))).distinct()
    cands = pairs.join(nodes.select(F.col("node").alias("cand"), "v"), "cand").select(F.col("block").alias("to_block"), "cand", "v")
    mine = members.join(lists.select("node", "ids", "scores"), "node").select("block", "node", "v", "ids", "scores")
    return mine.groupBy("block").cogroup(cands.groupBy("to_block")).applyInPandas(_merge(k, watch, search), _NEAR)


# ------------------------------------------------------------------ operator


class Index:
    """The neighbour graph of a table of vectors. Holds every usable row."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", copies: int = 20):
        spark = self.spark = vectors.sparkSession
        rows = usable(vectors, id_col, vec_col)
        keyed = Saved(spark, rows.withColumn("_key", F.sha2(F.concat_ws(",", F.col("x").cast("array<string>")), 256)), "op8-rows").df
        # a node is named after its smallest id
        names = keyed.groupBy("_key").agg(F.min("vec_id").alias("node"))
        self.rows = Saved(spark, keyed.join(names, "_key").select("vec_id", "node"), "op8-names").df
        self.vectors = Saved(spark, keyed.join(names, "_key").where("vec_id = node").select("node", "x").dropDuplicates(["node"]), "op8-vectors").df
        self.copies = _first_copies(self.rows, copies)
        norm = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
        stats = self.vectors.agg(F.count("*").alias("n"), F.coalesce(F.max(norm), F.lit(0.0)).alias("top")).first()
        self.n, top = stats["n"], stats["top"]
        if not self.n:
            return
        sample = self.vectors.orderBy(F.xxhash64("node", F.lit(SEED)), "node").limit(TREE_SAMPLE).toPandas()
        x = _augmented(np.stack(sample["x"].to_numpy()).astype(float), top)
        depth = int(min(max(0, np.ceil(np.log2(self.n / BLOCK))), max(0, np.floor(np.log2(len(x) / 16)))))
        trees = [_tree(x, depth, SEED + t) for t in (0, 1)]
        leaves = self.vectors.mapInPandas(_leaves(trees, top, x.shape[1] - 1), "node long, leaf long, leaf2 long, v binary")
        leaves = Saved(spark, leaves, "op8-leaves").df
        # a leaf of more than BLOCK nodes becomes several blocks
        for leaf, block in (("leaf", "block"), ("leaf2", "block2")):
            sizes = leaves.groupBy(leaf).agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
            leaves = leaves.join(sizes, leaf).withColumn(block, F.concat_ws("-", leaf, F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("parts")))).drop("parts")
        self.nodes = Saved(spark, leaves.select("block", "block2", "node", "v"), "op8-nodes").df
        self.graph = self._descend()

    def _descend(self) -> DataFrame:
        spark, nodes = self.spark, self.nodes
        one, two = (nodes.select(F.col(b).alias("block"), "node", "v").groupBy("block").applyInPandas(_start(K), _NEAR) for b in ("block", "block2"))
        pairs = lambda ids, scores: F.arrays_zip(F.col(scores).alias("s"), F.col(ids).alias("i"))
        both = one.join(two.select("node", F.col("ids").alias("ids2"), F.col("scores").alias("scores2")), "node")
        best = F.slice(F.sort_array(F.array_distinct(F.concat(pairs("ids", "scores"), pairs("ids2", "scores2"))), False), 1, K)
        start = both.select("node", best.alias("b")).select("node", F.col("b.i").alias("ids"), F.col("b.s").alias("scores"), F.lit(1).alias("changed"))
        graph = Saved(spark, start, "op8-graph-0")
        nodes = nodes.drop("block2")
        for i in range(1, ROUNDS + 1):
            edges = graph.df.select("node", F.explode(F.slice("ids", 1, SPREAD)).alias("lead"))
            there = nodes.select("node", "block").join(edges, "node").select("block", "lead")
            # the other way round: blocks of those a node is a neighbour of
            back = nodes.select(F.col("node").alias("lead"), "block").join(edges, "lead").select("block", F.col("node").alias("lead"))
            leads = there.unionByName(back)
            after = Saved(spark, _step(nodes, graph.df, nodes, leads, graph.df, K, K, False), f"op8-graph-{i}")
            graph.drop()
            graph = after
        return graph.df

    def search(self, queries: DataFrame, k: int = 20) -> DataFrame:
        """``queries`` (vec_id of indexed rows) -> query_id, rank, vec_id, score.

        Each query's own row is no candidate; rows with an equal vector are.
        """
        spark = self.spark
        if not self.n:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        asked = self.rows.join(queries.select("vec_id").distinct(), "vec_id", "left_semi")
        starts = asked.select("node").distinct()
        members = Saved(spark, self.nodes.drop("block2").join(starts, "node", "left_semi"), "op8-queries").df
        keep = max(KEEP, 2 * k)
        # scores of the graph are with the added coordinate: look at all again
        empty = F.array().cast("array<long>"), F.array().cast("array<double>")
        lists = members.select("node", empty[0].alias("ids"), empty[1].alias("scores"))
        seeds = self.graph.select("node", F.explode(F.concat(F.array("node"), "ids")).alias("lead"))
        leads = members.select("node", "block").join(seeds, "node").select("block", "lead")
        square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
        hubs = [r["node"] for r in self.vectors.select("node", square.alias("s")).orderBy(F.desc("s"), "node").limit(HUBS).collect()]
        met = members.select("block").distinct().select("block", F.explode(F.array(*[F.lit(h).cast("long") for h in hubs])).alias("lead"))
        leads = leads.unionByName(met)
        for hop in range(MAX_HOPS):
            found = Saved(spark, _step(members, lists, self.nodes, leads, self.graph, keep, k + 1, True), f"op8-search-{hop}").df
            lists = found
            if not found.agg(F.coalesce(F.sum("changed"), F.lit(0)).alias("c")).first()["c"]:
                break
            moving = found.where("changed = 1").select("node", F.explode(F.slice("ids", 1, BEAM)).alias("lead"))
            leads = members.select("node", "block").join(moving, "node").select("block", "lead")
        pairs = lists.select("node", F.explode("ids").alias("near"))
        exact = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        scored = (
            pairs.join(self.vectors, "node")
            .join(self.vectors.select(F.col("node").alias("near"), F.col("x").alias("y")), "near")
            .select("node", "near", exact.alias("score"))
        )
        shown = scored.join(self.copies.withColumnRenamed("node", "near"), "near").select("node", "vec_id", "score")
        wanted = asked.select("node", F.col("vec_id").alias("query_id")).join(shown, "node").where("query_id <> vec_id")
        rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return wanted.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row of ``embeddings`` whose id 20 divides."""
    vectors = table(spark, sf_dir, "embeddings")
    return Index(vectors).search(vectors.select("vec_id").where(F.col("vec_id") % 20 == 0), 20)
