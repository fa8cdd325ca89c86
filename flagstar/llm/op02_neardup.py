"""Near-duplicate documents with an LSH forest over MinHash signatures.

Two documents are linked when their sets of five-word shingles overlap by
``SIMILARITY`` or more; linked documents form components.

* Signature: ``TREES`` independent orders of ``DEPTH`` MinHash values each.
* Equal sets are one node from the start, so exact copies cost nothing more.
* Each tree is a *sorted* list of all nodes by its signature order, range
  partitioned (ties go on by node id, so a hot region is cut like any other).
  Candidates are neighbours in that order whose longest common prefix is at
  least ``MIN_DEPTH`` values. In a sparse region that is everyone who shares
  the prefix; in a dense one the order itself brings those together that share
  the longest prefixes: the depth adapts to the region.
* A pair at similarity 0.75 misses the common prefix in all trees with
  probability (1 - 0.75 ** 2) ** 24 = 2e-9.

Round 1 links each node with its next neighbour in ``FIRST_TREES`` trees, which
joins dense groups into few components without comparing all their pairs.
Round 2 takes all trees and only pairs across components: up to ``REACH``
neighbours on, counting nodes of other components only, so a large group never
hides an outsider from it; of several of one component only the one whose sketch
agrees best is a candidate. Candidates whose 120-value sketches say that they
can't be similar are left out; every other one is confirmed on the full shingle
sets of both texts. Groups larger than that reach are connected through their
chains.

A region (tree and prefix) in which some node's reach ended before the region
did, or in which it had several candidates of one component, is *dense*. Dense regions are counted by label: one whose rows all have one
label is done. The others are compared again with the labels that the new links
gave; once a round found none, or little is left, completely: the rows of a
region meet in one task, or, in a region of more than ``BLOCK`` rows, those of
its largest label and its others are cut into blocks of about that many, and
every block of others meets every block of either in a task of its own. So the
reach only orders the work; it leaves no pair of a region out. Blocks are first
compared by sketches, which names the rows that may have a link across labels;
then those rows' full shingle sets meet, once a row and block, and only links
that join labels leave a task: fewer than its rows, however many pairs are
similar. The complete comparison holds two blocks of a region in a task; the
rounds before it still bring up to 8 * REACH rows of each partition of a region
together in one.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flagstar.llm.common import Saved, arrow_rows, fresh, ship, table
from flagstar.llm.components import components

ship(__name__)

SHINGLE = 5
SIMILARITY = (75, 100)  # 100 * intersection >= 75 * union
TREES, DEPTH, MIN_DEPTH = 24, 5, 2
FIRST_TREES = 4
REACH = 8
SKETCH_LEAST = 60  # of TREES * DEPTH
BLOCK = 2048  # rows of a region that meet those of another block at once
SLICE = 512  # rows or shingles of a block held as a dense matrix at once
RARE = 16  # shingles of at most this many rows of a block are counted by pairs
SALTS = 64
LITTLE = 8  # copies of a row that are fewer than another round costs
BATCH = 2000
SEED = 7
FILTER_BITS = 1 << 23  # fixed size of the id filter sent to the text scan

# ------------------------------------------------------------- shingle sets

_MIX = np.random.default_rng(SEED).integers(1, 1 << 63, size=512, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = _MIX[:256].copy()
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_PLACE = _MIX[400 : 400 + SHINGLE]
_BASE = _MIX[-1]
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BYTE[_BLANK] = 0


def _finish(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, cache: dict = {}) -> np.ndarray:  # noqa: B006 - kept per worker
    if len(cache.get("p", ())) < n:
        size = 1 << max(12, (n - 1).bit_length())
        with np.errstate(over="ignore"):
            cache["p"] = np.cumprod(np.full(size, _BASE, dtype=np.uint64))
    return cache["p"][:n]


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of each lower-cased word of a text, in order."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, dtype=np.uint64)
    blank = _BLANK[raw]
    edge = np.diff(np.concatenate(([True], blank, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    at = np.zeros(len(raw), dtype=np.int64)
    at[starts[0] :] = np.arange(starts[0], len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    value = _BYTE[raw] * _powers(int(at.max()) + 1)[at]
    sums = np.add.reduceat(value, starts)
    return _finish(sums + (ends - starts).astype(np.uint64))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes: runs of SHINGLE words, or the whole
    sequence if it is shorter; empty without words."""
    words = word_hashes(text or "")
    n = len(words)
    if n == 0:
        return words
    size = min(n, SHINGLE)
    total = np.zeros(n - size + 1, dtype=np.uint64)
    for j in range(size):
        total += words[j : n - size + 1 + j] * _PLACE[j]
    out = np.sort(_finish(total + np.uint64(size)))
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


# --------------------------------------------------------------- signatures


_FACTORS = (_MIX[: TREES * DEPTH] >> np.uint64(20)).astype(np.uint32) | np.uint32(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """TREES x DEPTH MinHash values (32 bits) of a non-empty set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(_FACTORS), np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(x), 4096):
        np.minimum(least, (x[None, at : at + 4096] * _FACTORS[:, None]).min(axis=1), out=least)
    return least.astype(">u4")


def sketch(values: np.ndarray) -> bytes:
    """Four bits of each signature value."""
    bits = (values.astype(np.uint32) >> np.uint32(8)).astype(np.uint8) & np.uint8(15)
    return (bits[0::2] << np.uint8(4) | bits[1::2]).tobytes()


_LOW = int("1" * TREES * DEPTH, 16)


def agreement(a: int, b: int) -> int:
    """Equal values in two sketches. At similarity 0.75 it is 92 of 120 in the
    mean (deviation 4.6); below SKETCH_LEAST lies one such pair in 10 ** 10."""
    x = a ^ b
    return TREES * DEPTH - ((x | x >> 1 | x >> 2 | x >> 3) & _LOW).bit_count()


_SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, sig binary, sketch binary"


def _sign(batches):
    for b in batches:
        n, d1, d2, sig, small = [], [], [], [], []
        for i in range(b.num_rows):
            s = shingle_set(b.column(1)[i].as_py())
            n.append(len(s))
            if len(s):
                with np.errstate(over="ignore"):
                    d1.append(int(_finish(s).sum().astype(np.int64)))
                    d2.append(int(_finish(s * _PLACE[0]).sum().astype(np.int64)))
                values = signature(s)
                sig.append(values.tobytes())
                small.append(sketch(values))
            else:
                for column in (d1, d2, sig, small):
                    column.append(None)
        columns = [b.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sig, pa.binary()), pa.array(small, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "d1", "d2", "sig", "sketch"])


# ------------------------------------------------- neighbours in tree orders


def _tree_rows(nodes: DataFrame, trees: int) -> DataFrame:
    """One row per node and tree: tree, key (the tree's values, as bytes that
    sort like them), node, label, n."""
    width = 4 * DEPTH
    key = F.substring("sig", F.col("tree") * width + 1, F.lit(width))
    each = nodes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    return each.select("tree", key.alias("key"), "node", "label", F.col("n_shingles").alias("n"), "sketch")


class _Window:
    """The last rows of a sorted list that still matter as earlier neighbours."""

    def __init__(self, reach: int):
        self.reach, self.region, self.rows, self.forgotten = reach, None, {}, set()
        self.order: deque = deque()

    def pairs(self, tree, key, node, label, n, small):
        """Pairs of this row with up to ``reach`` rows before it, in its region,
        of other labels, and whether more pairs may be there: of each label only
        the row whose sketch agrees best makes a pair, and the reach may end the
        search. Per label only the latest ``reach`` rows are kept; whoever looks
        past them has met ``reach`` rows."""
        region = (tree, key[: 4 * MIN_DEPTH])
        if region != self.region:
            self.region = region
            self.order.clear()
            self.rows.clear()
            self.forgotten.clear()
        best, seen, dense, small = {}, 0, False, int.from_bytes(small, "big")
        for other, mark, size, theirs in reversed(self.order):
            if mark == label:
                continue
            if seen >= self.reach:
                dense = True
                break
            lo, hi = (n, size) if n < size else (size, n)
            if lo * SIMILARITY[1] >= hi * SIMILARITY[0] and (same := agreement(small, theirs)) >= SKETCH_LEAST:
                dense = dense or mark in best
                best[mark] = max(best.get(mark, (0, 0)), (same, other))
            seen += 1
        # kept rows can't show whether one was forgotten
        dense = dense or (seen >= self.reach and len(self.forgotten - {label}) > 0)
        self.order.append((node, label, n, small))
        self.rows[label] = self.rows.get(label, 0) + 1
        if self.rows[label] > self.reach:  # forget the label's oldest row
            for i, row in enumerate(self.order):
                if row[1] == label:
                    del self.order[i]
                    break
            self.rows[label] -= 1
            self.forgotten.add(label)
        return [(other, node) if other < node else (node, other) for _, other in best.values()], dense


_FOUND = "a long, b long, part int, side int, tree int, key binary, node long, label long, n long, sketch binary, place long"


def _neighbours(reach: int):
    """Pairs inside each sorted partition, its dense regions, and its first and
    last rows, for the pairs across partition borders."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        window, head, tail, place = _Window(reach), [], deque(maxlen=4 * reach), 0
        for b in batches:
            cols = [b.column(k).to_pylist() for k in range(6)]
            found, dense = set(), {}
            for row in zip(*cols):
                pairs, more = window.pairs(*row)
                found.update(pairs)
                if more:
                    dense[window.region] = None
                edge = (*row, place)
                if place < 4 * reach:
                    head.append(edge)
                tail.append(edge)
                place += 1
            yield _found_batch(sorted(found), [], part)
            yield _found_batch([], [(*r, None, None, None, None, None) for r in dense], part, 2)
        ends = {e[-1]: e for e in [*head, *tail]}
        yield _found_batch([], [ends[k] for k in sorted(ends)], part)

    return run


def _found_batch(pairs, ends, part, side=1):
    n, m = len(pairs), len(ends)
    pick = lambda k, kind: pa.array([None] * n + [e[k] for e in ends], kind)
    columns = [
        pa.array([p[0] for p in pairs] + [None] * m, pa.int64()),
        pa.array([p[1] for p in pairs] + [None] * m, pa.int64()),
        pa.array([part] * (n + m), pa.int32()),
        pa.array([0] * n + [side] * m, pa.int32()),
        pick(0, pa.int32()), pick(1, pa.binary()), pick(2, pa.int64()), pick(3, pa.int64()), pick(4, pa.int64()), pick(5, pa.binary()), pick(6, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", "part", "side", "tree", "key", "node", "label", "n", "sketch", "place"])


def _border_pairs(reach: int):
    """Pairs (side 0) of a region's rows at partition ends, or the region itself
    (side 2) where rows of several partitions may still not have met."""

    def run(pdf):
        import pandas as pd

        window, found, dense, last = _Window(reach), set(), False, None
        several = pdf["part"].nunique() > 1
        if several:
            for r in pdf.sort_values(["part", "place"]).itertuples():
                pairs, more = window.pairs(r.tree, r.key, r.node, r.label, r.n, r.sketch)
                found.update(pairs)
                # rows between a partition's first and last ones are not here
                gap = last is not None and last[0] == r.part and last[1] + 1 != r.place
                dense, last = dense or more or gap, (r.part, r.place)
        out = pd.DataFrame(sorted(found), columns=["a", "b"], dtype="Int64").assign(side=0, tree=None, region=None)
        if dense:
            first = pdf.iloc[0]
            out.loc[len(out)] = [None, None, 2, int(first["tree"]), first["region"]]
        return out

    return run


def candidates(nodes: DataFrame, trees: int, reach: int, name: str, within: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a < b, distinct) of nodes with different labels, and the
    dense regions (tree, region). ``within``: only these regions are looked at."""
    spark = nodes.sparkSession
    rows = _tree_rows(nodes, trees).select(F.col("tree").cast("int"), "key", "node", "label", "n", "sketch")
    region = F.substring("key", 1, 4 * MIN_DEPTH)
    if within is not None:
        rows = _of_regions(rows, within).drop("region", *(c for c in within.columns if c not in ("tree", "region")))
    ordered = rows.repartitionByRange("tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    found = Saved(spark, ordered.mapInArrow(_neighbours(reach), _FOUND), f"{name}-found").df
    # of each region, some rows per partition, however many rows a partition has
    ends = found.where("side = 1").withColumn("region", region)
    shape = "a long, b long, side int, tree int, region binary"
    across = Saved(spark, ends.groupBy("tree", "region").applyInPandas(_border_pairs(reach), shape), f"{name}-across").df
    inside = found.where("side = 0").select("a", "b")
    pairs = Saved(spark, inside.unionByName(across.where("side = 0").select("a", "b")).distinct(), f"{name}-pairs").df
    dense = found.where("side = 2").select("tree", F.col("key").alias("region")).unionByName(across.where("side = 2").select("tree", "region"))
    return pairs, Saved(spark, dense.distinct(), f"{name}-dense").df


def _of_regions(rows: DataFrame, regions: DataFrame) -> DataFrame:
    """Rows of some regions, with the regions' columns; salted, as one region
    may hold a large share of the rows."""
    salted = regions.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    keyed = rows.withColumn("region", F.substring("key", 1, 4 * MIN_DEPTH)).withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    return keyed.join(salted, ["tree", "region", "_salt"]).drop("_salt")


def unsettled(nodes: DataFrame, regions: DataFrame, name: str) -> DataFrame:
    """The regions whose rows have several labels: tree, region, top (the label
    of most rows), blocks of its rows and of all others, rows and copies."""
    rows = _of_regions(_tree_rows(nodes, TREES).select(F.col("tree").cast("int"), "key", "node", "label"), regions.select("tree", "region"))
    by_label = rows.groupBy("tree", "region", "label").agg(F.count("*").alias("n"))
    found = by_label.groupBy("tree", "region").agg(F.sum("n").alias("rows"), F.max(F.struct("n", "label")).alias("m"))
    cut = lambda n: F.ceil(n / BLOCK).cast("int")
    most, others = F.col("m.n"), F.col("rows") - F.col("m.n")
    found = found.where(others > 0).select("tree", "region", F.col("m.label").alias("top"), cut(most).alias("mine"), cut(others).alias("theirs"), "rows", most.alias("most"))
    copies = F.when(F.col("rows") > BLOCK, F.col("most") * F.col("theirs") + (F.col("rows") - F.col("most")) * (F.col("mine") + F.col("theirs"))).otherwise(F.col("rows"))
    return Saved(nodes.sparkSession, found.withColumn("copies", copies).drop("most"), name).df


_CELL = ["tree", "region", "kind", "i", "j"]
WHOLE, TOP, OTHERS = 2, 0, 1  # kinds of cells: a whole region, others with the largest label's rows, others with others


def _cells(nodes: DataFrame, regions: DataFrame) -> DataFrame:
    """The rows of ``regions`` (from ``unsettled``), once for each cell, that is
    pair of blocks, in which they meet others. ``second``: the block's side."""
    rows = _tree_rows(nodes, TREES).select(F.col("tree").cast("int"), "key", "node", "label", "n", "sketch")
    rows = _of_regions(rows, regions.select("tree", "region", "top", "mine", "theirs", "rows")).withColumn("is_top", F.col("label") == F.col("top"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit(SEED)), F.when(F.col("is_top"), F.col("mine")).otherwise(F.col("theirs"))).cast("int"))
    cell = lambda kind, i, j, second: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), second.cast("int").alias("second"))
    b, every = F.col("block"), lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    whole = F.array(cell(WHOLE, F.lit(0), F.lit(0), F.col("is_top")))
    top = F.transform(every("theirs"), lambda c: cell(TOP, c, b, F.lit(1)))
    met = F.transform(every("mine"), lambda c: cell(TOP, b, c, F.lit(0)))
    other = F.transform(every("theirs"), lambda c: cell(OTHERS, F.least(b, c), F.greatest(b, c), b > c))
    each = F.when(F.col("rows") <= BLOCK, whole).when(F.col("is_top"), top).otherwise(F.concat(met, other))
    cells = rows.withColumn("c", F.explode(each))
    return cells.select("tree", "region", "c.kind", "c.i", "c.j", "c.second", "node", "label", "n", "sketch")


def _sides(pdf) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a cell's rows that meet and are met."""
    kind, second = pdf["kind"].iloc[0], pdf["second"].to_numpy()
    one = np.flatnonzero(second == 0)
    if kind == WHOLE:
        return one, np.arange(len(pdf))
    return one, one if kind == OTHERS and pdf["i"].iloc[0] == pdf["j"].iloc[0] else np.flatnonzero(second == 1)


def _meet(pdf):
    """The rows of a cell that may be similar to one of another label."""
    nibbles = np.frombuffer(b"".join(pdf["sketch"]), dtype=np.uint8).reshape(len(pdf), -1)
    nibbles = np.concatenate([nibbles >> 4, nibbles & 15], axis=1).astype(np.int64)
    marks = np.zeros((len(pdf), nibbles.shape[1] * 16), dtype=np.float32)
    marks[np.arange(len(pdf))[:, None], np.arange(nibbles.shape[1]) * 16 + nibbles] = 1
    label, n = pdf["label"].to_numpy(), pdf["n"].to_numpy()
    one, two = _sides(pdf)
    near = np.zeros(len(pdf), dtype=bool)
    for at in range(0, len(one), SLICE):
        r = one[at : at + SLICE]
        lo, hi = np.minimum(n[r][:, None], n[two]), np.maximum(n[r][:, None], n[two])
        found = (marks[r] @ marks[two].T >= SKETCH_LEAST - 0.5) & (label[r][:, None] != label[two]) & (lo * SIMILARITY[1] >= hi * SIMILARITY[0])
        near[r] |= found.any(axis=1)
        near[two] |= found.any(axis=0)
    return pdf.loc[near, [*_CELL, "second", "node", "label"]]


def _overlaps(sets: list[np.ndarray], one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets ``one`` with sets ``two``."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    held = np.diff(np.append(starts, len(values)))
    out = np.zeros(len(sets) * len(sets), dtype=np.int32)
    for rows in range(2, RARE + 1):  # pairs of the rows that hold a rare shingle
        at = starts[held == rows]
        step = (1 << 20) // rows**2
        for some in range(0, len(at), step):
            r = owner[at[some : some + step, None] + np.arange(rows)]
            np.add.at(out, (r[:, :, None] * len(sets) + r[:, None, :]).ravel(), 1)
    out = out.reshape(len(sets), len(sets))[np.ix_(one, two)].astype(np.float32)
    many = np.flatnonzero(held > RARE)
    for some in range(0, len(many), SLICE):
        c = many[some : some + SLICE]
        dense = np.zeros((len(sets), len(c)), dtype=np.float32)
        column = np.repeat(np.arange(len(c)), held[c])
        within = np.arange(len(column)) - np.repeat(np.cumsum(held[c]) - held[c], held[c])
        dense[owner[np.repeat(starts[c], held[c]) + within], column] = 1
        out += dense[one] @ dense[two].T
    return out


def _link(pdf):
    """Links (a < b) between rows of a cell that join its labels: a spanning
    forest of the similar pairs, counted on full sets."""
    import pandas as pd

    one, two = _sides(pdf)
    found = []
    if len(one) and len(two):
        sets = [np.frombuffer(s, dtype=np.uint64) for s in pdf["shingles"]]
        n, node = np.array([len(s) for s in sets]), pdf["node"].to_numpy()
        labels, mark = np.unique(pdf["label"].to_numpy(), return_inverse=True)
        parent = list(range(len(labels)))

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        both = _overlaps(sets, one, two)
        for k, x in enumerate(one):
            near = two[both[k].astype(np.int64) * (SIMILARITY[0] + SIMILARITY[1]) >= SIMILARITY[0] * (n[x] + n[two])]
            for other, first in zip(*np.unique(mark[near], return_index=True)):
                a, b = root(mark[x]), root(other)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    found.append(sorted((int(node[x]), int(node[near[first]]))))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def joined(nodes: DataFrame, regions: DataFrame, texts: DataFrame, name: str, repeats: bool = True) -> DataFrame:
    """Links (a, b) that join all labels in ``regions`` (from ``unsettled``)
    between which there is any similar pair."""
    spark = nodes.sparkSession
    shape = "tree int, region binary, kind int, i int, j int, second int, node long, label long"
    near = Saved(spark, _cells(nodes, regions).groupBy(*_CELL).applyInPandas(_meet, shape), f"{name}-near").df
    sets = shingles_of(near.select(F.col("node").alias("a"), F.col("node").alias("b")), texts, f"{name}-sets", repeats)
    met = near.join(sets.df.withColumnRenamed("doc_id", "node"), "node")
    found = Saved(spark, met.groupBy(*_CELL).applyInPandas(_link, "a long, b long").distinct(), f"{name}-links").df
    sets.drop()
    return found


# ------------------------------------------------------------- confirmation


def _sets(bitmap: np.ndarray):
    """Shingle sets of the rows whose id may be in the filter (false positives
    pass)."""

    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            if b.column(0).null_count:
                ids = np.nan_to_num(ids, nan=-1)
            bit = (_finish(ids.astype(np.int64).view(np.uint64)) % np.uint64(FILTER_BITS)).astype(np.int64)
            keep = np.flatnonzero(bitmap[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & np.uint8(1))
            for at in range(0, len(keep), 256):
                some = b.take(pa.array(keep[at : at + 256]))
                sets = [shingle_set(t.as_py()).tobytes() for t in some.column(1)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sets, pa.binary())], names=["doc_id", "shingles"])

    return run


def _mark(batches):
    seen = np.zeros(FILTER_BITS, dtype=bool)
    for b in batches:
        for k in (0, 1):
            seen[_finish(b.column(k).to_numpy().astype(np.int64).view(np.uint64)) % np.uint64(FILTER_BITS)] = True
    at = np.flatnonzero(np.packbits(seen).reshape(-1, 1024).any(axis=1))
    rows = np.packbits(seen).reshape(-1, 1024)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([rows[i].tobytes() for i in at], pa.binary())], names=["at", "bits"])


def _id_filter(pairs: DataFrame) -> np.ndarray:
    """FILTER_BITS flags of the ids in ``pairs``, as bits: one megabyte at any size."""
    merged = np.zeros((FILTER_BITS // 8 // 1024, 1024), dtype=np.uint8)
    for row in pairs.mapInArrow(_mark, "at int, bits binary").toLocalIterator():
        merged[row["at"]] |= np.frombuffer(row["bits"], dtype=np.uint8)
    return merged.reshape(-1)


def shingles_of(pairs: DataFrame, texts: DataFrame, name: str, repeats: bool = True) -> Saved:
    """(doc_id, shingles): the sets of all texts that ``pairs`` (a, b) name, and
    few others. The scan drops others by a filter of fixed size. ``repeats``:
    ids may repeat, so that equal rows must be made one."""
    sets = texts.mapInArrow(_sets(_id_filter(pairs)), "doc_id long, shingles binary")
    return Saved(pairs.sparkSession, sets.distinct() if repeats else sets, name)


def _confirm(batches):
    for b in batches:
        keep = []
        for one, two in zip(b.column(2), b.column(3)):
            one, two = (np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in (one, two))
            both = len(np.intersect1d(one, two, assume_unique=True))
            keep.append(both > 0 and both * SIMILARITY[1] >= SIMILARITY[0] * (len(one) + len(two) - both))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def confirm(pairs: DataFrame, texts: DataFrame, name: str, repeats: bool = True) -> Saved:
    """The pairs whose texts' full shingle sets overlap enough.

    ``texts``: (doc_id, text). Each named text is cut into shingles once, and
    only the sets travel.
    """
    sets = shingles_of(pairs, texts, f"{name}-sets", repeats)
    one = pairs.join(sets.df.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
    two = one.join(sets.df.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
    checked = Saved(pairs.sparkSession, two.select("a", "b", "set_a", "set_b").mapInArrow(_confirm, "a long, b long").distinct(), f"{name}-links")
    sets.drop()
    return checked


# ------------------------------------------------------------------ operator


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    Null texts and texts without words have no shingles, are linked with
    nothing and are kept. An id names a document: rows that share one are one
    node, linked with all that any of them is linked with, and if their texts
    differ a link confirmed for either holds. Rows without an id are linked
    with nothing (component_id null, kept). Empty tables give no rows; extra
    columns are ignored. Runs in Arrow batches of ``BATCH`` rows at most: texts
    and sets may be long, and an executor holds several batches at once.
    """
    with arrow_rows(docs.sparkSession, BATCH):
        return _components(docs, id_col, text_col)


def _components(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = Saved(spark, texts.mapInArrow(_sign, _SIGNED), "op2-signed")
    real = signed.df.where("doc_id IS NOT NULL AND n_shingles > 0")
    groups = Saved(spark, real.groupBy("d1", "d2").agg(F.min("doc_id").alias("node")), "op2-groups")
    repeats = not real.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    # one row per node; a repeated id keeps each of its different sets
    key = ["d1", "d2", "node"]
    nodes = Saved(
        spark,
        real.withColumnRenamed("doc_id", "node").join(groups.df, key, "left_semi").dropDuplicates(key).select("node", "n_shingles", "sig", "sketch"),
        "op2-nodes",
    )
    # an id whose rows have different sets ties their groups together
    tied = real.select(F.col("doc_id").alias("a"), "d1", "d2").join(groups.df, ["d1", "d2"]).select("a", F.col("node").alias("b")).where("a <> b")
    several = real.groupBy("doc_id").agg((F.min(F.struct("d1", "d2")) != F.max(F.struct("d1", "d2"))).alias("x")).where("x").select(F.col("doc_id").alias("a"))
    links = Saved(spark, tied.join(several, "a", "left_semi"), "op2-links").df
    labels, tried, dense, i, last = None, None, None, 0, False
    while True:
        first = i == 0
        label = F.col("node") if first else F.coalesce("label", "node")
        marked = (nodes.df if first else nodes.df.join(labels, "node", "left")).withColumn("label", label)
        if dense is not None:
            dense = unsettled(marked, dense, f"op2-{i}-unsettled")
            work = dense.agg(F.count("*").alias("n"), F.sum("rows").alias("rows"), F.sum("copies").alias("copies")).first()
            if not work["n"]:
                break
            last = not linked or work["copies"] <= LITTLE * work["rows"]
        if last:
            confirmed = joined(marked, dense, texts, f"op2-{i}", repeats)
        else:
            pairs, more = candidates(marked, FIRST_TREES if first else TREES, 1 if first else REACH, f"op2-{i}", dense)
            untried = pairs if tried is None else Saved(spark, pairs.join(tried, ["a", "b"], "left_anti"), f"op2-{i}-untried").df
            confirmed = confirm(untried, texts, f"op2-{i}", repeats).df
            tried = pairs if tried is None else tried.unionByName(pairs)
        linked = first or not confirmed.isEmpty()
        if linked:
            links = links.unionByName(confirmed)
            labels = Saved(spark, components(spark, links), f"op2-labels-{i}").df
        if last:
            break
        if not first:
            dense = more
        i += 1
    found = groups.df.join(labels, "node", "left").select("d1", "d2", F.coalesce("label", "node").alias("component_id"))
    out = signed.df.join(found, ["d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents``."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, with its own columns. Of rows that
    repeat a kept id, one stays; rows without an id all stay."""
    keep = Saved(spark, near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct(), "op2-kept").df
    key, n = fresh(docs, "_kept_id"), fresh(docs, "_row")
    kept = docs.join(keep.withColumnRenamed("doc_id", key), F.col("doc_id") == F.col(key)).drop(key)
    first = kept.withColumn(n, F.row_number().over(W.partitionBy("doc_id").orderBy(F.xxhash64("text")))).where(F.col(n) == 1).drop(n)
    return first.unionByName(docs.where("doc_id IS NULL"))
