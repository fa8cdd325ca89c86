"""Best-fit packing under conflict constraints.

Documents become pieces of at most ``CAPACITY`` words; pieces go into bins of
``CAPACITY`` words, longest first. The bins of a shard are kept in order of
their residual (free words). For a piece, the search starts at the least
residual that holds it and goes on to the next larger one until it meets a bin
that takes it: the tightest compatible bin. A bin carries bitmaps of

* the duplicate clusters inside (no two pieces of one cluster share a bin), and
* the sources inside, one bitmap per multiplicity (at most ``MAX_PER_SOURCE``
  pieces of one source).

Only if none fits, a new bin opens. Shards are random parts of bounded expected
size, so packing runs on as many tasks as there are data and a hot source or
cluster is spread over all of them; every piece is packed.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstar.llm.common import Saved, lower_ascii, ship, table, word_array, word_count

ship(__name__)

CAPACITY = 2048
MAX_PER_SOURCE = 4
SHARD_PIECES = 6_000
SEED = 3

_PACKED = "shard long, row long, bin int, position int, offset int"


class Bins:
    """The open and full bins of one shard."""

    def __init__(self, capacity: int, max_per_source: int):
        self.capacity, self.levels = capacity, max_per_source
        self.residuals: list[int] = []  # distinct residuals that occur, sorted
        self.at: dict[int, list[int]] = {}  # residual -> its bins, oldest first
        self.clusters: list[int] = []  # bitmap per bin
        self.sources: list[list[int]] = []  # per bin: bitmap per multiplicity
        self.filled: list[int] = []
        self.held: list[int] = []

    def put(self, size: int, source: int, cluster: int) -> tuple[int, int, int]:
        """Bin, position and offset of a piece; 0 as ``source`` or ``cluster``
        bit means that it can't conflict."""
        for r in self.residuals[bisect_left(self.residuals, size) :]:
            for b in self.at[r]:
                if not self.clusters[b] & cluster and not self.sources[b][-1] & source:
                    self._leave(r, b)
                    return self._add(b, size, source, cluster)
        b = len(self.filled)
        self.clusters.append(0)
        self.sources.append([0] * self.levels)
        self.filled.append(0)
        self.held.append(0)
        return self._add(b, size, source, cluster)

    def _leave(self, residual: int, b: int) -> None:
        bins = self.at[residual]
        bins.remove(b)
        if not bins:
            del self.at[residual]
            del self.residuals[bisect_left(self.residuals, residual)]

    def _add(self, b: int, size: int, source: int, cluster: int) -> tuple[int, int, int]:
        place = b, self.held[b], self.filled[b]
        self.clusters[b] |= cluster
        for level, bits in enumerate(self.sources[b]):
            if not bits & source:
                self.sources[b][level] |= source
                break
        self.held[b] += 1
        self.filled[b] += size
        residual = self.capacity - self.filled[b]
        if residual:
            if residual not in self.at:
                insort(self.residuals, residual)
                self.at[residual] = []
            self.at[residual].append(b)
        return place


def _bits(keys: list, least: int) -> list[int]:
    """A bit per key that occurs ``least`` times; 0 for the others, which can't
    come to a conflict."""
    counts: dict = {}
    for k in keys:
        counts[k] = counts.get(k, 0) + 1
    index: dict = {}
    return [1 << index.setdefault(k, len(index)) if counts[k] >= least else 0 for k in keys]


def _pack(capacity: int, max_per_source: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_words", "row"], ascending=[False, True], kind="stable")
        clusters, sources = _bits(pdf["cluster"].tolist(), 2), _bits(pdf["skey"].tolist(), max_per_source + 1)
        bins = Bins(capacity, max_per_source)
        places = [bins.put(*x) for x in zip(pdf["n_words"].tolist(), sources, clusters)]
        out = pd.DataFrame(places, columns=["bin", "position", "offset"], dtype="int32")
        return pd.concat([pdf[["shard", "row"]].reset_index(drop=True), out], axis=1)

    return run


def content_cluster(text: Column) -> Column:
    """Cluster of texts that hold the same lower-cased words."""
    return F.xxhash64(F.array_join(word_array(lower_ascii(text)), " "))


def pack(
    docs: DataFrame,
    cluster: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    capacity: int = CAPACITY,
    max_per_source: int = MAX_PER_SOURCE,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, piece, start_word, n_words, bin_id, position,
    offset, source.

    A document is cut every ``capacity`` words; its pieces are of one cluster
    (default: documents with the same words), so they lie in different bins.
    Null texts and texts without words have no piece; a null source is a source
    of its own; repeated rows are pieces of their own, in different bins. An
    empty table gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("_words"),
        (content_cluster(F.col(text_col)) if cluster is None else cluster).cast("string").alias("cluster"),
    )
    cut = sized.where("_words > 0").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_words") - 1) / capacity))))
    pieces = cut.select(
        "doc_id",
        "piece",
        (F.col("piece") * capacity).alias("start_word"),
        F.least(F.lit(capacity), F.col("_words") - F.col("piece") * capacity).cast("long").alias("n_words"),
        "source",
        "cluster",
        F.monotonically_increasing_id().alias("row"),
    )
    # written first: row numbers are fixed from here on, whatever is lost later
    saved = Saved(spark, pieces, "op4-pieces").df
    shards = max(1, -(-saved.count() // shard_pieces))
    dealt = saved.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(SEED)), F.lit(shards)))
    slim = dealt.select("shard", "row", "n_words", F.coalesce("cluster", F.lit("")).alias("cluster"), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("skey"))
    placed = slim.groupBy("shard").applyInPandas(_pack(capacity, max_per_source), _PACKED)
    bin_id = F.col("shard") * (1 << 32) + F.col("bin")
    return (
        saved.join(placed, "row")
        .select("doc_id", "piece", "start_word", "n_words", bin_id.alias("bin_id"), "position", "offset", "source")
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all ``documents`` and the bins they lie in."""
    return pack(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage: the packed pieces. Copies that the mix made are one cluster."""
    return pack(docs)
