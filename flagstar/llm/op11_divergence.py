"""Source divergence audit: how differently sources of a language use terms.

A *term* is a run of ASCII letters and of characters beyond ASCII, A-Z
lower-cased. Terms are counted over Arrow buffers without making a string of
any occurrence:

* A shard (one Arrow batch) is one byte buffer. A table lookup marks term bytes;
  their rising edges are *term-start pointers* into the buffer.
* The pointers are sorted by the terms they start: a multikey quicksort over
  digits of eight bytes (three-way partitions around a median; slices of at most
  SLICE pointers by numpy's own sort). Pointers that agree in a digit go on with
  the next one, those that end in it are done.
* Equal runs of the sorted pointers are the shard's terms. Their lengths give
  occurrences per source, the changes of document inside them document
  frequencies.

Shards send one row per term and source; everything after is joins and
aggregates of such rows. Only the report's own rows grow with the square of a
language's sources: their sums of differences are made per batch of terms.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flagstar.llm.common import Saved, ship, table

ship(__name__)

MIN_DOCS = 30
TOP = 50
UNIT, PRIOR = 1_000_000_000, 5
SLICE = 1 << 17  # pointers sorted at once by numpy
CELLS = 1 << 22  # terms x sources held at once when differences are summed

_TERM = np.zeros(256, dtype=bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([(1 << 64) - (1 << 64 - 8 * k) for k in range(9)], dtype=np.uint64)  # the first k of eight bytes

# ------------------------------------------------------- pointers and sorting


def term_pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every term in ``data``; ``offsets`` of the documents
    cut terms too."""
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[1:] = _TERM[data]
    inside = np.append(inside, False)
    start, end = inside[1:] & ~inside[:-1], ~inside[1:] & inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    start[cuts], end[cuts] = True, True
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) - starts


def _digits(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes from ``depth`` on as one number that sorts like them; beyond a
    term's end 0, which no term has inside. ``data`` ends with eight more bytes."""
    words = np.ndarray((len(data) - 7,), dtype=">u8", buffer=data, strides=(1,))
    at = np.minimum(starts + depth, len(words) - 1)
    return words[at].astype(np.uint64) & _KEEP[np.clip(lengths - depth, 0, 8)]


def multikey_sort(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): pointers in the order of their terms, equal ones in the
    order given; first marks where an equal run begins."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    n = len(starts)
    order, first = np.arange(n), np.zeros(n, dtype=bool)
    todo = [(0, n, 0, _digits(padded, starts, lengths, 0))] if n else []
    while todo:
        lo, hi, depth, keys = todo.pop()
        if hi - lo <= SLICE:
            _sort_slice(padded, starts, lengths, order, first, lo, depth, keys)
            continue
        some = np.sort(keys[:: 1 + (hi - lo) // 1024])
        pivot = some[len(some) // 2]
        less, same, more = (np.flatnonzero(x) for x in (keys < pivot, keys == pivot, keys > pivot))
        own = order[lo:hi].copy()
        one, two = lo + len(less), hi - len(more)
        for at, side in ((lo, less), (one, same), (two, more)):
            order[at : at + len(side)] = own[side]
        todo += [(a, a + len(side), depth, keys[side]) for a, side in ((lo, less), (two, more)) if len(side)]
        first[one] = True
        if lengths[order[one]] >= depth + 8:  # else all end in this digit
            own = order[one:two]
            todo.append((one, two, depth + 8, _digits(padded, starts[own], lengths[own], depth + 8)))
    return order, first


def _sort_slice(padded, starts, lengths, order, first, lo, depth, keys):
    """Sort a small slice digit by digit; each round goes on with the runs that
    agree in a full digit, all at once."""
    at, run = np.arange(lo, lo + len(keys)), np.zeros(len(keys), dtype=np.int64)
    while len(at):
        by = np.lexsort((keys, run)) if run[-1] else np.argsort(keys, kind="stable")
        order[at], keys = order[at][by], keys[by]
        new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (run[1:] != run[:-1])))
        first[at[new]] = True
        run = np.cumsum(new) - 1
        on = (np.bincount(run)[run] > 1) & (lengths[order[at]] >= depth + 8)
        at, run, depth = at[on], run[on], depth + 8
        keys = _digits(padded, starts[order[at]], lengths[order[at]], depth)


# ------------------------------------------------------------------ counting


def shard_counts(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Terms of a shard, and per term and group of documents: (term's number,
    group, occurrences, documents)."""
    starts, lengths = term_pointers(data, offsets)
    if not len(starts):
        return [], *(np.zeros(0, dtype=np.int64) for _ in range(3))
    lower = _LOWER[data]
    order, first = multikey_sort(lower, starts, lengths)
    run = np.cumsum(first) - 1
    heads = order[first]
    terms = [lower[s : s + n].tobytes() for s, n in zip(starts[heads].tolist(), lengths[heads].tolist())]
    doc = (np.searchsorted(offsets, starts, side="right") - 1)[order]
    change = first.copy()
    change[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(change)
    groups = int(group.max()) + 1
    cell = run[at] * groups + group[doc[at]]
    by = np.argsort(cell, kind="stable")
    cell = cell[by]
    edge = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    n = np.add.reduceat(np.diff(np.append(at, len(order)))[by], edge)
    return terms, cell[edge], n, np.diff(np.append(edge, len(cell)))


_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _count(batches):
    for b in batches:
        if not b.num_rows:
            continue
        pairs = pa.StructArray.from_arrays([b.column(0), b.column(1)], names=["lang", "source"])
        kinds = pc.unique(pc.struct_field(pairs, [0])), pc.unique(pc.struct_field(pairs, [1]))
        lang, source = (pc.index_in(b.column(k), kinds[k]).to_numpy().astype(np.int64) for k in (0, 1))
        used, group = np.unique(lang * len(kinds[1]) + source, return_inverse=True)
        text = b.column(2).cast(pa.large_string())
        offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
        raw = text.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        terms, cell, n, docs = shard_counts(data, offsets - offsets[0], group)
        if not terms:
            continue
        groups = int(group.max()) + 1
        own = used[cell % groups]
        columns = [kinds[0].take(pa.array(own // len(kinds[1]))), kinds[1].take(pa.array(own % len(kinds[1])))]
        named = pa.array([t.decode("utf-8", "replace") for t in terms], pa.string()).take(pa.array(cell // groups))
        whole = pa.RecordBatch.from_arrays([*columns, named, pa.array(n.astype(np.int64)), pa.array(docs.astype(np.int64))], schema=_COUNTS)
        for at in range(0, whole.num_rows, 20_000):
            yield whole.slice(at, 20_000)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that have it) of
    (lang, source, text) rows without nulls."""
    shards = docs.select("lang", "source", "text").mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return shards.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ---------------------------------------------------------------- divergence


def _share(n, total, size):
    """1 + floor(UNIT * (n + PRIOR) / (total + PRIOR * size)), exactly."""
    wide = lambda c: c.cast("decimal(20,0)")
    return (F.lit(1) + F.call_function("div", wide(F.lit(UNIT)) * wide(n + PRIOR), wide(total + PRIOR * size))).cast("long")


def _differences(batches):
    """Per lang and pair of its sources, the sum of |p - q| over a batch's terms."""
    for b in batches:
        langs = b.column(0).dictionary_encode()
        code = langs.indices.to_numpy()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            rows = b.filter(pa.array(code == k))
            base = np.array(rows.column(1)[0].as_py(), dtype=np.int64)  # of a term that a source lacks
            sources = len(base)
            total = np.zeros((sources, sources), dtype=np.int64)
            step = max(1, CELLS // sources)
            for at in range(0, rows.num_rows, step):
                part = rows.slice(at, step)
                sizes = pc.list_value_length(part.column(2)).to_numpy()
                p = np.tile(base, (part.num_rows, 1))
                p[np.repeat(np.arange(part.num_rows), sizes), part.column(2).flatten().to_numpy()] = part.column(3).flatten().to_numpy()
                for s in range(sources):
                    total[s] += np.abs(p - p[:, s : s + 1]).sum(axis=0)
            for s in range(sources):
                columns = [pa.array([lang] * sources), pa.array(np.full(sources, s, np.int32)), pa.array(np.arange(sources, dtype=np.int32)), pa.array(total[s])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "one", "two", "f"])


def divergence(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS, top: int = TOP
) -> DataFrame:
    """Per (lang, source): part ``pair`` compares it with each other source of
    the lang over all kept terms, part ``term`` lists the ``top`` terms that it
    uses more than the lang does. Columns lang, source, part, item, value, rank.

    Nulls in any of the three columns count as empty strings. A lang keeps the
    terms of at least ``min_docs`` of its documents; every row is a document, so
    repeated rows count each. A lang without kept terms has pairs of value 0 and
    no terms; a source of its own has no pairs. Ties rank by item. Empty texts
    and texts without terms still make their source appear; an empty table gives
    no rows; extra columns are ignored. A text must fit a task.
    """
    spark = docs.sparkSession
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(plain(lang_col).alias("lang"), plain(source_col).alias("source"), plain(text_col).alias("text"))
    counts = Saved(spark, term_counts(rows), "op11-counts").df
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("lang", "term")
    used = Saved(spark, counts.join(kept, ["lang", "term"]).select("lang", "term", "source", "n"), "op11-kept").df

    # one row per group, with its totals and its place among the lang's sources
    groups = rows.select("lang", "source").distinct()
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = used.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("size"))
    known = groups.join(sums, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["total", "size"])
    place = F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1
    known = Saved(spark, known.withColumn("place", place), "op11-groups").df

    # p of every kept term in every group that has it, and in the lang
    of_lang = known.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    p = used.join(known, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("size")))
    terms = used.groupBy("lang", "term").agg(F.sum("n").alias("lang_n")).join(of_lang, "lang")
    more = p.join(terms, ["lang", "term"]).withColumn("q", _share(F.col("lang_n"), F.col("lang_total"), F.col("size"))).where("p > q")
    best = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    # sums over pairs: the p of a term's sources side by side
    lacking = F.when(F.col("size") > 0, _share(F.lit(0), F.col("total"), F.greatest("size", F.lit(1))))
    bases = known.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", lacking.alias("p")))).alias("b")).select("lang", F.col("b.p").alias("base"))
    sparse = p.groupBy("lang", "term").agg(F.collect_list(F.struct("place", "p")).alias("c")).join(bases, "lang")
    sparse = sparse.select("lang", "base", F.col("c.place").alias("places"), F.col("c.p").alias("ps"))
    sums_of = sparse.mapInArrow(_differences, "lang string, one int, two int, f long").groupBy("lang", "one", "two").agg(F.sum("f").alias("f"))
    left, right = known.select("lang", "source", F.col("place").alias("one")), known.select("lang", F.col("source").alias("item"), F.col("place").alias("two"))
    pairs = left.join(right, "lang").where("one <> two").join(sums_of, ["lang", "one", "two"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("f", F.lit(0)).cast("long").alias("value"))

    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return pairs.withColumn("rank", rank).unionByName(best.withColumn("rank", rank).where(F.col("rank") <= top))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all ``documents``."""
    return divergence(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), t AS (
  SELECT id, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d
), c AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT id) AS docs FROM t GROUP BY ALL
), k AS (
  SELECT lang, term, sum(n)::HUGEINT AS lang_n FROM c GROUP BY ALL HAVING sum(docs) >= 30
), g AS (
  SELECT lang, source, coalesce(total, 0)::HUGEINT AS total, coalesce(size, 0)::HUGEINT AS size
  FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c JOIN k USING (lang, term) GROUP BY ALL) USING (lang, source)
  LEFT JOIN (SELECT lang, count(*) AS size FROM k GROUP BY ALL) USING (lang)
), l AS (
  SELECT lang, sum(total) AS total, max(size) AS size FROM g GROUP BY ALL
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.size) AS p,
         1 + (1000000000::HUGEINT * (k.lang_n + 5)) // (l.total + 5 * l.size) AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q
)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts
) WHERE part = 'pair' OR rank <= 50
""".strip()
