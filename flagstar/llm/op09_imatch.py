"""Document fingerprints by I-Match with randomised lexicon subsets.

The *lexicon* holds the terms (distinct lower-cased words) whose document
frequency lies in a chosen band: too common ones say nothing about a document,
too rare ones make a fingerprint break at the first edit. Frequencies count
distinct texts, so that copies of a text don't push its terms out of the band.
Each term of the band occurs in a least share of all distinct texts, so the lexicon has at most
``LEXICON_BOUND`` terms however large the corpus is, and all tasks get it as one
constant table of buckets.

A document's in-band terms are sorted once. Each of ``FAMILIES`` x ``RATES``
randomised subsets of the lexicon keeps a term by a seeded hash, at rates from
1 down to 1 / 2 ** 9, and the terms kept are hashed together. Two documents are
alike in the share of equal hashes among those subsets in which either has a
term: high rates serve short texts, low rates long ones. A text without in-band
terms is hashed by all its own terms instead; where it meets a text with in-band
terms, both are compared by all their terms.

Everything is DataFrame functions; terms travel as 64-bit hashes.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flagstar.llm.common import Saved, lower_ascii, shuffle_partitions, table, word_array

MIN_DF, MAX_DF = 0.002, 0.15  # shares of all distinct texts
FAMILIES = 4  # independent hashes
RATES = 10  # subset r of a family keeps a term with probability 1 / 2 ** r
LEXICON_BUCKETS = 1 << 15
LEXICON_BOUND = 250_000
MAX_SLICES = 4096  # doc_id ranges for finding the next document
EMPTY = "-"  # in a fingerprint: a subset in which the text has no term


def term_hashes(text: Column) -> Column:
    """Distinct terms of a text as 64-bit hashes."""
    return F.array_distinct(F.transform(word_array(lower_ascii(text)), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text_col: str = "text", min_df: float = MIN_DF, max_df: float = MAX_DF, bound: int = LEXICON_BOUND) -> DataFrame:
    """Terms (hashes) in the frequency band, counted over all distinct texts.

    A term must occur in two texts at least. The band's lower end is at least
    (all occurrences) / ``bound``, so at most ``bound`` terms can reach it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # copies are dropped in the tasks that read them, before the shuffle
    texts = docs.select(F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit(1)).alias("h2"), text.alias("text")).groupBy("h1", "h2").agg(F.first("text").alias("text"))
    n = docs.select(F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit(1)).alias("h2")).distinct().count()
    terms = texts.select(F.explode(term_hashes(F.col("text"))).alias("term"))
    counts = Saved(docs.sparkSession, terms.groupBy("term").agg(F.count("*").alias("df")).where("df >= 2"), "op9-counts").df
    occurrences = counts.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("s")).first()["s"]
    least = max(2.0, min_df * n, occurrences / bound)
    return counts.where((F.col("df") >= least) & (F.col("df") <= max(2.0, max_df * n))).select("term")


class Fingerprints:
    """Fingerprint expressions for one lexicon (at most LEXICON_BOUND terms).

    The lexicon becomes a constant of the query: an array of buckets, each an
    array of term hashes, so that looking a term up costs one bucket.
    """

    def __init__(self, terms: DataFrame, families: int = FAMILIES):
        self.families = families
        buckets: list[list[int]] = [[] for _ in range(LEXICON_BUCKETS)]
        for row in terms.select("term").toLocalIterator():
            buckets[row["term"] % LEXICON_BUCKETS].append(row["term"])
        starts = [1, *itertools.accumulate((len(b) for b in buckets), initial=1)][1:]
        constant = lambda values, kind: F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")
        self.starts = constant(starts, "int")
        self.table = constant([t for b in buckets for t in sorted(b)] or [0], "bigint")

    def terms(self, text: Column) -> Column:
        """The sorted in-band terms of a text; none: empty array."""

        def known(h: Column) -> Column:
            slot = F.pmod(h, F.lit(LEXICON_BUCKETS)).cast("int")
            start = F.element_at(self.starts, slot + 1)
            return F.array_contains(F.slice(self.table, start, F.element_at(self.starts, slot + 2) - start), h)

        return F.array_sort(F.filter(term_hashes(text), known))

    def of(self, terms: Column) -> Column:
        """Subset hashes, joined: 16 hex digits each, or EMPTY; families one
        after the other, rates 1, 1/2, ... in each."""
        state = lambda left, out: F.struct(left.alias("left"), out.alias("out"))

        def halve(acc: Column, r: Column) -> Column:
            # hash what is left, then keep each term by one more bit
            digest = F.when(F.size(acc["left"]) == 0, F.lit(EMPTY)).otherwise(F.lpad(F.lower(F.hex(F.xxhash64(acc["left"]))), 16, "0"))
            kept = F.filter(acc["left"], lambda h: h.bitwiseAND(r) == 0)
            return state(kept, F.concat(acc["out"], F.array(digest)))

        def family(f: int) -> Column:
            start = state(F.transform(terms, lambda t: F.xxhash64(t, F.lit(f))), F.array().cast("array<string>"))
            bits = F.array(*[F.lit(1 << r).cast("bigint") for r in range(RATES)])
            return F.array_join(F.aggregate(bits, start, halve, lambda acc: acc["out"]), ".")

        # one expression a family: `terms`, used more than once, stays a column
        # of its own and is not computed again inside each
        return F.concat_ws(".", *[family(f) for f in range(self.families)])


def own_terms(text: Column) -> Column:
    """All terms of a text, sorted."""
    return F.array_sort(term_hashes(text))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal subset hashes, 0 to 1, among subsets where either has a
    term. A subset counts by the inverse of its rate, as one that keeps few
    terms is changed by few edits. Equal fingerprints: 1; one null: null."""
    pairs = F.zip_with(F.split(a, r"\."), F.split(b, r"\."), lambda x, y: F.when((x != EMPTY) | (y != EMPTY), (x == y).cast("int")))
    weight = lambda i: F.pow(F.lit(2.0), F.pmod(i, F.lit(RATES)))
    used = F.transform(pairs, lambda same, i: F.struct((F.coalesce(same, F.lit(0)) * weight(i)).alias("same"), F.when(same.isNull(), 0.0).otherwise(weight(i)).alias("all")))
    sums = F.aggregate(used, F.struct(F.lit(0.0).alias("same"), F.lit(0.0).alias("all")), lambda t, x: F.struct((t["same"] + x["same"]).alias("same"), (t["all"] + x["all"]).alias("all")))
    return F.when(a == b, 1.0).when(sums["all"] == 0, 0.0).otherwise(sums["same"] / sums["all"])


def with_next(docs: DataFrame, id_col: str, tie_col: str, columns: list[str]) -> DataFrame:
    """Add ``next_<column>``: its value in the next row in descending order of
    ``id_col`` (nulls last, then ``tie_col``); after the last comes the first.

    Rows are dealt to ranges of ids, and each range's window also gets a copy
    of the first rows of the next range, so no window spans the whole table.
    """
    spark = docs.sparkSession
    n = min(MAX_SLICES, 8 * shuffle_partitions(spark))
    probs = [i / n for i in range(n + 1)]
    found = docs.agg(F.percentile_approx(id_col, probs, 20 * n).alias("q"), F.max(id_col).alias("top"), F.sum(F.col(id_col).isNull().cast("int")).alias("nulls")).first()
    # range i holds ids in (bounds[i + 1], bounds[i]]; bounds are ids that occur
    bounds = sorted({*(found["q"] or []), *([found["top"]] if found["top"] is not None else [])}, reverse=True)
    if found["nulls"] or not bounds:
        bounds.append(None)  # a last range of its own for null ids
    real = [b for b in bounds if b is not None]
    size = 1
    while size < len(real) + 1:
        size *= 2
    padded = F.array(*[F.lit(b).cast("long") for b in real + [None] * (size - len(real))])
    # binary search: how many bounds are >= the id
    steps = [size >> k for k in range(1, size.bit_length())]
    at = F.aggregate(
        F.array(*[F.lit(s) for s in steps]) if steps else F.array().cast("array<int>"),
        F.lit(0),
        lambda lo, s: F.when(F.coalesce(F.element_at(padded, lo + s) >= F.col(id_col), F.lit(False)), lo + s).otherwise(lo),
    )
    last = len(bounds) - 1
    own = F.when(F.col(id_col).isNull(), F.lit(last)).otherwise(at - 1)
    sliced = docs.withColumn("_slice", own.cast("int"))
    # the first rows of a range stand at the end of the range before as well
    first = F.when(F.col(id_col).isNull(), F.lit(True)).otherwise(F.element_at(padded, F.col("_slice") + 1) == F.col(id_col)) if real else F.lit(True)
    before = F.pmod(F.col("_slice") - 1, F.lit(len(bounds))).cast("int")
    dealt = sliced.withColumn(
        "_copy",
        F.explode(
            F.when(first, F.array(F.struct(F.col("_slice").alias("at"), F.lit(False).alias("guest")), F.struct(before.alias("at"), F.lit(True).alias("guest")))).otherwise(
                F.array(F.struct(F.col("_slice").alias("at"), F.lit(False).alias("guest")))
            )
        ),
    )
    order = W.partitionBy("_at").orderBy("_guest", F.col(id_col).desc_nulls_last(), tie_col)
    flat = dealt.withColumn("_at", F.col("_copy.at")).withColumn("_guest", F.col("_copy.guest"))
    led = flat.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return led.where(~F.col("_guest")).drop("_slice", "_copy", "_at", "_guest")


def op9_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and of their edited texts.

    Null texts count as empty; a text without in-band terms has a fingerprint
    of all its terms, one without words has empty subsets only. Documents that share an id follow each other by a hash
    of their text; null ids come last. A single document is its own next one.
    """
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    prints = Fingerprints(lexicon(docs))
    own = lambda terms: F.size(terms) == 0
    used = lambda terms, text: F.when(own(terms), own_terms(text)).otherwise(terms)
    marked = docs.withColumn("_band", prints.terms(F.col("text")))
    marked = marked.select("doc_id", "text", own(F.col("_band")).alias("own"), used(F.col("_band"), F.col("text")).alias("terms"))
    marked = marked.select("doc_id", "text", "own", prints.of(F.col("terms")).alias("fingerprint"), F.xxhash64("text").alias("_tie"))
    led = with_next(marked, "doc_id", "_tie", ["text", "own", "fingerprint"])
    n, cut = F.length("text"), F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - cut), F.substr("next_text", F.lit(1), cut))

    def near(other: str) -> Column:
        # one of the two has no in-band terms: all terms of both
        whole = lambda text: prints.of(own_terms(F.col(text)))
        mixed = F.col("own") != F.col(f"{other}_own")
        return F.when(mixed, likeness(whole("text"), whole(f"{other}_text"))).otherwise(likeness(F.col("fingerprint"), F.col(f"{other}_fingerprint")))

    out = led.withColumn("n_chars", n.cast("long")).withColumn("edited_text", edited)
    out = out.withColumn("_band", prints.terms(F.col("edited_text")))
    out = out.withColumn("edited_own", own(F.col("_band"))).withColumn("_terms", used(F.col("_band"), F.col("edited_text")))
    out = out.withColumn("edited_sha256", F.sha2(F.col("edited_text").cast("binary"), 256)).withColumn("edited_fingerprint", prints.of(F.col("_terms")))
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        near("edited").alias("near_edited"),
        near("next").alias("near_next"),
    )
