"""Secret scans: fixed patterns plus a battery of randomness tests.

Fixed patterns give the base spans. Beyond them, every run of 20 or more
characters of the base64 alphabets is a candidate, and so are the runs of 20 or
more inside it that hold to one alphabet (letters and digits; those and ``+/``;
those and ``-_``), as a token may stand in a path or be joined to words. Of
overlapping ones, the one with the least p-value is kept (ties: the longest,
then the first), its p-value multiplied by the number of runs it stands for. The encoding (hex, base32, base62, base64, base64url, letters)
is inferred from the characters it uses, and three tests look at it:

* chi-squared: are the symbols spread evenly over the encoding's alphabet?
* runs: does the string cross the middle of the alphabet as often as chance?
* serial correlation: is a symbol's position unrelated to the one before?

Each test gives a p-value under the hypothesis "ordinary text" (identifiers,
paths, run-together words: uneven letters, few crossings, correlated
neighbours). The evidence grows with the length, as each model's mean and
spread do. The three are combined (Stouffer, with an allowance for their
dependence), and within each length class a Benjamini-Hochberg threshold over
the candidates of the whole corpus bounds the share of false secrets. A
candidate that itself looks too uneven to be random (two-sided chi-squared
against its alphabet) is never reported, nor is one inside a base span.

Everything is DataFrame functions. Texts are read once; what is kept of them
(spans, p-value classes) is written to the shared folder, from which both the
threshold and the result are computed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flagstar.llm.common import Saved, table

# Base patterns and their least lengths (fixed values).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
# A run shorter than the least length can only fail, so the scan looks for runs
# that are long enough; a run is maximal either way.
ACCESS_SCAN = r"AKIA[A-Z0-9]{%d,}+" % (ACCESS_MIN - 4)
HEX_SCAN = r"(?<![0-9a-f])[0-9a-f]{%d,}+" % HEX_MIN
CANDIDATE_MIN = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{%d,}+={0,2}" % CANDIDATE_MIN
# maximal runs inside a candidate, each of which some entry of ENCODINGS fits
PARTS = tuple(r"[A-Za-z0-9%s]{%d,}+" % (more, CANDIDATE_MIN) for more in ("", "+/", "_-"))
KINDS = ("assign", "access", "hex", "random")

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# name, pattern that infers it, alphabet in test order, excess of chi-squared a
# symbol that ordinary text shows over that alphabet. First match holds.
ENCODINGS = (
    ("decimal", "^[0-9]+$", DIGITS, None),
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef", 0.8),
    ("letters", "^([a-z]+|[A-Z]+)$", LOWER, 0.73),
    ("base32", "^[A-Z2-7]+$", UPPER.lower() + "234567", 1.1),
    ("base62", "^[A-Za-z0-9]+$", DIGITS + UPPER + LOWER, 2.7),
    ("base64", "^[A-Za-z0-9+/]+$", DIGITS + UPPER + LOWER + "+/", 2.8),
    ("base64url", "^[A-Za-z0-9_-]+$", DIGITS + UPPER + LOWER + "-_", 2.8),
)
ONE_CASE = {"hex", "letters", "base32"}
TEXT_CROSSINGS, TEXT_CORRELATION = 0.25, 0.45  # of neighbouring symbols, ordinary text
DEPENDENCE = 0.3  # assumed correlation between any two of the tests
UNEVEN_Z = 4.0  # chi-squared this many deviations from uniform: not random
FDR = 0.01
LENGTH_CLASSES = (32, 48, 96)  # upper ends; longer ones form the last class
STEPS_PER_DECADE, MAX_STEP = 20, 400  # resolution of p-values: 10 ** (-step / 20)


def match_spans(gaps: Column, matches: Column) -> Column:
    """Start and end (code points) of regex matches, from the pieces between
    them. Sums run in blocks of 64, so long lists are not copied over and over."""
    span = "array<struct<s:bigint,e:bigint,m:string>>"
    state = lambda at, out: F.struct(at.cast("bigint").alias("at"), out.alias("out"))
    pairs = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.struct(F.length(g).alias("g"), m.alias("m")))

    def one(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["g"]
        end = start + F.length(x["m"])
        return state(end, F.concat(acc["out"], F.array(F.struct(start.cast("bigint").alias("s"), end.cast("bigint").alias("e"), x["m"].alias("m")))))

    def block(acc: Column, i: Column) -> Column:
        done = F.aggregate(F.slice(pairs, i * 64 + 1, F.lit(64)), state(acc["at"], F.array().cast(span)), one)
        return F.struct(done["at"].alias("at"), F.concat(acc["out"], F.array(done["out"])).alias("out"))

    blocks = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / 64).cast("int"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{span}>").alias("out"))
    found = F.flatten(F.aggregate(blocks, start, block, lambda acc: acc["out"]))
    return F.when(F.size(matches) == 0, F.array().cast(span)).otherwise(found)


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function; tails by an asymptotic series."""
    a = F.abs(z)
    t = 1.0 / (1.0 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z < 0, tail).otherwise(1 - tail)


def _bound(expr: Column, values: dict[str, Column]) -> Column:
    return F.transform(expr, lambda x: F.struct(*[v(x).alias(n) for n, v in values.items()]))


def judge(candidates: Column) -> Column:
    """Candidates (array of struct s, e, m, g) as array of struct s, e, g, band, step:
    length class and p-value class; step null where the string is not random.

    Each pass over the array gives names to values that the next one uses.
    """
    body = lambda x: F.rtrim(x["m"], F.lit("="))
    def inferred(x: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, pattern, _, _ in reversed(ENCODINGS):
            out = F.when(x["body"].rlike(pattern), F.lit(name)).otherwise(out)
        return out

    named = lambda values: F.create_map(*[F.lit(v) for kv in values for v in kv])
    alphabets, excesses = named([(e[0], e[2]) for e in ENCODINGS]), named([(e[0], e[3] or 0.0) for e in ENCODINGS])
    keep = {"s": lambda x: x["s"], "e": lambda x: x["e"], "g": lambda x: x["g"]}
    step1 = _bound(candidates, keep | {"body": body})
    step2 = _bound(step1, keep | {"body": lambda x: x["body"], "enc": inferred})
    step3 = _bound(
        step2,
        keep
        | {
            "length": lambda x: F.length(x["body"]),
            "body": lambda x: F.when(x["enc"].isin(*ONE_CASE), F.lower(x["body"])).otherwise(x["body"]),
            "alphabet": lambda x: F.element_at(alphabets, x["enc"]),
            "excess": lambda x: F.element_at(excesses, x["enc"]),
        },
    )
    on = {"length": lambda x: x["length"], "excess": lambda x: x["excess"]}
    step4 = _bound(
        step3,
        keep
        | on
        | {
            "k": lambda x: F.length(x["alphabet"]).cast("double"),
            "v": lambda x: F.when(
                x["excess"] > 0, F.transform(F.split(x["body"], ""), lambda c: (F.call_function("instr", x["alphabet"], c) - 1).cast("double"))
            ),
        },
    )
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, y: acc + y)

    def squares(x: Column) -> Column:
        each = F.transform(F.array_distinct(x["v"]), lambda s: F.size(F.filter(x["v"], lambda y: y == s)).cast("double"))
        return total(F.transform(each, lambda c: c * c))

    def neighbours(x: Column, f) -> Column:
        return total(F.zip_with(F.slice(x["v"], 1, F.size(x["v"]) - 1), F.slice(x["v"], 2, F.size(x["v"])), f))

    step5 = _bound(
        step4,
        keep
        | on
        | {
            "k": lambda x: x["k"],
            "n": lambda x: F.size(x["v"]).cast("double"),
            "chi": lambda x: F.when(x["v"].isNotNull(), squares(x) * x["k"] / F.size(x["v"]) - F.size(x["v"])),
            "cross": lambda x: neighbours(x, lambda a, b: ((a >= x["k"] / 2) != (b >= x["k"] / 2)).cast("double")),
            "serial": lambda x: neighbours(x, lambda a, b: (a - (x["k"] - 1) / 2) * (b - (x["k"] - 1) / 2)) / (F.size(x["v"]) - 1) / ((x["k"] * x["k"] - 1) / 12),
        },
    )

    def text_z(x: Column) -> Column:
        m, free = x["n"] - 1, x["k"] - 1
        z_chi = (free + x["n"] * x["excess"] - x["chi"]) / F.sqrt(free * 2 + x["n"] * x["excess"] * 4)
        z_runs = (x["cross"] - m * TEXT_CROSSINGS) / F.sqrt(m * (TEXT_CROSSINGS * (1 - TEXT_CROSSINGS)))
        z_serial = (F.lit(TEXT_CORRELATION) - x["serial"]) * F.sqrt(m)
        return (z_chi + z_runs + z_serial) / math.sqrt(3 + 6 * DEPENDENCE)

    def random(x: Column) -> Column:
        m, free = x["n"] - 1, x["k"] - 1
        return (
            (F.abs(x["chi"] - free) <= F.sqrt(free * 2) * UNEVEN_Z)
            & (F.abs(x["cross"] - m / 2) <= F.sqrt(m) * (UNEVEN_Z / 2))
            & (F.abs(x["serial"]) * F.sqrt(m) <= UNEVEN_Z)
        )

    def band(x: Column) -> Column:
        out = F.lit(len(LENGTH_CLASSES))
        for i, end in reversed(list(enumerate(LENGTH_CLASSES))):
            out = F.when(x["length"] < end, i).otherwise(out)
        return out.cast("int")

    step6 = _bound(step5, keep | {"band": band, "z": lambda x: F.when(random(x), text_z(x))})
    p = lambda x: F.greatest(normal_cdf(-x["z"]), F.lit(1e-300))
    classed = lambda x: F.least(F.lit(MAX_STEP), F.floor(-F.log10(p(x)) * STEPS_PER_DECADE)).cast("int")
    return _bound(step6, keep | {"band": lambda x: x["band"], "step": lambda x: F.when(x["z"].isNotNull(), classed(x))})


def with_parts(candidates: Column) -> Column:
    """Candidates, each replaced by itself and its runs of one alphabet (array
    of struct s, e, m, g; g: start of the whole candidate)."""

    def inside(x: Column) -> Column:
        own = F.array(F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), x["s"].alias("g")))
        found = [match_spans(F.split(x["m"], p, -1), F.regexp_extract_all(x["m"], F.lit(p), F.lit(0))) for p in PARTS]
        moved = F.transform(F.concat(*found), lambda y: F.struct((y["s"] + x["s"]).alias("s"), (y["e"] + x["s"]).alias("e"), y["m"].alias("m"), x["s"].alias("g")))
        # a run that is the whole candidate but for its padding is no part
        parts = F.filter(moved, lambda y: F.length(y["m"]) < F.length(F.rtrim(x["m"], F.lit("="))))
        return F.concat(own, F.array_distinct(parts))

    whole = lambda x: F.array(F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), x["s"].alias("g")))
    mixed = lambda x: x["m"].rlike("[+/_-]")
    return F.flatten(F.transform(candidates, lambda x: F.when(mixed(x), inside(x)).otherwise(whole(x))))


def best_apart(judged: Column) -> Column:
    """Of judged candidates that overlap, those of the highest step (untested
    ones last; ties: the longest, then the first)."""
    rank = lambda x: F.struct((-F.coalesce(x["step"], F.lit(-1))).alias("a"), (x["s"] - x["e"]).alias("b"), x["s"].alias("c"), x.alias("x"))
    kind = "array<struct<s:bigint,e:bigint,band:int,step:int>>"

    def take(acc: Column, r: Column) -> Column:
        x = r["x"]
        return F.when(F.exists(acc, lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"])), acc).otherwise(F.concat(acc, F.array(x)))

    # the best of several is small by chance more often: p times their number
    several = lambda x, group: F.greatest(F.lit(0), x["step"] - F.ceil(F.log10(F.size(group)) * STEPS_PER_DECADE).cast("int"))
    priced = lambda x, group: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["band"].alias("band"), F.when(x["step"].isNotNull(), several(x, group)).alias("step"))
    best = lambda group: F.transform(F.aggregate(F.array_sort(F.transform(group, rank)), F.array().cast(kind), take), lambda x: priced(x, group))
    plain = lambda x: F.struct(*[x[c].alias(c) for c in ("s", "e", "band", "step")])
    # whole candidates never overlap: their parts are looked at apart
    starts = F.array_distinct(F.transform(judged, lambda x: x["g"]))
    groups = F.transform(starts, lambda g: best(F.transform(F.filter(judged, lambda x: x["g"] == g), plain)))
    return F.when(F.size(starts) == F.size(judged), F.transform(judged, plain)).otherwise(F.flatten(groups))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, base (array of struct s, e, k) and candidates (array of
    struct s, e, band, step), not yet thresholded."""
    scans = {"assign": ASSIGN, "access": ACCESS_SCAN, "hex": HEX_SCAN, "random": CANDIDATE}
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pieces = texts.select("doc_id", "text", *[F.split("text", p, -1).alias(f"g_{k}") for k, p in scans.items()])
    none = F.array().cast("array<string>")
    matched = pieces.select(
        "doc_id",
        *[f"g_{k}" for k in scans],
        *[F.when(F.size(f"g_{k}") > 1, F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none).alias(f"m_{k}") for k, p in scans.items()],
    )
    placed = matched.select("doc_id", *[match_spans(F.col(f"g_{k}"), F.col(f"m_{k}")).alias(k) for k in scans])
    long_enough = F.filter("assign", lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= ASSIGN_MIN)
    kind = lambda c, i: F.transform(c, lambda x: F.struct(x["s"].alias("s"), F.lit(i).alias("k"), x["e"].alias("e")))
    base = F.array_sort(F.concat(kind(long_enough, 0), kind(F.col("access"), 1), kind(F.col("hex"), 2)))
    based = placed.select("doc_id", base.alias("base"), "random")
    outside = F.filter(with_parts(F.col("random")), lambda c: ~F.exists("base", lambda b: (b["s"] <= c["s"]) & (b["e"] >= c["e"])))
    judged = based.select("doc_id", "base", judge(outside).alias("judged"))
    return judged.select("doc_id", "base", best_apart(F.col("judged")).alias("candidates"))


def thresholds(scanned: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """Least p-value step that passes in each length class (Benjamini-Hochberg
    at rate ``fdr`` over all candidates of the class). The histogram has at
    most classes x steps rows."""
    each = scanned.select(F.explode("candidates").alias("c")).select(F.col("c.band").alias("band"), F.coalesce(F.col("c.step"), F.lit(0)).alias("step"))
    histogram = each.groupBy("band", "step").agg(F.count("*").alias("n"))
    down = W.partitionBy("band").orderBy(F.col("step").desc()).rowsBetween(W.unboundedPreceding, 0)
    ranked = histogram.withColumn("rank", F.sum("n").over(down)).withColumn("m", F.sum("n").over(W.partitionBy("band")))
    passing = ranked.where((F.col("step") > 0) & (F.pow(F.lit(10.0), -F.col("step") / STEPS_PER_DECADE) * F.col("m") <= F.col("rank") * F.lit(fdr)))
    return {r["band"]: r["step"] for r in passing.groupBy("band").agg(F.min("step").alias("step")).collect()}


def _listing(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    show = lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))
    return F.array_join(F.transform(spans, show), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """Per row of ``docs``: doc_id, base and spans (arrays of struct s, k, e in
    order of start, then kind; k indexes KINDS; code points, end exclusive).

    Null and empty texts have no spans. Rows are independent of each other
    except for the threshold, so repeated ids and rows each give their row.
    An empty table gives no rows; extra columns are ignored.
    """
    scanned = Saved(docs.sparkSession, scan(docs, id_col, text_col), "op1-scan").df
    least = thresholds(scanned, fdr)
    passes = lambda c: F.coalesce(
        F.element_at(F.array(*[F.lit(least.get(i, MAX_STEP + 1)) for i in range(len(LENGTH_CLASSES) + 1)]), c["band"] + 1) <= c["step"], F.lit(False)
    )
    added = F.transform(F.filter("candidates", passes), lambda c: F.struct(c["s"].alias("s"), F.lit(len(KINDS) - 1).alias("k"), c["e"].alias("e")))
    return scanned.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda i: F.size(F.filter("base", lambda x: x["k"] == i)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listing(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listing(F.col("spans")).alias("spans"),
    )
