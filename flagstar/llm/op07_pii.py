"""Personal data by candidate generators and gradient-boosted trees.

1. Base patterns (e-mail, IP, card, phone) give spans that always stay.
2. High-recall generators propose further spans, which may overlap: obfuscated
   and bare addresses, digit groups, dotted numbers, account-like codes.
3. Every candidate, base spans among them, is described by its format (length,
   digits, groups, separators, checksums) and by its context (cue words and
   characters around it).
4. Boosted trees learn, from a bounded sample of the corpus's own candidates
   (about ``MAX_TRAIN``, an equal part for each kind and label), which formats in which contexts
   are personal data. No labels exist, so evidence outside the base patterns
   gives them: addresses are made plain before they are validated, national
   phone numbers go by digits and words around them. Spans without evidence
   either way, and those that overlap a base span, stay out of the fit.
5. A threshold per kind is calibrated on all candidates kept out of the fit,
   from counts by kind, range of scores and label: the lowest score from which
   a share of ``PRECISION`` is positive, among spans that are no base spans
   where those have enough positives.
   Candidates above it are added, best first, where they don't overlap a base
   span or a better one.

Texts are read once, whole; only spans and features of candidates are kept.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstar.llm.common import Saved, ship, table

ship(__name__)

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = 4
MAX_TRAIN = 12_000
PRECISION, PRIOR = 0.99, 1.0  # of a threshold; weight of the prior that it has just that, in candidates
NEVER = 1 << 30  # a threshold that no score reaches
DRAWN = 1 << 30  # marks of candidates for the fit's sample are below
TREES, DEPTH, RATE, BINS, MIN_LEAF = 30, 3, 0.3, 16, 5
SEED = 5
CONTEXT = 32  # characters looked at on either side

# ------------------------------------------------------------------- spans
# Base patterns (fixed values), written so that no text makes them slow: a run
# is entered at its start only, and repeats never give back.

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _octets(text: str) -> bool:
    """All dotted parts at most 255, however many zeros lead."""
    parts = [p.lstrip("0") or "0" for p in text.split(".")]
    return all(len(p) <= 3 and int(p) <= 255 for p in parts)


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping e-mail matches, found from their ``@``."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
            at = text.find("@", free)
        else:
            # what this run scanned can't start a later match
            at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base spans, in order."""
    out = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


# ------------------------------------------------------------- candidates

_GENERATORS = (
    (0, re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}+\x20?(?:\(at\)|\[at\]|@)\x20?[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]{1,63}+){1,6}")),
    (1, re.compile(r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){3}(?![0-9.]*[0-9])")),
    (2, re.compile(r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){11,18}+(?![0-9])")),
    (3, re.compile(r"(?<![0-9+])(?:\+|00)?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])")),
    (4, re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    (5, re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
)
_CUES = tuple(
    re.compile(p, re.I)
    for p in (
        r"mail|contact|write|@", r"\bip\b|host|server|address", r"card|visa|master|credit|pay|carte|tarjeta|karte",
        r"phone|tel|call|mobile|fax|cell|whatsapp|t[eé]l[eé]", r"iban|account|bank|konto|compte|cuenta", r"ssn|social|security",
    )
)
_MAIL_CUE = re.compile(r"mail|\bcontact\b|\bwrite\b|\breach\b", re.I)
_PHONE_CUE = re.compile(r"phone|\btel\b|\bcall\b|\bmobile\b|\bfax\b|\bcell\b|\bsms\b|whatsapp|t[eé]l[eé]f", re.I)
_AT, _DOT = re.compile(r"\x20?(?:\(at\)|\[at\]|@)\x20?"), re.compile(r"\x20?(?:\(dot\)|\[dot\])\x20?")
_PLAIN_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}")
_CODE = re.compile(r"version|release|build|order|invoice|item|no\.|isbn|#", re.I)


def _iban(text: str) -> bool:
    code = text.replace(" ", "").upper()
    if not 15 <= len(code) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _address(span: str) -> bool:
    """An e-mail address once (at) and (dot) are written plainly."""
    return _PLAIN_EMAIL.fullmatch(_DOT.sub(".", _AT.sub("@", span))) is not None


def _series(before: str, after: str) -> bool:
    """More digit groups go before or after, or it is an amount."""
    return re.search(r"[0-9][\x20.,/-]$|[$€£]\x20?$", before) is not None or re.match(r"[\x20.,/-][0-9]", after) is not None


def _years(groups: list[str]) -> bool:
    return all(len(g) == 4 and g[:2] in ("19", "20") for g in groups)


def valid(kind: int, span: str, before: str, after: str = "") -> bool | None:
    """Training labels; None: no evidence either way."""
    digits = _digits(span)
    if kind == 0:
        if not _address(span):
            return False
        # a sign between blanks also stands for the word "at"
        return True if _MAIL_CUE.search(before) or not ("@ " in span or " @" in span) else None
    if kind == 1:
        return re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", span) is not None and _octets(span) and _CODE.search(before) is None
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits) and digits[0] in "3456"
    if kind == 3:
        if span[:1] == "+" or not 8 <= len(digits) <= 15:
            return 9 <= len(digits) <= 15
        cue = _PHONE_CUE.search(before) is not None
        other = any(c.search(before) for c in (_CODE, _CUES[2], _CUES[4], _CUES[5]))
        other = other or _series(before, after) or _years(re.findall(r"[0-9]+", span)) or len(set(digits)) <= 2
        return cue if cue != other else None
    if kind == 4:
        return _iban(span)
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and _CUES[5].search(before) is not None


def features(kind: int, text: str, start: int, end: int) -> list[float]:
    """Format and context of one candidate."""
    span = text[start:end]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    digits = _digits(span)
    groups = re.findall(r"[0-9]+", span)
    near = [float(c.search(before) is not None) for c in _CUES]
    return [
        float(kind), float(end - start), float(len(digits)), float(len(groups)), float(max(map(len, groups), default=0)),
        float(span.count(" ")), float(span.count("-")), float(span.count(".")), float(span.count("(")), float(span[:1] == "+"),
        float(span.count("@")), float(sum(c.isalpha() for c in span)), float(sum(c.isupper() for c in span)),
        float(len(set(digits))), float(bool(digits) and luhn(digits)), float(kind == 1 and _octets(span)), float(kind == 4 and _iban(span)),
        float(digits[:1] in tuple("3456")), float(before[-1:].isalnum()), float(after[:1].isalnum()), float(near[kind]), float(sum(near)),
        float(_CODE.search(before) is not None), float(kind == 0 and _address(span)), float(_MAIL_CUE.search(before) is not None),
        float(_PHONE_CUE.search(before) is not None), float(_series(before, after)), float(bool(groups) and _years(groups)),
    ]


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of proposed spans; they may overlap each other."""
    found = {(m.start(), k, m.end()) for k, p in _GENERATORS for m in p.finditer(text)}
    return sorted(found | set(base))


def labels(text: str, base: list[tuple[int, int, int]], found: list[tuple[int, int, int]]) -> list[bool | None]:
    """Training labels of candidates; those that only a base span keeps out
    say nothing about spans to add."""
    own, ends, top = set(base), [], 0
    for _, _, e in base:
        ends.append(top := max(top, e))
    starts = [s for s, _, _ in base]
    # the base spans that start before e reach furthest to ends[at - 1]
    covered = lambda s, e: (at := bisect.bisect_left(starts, e)) > 0 and ends[at - 1] > s
    return [
        None if (s, k, e) not in own and covered(s, e) else valid(k, text[s:e], text[max(0, s - CONTEXT) : s], text[e : e + CONTEXT])
        for s, k, e in found
    ]


# ----------------------------------------------------------- boosted trees


class Trees:
    """Gradient-boosted regression trees on the logistic loss.

    Features are cut into at most BINS ranges; a tree is a list of
    (feature, cut, left, right) or leaf values, grown level by level.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])] if len(x) else []
        self.base, self.trees = 0.0, []
        if len(x) == 0 or y.min() == y.max():
            self.base = -20.0 if len(x) == 0 or y.max() == 0 else 20.0
            return
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(self.cuts)], axis=1)
        self.base = float(np.log(y.mean() / (1 - y.mean())))
        z = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            tree = self._grow(binned, y - p, p * (1 - p), np.arange(len(y)), DEPTH)
            self.trees.append(tree)
            z += self._apply(tree, binned)

    def _grow(self, binned, grad, hess, rows, depth):
        g, h = grad[rows].sum(), hess[rows].sum()
        leaf = RATE * g / (h + 1.0)
        if depth == 0 or len(rows) < 2 * MIN_LEAF:
            return float(leaf)
        best = (1e-6, None, None)
        for f in range(binned.shape[1]):
            b = binned[rows, f]
            n = np.cumsum(np.bincount(b, minlength=BINS + 1))
            gs, hs = np.cumsum(np.bincount(b, grad[rows], BINS + 1)), np.cumsum(np.bincount(b, hess[rows], BINS + 1))
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g * g / (h + 1)
            gain[(n < MIN_LEAF) | (len(rows) - n < MIN_LEAF)] = 0
            if gain.max() > best[0]:
                best = (float(gain.max()), f, int(gain.argmax()))
        if best[1] is None:
            return float(leaf)
        left = binned[rows, best[1]] <= best[2]
        return best[1], best[2], self._grow(binned, grad, hess, rows[left], depth - 1), self._grow(binned, grad, hess, rows[~left], depth - 1)

    def _apply(self, tree, binned):
        if not isinstance(tree, tuple):
            return np.full(len(binned), tree)
        return np.where(binned[:, tree[0]] <= tree[1], self._apply(tree[2], binned), self._apply(tree[3], binned))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of "personal data" for rows of features."""
        z = np.full(len(x), self.base)
        if self.trees and len(x):
            binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(self.cuts)], axis=1)
            for tree in self.trees:
                z += self._apply(tree, binned)
        return 1 / (1 + np.exp(-z))


def ranges(scores: np.ndarray) -> np.ndarray:
    """Ranges of scores, even in log odds."""
    p = np.clip(scores, 1e-9, 1 - 1e-9)
    return np.floor(np.log(p / (1 - p)) * 64).astype(np.int64)


def calibrate(at: np.ndarray, labels: np.ndarray, n: np.ndarray) -> int:
    """Lowest range of scores from which the expected share of positives stays at
    PRECISION, with a prior of PRIOR candidates that have it: any number of
    positives counts, however small the corpus. NEVER if no range has it."""
    if not (labels * n).sum():
        return NEVER
    found, which = np.unique(at, return_inverse=True)
    good, every = np.bincount(which, labels * n)[::-1].cumsum(), np.bincount(which, n)[::-1].cumsum()
    enough = np.flatnonzero((good > 0) & (good + PRIOR * PRECISION >= PRECISION * (every + PRIOR)))
    return int(found[::-1][enough[-1]]) if len(enough) else NEVER


class Model:
    """Trees, and the least range of scores that passes for each kind."""

    def __init__(self, trees: Trees, thresholds: list[int]):
        self.trees, self.thresholds = trees, thresholds


# ------------------------------------------------------------------ operator

_SPAN = "array<struct<s:long,k:int,e:long>>"
_SCAN_SCHEMA = f"base {_SPAN}, cands {_SPAN}, feats array<double>, valid array<boolean>"
_SPAN_TYPE = pa.list_(pa.struct([("s", pa.int64()), ("k", pa.int32()), ("e", pa.int64())]))


def _spans_array(rows):
    return pa.array([[{"s": s, "k": k, "e": e} for s, k, e in r] for r in rows], _SPAN_TYPE)


def _scan(text_at: int, keep: list[int], names: list[str]):
    def run(batches):
        for b in batches:
            base, cands, feats, oks = [], [], [], []
            for t in b.column(text_at):
                text = t.as_py() or ""
                spans = base_spans(text)
                found = candidates(text, spans)
                base.append(spans)
                cands.append(found)
                feats.append([v for s, k, e in found for v in features(k, text, s, e)])
                oks.append(labels(text, spans, found))
            columns = [b.column(i) for i in keep]
            columns += [_spans_array(base), _spans_array(cands), pa.array(feats, pa.list_(pa.float64())), pa.array(oks, pa.list_(pa.bool_()))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def choose(model: Model, base, cands, feats) -> list[tuple[int, int, int]]:
    """All spans of one text: the base and the candidates that pass."""
    out = list(base)
    if len(cands) > len(base):
        scores = model.trees.score(np.asarray(feats, dtype=float).reshape(len(cands), -1))
        at = ranges(scores)
        taken = set(base)
        for i in sorted(range(len(cands)), key=lambda i: (-scores[i], cands[i])):
            s, k, e = cands[i]
            if cands[i] not in taken and at[i] >= model.thresholds[k] and all(e <= x[0] or s >= x[2] for x in out):
                out.append(cands[i])
    return sorted(out)


def _listing(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _finish(model: Model):
    import hashlib

    def run(batches):
        for b in batches:
            ids, counts, digests, shown, all_spans = b.column(0), [[] for _ in range(BASE_KINDS)], [], [], []
            for i in range(b.num_rows):
                base, cands = ([(x["s"], x["k"], x["e"]) for x in b.column(c)[i].as_py()] for c in (1, 2))
                spans = choose(model, base, cands, b.column(3)[i].as_py())
                for k in range(BASE_KINDS):
                    counts[k].append(sum(x[1] == k for x in base))
                digests.append(hashlib.sha256(_listing(base).encode()).hexdigest())
                shown.append(_listing(spans))
                all_spans.append(spans)
            columns = [ids, *[pa.array(c, pa.int64()) for c in counts], pa.array(digests), pa.array(shown), _spans_array(all_spans)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "all_spans"])

    return run


def _histogram(trees: Trees, drawn: dict[tuple[int, bool], int]):
    """Labelled candidates kept out of the fit, counted by kind, range of
    scores, label and whether they are a base span."""

    def run(batches):
        for b in batches:
            own, cands, marks, oks = (b.column(i).to_pylist() for i in (0, 1, 2, 4))
            x = b.column(3).flatten().to_numpy(zero_copy_only=False)
            own = [{(c["s"], c["k"], c["e"]) for c in o} for o in own]
            keys = [(c["k"], (c["s"], c["k"], c["e"]) in o, y, m) for o, cs, ms, ys in zip(own, cands, marks, oks) for c, m, y in zip(cs, ms, ys)]
            if not keys:
                continue
            at = ranges(trees.score(x.reshape(len(keys), -1))).tolist()
            n = Counter((k, r, y, base) for (k, base, y, m), r in zip(keys, at) if y is not None and m >= drawn.get((k, y), 0))
            columns = list(zip(*[(*key, v) for key, v in n.items()])) or [[]] * 5
            kinds = (pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["k", "at", "y", "base", "n"])

    return run


def _train(scanned: DataFrame) -> Model:
    """Fit on about MAX_TRAIN candidates, whatever the corpus holds; thresholds
    from all others. Half of the marks are never drawn for the fit."""
    width = len(features(0, "", 0, 0))
    mark = lambda i: F.pmod(F.xxhash64("doc_id", F.lit(SEED), i, F.slice("feats", i * width + 1, F.lit(width))), F.lit(2 * DRAWN))
    marked = scanned.withColumn("marks", F.transform("valid", lambda _, i: mark(i)))
    each = marked.select("doc_id", F.posexplode(F.arrays_zip("cands", "valid", "marks")).alias("at", "c"), "feats").select(
        F.col("c.cands.k").alias("k"), F.col("c.valid").alias("y"), F.col("c.marks").alias("mark"), F.slice("feats", F.col("at") * width + 1, F.lit(width)).alias("x")
    )
    each = each.where(F.col("y").isNotNull() & (F.col("mark") < DRAWN))
    counts = each.groupBy("k", "y").count().collect()
    drawn = {(r["k"], r["y"]): min(DRAWN, DRAWN * MAX_TRAIN // (2 * len(KINDS) * r["count"])) for r in counts}
    below = F.lit(False)
    for (k, y), end in sorted(drawn.items()):
        below = below | ((F.col("k") == k) & (F.col("y") == y) & (F.col("mark") < end))
    rows = each.where(below).orderBy("mark", "k", "x").limit(2 * MAX_TRAIN).toPandas()
    x = np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), width)
    trees = Trees(x, rows["y"].to_numpy(dtype=float))
    counted = marked.select("base", "cands", "marks", "feats", "valid").mapInArrow(_histogram(trees, drawn), "k int, at long, y boolean, base boolean, n long")
    got = counted.groupBy("k", "at", "y", "base").agg(F.sum("n").alias("n")).toPandas()
    thresholds = []
    for k in range(len(KINDS)):
        mine = got[got["k"] == k]
        beyond = mine[~mine["base"].astype(bool)]
        if len(beyond):  # labelled candidates that the base patterns don't decide
            mine = beyond
        thresholds.append(calibrate(mine["at"].to_numpy(np.int64), mine["y"].to_numpy(float), mine["n"].to_numpy(float)))
    return Model(trees, thresholds)


def scan_and_fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Model]:
    only = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    names = ["doc_id", "base", "cands", "feats", "valid"]
    scanned = Saved(docs.sparkSession, only.mapInArrow(_scan(1, [0], names), f"doc_id long, {_SCAN_SCHEMA}"), "op7-scan").df
    return scanned, _train(scanned)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, counts of base spans, base_sha256, spans (listed) and
    all_spans (array of struct s, k, e; k indexes KINDS).

    Null texts count as empty and have no spans. Rows are independent but for
    the model, so repeated rows give equal rows. Without candidates nothing is
    added. Extra columns are ignored; an empty table gives no rows.
    """
    scanned, model = scan_and_fit(docs, id_col, text_col)
    schema = f"doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, all_spans {_SPAN}"
    return scanned.select("doc_id", "base", "cands", "feats").mapInArrow(_finish(model), schema)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Spans replaced by ``[KIND]``; overlapping spans become one, named after
    the first."""
    out, at = [], 0
    for s, k, e in sorted(spans):
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def _redact(model: Model, text_at: int, n_at: int | None):
    def run(batches):
        for b in batches:
            texts = []
            for t in b.column(text_at):
                text = t.as_py()
                if text:
                    base = base_spans(text)
                    found = candidates(text, base)
                    feats = [features(k, text, s, e) for s, k, e in found] if len(found) > len(base) else []
                    spans = choose(model, base, found if feats else base, feats)
                    text = redact(text, spans)
                texts.append(text)
            columns = list(b.columns)
            columns[text_at] = pa.array(texts, pa.string())
            if n_at is not None:
                columns[n_at] = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(b.schema.field(n_at).type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return run


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of ``documents``."""
    return find_pii(table(spark, sf_dir, "documents")).drop("all_spans")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by ``[KIND]``; n_chars follows the
    new text where the table has it."""
    _, model = scan_and_fit(docs)
    n_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    return docs.mapInArrow(_redact(model, docs.columns.index("text"), n_at), docs.schema)
