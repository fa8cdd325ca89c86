"""The source audit against plain counting, and its pointer sort against ``sorted``."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from flagstar.llm import op11_divergence as op

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, min_docs, top):
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source, found = lang or "", source or "", terms(text)
        groups.add((lang, source))
        n[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        sources = [s for x, s in groups if x == lang]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[k] for k in kept) + 5 * len(kept)) for t in kept}  # noqa: B023, E731
        p, q = share(n[lang, source]), share(sum((n[lang, s] for s in sources), Counter()))
        pairs = [(s, sum(abs(p[t] - o[t]) for t in kept)) for s in sources if s != source for o in [share(n[lang, s])]]
        more = [(t, p[t] - q[t]) for t in kept if n[lang, source][t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, len(pairs)), ("term", more, top)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, v, k) for k, (item, v) in enumerate(items[:most], 1)]
    return sorted(out)


def test_sort_equals_sorted():
    rng = random.Random(3)
    words = ["a" * k for k in (1, 7, 8, 9, 15, 16, 17, 40)] + ["abcdefgh", "abcdefghi", "abcdefghabcdefgh", "ä" * 4, "漢字漢字漢字"]
    words += ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    picked = [rng.choice(words) for _ in range(5000)]
    data = np.frombuffer(" ".join(picked).encode(), dtype=np.uint8)
    starts, lengths = op.term_pointers(data, np.array([0, len(data)]))
    raw = [data[s : s + n].tobytes() for s, n in zip(starts, lengths)]
    assert raw == [w.encode() for w in picked]
    for slice_size in (op.SLICE, 50):
        saved, op.SLICE = op.SLICE, slice_size
        try:
            order, first = op.multikey_sort(data, starts, lengths)
        finally:
            op.SLICE = saved
        assert [raw[k] for k in order] == sorted(raw)
        assert first.sum() == len(set(raw)) and first[0]
        assert all(first[k] == (raw[order[k]] != raw[order[k - 1]]) for k in range(1, len(order)))
        assert all(first[k] or order[k] > order[k - 1] for k in range(1, len(order)))


def test_documents_cut_terms_and_hot_source(spark):
    rng = random.Random(4)
    words = [f"{a}{b}" for a in "abcdefghij" for b in ("", "x", "Y", "é", "漢", "longerthaneight")]
    rows = []
    for k in range(400):
        source = "hot" if k % 2 else rng.choice(["a", "b", None, "ü"])
        rows.append((rng.choice(["en", "en", "de", None]), source, " ".join(rng.choices(words, weights=range(1, len(words) + 1), k=rng.choice([0, 1, 30])))))
    rows += [("xx", "alone", None), ("xx", "other", ""), ("yy", "only", "1 2 3"), ("en", "a", "ab"), ("en", "a", "cd"), ("en", "tail", "zz " * 5000)]
    rows += [rows[0]] * 40
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, source string, text string, term string, n int").repartition(5)
    for min_docs, top in ((30, 50), (3, 4), (10**6, 50)):
        got = sorted(tuple(r) for r in op.divergence(df, min_docs=min_docs, top=top).collect())
        assert got == brute(rows, min_docs, top)


def test_empty_table(spark):
    assert op.divergence(spark.createDataFrame([], "lang string, source string, text string")).collect() == []


def test_query_on_hard_cases(spark, small, empty):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("lang", "source", "text").collect()]
    assert sorted(tuple(r) for r in op.op11_source_divergence(spark, small).collect()) == brute(rows, 30, 50)
    assert op.op11_source_divergence(spark, empty).collect() == []
