"""Fill-in-middle against a token by token version, and its exact undoing."""

import hashlib
import random
import re

import pytest

from flagstar.llm import op12_fim as op

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = ["", None, " ", "  \n", "one", " one", "one ", "a <P> b", "x <S", "<M", "< P>", "<", "<<", "ends with <", "<P", "S> a <M", "漢字 　 é", "a\x00b \x85c", "a\tb\x0bc\x0cd\re\x1cf"]


def units(text):
    out, at = [], 0
    while at < len(text):
        m = UNIT.match(text, at)
        out.append(m.group())
        at = m.end()
    return out


def brute(doc_id, text):
    text = text or ""
    t = units(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(t), "plain", None, None, text
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    pre, mid, suf = "".join(t[:a]), "".join(t[a:b]), "".join(t[b:])
    if h4 % 100 < 80:
        return len(t), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(t), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_against_brute_force_and_back(spark):
    rng = random.Random(5)
    texts = ODD * 12 + ["".join(rng.choice("ab<> \n\tPSM") for _ in range(rng.randrange(60))) for _ in range(400)]
    rows = [*enumerate(texts), (None, "no id but words"), (3, "again"), (3, "again")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, output string, form string").repartition(4)
    out = op.fill_in_middle(df)
    got = sorted(repr(tuple(r)) for r in out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect())
    assert got == sorted(repr((i, *brute(i, t))) for i, t in rows)
    back = out.withColumn("back", op.restored("output", "form")).select("doc_id", "back").collect()
    assert sorted(map(repr, map(tuple, back))) == sorted(repr((i, t or "")) for i, t in rows)
    assert {r.form for r in out.select("form").distinct().collect()} == {"plain", "spm", "psm"}


def test_windows_give_the_ends_of_one_match():
    rng = random.Random(6)
    for _ in range(200):
        text = "".join(rng.choice("ab  \n") for _ in range(rng.randrange(200)))
        assert op.token_ends(text, window=7) == op.token_ends(text)
    for text in (" " * 100, "a" * 100, "a" * 50 + " " * 50, " " * 50 + "a" * 50):
        assert op.token_ends(text, window=7) == op.token_ends(text)


def test_very_long_text():
    text = "ab cd\n" * 1_000_000
    n, form, one, two, out = op.transform(8, text, op.Fim(rate=100))
    assert n == 2_000_001 and form != "plain" and len(out) == len(text) + 9


def test_markers_that_could_not_be_undone_are_refused():
    for markers in (("<P>", "<P>", "<M>"), ("<P>", "[S]", "<M>"), ("<<", "<S>", "<M>"), ("", "<S>", "<M>")):
        with pytest.raises(ValueError):
            op.Fim(markers=markers)


def test_query(spark, small, empty):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = sorted(repr((i, *brute(i, t)[:4], sha(brute(i, t)[4]), sha(t))) for i, t in rows)
    assert sorted(repr(tuple(r)) for r in op.op12_fill_in_middle(spark, small).collect()) == want
    assert op.op12_fill_in_middle(spark, empty).collect() == []
