"""Spans beyond the base patterns."""

from __future__ import annotations

import random

import pytest

from flagstar.llm import op07_pii


def _added(spark, docs):
    """Texts of the spans that are not base spans, by doc_id."""
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = {}
    for r in op07_pii.find_pii(df).collect():
        text = dict(docs)[r.doc_id]
        base = set(op07_pii.base_spans(text))
        out[r.doc_id] = [text[x.s : x.e] for x in r.all_spans if (x.s, x.k, x.e) not in base]
    return out


def _plain(rng, i):
    name, host = f"user{i}", rng.choice(["mail", "corp", "uni"])
    return [
        f"please contact {name}@{host}.com soon",
        f"call +44 20 {rng.randrange(1000, 9999)} {rng.randrange(1000, 9999)} now",
        f"order {rng.randrange(100, 999)}-{rng.randrange(100, 999)}-{rng.randrange(1000, 9999)} shipped, release {i % 9}.{i % 7}.300.{i % 5}",
        f"code {name}@{host}.{i} and years 2019 2020 {2000 + i % 30}",
    ]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    texts = [t for i in range(300) for t in _plain(rng, i)]
    for i in range(150):
        texts.append(f"write to name{i} (at) host{i % 9} (dot) com today")
        texts.append(f"phone: ({rng.randrange(201, 989)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)} ask for me")
    return list(enumerate(texts))


def test_obfuscated_addresses_and_national_numbers_are_added(spark, corpus):
    added = _added(spark, corpus)
    want = {i: t for i, t in corpus if t.startswith(("write to", "phone:"))}
    missed = [t for i, t in want.items() if len(added[i]) != 1]
    assert not missed
    wrong = [t for i, t in corpus if t.startswith(("order", "code")) and added[i]]
    assert not wrong


def test_labels_need_evidence():
    valid = op07_pii.valid
    assert valid(0, "name (at) host (dot) com", "") and valid(0, "name@host.org", "")
    assert valid(0, "name @ host.org", "my mail: ") and valid(0, "see @ cafe.then", "") is None and valid(0, "a @ 3.50", "") is False
    assert valid(3, "555 123-4567", "tel: ") and valid(3, "555 123-4567", "about ") is None and valid(3, "555 123-4567", "order ") is False
    text = "call +1 (555) 123-4567 x"
    base = op07_pii.base_spans(text)
    found = op07_pii.candidates(text, base)
    assert len(found) == 2 and op07_pii.labels(text, base, found) == [True, None]


def _iban(n):
    bban = f"{n:018d}"
    check = 98 - int(bban + "131400") % 97  # D = 13, E = 14
    code = f"DE{check:02d}{bban}"
    return " ".join(code[i : i + 4] for i in range(0, 22, 4))


def test_a_rare_kind_keeps_its_threshold(spark, monkeypatch):
    # one account in 200 candidates; the sample for the fit holds 480
    monkeypatch.setattr(op07_pii, "MAX_TRAIN", 480)
    rng = random.Random(6)
    texts = [" ".join(f"mail u{i}x{j}@host.com" for j in range(100)) for i in range(200)]
    texts += [f"iban {_iban(rng.randrange(10**17))} of the bank" for _ in range(100)]
    docs = list(enumerate(texts))
    added = _added(spark, docs)
    assert all(len(added[i]) == 1 for i, t in docs if t.startswith("iban"))


def test_counts_hold_all_candidates_out_of_the_fit():
    import numpy as np

    at, one = np.array([5, 4, 3, 2]), np.array([1.0, 1.0, 0.0, 1.0])
    assert op07_pii.calibrate(at, one, np.array([10.0, 5000.0, 5.0, 1.0])) == 2
    assert op07_pii.calibrate(at, one, np.array([10.0, 5000.0, 500.0, 1.0])) == 4
    assert op07_pii.calibrate(at, one, np.array([10.0, 5.0, 0.0, 1.0])) == 2  # few positives count as many do
    assert op07_pii.calibrate(at, 0 * one, np.array([10.0, 5.0, 0.0, 1.0])) == op07_pii.NEVER


@pytest.mark.parametrize("n", [5, 19])
def test_few_obfuscated_addresses_are_added(spark, n):
    rng = random.Random(6)
    texts = [t for i in range(150) for t in _plain(rng, i)]
    texts += [f"write to name{i} (at) host{i} (dot) com today" for i in range(n)]
    added = _added(spark, list(enumerate(texts)))
    assert all(len(added[len(texts) - 1 - i]) == 1 for i in range(n))
    assert not any(added[i] for i in range(len(texts) - n) if texts[i].startswith(("order", "code")))
