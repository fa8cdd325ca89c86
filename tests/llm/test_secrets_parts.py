"""Random tokens in paths or joined to words."""

from __future__ import annotations

import random
import string

from flagstar.llm import op01_secrets


def test_tokens_in_paths_and_beside_words_are_found(spark):
    rng = random.Random(8)
    token = lambda: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(40))
    tokens = [token() for _ in range(12)]
    shapes = ["at /my-app/{} now", "see /repos/ghp_{}/x", "words-and-more-words/of_a_path/{}"]
    docs = [(i, shapes[i % 3].format(t)) for i, t in enumerate(tokens)]
    docs += [(100 + i, f"a/plain-path/with_many/ordinary-words/like_this{i}/and-these") for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: [x for x in r.spans if x.k == 3] for r in op01_secrets.find_secrets(df).collect()}
    for i, t in enumerate(tokens):
        text = docs[i][1]
        assert len(found[i]) == 1 and t in text[found[i][0].s : found[i][0].e], text
        assert len(text[found[i][0].s : found[i][0].e]) <= len(t) + 5
    assert not any(found[i] for i in range(100, 140))


def test_overlapping_parts_are_counted_once(spark):
    text = "x aa-bb/cc_dd/" + "q7Zk" * 6 + "-" + "w9Lm" * 6
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = sorted((c.s, c.e) for c in op01_secrets.scan(df).first().candidates)
    assert spans and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
