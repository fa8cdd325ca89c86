"""I-Match where copies or words out of the band would leave no terms."""

from __future__ import annotations

import random

from flagstar.llm import op09_imatch


def _run(spark, tmp_path, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return {r.doc_id: r for r in op09_imatch.op9_imatch(spark, str(tmp_path)).collect()}


def test_copies_do_not_push_terms_out_of_band(spark, tmp_path):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(600)]
    texts = [" ".join(rng.sample(words, 30)) for _ in range(200)]
    texts += [texts[0]] * 100  # a third of the rows
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    terms = {r.term for r in op09_imatch.lexicon(docs).collect()}
    own = docs.limit(1).select(op09_imatch.term_hashes(docs.text).alias("t")).first().t
    assert set(own) <= terms
    got = _run(spark, tmp_path, texts)
    assert got[250].near_edited > 0 and got[250].near_next == 1.0 and got[150].near_next < 0.5


def test_texts_without_band_terms_differ(spark, tmp_path):
    texts = [f"only{i} here{i} once{i}" for i in range(40)] + ["", None]
    got = _run(spark, tmp_path, texts)
    assert len({got[i].fingerprint for i in range(40)}) == 40
    assert all(got[i].near_next == 0.0 for i in range(40))


def test_no_band_terms_beside_an_edit_that_has_some(spark, tmp_path):
    # the last text's words stand nowhere else; the edit's end has band terms
    texts = [f"aa{i // 4} bb{i // 4} " * 12 for i in range(40)] + [" ".join(f"own{i}" for i in range(60))]
    got = _run(spark, tmp_path, texts)
    assert 0 < got[40].near_edited < 1
