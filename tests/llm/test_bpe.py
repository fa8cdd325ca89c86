"""Ids and texts against the tokenizers library on whole texts."""

import hashlib
import json

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flagstar.llm import op13_bpe as op

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)


def lib_ids(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


def both_ways(spark, texts):
    df = spark.createDataFrame([(i, t, "x", [1]) for i, t in enumerate(texts)], "doc_id long, text string, word string, ids array<int>").repartition(6)
    out = {r.doc_id: (r.ids, r.text) for r in op.decode(op.encode(df, PATH), PATH).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        ids = lib_ids(t)
        assert out[i] == (ids, LIB.decode(ids, skip_special_tokens=False)), repr(t)[:80]


def test_hard_texts(spark):
    both_ways(spark, [
        "", None, " ", "  ", "\n\n a", "a<|endoftext|>b  c", "<|endoftext|>", "!<|endoftext|><|endoftext|> ", "<|endoftext|", "x\0y \0", "\0",
        "don't we'll 'S it''s I've 'RE", " \n\n\t x   y\u0085z　", "1½①x ²", "áb é", "  a᠎b﻿c\x1c\x1d a\x1f",
        "x" * 40_000, " " * 2000, "\U000323b0 a \U0003fffe՘", "漢字かな한글 ☃🙂🏽", "tab\tand  two", "same text", "same text",
    ])


def test_every_code_point(spark):
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    both_ways(spark, ["".join(c + ("a", " ", "1", "!")[k % 4] for k, c in enumerate(chars[at : at + 3000])) for at in range(0, len(chars), 3000)])


def test_each_distinct_word_is_encoded_once(spark):
    texts = ["one two three " * 50 for _ in range(60)] + [f"one w{i} " for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(10)
    seen = spark.sparkContext.accumulator(0)

    def counted(*args):
        inner = real(*args)

        def run(batches):
            def watch(items):
                last = None
                for b in items:
                    for w in b.column(1).to_pylist():
                        if w != last:
                            seen.add(1)
                        last = w
                    yield b

            yield from inner(watch(batches))

        return run

    real = op._encode_words
    op._encode_words = counted
    try:
        op.encode(df, PATH).write.format("noop").mode("overwrite").save()
    finally:
        op._encode_words = real
    words = {w for t in texts for w, _ in LIB.pre_tokenizer.pre_tokenize_str(t)}
    assert len(words) <= seen.value <= len(words) + 1  # the empty word behind the last SEP


def test_decode_any_ids(spark):
    rows = [(0, [1, 2, 3], "a"), (1, [], "b"), (2, None, "c"), (3, [50256, 999_999, -1, 15496], "d"), (4, [162], "e"), (5, [447, 247, 162, 50256], "f")]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>, text string")
    got = {r.doc_id: r.text for r in op.decode(df, PATH).collect()}
    assert got[2] is None
    for i, ids, _ in rows:
        if ids is not None:
            assert got[i] == LIB.decode([x for x in ids if 0 <= x < 50257], skip_special_tokens=False)


def test_rows_stay_rows(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (None, None)]
    got = op.encode(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    assert sorted(repr((r.doc_id, r.ids)) for r in got) == sorted(repr((i, lib_ids(t))) for i, t in rows)


def test_other_tokenizers_are_refused(tmp_path):
    told = json.load(open(PATH, encoding="utf-8"))
    told["normalizer"] = {"type": "Lowercase"}
    (tmp_path / "t.json").write_text(json.dumps(told), encoding="utf-8")
    with pytest.raises(ValueError):
        op.special_tokens(str(tmp_path / "t.json"))
    with pytest.raises(ValueError):
        op.special_tokens(public_tokenizers.path("word_bpe_49k.json"))


def test_query(spark, small, empty):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect():
        ids = lib_ids(r.text)
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(LIB.decode(ids, skip_special_tokens=False))))
    assert sorted(map(repr, map(tuple, op.op13_bpe_round_trip(spark, small).collect()))) == sorted(map(repr, want))
    assert op.op13_bpe_round_trip(spark, empty).collect() == []
