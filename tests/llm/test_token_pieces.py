"""Token ids by pieces against the tokenizers library on whole texts; file order."""

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flagstar.llm import op05_tokens as op

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)


def crc(text):
    ids = [*LIB.encode(text or "", add_special_tokens=False).ids, op.END_ID]
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def check(spark, texts, folder):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    op.write_token_files(df, folder, PATH)
    got = {r.doc_id: r for r in op.read_token_files(spark, folder).collect()}
    at = 0
    for i, t in enumerate(texts):
        n = len(LIB.encode(t or "", add_special_tokens=False).ids) + 1
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, n, crc(t)), repr(t)[:60]
        at += n


def test_hard_texts(spark, tmp_path):
    check(spark, [
        "", None, " \n\t ", "Don't WE'LL 'S ''s I'VE", "a<|endoftext|>b <|startoftext|>", "x\0y", "é İstanbul ΣΣΣ straße", "1234 a1b2²½",
        "한 각", "café, naïve! Привет 漢字かな", "a b　c d\u0085e", "Å Ω ﬁ ＡＢ", "x" * 5000, "a\x1cb\x0bc", "<| endoftext |>", "...!!!??",
    ], str(tmp_path / "f"))


def test_every_character_beside_others(spark, tmp_path):
    chars = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"{c}a{c}{d}B'{c} 1{c}!" for c, d in zip(chars[k : k + 400], chars[k + 1 : k + 401])) for k in range(0, len(chars), 400)]
    texts += ["".join(chars[k::97]) for k in range(97)]
    check(spark, texts, str(tmp_path / "f"))


def test_start_follows_rows_not_file_names(spark, tmp_path):
    folder = tmp_path / "f"
    df = spark.createDataFrame([(i, f"word {i} " * (i % 5)) for i in range(200)], "doc_id long, text string").repartition(6)
    op.write_token_files(df, str(folder), PATH)
    want = sorted(tuple(r) for r in op.read_token_files(spark, str(folder)).collect())
    parts = sorted((folder / "ids").glob("part-*.parquet"))
    for k, part in enumerate(parts):  # as if numbers had grown by a digit
        (folder / "ids" / f".{part.name}.crc").unlink(missing_ok=True)
        part.rename(folder / "ids" / f"part-{99_998 + k}-{part.name}")
    assert sorted(tuple(r) for r in op.read_token_files(spark, str(folder)).collect()) == want
    assert [s for _, s, _, _ in want] == [sum(n for _, _, n, _ in want[:k]) for k in range(len(want))]


def test_empty_table_repeated_rows_and_null_ids(spark, tmp_path):
    op.write_token_files(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "none"), PATH)
    assert op.read_token_files(spark, str(tmp_path / "none")).count() == 0
    given = [(3, "the cat"), (3, "the cat"), (None, "x " * 400_000), (1, None), (3, "the"), (None, "")]
    df = spark.createDataFrame([(i, t, 7) for i, t in given], "doc_id long, text string, ids_crc32 int").repartition(3)
    op.write_token_files(df, str(tmp_path / "f"), PATH)
    got = sorted(op.read_token_files(spark, str(tmp_path / "f")).collect(), key=lambda r: r.start)
    n = {t: len(LIB.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in given}
    want = sorted(((i is not None, i or 0, n[t], crc(t)) for i, t in given))
    assert [(r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got] == want
    assert [r.start for r in got] == [sum(w[2] for w in want[:k]) for k in range(len(want))]


def test_hot_word_and_many_blocks(spark, tmp_path):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        check(spark, [f"hot{'!' * (k % 3)} Hot w{k} it's hot {'HOT ' * (k % 50)}" for k in range(300)], str(tmp_path / "f"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_lists_of_codes_round_trip():
    rng = np.random.default_rng(5)
    n = rng.integers(0, 9, 200)
    values = (2.0 ** rng.uniform(0, 32, n.sum())).astype(np.uint32)
    control, data, sizes = op.encode_lists(values, n)
    assert (op.decode_lists(control.tobytes(), data.tobytes(), n) == values).all()
    one = [op.encode_ranks(v) for v in np.split(values, np.cumsum(n)[:-1])]
    assert b"".join(c for c, _ in one) == control.tobytes() and b"".join(d for _, d in one) == data.tobytes()
    assert [len(d) for _, d in one] == sizes.tolist()


def test_plain_characters_are_cut_as_the_library_cuts_them():
    """Every plain character alone, and all pairs of a choice of them, between others."""
    own, plain = op.PieceEncoder(PATH), [chr(c) for c in range(33, 0x600) if re.fullmatch(op.PLAIN, chr(c))]
    assert len(plain) > 300 and not {"İ", "×", "÷", "Σ", "²", "́"} & set(plain)
    some = [*"aSTtVe'!9~", *"ÀßÿŐŉſЀйџ"]
    words = [f"{x}{c}{y}" for c in plain for x in ("", "a'", "É1", "!") for y in ("", "s", "Ж,")]
    words += [f"{a}{b}{c}" for a in some for b in some for c in some] + [f"'{a}{b}'{c}" for a in "sSrlvd" for b in "aelLE" for c in "sté"]
    words += ["a<|endoftext|>b", "x<|STARTOFTEXT|>", "", "ΑΣ", "İ", "é", "x\x0by"]
    for word, raw in zip(words, own.ids(words), strict=True):
        assert np.frombuffer(raw, dtype="<u4").tolist() == LIB.encode(word, add_special_tokens=False).ids, word


def test_a_piece_is_encoded_once_whatever_stands_beside_it(monkeypatch):
    """Case and punctuation make no new pieces, and letters beyond ASCII need no whole pass of the library."""
    own, seen = op.PieceEncoder(PATH), []
    asked = own._encode
    monkeypatch.setattr(own, "_encode", lambda units: asked(seen.append(units) or units))
    monkeypatch.setattr(own, "tokenizer", type("Library", (), {"encode_batch_fast": lambda self, words, **_: [pytest.fail(w) for w in words]})())
    own.ids(["Café", "café,", "CAFÉ!!", "(café)", "Дом", "дом,"])
    own.ids(["dog", "Dog!!", "CAFÉ,"])
    assert sorted(u for units in seen for u in units) == sorted(["café", ",", "!!", "(", ")", "дом", "dog"])
