"""Every operator on the hard cases, against plain-Python definitions."""

from __future__ import annotations

import hashlib
import json
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flagstar.llm import op02_neardup, op03_mixing, op04_packing, op05_tokens, op06_toxicity, op07_pii, op10_chat
from flagstar.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(spark, name, folder):
    return QUERIES[name](spark, folder).collect()


def texts(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables(spark, empty, name):
    got = rows(spark, name, empty)
    assert len(got) == (1 if name.startswith("op10") else 0)


def test_secrets_base(spark, small):
    assign = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in rows(spark, "op1_secrets", small))
    want = []
    for i, t in texts(spark, small):
        t = t or ""
        s = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        s += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        s += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        shown = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(s))
        n = [sum(x[1] == k for x in s) for k in range(3)]
        want.append((i is None, i or 0, hashlib.sha256(shown.encode()).hexdigest(), *n))
    assert got == sorted(want)


def test_secrets_random_string(spark, small):
    found = [r.spans for r in rows(spark, "op1_secrets", small) if "random" in r.spans]
    assert found == ["random:3:50"]


def _shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("reach", [op02_neardup.REACH, 1])
def test_near_duplicates_brute_force(spark, small, monkeypatch, reach):
    monkeypatch.setattr(op02_neardup, "REACH", reach)
    docs = [(i, _shingles(t)) for i, t in texts(spark, small)]
    label = {i: i for i, _ in docs if i is not None}
    named = [(i, s) for i, s in docs if i is not None and s]
    changed = True
    while changed:
        changed = False
        for i, s in named:
            for j, t in named:
                if label[i] < label[j] and 100 * len(s & t) >= 75 * len(s | t):
                    label[j], changed = label[i], True
    got = rows(spark, "op2_near_duplicates", small)
    key = lambda x: (x[0] is None, x[0] or 0)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=key) == sorted(
        ((i, len(s), label.get(i), i is None or label[i] == i) for i, s in docs), key=key
    )


def test_window_names_a_region_dense_only_where_its_reach_ended():
    small = bytes(32)
    for reach, want in ((1, [False, False, True]), (2, [False, False, False])):
        window = op02_neardup._Window(reach)
        assert [window.pairs(0, bytes(20), n, n, 10, small)[1] for n in range(3)] == want
    window = op02_neardup._Window(1)
    # two rows of one label, of which one is forgotten, before one of another
    assert [window.pairs(0, bytes(20), n, mark, 10, small)[1] for n, mark in enumerate((7, 7, 8))] == [False, False, True]


def test_fit_counts_hits_budget():
    rng = np.random.default_rng(0)
    for _ in range(30):
        sizes = np.unique(rng.integers(1, 500, 40))
        counts = rng.integers(1, 50, len(sizes))
        total = int((sizes * counts).sum())
        for budget in (0, 1, total // 3, total - 1, total, total + 5):
            take = op03_mixing.fit_counts(sizes, counts, budget)
            assert (take >= 0).all() and (take <= counts).all()
            got = int((sizes * take).sum())
            assert got <= budget and (got == min(budget, total) or budget in (1, total - 1))


def test_mix(spark, small):
    got = rows(spark, "op3_mix_sources", small)
    by = {}
    for r in got:
        assert r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        by.setdefault(r.source, []).append(r)
    sizes = {s: sum(r.size for r in v) for s, v in by.items()}
    order = sorted((s for s in by if s is not None)) + ([None] if None in by else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
        open_ -= over
    for s, v in by.items():
        assert v[0].source_size == sizes[s] and abs(v[0].target - target[s]) < 1e-6
        if max(r.size for r in v) < 1000:  # else the one long text can't be split
            assert abs(sum(r.taken for r in v) - target[s]) <= 60
    again = rows(spark, "op3_mix_sources", small)
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_packing(spark, small):
    got = rows(spark, "op4_best_fit_packing", small)
    n = sum(len(WORD.findall(t or "")) for _, t in texts(spark, small))
    assert sum(r.n_words for r in got) == n
    bins = {}
    for r in got:
        bins.setdefault(r.bin_id, []).append(r)
    for b in bins.values():
        at = 0
        for r in sorted(b, key=lambda r: r.position):
            assert r.offset == at
            at += r.n_words
        assert at <= op04_packing.CAPACITY
        assert len({(r.doc_id) for r in b}) == len(b)
        for s in {r.source for r in b}:
            assert sum(r.source == s for r in b) <= op04_packing.MAX_PER_SOURCE


def test_tightest_compatible_bin():
    bins = op04_packing.Bins(10, 1)
    assert [bins.put(*x)[0] for x in ((6, 1, 1), (5, 2, 2), (4, 4, 1), (3, 1, 0), (4, 1, 0))] == [0, 1, 1, 2, 3]


def test_token_codes_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (2.0 ** rng.uniform(0, 32, n)).astype(np.uint64).clip(0, 2**32 - 1).astype(np.uint32)
        assert (op05_tokens.decode_ranks(*op05_tokens.encode_ranks(v), n) == v).all()


def test_token_files(spark, small):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    docs = sorted(texts(spark, small), key=lambda d: (d[0] is not None, d[0] or 0))
    for i, t in docs:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted(rows(spark, "op5_token_files", small), key=lambda r: r.start)
    assert [tuple(r) for r in got] == want


def test_piece_encoder_equals_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok, own = Tokenizer.from_file(path), op05_tokens.PieceEncoder(path)
    odd = ["it's we'll  a b́ <|endoftext|> ΑΣ Σ", "́x ́", "a\tb\r\nc d", "İstanbul ﬁ ½ 12,345.6 🙂🙂", "don't 'S"]
    forgetful = op05_tokens.PieceEncoder(path, limit=3)
    for text in odd * 2:
        parts = text.replace("\n", " ").split(" ")
        want = tok.encode(text, add_special_tokens=False).ids
        for encoder in (own, forgetful):
            assert want == [int(i) for raw in encoder.ids(parts) for i in np.frombuffer(raw, dtype="<u4")]


def test_toxicity(spark, small):
    got = rows(spark, "op6_toxicity", small)
    assert len(got) == len(texts(spark, small))
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_swaps_keep_group_mentions_neutral():
    rng = np.random.default_rng(1)
    words, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        w = {f"n{k}" for k in rng.integers(0, 50, 8)}
        if toxic and rng.random() < 0.8:
            w.add("vile")
        if rng.random() < (0.7 if toxic else 0.05):
            w.add("muslim")
        words.append(w)
        labels.append(int(toxic))
    plain, fair = (op06_toxicity.fit(words, np.array(labels), swap_weight=s) for s in (0.0, 5.0))
    text = "a muslim family n1 n2"
    assert fair.score(text) < plain.score(text) and fair.score(text) < 0.5 < fair.score("vile n1")
    assert op06_toxicity.fit([], np.array([])).score("x") == 0.5


def test_pii_base(spark, small):
    got = {(r.doc_id, r.base_sha256): r for r in rows(spark, "op7_pii", small)}
    hit = [r for r in got.values() if r.n_email]
    assert [(r.n_email, r.n_ip, r.n_card, r.n_phone) for r in hit] == [(1, 1, 1, 1)]
    text = next(t for _, t in texts(spark, small) if t and t.startswith("mail a.b"))
    spans = op07_pii.base_spans(text)
    assert [text[s:e] for s, _, e in spans] == ["a.b+c@mail.example.com", "10.0.0.255", "4539 1488 0343 6467", "+1 (555) 123-4567"]
    assert op07_pii.redact(text, spans) == "mail [EMAIL] or x@y, ip [IP] and 1.2.3.999, card [CARD], call [PHONE]."


def test_emails_equal_the_pattern():
    pattern = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    rng = np.random.default_rng(2)
    for _ in range(3000):
        t = "".join(rng.choice(list("ab.@-_ +"), 30))
        assert op07_pii.emails(t) == [m.span() for m in pattern.finditer(t)]


def test_nearest_neighbours(spark, small):
    v = {r.vec_id: np.array(r.embedding, dtype=float) for r in spark.read.parquet(f"{small}/embeddings.parquet").where("vec_id < 400").collect()}
    got = {}
    for r in rows(spark, "op8_nn_descent", small):
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in v if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and q not in [f[1] for f in found]
        want = sorted(((-float(v[q] @ x), i) for i, x in v.items() if i != q))[:20]
        hits += len({f[1] for f in found} & {i for _, i in want})
        assert all(abs(s - float(v[q] @ v[i])) < 1e-9 for _, i, s in found)
    assert hits >= 0.9 * 20 * len(got)


def test_imatch(spark, small):
    docs = sorted(texts(spark, small), key=lambda d: (d[0] is None, -(d[0] or 0)))
    got = rows(spark, "op9_imatch", small)
    assert len(got) == len(docs)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    for k, (i, t) in enumerate(docs):
        if len(by[i]) == 1:
            t, nxt = t or "", docs[(k + 1) % len(docs)][1] or ""
            edited = t[: len(t) - len(t) // 3] + nxt[: len(t) // 3]
            assert by[i][0].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and by[i][0].n_chars == len(t)
    prints = {}
    for i, t in docs:
        prints.setdefault(t, set()).update(r.fingerprint for r in by[i])
    assert all(len(p) == 1 for t, p in prints.items() if t == "exact copy of a text with seven words")


def test_chat_round_trip(spark, small):
    got = {r.conv_id: r for r in rows(spark, "op10_chat_format", small)}
    assert set(got) == {1, 2, None, -7}
    text = "</s>[INST] ok [/INST]"
    assert got[-7].turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert got[-7].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert got[1].n_turns == 3 and got[1].loss_chars == 2 * len("a]b&lt;</s>") and got[2].n_turns == 2


def test_layouts_by_fingerprint(spark):
    records = [
        {"prompt": "p", "response": "r"},
        {"instruction": "i", "input": "", "output": "o"},
        {"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]},
        {"unknown": 1},
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in records] + [("no json",), (None,)], "record string")
    got = [[tuple(t) for t in r.t] if r.t is not None else None for r in df.select(op10_chat.json_turns(F.col("record")).alias("t")).collect()]
    assert got == [
        [("user", "p"), ("assistant", "r")],
        [("user", "i"), ("assistant", "o")],
        [("user", "u"), ("assistant", "a")],
        [("user", "h"), ("assistant", "g")],
        None, None, None,
    ]


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, small)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
            docs = corpus_pipeline.Saved(spark, out, "test-stage").df
    assert out.count() > 0


def test_pipeline_on_empty_tables(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_dedup_stage_keeps_one_of_each(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = op02_neardup.stage(spark, docs, small)
    assert kept.where("text = 'exact copy of a text with seven words'").count() == 1
    assert kept.where("text LIKE '%changed%'").count() == 1
