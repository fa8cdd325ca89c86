"""Dense regions are settled by label counts or joined in bounded blocks."""

from __future__ import annotations

import numpy as np
import pytest

from flagstar.llm import op02_neardup as op2


def _nodes(spark, labels):
    """Nodes in one region of every tree, whose sketches all agree."""
    sig = np.zeros(op2.TREES * op2.DEPTH, dtype=">u4").tobytes()
    rows = [(i, 10, bytearray(sig), bytearray(60), lab) for i, lab in enumerate(labels)]
    nodes = spark.createDataFrame(rows, "node long, n_shingles long, sig binary, sketch binary, label long")
    key = bytearray(4 * op2.MIN_DEPTH)
    return nodes, spark.createDataFrame([(0, key)], "tree int, region binary")


def test_one_label_settles_a_region(spark):
    nodes, regions = _nodes(spark, [0] * 300)
    assert op2.unsettled(nodes, regions, "t").count() == 0


def test_overlaps_equal_set_intersections(monkeypatch):
    monkeypatch.setattr(op2, "SLICE", 7)
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 200)).astype(np.uint64)) for _ in range(60)]
    one, two = np.arange(5, 50), np.arange(60)
    got = op2._overlaps(sets, one, two)
    assert [[len(np.intersect1d(sets[x], sets[y])) for y in two] for x in one] == got.tolist()


@pytest.mark.parametrize("block", [8, 2048])
@pytest.mark.parametrize("labels", [[0] * 90 + [90] * 5 + [95, 96], list(range(40)), [0] * 3 + [3]])
def test_blocks_join_all_labels_and_stay_bounded(spark, monkeypatch, labels, block):
    """Rows 0, 2, 4, ... hold one text with a word changed each (all similar),
    the others texts of their own (none similar): links join just the labels of
    the former, and each cell gives fewer links than it has rows."""
    monkeypatch.setattr(op2, "BLOCK", block)
    nodes, regions = _nodes(spark, labels)
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*words[: i // 2], f"x{i}", *words[i // 2 + 1 :]] if i % 2 == 0 else [f"own{i}-{w}" for w in words])) for i in range(len(labels))]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    left = op2.unsettled(nodes, regions, "t")
    got = [(r.a, r.b) for r in op2.joined(nodes, left, texts, "t").collect()]
    n, sets = len(labels), [set(op2.shingle_set(t).tolist()) for _, t in rows]
    similar = {(a, b) for a in range(n) for b in range(a + 1, n) if labels[a] != labels[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert set(got) <= similar

    def joined(pairs):
        mark = {x: x for x in labels}
        for _ in labels:
            for a, b in pairs:
                x, y = mark[labels[a]], mark[labels[b]]
                mark = {k: min(x, y) if v in (x, y) else v for k, v in mark.items()}
        return mark

    assert joined(got) == joined(sorted(similar))
    cells = op2._cells(nodes, left).groupBy(*op2._CELL).count().collect()
    assert len(got) <= sum(c["count"] - 1 for c in cells)
    r = left.first()
    most = max(labels.count(x) for x in labels)
    assert (r["mine"], r["theirs"], r["rows"]) == (-(-most // block), -(-(n - most) // block), n)
