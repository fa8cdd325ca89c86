"""Neighbours where a few vectors are very much longer than all others."""

from __future__ import annotations

import numpy as np
import pytest

from flagstar.llm import op08_nndescent as op8


@pytest.mark.parametrize("ratio", [1.0, 1e4])
def test_recall_beside_long_vectors(spark, ratio):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1500, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[[3, 700, 1201]] *= ratio
    x = x.astype("f4").astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    index = op8.Index(df)
    # the graph holds the nearest, not arbitrary ones
    graph = {r.node: set(r.ids) for r in index.graph.collect()}
    plain = [i for i in range(0, 1500, 20) if i not in (3, 700, 1201)]
    far = ((x[plain][:, None] - x[None]) ** 2).sum(axis=2)
    kept = np.mean([len(set(np.argsort(d)[1:9].tolist()) & graph[i]) / 8 for i, d in zip(plain, far)])
    assert kept >= 0.8
    got = {}
    for r in index.search(df.select("vec_id").where("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, ids in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(ids & set(np.argsort(-s)[:20].tolist()))
    assert hits >= 0.9 * 20 * len(got)
