"""Exact top-k against a full scan."""

import numpy as np
import pytest

from millrace.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, v string, label int"


def plain(rows, every, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good[i] = [int(np.floor(1024 * float(np.float32(x)))) for x in v]
    out = []
    for q, v in good.items():
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good.items() if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def corpus(n, dims, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) * rng.choice([0.01, 0.2, 3], dims)
    rows = [(i, x[i].tolist()) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(30)]  # ties
    rows += [(1000 + i, v) for i, v in enumerate([None, [None] * dims, [float("nan")] * dims, [float("inf")] + [0.0] * (dims - 1)])]
    return rows + [(None, rows[0][1]), rows[5], (1100, [0.0] * dims), (1200, []), (1300, [1.0, -2.0])]


@pytest.mark.parametrize("shard_rows", [40, 100_000])
def test_equals_full_scan(spark, shard_rows):
    rows = corpus(300, 7, 1)
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    whole = topk.quantised(frame).cache()
    got = topk.top_k(topk.build_index(whole, shard_rows), whole.filter("vec_id % 20 = 0"), query_rows=9)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 20, 10)


def test_index_prunes_and_stays_exact():
    rng = np.random.default_rng(2)
    x = np.floor(1024 * rng.normal(size=(5000, 32))).astype(np.int64)
    index = topk.Index(np.arange(5000), x)
    again = topk.Index.read(index.bytes())
    for q in (3, 77):
        want = sorted((-int(s), i) for i, s in enumerate(x @ x[q]) if i != q)[:10]
        for each in (index, again):
            ids, scores = each.best(q, x[q], 10)
            assert [(-s, i) for i, s in zip(ids.tolist(), scores.tolist())] == want


def test_few_rows_and_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.search(empty).count() == 0
    two = spark.createDataFrame([(0, [1.0], "", 1), (1, [2.0], "", 1)], SCHEMA)
    assert [tuple(r) for r in topk.search(two).collect()] == [(0, 1, 1, 1024 * 2048)]


def test_stops_when_proven():
    """A query whose best are far ahead stops early, one among equals reads on."""
    rng = np.random.default_rng(5)
    x = np.floor(1024 * rng.normal(size=(4000, 16))).astype(np.int64)
    x[:40] = 40 * x[0]
    index = topk.Index(np.arange(4000), x)
    want = sorted((-int(s), i) for i, s in enumerate(x @ x[1]) if i != 1)[:10]
    for looks in (topk.LOOKS, (0.5,), (0.01, 1.0)):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(topk, "LOOKS", looks)
            ids, scores = index.best(1, x[1], 10)
            assert [(-s, i) for i, s in zip(ids.tolist(), scores.tolist())] == want


def test_only_empty_vectors_and_too_long_ones(spark):
    empty = spark.createDataFrame([(0, [], "", 1), (1, [], "", 1)], SCHEMA)
    assert [tuple(r) for r in topk.search(empty).collect()] == [(0, 1, 1, 0)]
    long = spark.createDataFrame([(0, [1e13, 1.0], "", 1), (1, [-1e13, 1.0], "", 1)], SCHEMA)
    with pytest.raises(Exception, match="too long"):
        topk.search(long).collect()
