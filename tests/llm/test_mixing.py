"""Targets against the stated procedure, draws against their definition."""

import random
from collections import Counter

import numpy as np

from millrace.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, size string"


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), {}, set(names)
    while True:
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 3.0 * sizes[s] for s in over}
        open_ -= over


def corpus():
    rng = random.Random(2)
    rows = []
    for i in range(900):
        source = rng.choice(["a", "a", "a", "b", "é", "ab", None, "Z", "tiny"])
        n = rng.choice([0, 1, 5, 60, 400]) if source != "tiny" else rng.choice([0, 1])
        rows.append((i, "\t".join(["w"] * n), source, "x"))
    rows += [(900, "long " * 30_000, "a", None), (901, None, "b", None), (None, "x y z", "b", None), rows[5], rows[5]]
    return rows


def test_targets_and_draws(spark):
    rows = corpus()
    frame = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mixed(frame, shards=8).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter((i, t, s) for i, t, s, _ in rows)
    sizes, taken = Counter(), Counter()
    for _, t, s, _ in rows:
        sizes[s] += len((t or "").split())
    want = plain_targets(sizes)
    by_shard = {k: set() for k in range(8)}
    for r in got:
        assert r.size == len((r.text or "").split())
        assert r.taken == sum(p.words for p in r.pieces) <= 3 * r.size
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        taken[r.source] += r.taken
        for p in r.pieces:
            assert 0 <= p.first_word and p.first_word + p.words <= r.size
            by_shard[p.shard].add((r.source, p.block, p.epoch))
    for s, target in want.items():
        assert abs(taken[s] - target) <= max(2, 0.01 * target)
    blocks = [len(x) for x in by_shard.values()]
    assert max(blocks) - min(blocks) <= 3  # halving rounds once a level
    assert sum(blocks) == len(set.union(*by_shard.values()))
    again = mixing.mixed(frame.repartition(5), shards=8).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.taken, str(r.pieces))
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_tree_is_exact_and_permutation_is_one():
    quotas = np.array([1000, 3, 0, 77, 5], np.int64)
    counts = [mixing.shard_counts(quotas, 7, k, 3) for k in range(7)]
    assert (sum(counts) == quotas).all()
    sizes = [c.sum() for c in counts]
    assert max(sizes) - min(sizes) <= 3
    for n in (1, 2, 3, 5, 64, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, 9).tolist()) == list(range(n))
    big = np.array([2 * 10**9, 10**9], np.int64)
    assert mixing.draw(np.random.default_rng(1), big, 10**9).sum() == 10**9


def test_shards_and_empty_table(spark):
    assert mixing.mixed(spark.createDataFrame([], SCHEMA)).count() == 0
    empty = mixing.mixed(spark.createDataFrame([(1, None, None, None)], SCHEMA)).collect()
    assert [(r.taken, r.target, r.pieces) for r in empty] == [(0, 0.0, [])]
    frame = spark.createDataFrame(corpus(), SCHEMA)
    mix = mixing.mixed(frame, shards=4)
    rows = mixing.shard_rows(mix).collect()
    assert sum(r.words for r in rows) == sum(r.taken for r in mix.collect())


def test_draws_by_inversion_follow_the_law():
    """Against numpy's draws where it has them, and exact moments where it has none."""
    rng = np.random.default_rng(4)
    got = np.array([mixing.by_inversion(rng, 30, 20, 12) for _ in range(20_000)])
    want = rng.hypergeometric(30, 20, 12, 20_000)
    for k in range(13):
        assert abs((got == k).mean() - (want == k).mean()) < 0.015
    assert mixing.by_inversion(rng, 5, 0, 3) == 3 and mixing.by_inversion(rng, 0, 5, 3) == 0
    count, others, n = 3 * 10**10, 10**10, 10**9
    got = np.array([mixing.by_inversion(rng, count, others, n) for _ in range(3000)])
    total = count + others
    spread = (n * (count / total) * (others / total) * (total - n) / (total - 1)) ** 0.5
    assert abs(got.mean() - n * 0.75) < 4 * spread / 3000**0.5
    assert abs(got.std() / spread - 1) < 0.06
    assert abs((got > n * 0.75 + spread).mean() - 0.1587) < 0.03
