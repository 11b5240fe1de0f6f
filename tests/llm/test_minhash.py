"""MinHash near-duplicates against all pairs, and the pigeonhole chunks themselves."""

import random
from itertools import combinations

import numpy as np
import pytest

from millrace.llm import minhash

SCHEMA = "doc_id bigint, text string, node string, size int, value int"


def plain_set(text, words=3):
    t = (text or "").encode().lower().split()
    return {b" ".join(t[i : i + words]) for i in range(max(1, len(t) - words + 1))} if t else set()


def plain(rows, percent=85):
    sets = [(i, plain_set(t)) for i, t, *_ in rows]
    label = {i: i for i, _ in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for (a, x), (b, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            low, high = sorted((root(a), root(b)))
            label[high] = low
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets)


def varied(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def cases():
    rng = random.Random(4)
    rows, n = [], 0

    def add(text):
        nonlocal n
        n += 3
        rows.append((n, text, "x", 1, 1))

    for _ in range(30):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(40, 400))]
        add(" ".join(base))
        for changes in (1, 2, 3, 6):
            add(varied(rng, base, max(1, changes * len(base) // 100)))
    for _ in range(40):
        add(" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(1, 60))))
    for text in (None, "", " \n\t", "one", "ONE", "one two", "one\x0btwo", "ÄA ä a", "äa ä a", "long text " * 60_000, "a b c " * 9):
        add(text)
    rows += [rows[0]] * 3 + [rows[-5]]
    rng.shuffle(rows)
    return rows


def got(frame):
    assert frame.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(tuple(r) for r in frame.collect())


def test_equals_all_pairs(spark):
    docs = spark.createDataFrame(cases(), SCHEMA).repartition(5)
    assert got(minhash.near_duplicates(docs)) == plain(cases())


def test_large_groups_are_dealt_out(spark, monkeypatch):
    """A chain, a dense group and members beside it, in blocks of a few members."""
    monkeypatch.setattr(minhash, "BUCKET_BLOCK", 8)
    monkeypatch.setattr(minhash, "GROUP_BLOCK", 8)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(300)]
    texts = [varied(rng, base, rng.choice([1, 2, 3, 9, 12, 15])) for _ in range(120)]
    chain = list(base)
    for i in range(0, 300, 7):
        chain[i] = f"c{i}"
        texts.append(" ".join(chain))
    rows = [(i, t, "x", 1, 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(minhash.near_duplicates(docs)) == plain(rows)


def test_rows_without_id_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d", "x", 1, 1), (4, "a b c d", "x", 1, 1)], SCHEMA)
    assert {tuple(r) for r in minhash.near_duplicates(docs).collect()} == {(None, 2, None, None), (4, 2, 4, True)}
    assert minhash.near_duplicates(docs.limit(0)).collect() == []


def test_chunks_find_every_signature_within_the_distance(spark):
    """Signatures at exactly the distance share a key, however the errors are placed."""
    rng = np.random.default_rng(6)
    variants = minhash.chunk_variants()
    chunks = {}
    for chunk, kept in variants:
        chunks.setdefault(chunk, set()).update(kept)
    assert sorted(p for c in chunks.values() for p in c) == list(range(minhash.POSITIONS))
    for trial in range(3000):
        wrong = set(rng.permutation(minhash.POSITIONS)[: minhash.DISTANCE].tolist())
        if trial % 2:  # as evenly as errors can be placed
            order = [p for i in range(8) for c in chunks.values() for p in sorted(c)[i : i + 1]]
            wrong = set(order[: minhash.DISTANCE])
        assert any(not wrong & set(kept) for _, kept in variants)


@pytest.mark.parametrize("percent", [85, 95])
def test_signatures_of_linked_sets_are_within_the_distance(percent):
    rng = np.random.default_rng(percent)
    for n in (7, 20, 100, 1000):
        for _ in range(300):
            both = -(-percent * n // 100)
            pool = rng.integers(0, 1 << 63, n, np.uint64)
            a = np.unique(np.concatenate([pool[:both], pool[both : both + (n - both) // 2]]))
            b = np.unique(np.concatenate([pool[:both], pool[both + (n - both) // 2 :]]))
            differ = minhash.signature(a) != minhash.signature(b)
            assert differ.sum() <= minhash.DISTANCE
