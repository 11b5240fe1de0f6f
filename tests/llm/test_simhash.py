"""SimHash near-duplicates against all pairs, and the pigeonhole plan itself."""

import random

import numpy as np
import pytest
import xxhash

from millrace.llm import simhash

SCHEMA = "doc_id bigint, text string, fp string, node int"


def plain_fingerprint(text, words=4):
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    shingles = [b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def plain_components(prints, max_bits):
    label = {i: i for i in prints}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if bin(prints[a] ^ prints[b]).count("1") <= max_bits:
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: root(i) for i in ids}


def texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 120))] for _ in range(60)]
    out = [" ".join(b) for b in base]
    for b in base[:25]:
        for _ in range(4):
            c = list(b)
            c[rng.randrange(len(c))] = rng.choice(vocabulary)
            out.append("\t".join(c))
    out += [out[0]] * 5 + [None, "", " \n ", " one two", "ÄA äa", "a " * 30_000]
    return out


def test_equals_all_pairs(spark):
    rows = [(7 + 3 * i, t, "x", 1) for i, t in enumerate(texts())]
    rows.append(rows[3])
    docs = spark.createDataFrame(rows + [(None, "no id", "x", 1)], SCHEMA)
    got = simhash.near_duplicates(docs).collect()
    prints = {i: plain_fingerprint(t) for i, t, *_ in rows}
    groups = plain_components(prints, 4)
    assert sorted((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in got if r.doc_id) == sorted(
        (i, prints[i], groups[i]) for i, *_ in rows
    )
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_dense_group_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(1)
    prints = set()
    for centre in (0, 0x0F0F33CC55AA9966):
        while len(prints) < 150 * (1 + (centre > 0)):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 3)):
                x ^= 1 << b
            prints.add(x)
    prints |= {rng.getrandbits(64) for _ in range(200)}
    signed = {i: p for i, p in enumerate(sorted(prints))}
    nodes = spark.createDataFrame(
        [(i, p - (1 << 64) if p >> 63 else p, 0) for i, p in signed.items()],
        "node bigint, fp bigint, fp2 bigint",
    )
    links = simhash.links(nodes, 4)
    assert all(bin(signed[r.a] ^ signed[r.b]).count("1") <= 4 for r in links.collect())
    got = {r.node: r.component for r in simhash.components(links).collect()}
    assert {i: got.get(i, i) for i in signed} == plain_components(signed, 4)


def test_chain_of_links(spark):
    links = spark.createDataFrame(
        [(i, i + 1) for i in range(40)] + [(100, 100), (7, None), (300, 200), (200, 300)], "a int, b int"
    )
    got = {r.node: r.component for r in simhash.components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {200: 200, 300: 200}


@pytest.mark.parametrize("max_bits", [1, 4, 8])
def test_thresholds_cover_the_bound(max_bits):
    rng = np.random.default_rng(3)
    bits = rng.random((500, 64)) < np.linspace(0.05, 0.5, 64)
    bits[:, 1] = bits[:, 0]
    counts = bits.T.astype(float) @ bits
    parts = simhash.plan(500, counts, max_bits)
    used = [b for p in parts for b in p.bits]
    assert len(used) == len(set(used))
    assert sum(p.threshold + 1 for p in parts) == max_bits + 1


def test_empty_table_and_stage(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(5, "one two three four five six", "a", 1), (2, "One two three four five six", "b", 1)]
    docs = spark.createDataFrame([*rows, (9, "quite another text about other things", None, 2), (None, None, None, None)], SCHEMA)
    kept = simhash.keep_one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 9]


def test_similar_pairs_are_found_and_others_are_not(spark, monkeypatch):
    """Word-shingle Jaccard similarities around 0.8, against a comparison of all pairs."""
    monkeypatch.setattr(simhash, "GROUP_BLOCK", 4)
    rng = random.Random(2)
    rows = []
    for k in range(120):
        base = [f"a{rng.randrange(10**6)}" for _ in range(rng.choice([12, 60, 200]))]
        rows.append((1000 * k, " ".join(base), "x", 1))
        for n in range(1, rng.choice([2, 2, 9])):
            cut = rng.randint(1, max(2, len(base) // 4))
            rows.append((1000 * k + n, " ".join(base[cut:] + [f"b{rng.randrange(10**6)}" for _ in range(cut // 8)]), "x", 1))
    rows += [(5 * 10**6, None, "x", 1), (5 * 10**6 + 1, "", "x", 1), (5 * 10**6 + 2, rows[0][1] + "\n", "x", 1)]

    def shingles(text):
        w = (text or "").split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = {i: shingles(t) for i, t, *_ in rows}
    label = {i: i for i in sets}
    pairs = {}
    for a in sets:
        for b in sets:
            if a < b and (both := len(sets[a] & sets[b])):
                pairs[a, b] = both / len(sets[a] | sets[b])
    for (a, b), j in sorted(pairs.items()):
        if j >= 0.8 and label[a] != label[b]:
            x, y = sorted((label[a], label[b]))
            label = {i: x if g == y else g for i, g in label.items()}
    assert sum(0.8 <= j < 0.85 for j in pairs.values()) > 20 and sum(0.6 < j < 0.8 for j in pairs.values()) > 20
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(docs).collect()}
    assert got == label
