"""Ranked lexical search against a plain version."""

import math
import random
import re
from collections import Counter

from millrace.llm import lexical

SCHEMA = "doc_id bigint, text string, rank string, term int"


def plain_terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in found]


def plain(rows, items, k):
    docs = [(doc_id, Counter(plain_terms(text))) for doc_id, text, *_ in rows]
    docs = [(i, c, c.total()) for i, c in docs if c]
    every, length = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    wanted = {}
    for item_id, text in items:
        if item_id is not None:
            wanted.setdefault(item_id, set()).update(plain_terms(text))
    out = []
    for item_id, mine in wanted.items():
        scored = []
        for doc_id, c, n in docs:
            m = 10 + 90 * n * every // length
            score = sum(
                math.floor(1000 * math.log((2 * every + 2) / (2 * df[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in mine
                if c[t]
            )
            if score > 0 and doc_id is not None:
                scored.append((-score, doc_id))
        out += [(item_id, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def cases():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(90)] + ["ÄRGER", "Naïve", "日本", "the", "The", "THE"]
    weights = [1 / (i + 1) for i in range(90)] + [0.2] * 3 + [2] * 3
    rows = [
        (3 * i - 40, rng.choice(" _-\n").join(rng.choices(words, weights, k=rng.randint(0, 80))), "r", 1)
        for i in range(400)
    ]
    rows += [rows[4]] * 12 + [(9000, None, "r", 1), (9001, "", "r", 1), (9002, "w1 " * 50_000, "r", 1)]
    rows += [(None, "w1 w89 the", "r", 1)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(25)]
    # more terms than one mask word holds, no term, unknown terms, null, a repeated item
    items += [(50, " ".join(words)), (51, "-- !"), (52, "zzz yyy"), (53, None), (None, "w1"), (3, "w7 the")]
    return rows, items


def run(spark, rows, items, k=10):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    wanted = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, score int")
    found = lexical.search(docs, wanted, k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(tuple(r) for r in found.collect())


def test_equals_plain_version(spark):
    rows, items = cases()
    assert run(spark, rows, items) == plain(rows, items, 10)
    assert run(spark, rows, items, 1) == plain(rows, items, 1)


def test_small_blocks(spark, monkeypatch):
    rows, items = cases()
    monkeypatch.setattr(lexical, "QUERIES_AT_ONCE", 9)
    monkeypatch.setattr(lexical, "POSTINGS_AT_ONCE", 40)
    monkeypatch.setattr(lexical, "SCORED_AT_ONCE", 1)
    assert run(spark, rows, items) == plain(rows, items, 10)


def test_empty_tables(spark):
    rows, items = cases()
    assert run(spark, [], items) == run(spark, rows, []) == run(spark, [(1, None, "", 0)], items) == []


def test_groups_left_out_are_below_the_tenth(monkeypatch):
    """Of many documents that match little, few are scored."""
    import numpy as np

    rng = np.random.default_rng(2)
    docs, per_doc = 5000, 6
    term = np.concatenate([rng.permutation(40)[:per_doc] for _ in range(docs)])
    term[: 12 * per_doc] = np.tile(np.arange(per_doc), 12)
    block = lexical.Block(
        np.arange(docs), np.full(docs, per_doc), term, np.repeat(np.arange(docs), per_doc),
        np.ones(len(term), np.int64), (docs, docs * per_doc),
    )
    scored = []
    whole = lexical.Block.scores
    monkeypatch.setattr(lexical.Block, "scores", lambda self, d, *a: scored.append(len(d)) or whole(self, d, *a))
    none = np.empty(0, np.int64)
    held = block.best(np.arange(per_doc), np.full(40, 100), 10, (none, none))
    assert held[1].tolist() == list(range(10))
    assert sum(scored) < 100
