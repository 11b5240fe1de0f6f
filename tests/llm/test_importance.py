"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

from pyspark.sql import functions as F

from millrace.llm import importance

SCHEMA = "doc_id bigint, text string, rank string, score int"


def plain_features(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [crc32(r.encode()) % 10_000 for r in runs]


def plain(rows, targets, percent, least_words):
    made = [plain_features(t) for _, t, *_ in rows]
    s = Counter(b for _, f in made for b in f)
    t = Counter(b for x in targets for b in plain_features(x)[1])
    all_s, all_t = s.total() + 10_000, t.total() + 10_000
    out = []
    for (doc_id, *_), (words, found) in zip(rows, made):
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in found)
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([doc_id, len(found), weight, score, words >= least_words])
    able = sorted((x for x in out if x[4] and x[0] is not None), key=lambda x: (-x[3], x[0], x[1]))
    ranks = {id(x): i + 1 for i, x in enumerate(able[: percent * len(able) // 100])}
    return sorted(((*x[:4], ranks.get(id(x))) for x in out), key=str)


def cases():
    rng = random.Random(3)
    words = ["Alpha", "beta", "GAMMA-ray", "x1", "ÄRGER", "Σ", "it's", "naïve", "a_b"]
    out = [(7 * i - 30, " ".join(rng.choices(words, k=rng.randint(0, 60))), "r", 1) for i in range(200)]
    out += [out[5]] * 9 + [(5000, None, "r", 1), (5001, "", "r", 1), (5002, "\x00 \x7f!", "r", 1)]
    return out + [(None, "no id " * 30, "r", 1), (5003, "long word " * 40_000, "r", 1)]


TARGETS = ["alpha beta x1", "Naïve ärger", None, "it's GAMMA"]


def run(spark, rows, targets, **more):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    wanted = spark.createDataFrame([(t, 1) for t in targets], "text string, doc_id int")
    return importance.resample(docs, wanted, **more)


def test_equals_plain_version(spark, monkeypatch):
    monkeypatch.setattr(importance, "WORDS_AT_ONCE", 50)
    for percent, least in ((5, 20), (50, 3), (100, 0)):
        got = run(spark, cases(), TARGETS, percent=percent, least_words=least)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == plain(cases(), TARGETS, percent, least)


def test_empty_tables(spark):
    assert run(spark, [], TARGETS).collect() == []
    got = run(spark, cases()[:20], [], percent=50, least_words=1)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(cases()[:20], [], 50, 1)
    assert {r["rank"] for r in run(spark, cases()[:5], TARGETS).collect()} == {None}


def test_cutoff_is_the_exact_order_statistic(spark):
    rng = random.Random(1)
    values = [rng.choice([-(2**40), -3, 0, 0, 0, 7, 2**50, rng.randint(-100, 100)]) for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "x bigint")
    for wanted in (1, 2, 77, 250, 499, 500):
        assert importance.cutoff(rows, F.col("x"), wanted) == sorted(values, reverse=True)[wanted - 1]


def test_ranks_over_range_partitions(spark):
    rows = [(i, 1, 5 if i % 3 else i) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, n_features bigint, score bigint")
    got = {r.doc_id: r["rank"] for r in importance.ranked(frame).collect()}
    best = sorted(rows, key=lambda r: (-r[2], r[0]))
    assert got == {r[0]: i + 1 for i, r in enumerate(best)}


def test_sum_over_wide_ranges(spark):
    assert importance.cutoff(spark.range(10), -F.col("id"), 3) == -2
