"""The ordinal model on held-out texts, its thresholds and odd inputs."""

import random

import numpy as np

from millrace.llm import quality
from millrace.llm.queries import ratings

SCHEMA = "doc_id bigint, text string, grade string, n int"


def text(rng, grade):
    words = [f"{rng.choice('abcdefgh')}{rng.choice('aeiou')}{rng.randrange(40)}" for _ in range(rng.randint(20, 300))]
    if grade == 0:
        for _ in range(4):
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "nasty", "rotten"]))
    if grade == 1:
        words = [w + "###" for w in words] if rng.random() < 0.5 else words[:3] * 40
    return " ".join(words)


def test_held_out_accuracy(spark):
    rng = random.Random(4)
    grades = [rng.choice([0, 1, 2, 2, 2]) for _ in range(900)]
    rows = [(i, text(rng, g), None, 1) for i, g in enumerate(grades)]
    docs = spark.createDataFrame([*rows, (2000, None, "x", 1), (2001, "", None, 1), (None, "some words", None, None), (2002, "long " * 100_000, None, 1)], SCHEMA)
    labels = spark.createDataFrame(
        [(i, int(g > 0) if g != 0 else None, int(g == 0)) for i, g in enumerate(grades[:600])]
        + [(None, 1, 0), (5, None, None), (9999, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    ).selectExpr("doc_id", "CASE WHEN toxic = 1 THEN 1 ELSE quality END AS quality", "toxic")
    truth = spark.createDataFrame([(i, g) for i, g in enumerate(grades[:600])], "doc_id bigint, grade int")
    model = quality.train(docs, truth)
    assert (np.diff(model.thresholds) > 0).all()
    out = quality.scored(docs, model)
    assert out.columns == [*docs.columns, "expected_grade", "top_probability"]
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows) + 4
    held = range(600, 900)
    right = [(got[i].top_probability >= 0.5) == (grades[i] == 2) for i in held]
    assert np.mean(right) > 0.85  # always saying good gives 0.6
    means = [np.mean([got[i].expected_grade for i in held if grades[i] == g]) for g in (0, 1, 2)]
    assert max(means[0], means[1]) < means[2]
    assert {r.grade for r in ratings(labels).collect()} == {0, 2, None}
    kept = quality.select_good(docs, model)
    assert kept.columns == docs.columns


def test_without_ratings(spark):
    docs = spark.createDataFrame([(1, "a text", None, 1)], SCHEMA)
    none = spark.createDataFrame([], "doc_id bigint, grade int")
    only = spark.createDataFrame([(1, 2)], "doc_id bigint, grade int")
    assert quality.scored(docs, quality.train(docs, none)).count() == 1
    assert quality.scored(docs, quality.train(docs, only)).first().top_probability > 0.5
    empty = docs.filter("doc_id > 5")
    assert quality.scored(empty, quality.train(empty, only)).count() == 0
