"""The pipeline's stages, one after another, against plain versions of each."""

import random

import numpy as np

import corpus_pipeline
from millrace.llm import decontaminate, mixing, quality
from test_linededup import plain as plain_lines
from test_simhash import plain_components

WORDS = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]


def prose(rng, n):
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randint(9, 20))) for _ in range(n)]


def tables():
    rng = random.Random(8)
    questions = [" ".join(rng.choice(WORDS) for _ in range(25)) for _ in range(4)]
    docs, labels = [], []
    for i in range(240):
        lines, bad = prose(rng, rng.randint(3, 8)), i % 6 == 5
        if bad:
            lines = [" ".join(f"{w}%%%" for w in line.split()) for line in lines]
        elif i % 10 == 1 and i > 30:
            lines = list(docs[i - 20][1].split("\n"))[:-1] + prose(rng, 4)
        elif i % 23 == 0:
            lines.insert(1, questions[i % 4])
        docs.append((i, "\n".join(lines), "en", f"s{i % 3}", 0))
        if i % 2:
            labels.append((i, 0 if bad else 1, 0))
    docs += [(500, None, None, None, None), (501, "", "en", "s1", 0), (502, docs[3][1], "en", None, 1)]
    return docs, labels, list(enumerate(questions))


def test_stages_equal_plain_versions(spark, tmp_path):
    docs, labels, questions = tables()
    frames = {
        "documents": (docs, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        "labels": (labels, "doc_id bigint, quality int, toxic int"),
        "benchmark": (questions, "item_id bigint, text string"),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = now.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "line_dedup", "near_dedup", "decontamination", "mixing"]

    def step(name, frame):
        out = stages[name](spark, frame, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    texts = {r.doc_id: r.text for r in now.collect()}
    rated = [(i, 0 if t else 2 if q else 1) for i, q, t in labels]
    slots = [np.array(sorted({quality.slot(f) for f in quality.features(texts[i])})) for i, _ in rated]
    model = quality.fit(slots, np.array([{0: 0, 1: 1, 2: 2}[g] for _, g in rated]))
    scores = {i: sum(model.weights[quality.slot(f)] for f in quality.features(t)) for i, t in texts.items()}
    good = {i for i, s in scores.items() if model.tails(np.array([s]))[0, -1] >= 0.5}
    now = step("quality_classifier", now)
    assert now.columns == columns and {r.doc_id for r in now.collect()} == good
    assert not {i for i in good if i < 240 and i % 6 == 5}

    gone = plain_lines([(r.doc_id, r.text) for r in now.collect()])
    want = {}
    for r in now.collect():
        lines = (r.text or "").split("\n")
        left = [x for n, x in enumerate(lines) if (r.doc_id, n) not in gone]
        if len(left) == len(lines):
            want[r.doc_id] = r.text
        elif any(len(x.split()) >= 3 for x in left):
            want[r.doc_id] = "\n".join(left)
    now = step("line_dedup", now)
    assert now.columns == columns and {r.doc_id: r.text for r in now.collect()} == want

    from millrace.llm.simhash import fingerprint

    both = {i: [x & (2**64 - 1) for x in fingerprint(t, 5, True)] for i, t in want.items()}
    wide = {i: a for i, (a, _) in both.items()}
    near = plain_components(wide, 8)
    now = step("near_dedup", now)
    kept = {r.doc_id for r in now.collect()}
    assert now.columns == columns and kept >= {i for i in want if near[i] == i}
    assert len({tuple(both[i]) for i in kept}) == len(kept)

    now = step("decontamination", now)
    leaked = {
        i for i in kept for _, q in questions
        if sum(" ".join(q.split()[k : k + 8]) in " ".join((want[i] or "").split()) for k in range(18)) >= decontaminate.NEEDED
    }
    assert leaked and now.columns == columns and {r.doc_id for r in now.collect()} == kept - leaked

    sizes = {r.doc_id: len((r.text or "").split()) for r in now.collect()}
    out = step("mixing", now)
    assert set(columns) <= set(out.columns)
    rows = out.collect()
    assert {r.doc_id for r in rows} <= set(sizes)
    assert all(0 < r.taken <= 3 * r.size and r.size == sizes[r.doc_id] for r in rows)
    total = sum(r.taken for r in rows)
    assert abs(total - sum(sizes.values())) <= 0.02 * sum(sizes.values()) + 10
    assert mixing.MOST == 3

    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r.doc_id, r.taken) for r in whole.collect()) == sorted((r.doc_id, r.taken) for r in rows)
