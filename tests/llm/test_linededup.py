"""Line dedup against a comparison of all pairs of lines."""

import random

from millrace.llm import linededup as ld

SCHEMA = "doc_id bigint, text string, n_chars bigint, line string, first int"


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


def plain(docs):
    """Places that go, and whether by an equal line."""
    lines = sorted(
        {
            (i, n, tuple(ld.words_of(raw)))
            for i, text in docs
            if i is not None
            for n, raw in enumerate((text or "").encode().split(b"\n"))
        }
    )
    lines = [x for x in lines if len(x[2]) >= ld.MIN_WORDS]
    out = {}
    for k, (i, n, words) in enumerate(lines):
        for j, m, other in lines[:k]:
            if words == other:
                out[i, n] = 0
                break
        else:
            long = [x for x in lines[:k] if len(x[2]) >= ld.NEAR_WORDS]
            if len(words) >= ld.NEAR_WORDS and any(edit_distance(words, x[2]) == 1 for x in long):
                out[i, n] = 1
    return out


def corpus():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(6)]
    lines = []
    for _ in range(90):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 20, 45]))]
        lines.append(base)
        for _ in range(rng.randint(0, 3)):
            c, p = list(base), rng.randrange(len(base))
            kind = rng.randrange(4)
            if kind == 0:
                c[p] = rng.choice(vocabulary).upper()
            elif kind == 1:
                c.insert(p, rng.choice(vocabulary))
            elif kind == 2:
                del c[p]
            else:
                c[p], c[-1] = "x", "y"
            lines.append(c)
    rng.shuffle(lines)
    docs = [(i, "\n".join("  ".join(x) for x in lines[5 * i : 5 * i + 5])) for i in range(60)]
    return docs + [(100, None), (101, ""), (102, "\n \n"), (103, docs[3][1]), (None, docs[3][1]), docs[4]]


def test_equals_all_pairs(spark):
    docs = corpus()
    frame = spark.createDataFrame([(i, t, 0, "x", 1) for i, t in docs], SCHEMA)
    got = ld.repeated_lines(frame).collect()
    assert len({(r.doc_id, r.line_no) for r in got}) == len(got)
    assert {(r.doc_id, r.line_no): r.edits for r in got} == plain(docs)
    assert all((r.kept_doc_id, r.kept_line_no) < (r.doc_id, r.line_no) for r in got)


def test_texts_lose_those_lines_only(spark):
    docs = corpus()
    gone = plain(docs)
    frame = spark.createDataFrame([(i, t, 7, "x", 1) for i, t in docs], SCHEMA)
    out = ld.without_repeated_lines(frame)
    assert out.columns == frame.columns
    want = []
    for i, t in docs:
        lines = (t or "").split("\n")
        left = "\n".join(x for n, x in enumerate(lines) if (i, n) not in gone)
        changed = any((i, n) in gone for n in range(len(lines)))
        if not changed:
            want.append((str(i), str(t), 7))
        elif any(len(x.split()) >= ld.MIN_WORDS for x in left.split("\n")):
            want.append((str(i), left, len(left)))
    assert sorted((str(r.doc_id), str(r.text), r.n_chars) for r in out.collect()) == sorted(want)


def test_hot_line_long_text_and_empty_table(spark):
    hot = "one two three four five six seven eight nine"
    rows = [(i, f"{hot} {'ten ' * (i % 3 == 0)}\nonly in {i} again", 0, "", 0) for i in range(200)]
    rows.append((500, " ".join(f"t{i}" for i in range(40_000)), 0, "", 0))
    rows.append((501, " ".join(f"t{i}" for i in range(40_000) if i != 20_000), 0, "", 0))
    got = ld.repeated_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.doc_id, r.line_no) for r in got} == {(i, 0) for i in range(1, 200)} | {(501, 0)}
    assert ld.repeated_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_stage_keeps_texts_without_spaces_and_short_lines(spark):
    import corpus_pipeline

    shared = "All rights reserved.\n"
    texts = ["first of all", "今天天气很好。我们一起去公园散步。", "apple\npear\nplum", "", " \t\n"]
    docs = [(i, shared + t, 0, "x", 1) for i, t in enumerate(texts)]
    stage = dict(corpus_pipeline.STAGES)["line_dedup"]
    out = stage(spark, spark.createDataFrame(docs, SCHEMA), "")
    assert {r.doc_id: r.text for r in out.collect()} == {0: shared + texts[0], 1: texts[1], 2: texts[2]}
