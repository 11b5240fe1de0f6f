"""Decontamination against a plain comparison of windows, and on planted cases."""

import re

from millrace.llm import decontaminate as d

DOCS = "doc_id bigint, text string, item_id string, h int"
ITEMS = "item_id bigint, text string, h string"
QUESTION = (
    "On Monday Anna buys 12 apples and 3 pears for her friends. Later that day Anna gives 5 km of rope "
    "to the club, and 12 apples stay at home with her sister in the kitchen."
)


def run(spark, docs, items):
    frame = spark.createDataFrame([(i, t, None, 1) for i, t in docs], DOCS)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    return {(r.doc_id, r.item_id): r for r in d.contaminated(frame, bench).collect()}


def test_templates(spark):
    row = spark.createDataFrame([("So, Bob Ray Lee  ran\t3,5 km!\nThen Ann slept.",)], "text string")
    m = row.select(d.marked(row.text).alias("m")).first().m
    assert m == f"so {d.NAME}bob {d.NAME}ray {d.NAME}lee ran {d.NUMBER}3{d.POINT}5 {d.UNIT}km then {d.NAME}ann slept"
    t = row.select(d.template(d.marked(row.text)).alias("t")).first().t
    assert t == f"so {d.NAME} {d.NAME} {d.NAME} ran {d.NUMBER} {d.UNIT} then {d.NAME} slept"


def test_planted_cases(spark):
    filler = "some other words that stand around it and are never part of any question at all "
    other = QUESTION.replace("Anna", "Zoe").replace("12", "40").replace("3 pears", "9 pears").replace("5 km", "77 mi")
    broken = QUESTION.replace("Later that day Anna", "Later that day Karl").replace("and 12 apples", "and 99 apples")
    docs = [
        (1, filler + QUESTION + " " + filler),
        (2, filler * 300 + QUESTION.upper().lower()),
        (3, filler + other),
        (4, filler * 50),
        (5, None), (6, ""), (7, "word"), (None, QUESTION),
        (8, QUESTION), (8, QUESTION),
        (9, "On Monday Anna buys 12 apples and"),
        (10, QUESTION.replace(" ", "\n\t ")),
    ]
    items = [(1, QUESTION), (2, "too short"), (3, None), (None, QUESTION), (4, QUESTION), (4, QUESTION)]
    got = run(spark, docs, items)
    found = {i for i, _ in got}
    assert {1, 3, 8, 10} <= found and not {4, 5, 6, 7, 9, None} & found
    assert got[1, 1].same_values and not got[3, 1].same_values
    assert {j for i, j in got if i == 1} == {1, 4}
    # Values that disagree with themselves along one alignment are no copy of the question.
    assert run(spark, [(1, broken)], items) == {}
    kept = d.without_leaks(
        spark.createDataFrame([(i, t, None, 1) for i, t in docs], DOCS),
        spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS),
    )
    assert {r.doc_id for r in kept.collect()} == {2, 4, 5, 6, 7, 9, None} - (found & {2})


def test_verbatim_passages_equal_plain_search(spark):
    words = [f"{a}{b}" for a in "bcdfg" for b in "aeiou"]
    items = [(k, " ".join(words[(k * i * i + i) % 25] for i in range(20 + k))) for k in range(1, 9)]
    docs = [
        (100 * k + n, f"start {' '.join(t.split()[: 8 + n])} stop {k} end")
        for k, t in items
        for n in range(0, 14, 2)
    ]

    def windows(text):
        w = re.findall(r"[a-z]+|[0-9]+", text)
        return {i: tuple(w[i : i + d.WINDOW]) for i in range(len(w) - d.WINDOW + 1)}

    want = {}
    for i, t in docs:
        have = set(windows(t).values())
        for k, q in items:
            met = sum(w in have for w in windows(q).values())
            if met >= min(d.NEEDED, len(windows(q))):
                want[i, k] = met
    assert {k: r.windows for k, r in run(spark, docs, items).items()} == want


def test_hashes_in_several_blocks_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(d, "BROADCAST_HASHES", 7)
    assert set(run(spark, [(1, QUESTION)], [(1, QUESTION)])) == {(1, 1)}
    assert run(spark, [], [(1, QUESTION)]) == {} == run(spark, [(1, QUESTION)], [])


def test_names_at_starts_rows_of_names_and_any_case(spark):
    tom = "Tom has 5 apples. Tom buys 3 more. How many apples does Tom have?"
    towns = "Yesterday the train from Boston to Chicago left early, so people from Boston had to wait for Chicago again."
    filler = "some other words that stand around it and are never part of any question "
    docs = [
        (1, filler + tom.replace("Tom", "Ann")),
        (2, filler + towns.replace("Boston", "New York").replace("Chicago", "Los Angeles")),
        (3, (filler + QUESTION + " " + filler).title()),
        (4, (filler + QUESTION).lower()),
        (5, filler * 9),
        (6, filler + towns.replace("to Chicago", "to New York")),
    ]
    got = run(spark, docs, [(1, tom), (2, towns), (3, QUESTION)])
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 3)}
    assert not got[1, 1].same_values and not got[2, 2].same_values and got[3, 3].same_values


def test_short_items_and_items_without_windows(spark):
    hang = "Who painted the Mona Lisa and in which city does it hang today?"
    sums = "What is 12 + 5 * 3 - 7 * 2 + 9 equal to ?"
    texas = "What Is The Capital City Of The State Of Texas?"
    items = [(1, hang), (2, sums), (3, texas), (4, "Name the largest ocean."), (5, "?!"), (6, None)]
    docs = [
        (10, f"as they say {hang} and more"), (11, f"Question: {hang}"), (12, f"It is so. {hang}"),
        (20, f"so, {sums.lower()} yes"), (21, sums.replace("12", "13")),
        (30, f"well {texas.lower()}"),
        (40, "please NAME the largest\n ocean, now"), (41, "name the largest lake"),
        (50, "?!"), (51, None),
    ]
    assert set(run(spark, docs, items)) == {(10, 1), (11, 1), (12, 1), (20, 2), (30, 3), (40, 4)}
