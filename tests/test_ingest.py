import json
from pathlib import Path

import pytest

from millrace.functions.rules import RuleSet
from millrace.operators.ingest import routed, run_statistics
from millrace.plans.jobs import ingest_files, ingest_stream
from millrace.sources.lines import read_lines, split_counts, with_line_numbers


def order(**changes):
    record = {
        "order_id": "O-1",
        "customer_id": "C-1",
        "amount": 42.5,
        "currency": "EUR",
        "created_at": "2026-04-01T10:12:00Z",
    }
    record.update(changes)
    return {k: v for k, v in record.items() if v != "absent"}


def judge(spark, lines, rules=RuleSet()):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i INT, line STRING")
    rows = routed(df, rules).orderBy("i").collect()
    return [(r["route"], r["errors"]) for r in rows]


@pytest.mark.parametrize(
    "record, errors",
    [
        (order(), []),
        (order(customer_id="absent"), ["missing_field:customer_id"]),
        (order(customer_id=None), ["null_field:customer_id"]),
        (order(amount="unknown"), ["amount_not_numeric"]),
        (order(amount=True), ["amount_not_numeric"]),
        (order(amount=42), []),
        (order(amount=0), []),
        (order(amount=-10), []),
        (order(amount=1e300), []),
        (order(amount=12345678901234567890123), []),
        (order(amount="42"), ["amount_not_numeric"]),
        (order(amount=None), ["null_field:amount"]),
        (order(amount=[]), ["amount_not_numeric"]),
        (order(amount={}), ["amount_not_numeric"]),
        (
            order(order_id="absent", currency=None, amount="x"),
            ["missing_field:order_id", "null_field:currency", "amount_not_numeric"],
        ),
    ],
)
def test_object_rules(spark, record, errors):
    route = "rejected" if errors else "valid"
    assert judge(spark, [json.dumps(record)]) == [(route, errors)]


def test_malformed_lines(spark):
    broken = [
        '{"a":1} x', '{"a":1}]', '{"a":1}}', '{"a":1}]}', '{"a":1},{"b":2}',
        '{"a":1}}]', '{"a":1}] //', "42 43", "{not json", '{"amount":NaN}',
    ]
    assert judge(spark, broken) == [("rejected", ["json_decode"])] * len(broken)
    others = ["[1]", '"x"', "null", "42"]
    assert judge(spark, others) == [("rejected", ["not_an_object"])] * 4
    assert judge(spark, ["", "  ", "\t", " ", "\x1f"]) == [("blank", None)] * 5


def test_merged_codes_and_extended_rules(spark):
    merged = RuleSet(merge_missing_and_null=True)
    assert judge(spark, [json.dumps(order(currency=None))], merged) == [
        ("rejected", ["missing_or_null_field:currency"])
    ]
    assert judge(spark, [json.dumps(order(currency="absent"))], merged) == [
        ("rejected", ["missing_or_null_field:currency"])
    ]
    extended = RuleSet(extended=True)
    lines = [
        order(amount=-1),
        order(created_at="yesterday"),
        order(amount=100_000),
        order(amount=100_000.01),
    ]
    assert judge(spark, [json.dumps(x) for x in lines], extended) == [
        ("rejected", ["amount_negative"]),
        ("rejected", ["invalid_iso_timestamp"]),
        ("valid", []),
        ("suspicious", []),
    ]


SAMPLE = [
    json.dumps(order(order_id="O-001")),
    json.dumps(order(order_id="O-002")),
    json.dumps(order(order_id="O-003", customer_id="absent")),
    json.dumps(order(order_id="O-004", amount="unknown")),
    json.dumps(order(order_id="O-005", extra={"kept": [1, 2]}, _batch_id="forged")),
    "{not even valid JSON",
    "",
    json.dumps(order(order_id="O-007")),
]


def stored(folder: Path):
    return [json.loads(l) for f in folder.glob("*.txt") for l in f.read_text().splitlines()]


def test_ingest_run(spark, tmp_path):
    source = tmp_path / "orders.jsonl"
    source.write_text("\n".join(SAMPLE) + "\n")
    bronze, log = tmp_path / "bronze", tmp_path / "log"
    result = ingest_files(spark, str(source), str(bronze), str(log), batch_id="b1")
    assert result.code == 0
    assert {k: result.log[k] for k in ("n_read", "n_valid", "n_rejected", "n_empty_lines")} == {
        "n_read": 7, "n_valid": 4, "n_rejected": 3, "n_empty_lines": 1,
    }
    assert result.log["status"] == "WARN"
    valid = stored(bronze / "route=valid" / "_batch_id=b1")
    assert sorted(r["order_id"] for r in valid) == ["O-001", "O-002", "O-005", "O-007"]
    kept = next(r for r in valid if r["order_id"] == "O-005")
    assert kept["extra"] == {"kept": [1, 2]} and kept["_batch_id"] == "b1"
    assert kept["_source_file"].endswith("orders.jsonl") and "_ingestion_timestamp" in kept
    rejected = stored(bronze / "route=rejected" / "_batch_id=b1")
    by_error = {r["_errors"][0]: r for r in rejected}
    assert set(by_error) == {"missing_field:customer_id", "amount_not_numeric", "json_decode"}
    assert by_error["json_decode"]["_raw"] == "{not even valid JSON"
    assert by_error["json_decode"]["_lineno"] == 6

    # A second run adds to the table and to the log, and changes nothing before it.
    again = ingest_files(spark, str(source), str(bronze), str(log), batch_id="b2")
    assert again.code == 0 and spark.read.json(str(log)).count() == 2
    assert len(stored(bronze / "route=valid" / "_batch_id=b1")) == 4


def test_missing_and_empty_sources(spark, tmp_path, capsys):
    bronze, log = tmp_path / "bronze", tmp_path / "log"
    result = ingest_files(spark, str(tmp_path / "none.jsonl"), str(bronze), str(log))
    assert result.code == 1 and not bronze.exists() and not log.exists()
    assert "ERROR" in capsys.readouterr().err
    empty = tmp_path / "empty.jsonl"
    empty.touch()
    result = ingest_files(spark, str(empty), str(bronze), str(log))
    assert result.code == 2 and result.log["status"] == "EMPTY" and result.log["n_read"] == 0


def test_all_corrupt_is_a_warning(spark, tmp_path):
    source = tmp_path / "bad.jsonl"
    source.write_text("{x\n{y\n")
    result = ingest_files(spark, str(source), str(tmp_path / "b"), str(tmp_path / "l"))
    assert result.code == 0 and result.log["status"] == "WARN" and result.log["n_valid"] == 0


def test_line_numbers_across_splits(spark, tmp_path):
    for name, n in (("a.txt", 700), ("b.txt", 50)):
        text = "".join(f"{i}{' ' * (i % 17)}\n" if i % 5 else "\n" for i in range(1, n + 1))
        (tmp_path / name).write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        lines = read_lines(spark, str(tmp_path))
        assert lines.select("_split").distinct().count() > 4
        rows = with_line_numbers(lines, split_counts(lines)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 750
    assert all(r["line"].strip() in ("", str(r["lineno"])) for r in rows)
    assert len({(r["source_file"], r["lineno"]) for r in rows}) == 750


def test_invalid_bytes_are_replaced_and_flagged(spark, tmp_path):
    good = json.dumps(order(order_id="X")).encode().replace(b'"X"', b'"\xff"')
    (tmp_path / "x.jsonl").write_bytes(good + b"\n\xfe{\n")
    lines = read_lines(spark, str(tmp_path / "x.jsonl"))
    rows = routed(lines).orderBy("_row").collect()
    assert [r["route"] for r in rows] == ["valid", "rejected"]
    assert all(r["replaced"] for r in rows)
    assert "�" in rows[0]["line"]


def test_statistics_of_nothing(spark):
    df = routed(spark.createDataFrame([], "line STRING"))
    row = run_statistics(df).first()
    assert (row["n_read"], row["status"]) == (0, "EMPTY")


def test_stream_ingest_in_two_runs(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    args = [str(tmp_path / x) for x in ("bronze", "log", "ck")]
    (source / "1.jsonl").write_text("\n".join(SAMPLE))
    ingest_stream(spark, str(source), *args, every=None).awaitTermination()
    (source / "2.jsonl").write_text(SAMPLE[0] + "\n")
    ingest_stream(spark, str(source), *args, every=None).awaitTermination()
    rows = spark.read.json(f"{args[1]}/*").orderBy("batch_id").collect()
    assert [(r["n_read"], r["n_valid"], r["n_empty_lines"], r["status"]) for r in rows] == [
        (7, 4, 1, "WARN"), (1, 1, 0, "OK"),
    ]
