from conftest import values
from pyspark.sql import functions as F

from chatterlens.operators.validate import (
    decode_messages,
    extract_fields,
    route,
    validation_report,
    with_reason,
)
from chatterlens.schemas import DEAD_LETTER, VALIDATED

RAW = [
    '{"text":"good","user":"u","timestamp":"2024-01-01T00:00:00Z","location":"x"}',
    '{"text":"  ","user":"u","timestamp":"2024-01-01T00:00:00Z"}',
    '{"text":"t","user":"\\t\\n","timestamp":"bad"}',
    '{"text":null,"user":""}',
    '{"user":"u","extra":1}',
    '{"text":5,"user":{"a":1},"timestamp":"later"}',
    "not json",
    "[1]",
    "",
    None,
]


def raw(rows):
    return rows([(v,) for v in RAW], "value string").select(F.col("value").cast("binary").alias("value"))


def test_reasons(rows):
    found = {r.raw: r.reason for r in with_reason(decode_messages(raw(rows))).collect()}
    assert [found[v] for v in RAW] == [
        None,
        "missing_text",
        "missing_user",
        "missing_text",
        "missing_text",
        None,
        "malformed_json",
        "malformed_json",
        "malformed_json",
        "malformed_json",
    ]


def test_route_is_a_partition_of_the_input(rows):
    at = F.lit("2024-02-01 10:00:00.7").cast("timestamp")
    valid, dead = route(decode_messages(raw(rows)), at)
    assert valid.schema.fieldNames() == VALIDATED.fieldNames()
    assert dead.schema.fieldNames() == DEAD_LETTER.fieldNames()
    assert valid.count() + dead.count() == len(RAW)
    texts = {r.text: r for r in valid.collect()}
    assert set(texts) == {"good", "5"} and texts["5"].user == '{"a":1}'
    assert texts["good"].validated is True and str(texts["good"].validation_time) == "2024-02-01 10:00:00"
    assert texts["5"].event_time is None and texts["good"].event_time is not None


def test_valid_rule(rows):
    df = rows([("a", "b"), ("a", None), (None, "b"), (" ", "b"), ("a", "\r\n")], "text string, user string")
    judged = with_reason(df.withColumn("malformed", F.lit(False)))
    assert [r.reason is None for r in judged.collect()] == [True, False, False, False, False]


def test_report_counts_every_problem(rows):
    found = {r.reason: r.n for r in validation_report(decode_messages(raw(rows))).collect()}
    assert found == {"malformed_json": 4, "missing_text": 3, "missing_user": 2, "bad_timestamp": 4}


def test_extract_fields(rows):
    df = rows([('{"text":"a","user":7,"deep":{"x":[1,2]}}',), ("no",)], "value string")
    assert values(extract_fields(df).select("text", "user", "location")) == sorted(
        [("a", "7", None), (None, None, None)], key=repr
    )
    deep = extract_fields(df, {"second": "$.deep.x[1]", "text": "$.text"})
    assert values(deep.select("second", "text")) == sorted([("2", "a"), (None, None)], key=repr)


def test_json_is_parsed_once(rows):
    valid, _ = route(decode_messages(raw(rows)))
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_other_columns_survive(rows):
    df = raw(rows).withColumn("offset", F.monotonically_increasing_id())
    assert "offset" in decode_messages(df).columns
