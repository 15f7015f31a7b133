"""Every registered query against DuckDB on the smallest tables, and the shape of the plans."""

import re
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point
from chatterlens.plans.catalogue import ORACLES, QUERIES

TABLES = "/root/testdata/sf0.001"

# Queries that hand rows to Python workers on purpose.
PYTHON = {"messages_scored_by_plugin"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(TABLES).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(frame: pd.DataFrame):
    def text(value):
        if value is None or value is pd.NaT or value != value:
            return "null"
        return f"{value:.6f}" if isinstance(value, float) else str(value)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(text, row)) for row in frame.itertuples(index=False, name=None))


def test_all_queries_have_an_oracle_and_are_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    ours = QUERIES[name](spark, TABLES).toPandas()
    theirs = duck.execute(ORACLES[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert comparable(ours) == comparable(theirs)
    assert len(ours) > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {n for n in ORACLES if n.startswith("stream_")}))
def test_plan_has_no_pair_join_and_no_needless_python(spark, name):
    plan = QUERIES[name](spark, TABLES)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON:
        assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInArrow|MapInPandas", plan)


def test_scans_read_only_what_is_used(spark):
    plan = QUERIES["top_users"](spark, TABLES)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan
    plan = QUERIES["volume_by_source"](spark, TABLES)._jdf.queryExecution().executedPlan().toString()
    assert "text:string" not in plan
