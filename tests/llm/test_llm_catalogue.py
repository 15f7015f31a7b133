"""Every query of the package: against DuckDB where it has SQL, and the kind of work its plan does."""

import re
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point
from chatterlens.llm.catalogue import ORACLES, QUERIES

TABLES = "/root/testdata/sf0.001"


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


def test_one_query_for_each_operator_and_the_pipeline():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES if name != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    ours, theirs = QUERIES[name](spark, TABLES).toPandas(), duck.execute(ORACLES[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert comparable(ours) == comparable(theirs) and len(ours) > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_joins(spark, name):
    plan = QUERIES[name](spark, TABLES)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name.startswith(("op5_", "op10_")):
        assert not re.search(r"Python|Pandas|MapInArrow", plan)


def test_native_operators_import_no_python_engine():
    for module in ("license_scan", "url_models"):
        source = Path(f"chatterlens/llm/{module}.py")
        source = source if source.exists() else Path(__file__).parents[2] / source
        assert not re.search(r"udf|mapIn|applyIn|\.rdd|import (numpy|pandas|pyarrow)", source.read_text())
