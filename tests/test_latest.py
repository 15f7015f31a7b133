import pytest
from conftest import values
from pyspark.sql import functions as F

from chatterlens.operators.latest import (
    best_per_key,
    compact_log,
    drop_repeats,
    latest_per_key,
    read_log,
    upsert_view,
    with_document_id,
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key(rows):
    df = rows([("a", 1, 1), ("a", 3, 2), ("a", 3, 3), ("b", 0, 4)], "k string, t int, id int")
    assert values(latest_per_key(df, ["k"], "t", "id", 2).select("k", "id")) == [("a", 2), ("a", 3), ("b", 4)]


def hot(spark):
    """A third of 30 000 rows under one key, many of them exact copies."""
    number = F.col("id")
    key = F.when(number % 3 == 0, 0).otherwise(number % 1000 + 1)
    return spark.range(30_000).select(key.alias("k"), (number % 7000).alias("t"))


def test_many_rows_per_key_agree_with_few(spark):
    df = hot(spark)
    for n in (5, 1500):
        found = best_per_key(df, ["k"], [F.desc("t")], n).groupBy("k").agg(F.count("*").alias("n"), F.sum("t").alias("s"))
        counts = {(r.k, r.n, r.s) for r in found.collect()}
        expected = {}
        for row in df.collect():
            expected.setdefault(row.k, []).append(row.t)
        best = {k: sorted(t, reverse=True)[:n] for k, t in expected.items()}
        assert counts == {(k, len(t), sum(t)) for k, t in best.items()}


def test_frequent_keys_are_cut_before_the_shuffle(spark):
    assert plan(latest_per_key(hot(spark).withColumn("id", F.col("t")), ["k"], "t", "id", 5)).count("WindowGroupLimit") == 2


def test_copies_and_versions_are_cut_before_the_shuffle(spark):
    df = hot(spark).withColumn("batch_id", F.lit(1))
    assert plan(drop_repeats(df, "k", "t")).count("WindowGroupLimit") == 2
    assert plan(upsert_view(df, ["k"])).count("WindowGroupLimit") == 2


def test_drop_repeats_is_idempotent(rows):
    df = rows([("a", 2, "late"), ("a", 1, "first"), ("b", 5, "only")], "id string, t int, v string")
    once = drop_repeats(df, "id", "t")
    assert values(once) == [("a", 1, "first"), ("b", 5, "only")]
    assert values(drop_repeats(once, "id", "t")) == values(once)


def test_document_id_tells_equal_times_apart(rows):
    df = rows([("u", "t", "x"), ("u", "t", "y"), ("u", "t", "x")], "user string, timestamp string, text string")
    assert with_document_id(df).select("id").distinct().count() == 2
    assert with_document_id(df, ["timestamp"]).select("id").distinct().count() == 1


def test_upsert_log_and_compaction(spark, rows, tmp_path):
    log, compact = str(tmp_path / "log"), str(tmp_path / "compact")
    rows([("a", 1), ("b", 1)], "id string, v int").write.parquet(f"{log}/run=1/batch_id=0")
    rows([("b", 2), ("c", 2)], "id string, v int").write.parquet(f"{log}/run=1/batch_id=1")
    current = upsert_view(read_log(spark, log)).select("id", "v")
    assert values(current) == [("a", 1), ("b", 2), ("c", 2)]
    compact_log(spark, log, compact)
    rows([("c", 3)], "id string, v int").write.parquet(f"{compact}/run=2/batch_id=0")
    assert values(upsert_view(read_log(spark, compact)).select("id", "v")) == [("a", 1), ("b", 2), ("c", 3)]


def test_compaction_keeps_dates_and_its_source(spark, rows, tmp_path):
    log, compact = str(tmp_path / "log"), str(tmp_path / "compact")
    dated = rows([("a", "2024-01-01"), ("b", "2024-01-02")], "id string, event_date string")
    for run in (1, 2):
        dated.write.partitionBy("event_date").parquet(f"{log}/run={run}/batch_id=0")
    compact_log(spark, log, compact)
    assert len(list((tmp_path / "compact").glob("run=2/batch_id=0/event_date=*"))) == 2
    assert read_log(spark, compact).count() == 2
    with pytest.raises(ValueError):
        compact_log(spark, log, log + "/")
    assert read_log(spark, log).count() == 4


def test_the_last_arrival_of_a_batch_stays(rows):
    log = rows([("a", 1, 5, "later"), ("a", 1, 4, "earlier"), ("a", 0, 9, "before")], "id string, batch_id int, o int, v string")
    log = log.withColumn("arrival", F.struct("o")).drop("o")
    assert values(upsert_view(log), "v") == ["later"]
