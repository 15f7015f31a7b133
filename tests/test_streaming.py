import time

import pytest
from conftest import values
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from chatterlens.functions.text import with_clean_text
from chatterlens.operators.dashboards import sentiment_over_time
from chatterlens.operators.latest import read_log, upsert_view
from chatterlens.operators.models import classifiers, train
from chatterlens.operators.validate import decode_messages, route
from chatterlens.plans import streams
from chatterlens.session import ROCKSDB, STATE_STORE, rocksdb_state
from chatterlens.sources.topics import read_messages
from chatterlens.streaming import jobs, runner, sinks
from chatterlens.streaming.first_copy import first_copies

RAW = [
    '{"text":"good day","user":"u","timestamp":"2024-01-01T00:00:00Z","location":"x"}',
    '{"text":"","user":"u"}',
    "broken",
    '{"text":"bad day","user":"v","timestamp":"2024-01-01T00:00:00Z","location":"y"}',
]
NOW = runner.AVAILABLE_NOW


def feed(folder, *files):
    """Write files one after the other, so that a stream reads them in this order."""
    folder.mkdir(exist_ok=True)
    for name, lines in files:
        path = folder / name
        path.write_text("\n".join(lines) + "\n")
        time.sleep(0.05)


def finish(*queries):
    assert runner.run(queries, timeout=120)


def test_validate_stream_equals_batch(spark, rows, tmp_path):
    feed(tmp_path / "in", ("a", RAW[:2]), ("b", RAW[2:]))
    stream = read_messages(spark, "text", str(tmp_path / "in"), max_per_trigger=1)
    at = F.lit("2024-02-01").cast("timestamp")
    folders = [str(tmp_path / name) for name in ("valid", "dead")]
    with runner.progress_logged(spark, str(tmp_path / "progress")):
        finish(
            jobs.validate_stream(
                stream, *[sinks.batch_folder(p) for p in folders], str(tmp_path / "cp"), NOW, at, name="checked"
            )
        )
    expected = route(decode_messages(rows([(r,) for r in RAW], "value string")), at)
    for path, batch in zip(folders, expected):
        assert values(spark.read.parquet(path).drop("run", "batch_id")) == values(batch)
    progress = runner.progress_table(spark, str(tmp_path / "progress"))
    assert [r.input_rows for r in progress.filter("input_rows > 0").orderBy("batch_id").collect()] == [2, 2]
    observed = progress.agg(*[F.sum(F.col("observed")[f"validation.{n}"]).alias(n) for n in ("messages", "valid", "invalid")])
    assert tuple(observed.first()) == (4, 2, 2)
    assert progress.first()["query"] == "checked"


def test_restart_adds_nothing_and_goes_on(spark, tmp_path):
    out = str(tmp_path / "out")
    for lines in (RAW[:3], RAW[:3], RAW):
        if lines is RAW:
            feed(tmp_path / "in", ("later", RAW[3:]))
        else:
            feed(tmp_path / "in", *([] if (tmp_path / "in").exists() else [("first", lines)]))
        stream = decode_messages(read_messages(spark, "text", str(tmp_path / "in")))
        finish(runner.start_batches(stream, sinks.batch_folder(out), str(tmp_path / "cp"), NOW))
        assert spark.read.parquet(out).count() == len(lines)


def test_fan_out_gives_all_sinks_the_same(spark, tmp_path):
    comments = spark.createDataFrame([("good", "positive"), ("bad", "negative")], "Comment string, Sentiment string")
    model = train(with_clean_text(comments, "Comment"), classifiers()["Naive_Bayes"])
    feed(tmp_path / "in", ("a", RAW))
    valid, _ = route(decode_messages(read_messages(spark, "text", str(tmp_path / "in"))))
    writers = [jobs.document_log(str(tmp_path / "docs")), sinks.topic_folder(str(tmp_path / "topic"))]
    finish(jobs.score_stream(valid, model, writers, str(tmp_path / "cp"), NOW))
    documents = upsert_view(read_log(spark, str(tmp_path / "docs")))
    sent = spark.read.schema("value string").text(str(tmp_path / "topic"))
    sent = sent.select(F.from_json("value", "id string, sentiment string, predicted_at timestamp").alias("r")).select("r.*")
    stored = documents.select("id", "sentiment", "predicted_at")
    assert values(stored) == values(sent) and stored.count() == 2
    assert sorted(values(sent, "sentiment")) == ["negative", "positive"]
    again = spark.read.parquet(str(tmp_path / "docs"))
    assert "event_date" in again.columns


def test_repeated_batch_overwrites_itself(spark, tmp_path):
    write = sinks.batch_folder(str(tmp_path / "t"))
    for batch_id in (0, 1, 1):
        write(spark.range(3), batch_id)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 6


def test_another_checkpoint_writes_beside_the_first(spark, tmp_path):
    feed(tmp_path / "in", ("a", RAW))
    out = str(tmp_path / "out")
    for checkpoint in ("cp1", "cp1", "cp2"):
        stream = read_messages(spark, "text", str(tmp_path / "in"))
        finish(runner.start_batches(stream, sinks.batch_folder(out), str(tmp_path / checkpoint), NOW))
    log = read_log(spark, out)
    assert log.count() == 8 and log.select("run").distinct().count() == 2
    assert values(log.select("batch_id").distinct(), "batch_id") == [0]


def test_only_repeats_run_python_in_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = event_stream(spark, tmp_path / "in")
    plans = [rows._jdf.queryExecution().logical().toString() for rows in (jobs.drop_repeats_stream(stream), jobs.live_sentiment(stream))]
    assert [plan.count("MapInArrow") for plan in plans] == [1, 0]


def test_empty_batches_are_skipped(spark):
    seen = []
    write = sinks.fan_out(lambda batch, batch_id: seen.append(batch_id))
    write(spark.range(0), 1)
    write(spark.range(1), 2)
    assert seen == [2]


def test_failing_sink_fails_the_query_and_the_batch_is_retried(spark, tmp_path):
    feed(tmp_path / "in", ("a", RAW))
    out = str(tmp_path / "out")

    def start(*writers):
        stream = read_messages(spark, "text", str(tmp_path / "in"))
        return runner.start_batches(stream, sinks.fan_out(*writers), str(tmp_path / "cp"), NOW)

    def broken(batch, batch_id):
        raise RuntimeError("sink is down")

    with pytest.raises(StreamingQueryException):
        runner.run([start(sinks.batch_folder(out), broken)], timeout=60)
    assert spark.read.parquet(out).count() == 4
    finish(start(sinks.batch_folder(out)))
    assert spark.read.parquet(out).count() == 4


EVENTS = "id string, event_time timestamp, sentiment string"


def events(*rows):
    return [f'{{"id":"{i}","event_time":"2024-01-01T{at}Z","sentiment":"{s}"}}' for i, at, s in rows]


def event_stream(spark, folder):
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).json(str(folder))


def test_live_sentiment_drops_late_rows_and_gives_each_bucket_once(spark, tmp_path):
    feed(
        tmp_path / "in",
        ("a", events(("1", "00:01:00", "p"), ("2", "00:02:00", "n"))),
        ("b", events(("3", "01:00:00", "p"))),
        ("c", events(("5", "01:01:00", "p"))),
        # 4 is late. The engine drops late rows one batch after the watermark has passed them.
        ("d", events(("4", "00:03:00", "p"), ("6", "02:00:00", "p"))),
    )
    counts = jobs.live_sentiment(event_stream(spark, tmp_path / "in"))
    finish(runner.start_table(counts, str(tmp_path / "out"), str(tmp_path / "cp"), NOW))
    found = spark.read.parquet(str(tmp_path / "out")).select(F.date_format("bucket", "HH:mm"), "sentiment", "n")
    assert values(found) == [("00:00", "n", 1), ("00:00", "p", 1), ("01:00", "p", 2)]


def test_live_buckets_equal_batch_buckets(spark, tmp_path):
    lines = events(*[(str(i), f"00:{i % 60:02d}:00", "p" if i % 3 else "n") for i in range(120)])
    feed(tmp_path / "in", ("a", lines))
    stream = event_stream(spark, tmp_path / "in")
    finish(runner.start_table(jobs.live_sentiment(stream), str(tmp_path / "out"), str(tmp_path / "cp"), NOW))
    batch = sentiment_over_time(spark.read.schema(EVENTS).json(str(tmp_path / "in")))
    closed = batch.filter(F.col("bucket") + F.expr("interval 5 minutes") <= F.lit("2024-01-01 00:49:00"))
    assert values(spark.read.parquet(str(tmp_path / "out")).select("bucket", "sentiment", "n")) == values(closed)


@pytest.fixture(params=["heap", "rocksdb"])
def state_store(spark, request):
    """Run a test with both kinds of streaming state."""
    before = spark.conf.get(STATE_STORE)
    if request.param == "rocksdb":
        spark.conf.set(STATE_STORE, ROCKSDB)
    yield
    spark.conf.set(STATE_STORE, before)


def test_repeats_are_dropped_within_and_across_batches(spark, tmp_path, state_store):
    hot = [("hot", f"00:00:{i:02d}", "p") for i in range(50)]
    feed(
        tmp_path / "in",
        ("a", events(*hot, ("1", "00:00:00", "p"))),
        ("b", events(("1", "00:00:30", "p"), ("2", "00:01:00", "p"), ("hot", "00:02:00", "p"))),
    )
    once = jobs.drop_repeats_stream(event_stream(spark, tmp_path / "in"))
    finish(runner.start_table(once, str(tmp_path / "out"), str(tmp_path / "cp"), NOW))
    assert sorted(values(spark.read.parquet(str(tmp_path / "out")), "id")) == ["1", "2", "hot"]


def test_an_id_with_a_late_copy_still_passes(spark, tmp_path):
    feed(
        tmp_path / "in",
        ("a", events(("1", "02:00:00", "p"))),
        ("b", events(("2", "02:00:01", "p"))),
        ("c", events(("late", "00:30:00", "p"), ("late", "02:01:00", "p"), ("gone", "00:30:00", "p"))),
    )
    once = jobs.drop_repeats_stream(event_stream(spark, tmp_path / "in"))
    finish(runner.start_table(once, str(tmp_path / "out"), str(tmp_path / "cp"), NOW))
    assert sorted(values(spark.read.parquet(str(tmp_path / "out")), "id")) == ["1", "2", "late"]


def test_hot_ids_are_thinned_before_the_shuffle(spark, tmp_path):
    number = F.col("id")
    many = spark.range(60_000).select(
        F.when(number % 3 == 0, "hot").otherwise(number.cast("string")).alias("id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + number % 100).alias("event_time"),
    )
    many.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(many.schema).parquet(str(tmp_path / "in"))
    query = runner.start_table(jobs.drop_repeats_stream(stream), str(tmp_path / "out"), str(tmp_path / "cp"), NOW)
    finish(query)
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.count() == found.select("id").distinct().count() == 40_001
    dropped = [op["customMetrics"]["numDroppedDuplicateRows"] for p in query.recentProgress for op in p["stateOperators"]]
    assert max(dropped) < 50


def test_triggers_and_console(spark, tmp_path):
    feed(tmp_path / "in", ("a", RAW))
    stream = read_messages(spark, "text", str(tmp_path / "in"))
    timed = runner.start_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "1 second")
    fast = runner.start_console(decode_messages(stream), name="preview")
    assert fast.name == "preview"
    timed.processAllAvailable()
    fast.processAllAvailable()
    assert runner.run([timed, fast], timeout=1) is False
    assert not timed.isActive and not fast.isActive
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_search_index_options():
    assert sinks.search_index_options("predictions") == {
        "es.resource": "predictions",
        "es.write.operation": "index",
        "es.mapping.id": "id",
    }


def test_the_earliest_copy_wins_and_state_ends(spark, tmp_path):
    copies = lambda *items: events(*items)
    files = [
        ("a", copies(("x", "00:05:00", "late arrival"), ("y", "00:01:00", "only"), ("z", "00:02:00", "first"))),
        ("b", copies(("x", "00:03:00", "first"), ("x", "00:04:00", "middle"))),
        ("c", copies(("z", "00:06:00", "repeat"), ("far", "00:30:00", "p"))),
        ("d", copies(("x", "00:01:00", "too late"), ("x", "00:21:00", "repeat"), ("far", "00:59:00", "p"))),
        ("e", copies(("end", "03:00:00", "p"))),
    ]
    for name, lines in files:
        feed(tmp_path / "in", (name, lines))
        with rocksdb_state(spark):
            first = first_copies(event_stream(spark, tmp_path / "in"))
            finish(runner.start_table(first, str(tmp_path / "out"), str(tmp_path / "cp"), NOW))
    found = spark.read.parquet(str(tmp_path / "out"))
    passed = found.select("id", "sentiment", F.date_format("event_time", "HH:mm").alias("at")).collect()
    assert sorted(map(tuple, passed)) == [("far", "p", "00:30"), ("x", "first", "00:03"), ("y", "only", "00:01"), ("z", "first", "00:02")]
    held = spark.read.format("statestore").option("stateVarName", "timer").load(str(tmp_path / "cp"))
    assert {r.key.id for r in held.collect()} == {"end"}


def test_ids_of_a_bucket_share_one_state(spark, tmp_path):
    ids = [f"id-{number}" for number in range(40)]
    files = [
        [(id, f"00:{5 + number % 4:02d}:00", f"{id} late arrival") for number, id in enumerate(ids)],
        [(id, f"00:{2 + number % 3:02d}:00", f"{id} first") for number, id in enumerate(ids)],
        [("far", "00:13:30", "p")],
        [(id, "00:13:00", "repeat") for id in ids[::2]],
        [("far", "00:27:00", "p"), ("far", "00:13:10", "earlier, but after its turn")],
        [(ids[0], "00:26:00", "again"), ("new", "00:17:30", "p"), ("end", "03:00:00", "p")],
    ]
    passed, stores = {}, {}
    for buckets in (None, 1, 7):
        base = tmp_path / str(buckets)
        base.mkdir()
        for number, lines in enumerate(files):
            feed(base / "in", (str(number), events(*lines)))
            with rocksdb_state(spark):
                first = first_copies(event_stream(spark, base / "in"), buckets=buckets)
                finish(runner.start_table(first, str(base / "out"), str(base / "cp"), NOW))
        found = spark.read.parquet(str(base / "out")).select("id", "sentiment", F.date_format("event_time", "HH:mm:ss").alias("at"))
        passed[buckets] = sorted(map(tuple, found.collect()))
        held = spark.read.format("statestore").option("stateVarName", "timer").load(str(base / "cp"))
        stores[buckets] = held.count()
    assert passed[1] == passed[7] == passed[None]
    assert {(id, text) for id, text, _ in passed[1]} >= {(id, f"{id} first") for id in ids} and len(passed[1]) >= 42
    assert stores[1] == 1 and stores[7] <= 7


def test_open_buckets_after_each_batch(spark, tmp_path):
    held, seen = jobs.live_table(spark, str(tmp_path / "table")), []
    parts = [[("1", "00:01:00", "p"), ("2", "00:02:00", "n")], [("3", "00:03:00", "p"), ("4", "00:07:00", "p")], [("5", "01:00:00", "p")], [("6", "00:01:00", "p")]]
    expected = [{("00:00", "p"): 1, ("00:00", "n"): 1}, {("00:00", "p"): 2, ("00:00", "n"): 1, ("00:05", "p"): 1}]
    expected += [expected[1] | {("01:00", "p"): 1}] * 2  # the last message is late
    for number, part in enumerate(parts):
        feed(tmp_path / "in", (str(number), events(*part)))
        finish(jobs.live_sentiment_stream(event_stream(spark, tmp_path / "in"), held, str(tmp_path / "cp"), NOW))
        rows = held.read().select(F.date_format("bucket", "HH:mm").alias("at"), "sentiment", "n").collect()
        seen.append({(r["at"], r.sentiment): r.n for r in rows})
    assert seen == expected


def test_progress_is_compacted(spark, tmp_path):
    path = str(tmp_path / "progress")
    feed(tmp_path / "in", ("a", RAW[:2]), ("b", RAW[2:]))
    with runner.progress_logged(spark, path):
        stream = decode_messages(read_messages(spark, "text", str(tmp_path / "in"), max_per_trigger=1))
        finish(runner.start_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"), NOW))
    before = values(runner.progress_table(spark, path).drop("observed"))
    assert runner.compact_progress(spark, path) == len(before) and runner.compact_progress(spark, path) == 1
    assert values(runner.progress_table(spark, path).drop("observed")) == before and len(before) >= 2


def test_missing_values_repeat_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(None,)] * 3 + [("a",), ("a",), ("b",)], "value string").selectExpr("cast(value as binary) value")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    finish(runner.start_table(jobs.unique_values(stream, "10 minutes"), str(tmp_path / "out"), str(tmp_path / "cp"), NOW))
    got = sorted((r.value.decode() if r.value else "null") for r in spark.read.parquet(str(tmp_path / "out")).select(F.col("value").cast("binary")).collect())
    assert got == ["a", "b", "null", "null", "null"]


def test_a_topic_has_more_files_with_more_bytes(spark, tmp_path, monkeypatch):
    text = F.concat(F.lit("good day "), F.repeat(F.lit("x"), 1000))
    spark.range(40).selectExpr("id event_id", "id user_id", "timestamp '2024-01-01' ts", "'view' event_type", "'{}' props").write.parquet(str(tmp_path / "events.parquet"))
    spark.range(40).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("web").alias("source")).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(streams, "TOPIC_FILE_BYTES", 5_000)
    monkeypatch.setattr(streams, "shared_folder", lambda spark, purpose: str(tmp_path / purpose))
    found = streams.stream_in_batches_of_bytes(spark, str(tmp_path)).collect()
    assert len(found) == 40 and all(row.bounded for row in found)
    assert len(list((tmp_path / "stream-bytes" / "topic").glob("part-*"))) >= 7
