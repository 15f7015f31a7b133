import json

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens.operators.validate import decode_messages
from chatterlens.schemas import RESULT
from chatterlens.sources.chat import chat_lines_to_messages, chat_messages_only
from chatterlens.sources.comments import comments_to_messages
from chatterlens.sources.tables import CSV_OPTIONS, conform, look_up, read_labelled_csv, read_results, write_for_look_up, write_results
from chatterlens.sources.topics import encode_messages, encode_rows, read_messages, topic_options


def test_topic_options():
    assert topic_options("k:9092", "in") == {
        "kafka.bootstrap.servers": "k:9092",
        "subscribe": "in",
        "startingOffsets": "earliest",
    }
    limited = topic_options("k:9092", "in", "latest", max_per_trigger=10_000, min_partitions=64)
    assert limited["startingOffsets"] == "latest"
    assert (limited["maxOffsetsPerTrigger"], limited["minPartitions"]) == ("10000", "64")
    with pytest.raises(ValueError):
        topic_options("k:9092", "in", "yesterday")


def test_read_messages_refuses_what_it_cannot_do(spark, tmp_path):
    with pytest.raises(ValueError):
        read_messages(spark, "kafka", "topic")
    with pytest.raises(ValueError):
        read_messages(spark, "text", str(tmp_path), starting="latest")
    with pytest.raises(ValueError):
        read_messages(spark, "carrier pigeon", "x")
    with pytest.raises(ValueError):
        read_messages(spark, "text", str(tmp_path), max_per_trigger=1, max_bytes=1)
    with pytest.raises(ValueError):
        read_messages(spark, "kafka", "topic", "k:9092", starting="latest", stream=False)


def test_read_messages_from_json_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"text":"one"}\n{"text":"two"}\n')
    stream = read_messages(spark, "text", str(tmp_path), max_per_trigger=1)
    assert stream.isStreaming and stream.schema["value"].dataType == T.BinaryType()
    batch = read_messages(spark, "text", str(tmp_path), stream=False)
    assert sorted(values(decode_messages(batch), "text")) == ["one", "two"]


def test_decode_undoes_encode(rows):
    data = [("héllo \"q\" \\ \n", "u", "t", None), (None, None, None, None), ("", " ", "2024", "🙂")]
    df = rows(data, "text string, user string, timestamp string, location string")
    back = decode_messages(encode_messages(df))
    assert values(back.select("text", "user", "timestamp", "location")) == values(df)
    assert values(back, "malformed") == [False] * 3


def test_encoded_nulls(rows):
    df = rows([("a", None, None, None)], "text string, user string, timestamp string, location string")
    message = json.loads(bytes(encode_messages(df).first().value))
    assert message == {"text": "a", "user": None, "timestamp": None, "location": None}
    assert json.loads(encode_rows(df).first().value) == {"text": "a"}


COMMENT = {
    "id": "1",
    "kind": "other",
    "snippet": {
        "topLevelComment": {
            "snippet": {
                "textDisplay": "hi",
                "authorDisplayName": "ann",
                "publishedAt": "2024-01-01T00:00:00Z",
                "authorChannelId": {"value": "c1"},
            }
        }
    },
}


def test_nested_comments(rows):
    inner = COMMENT["snippet"]["topLevelComment"]["snippet"]
    no_channel = json.loads(json.dumps(COMMENT))
    del no_channel["snippet"]["topLevelComment"]["snippet"]["authorChannelId"]
    no_text = json.loads(json.dumps(COMMENT))
    del no_text["snippet"]["topLevelComment"]["snippet"]["textDisplay"]
    items = [json.dumps(COMMENT), json.dumps(no_channel), json.dumps(no_text), "not json", None, "{}"]
    found = comments_to_messages(rows([(i,) for i in items], "item string"))
    assert found.columns == ["id", "text", "user", "timestamp", "location"]
    expected = ("1", "hi", "ann", inner["publishedAt"])
    assert values(found) == sorted([(*expected, "c1"), (*expected, "Unknown")], key=repr)


def test_nested_comments_as_struct(rows):
    from chatterlens.schemas import COMMENT_ITEM

    df = rows([(json.dumps(COMMENT),)], "j string").select(F.from_json("j", COMMENT_ITEM).alias("item"))
    assert values(comments_to_messages(df), "location") == ["c1"]


def reference_parse(line):
    """What a chat client does with one line, in plain Python."""
    if line is None or line.startswith("PING") or "PRIVMSG" not in line:
        return None
    prefix, message = line.split("PRIVMSG", 1)
    user = prefix.split("!", 1)[0].replace(":", "").strip()
    if ":" not in message:
        return None
    text = message.split(":", 1)[1].strip()
    return None if len(text) < 1 else (text, user[:50])


LINES = [
    ":ann!ann@host PRIVMSG #c :hello there ",
    ":bob!b@h PRIVMSG #c :see http://x.y: ok",
    "PING :server",
    "PING PRIVMSG #c :x",
    ":srv 001 welcome",
    ":cy!c@h PRIVMSG #c :   ",
    ":dee!d@h PRIVMSG #c no colon",
    ":" + "n" * 80 + "!x@h PRIVMSG #c :PRIVMSG again",
    "PRIVMSG :bare",
    ":e:f!x PRIVMSG #c ::)",
    "",
    None,
]


def test_chat_lines_equal_plain_python(rows):
    df = rows([(line,) for line in LINES], "value string")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    found = chat_lines_to_messages(df, at=at)
    assert values(found.select("text", "user")) == sorted(filter(None, map(reference_parse, LINES)), key=repr)
    assert set(values(found, "timestamp")) == {"2024-01-01T00:00:00.000000Z"}
    assert set(values(found, "location")) == {"Twitch"}
    kept = [line for line in LINES if line and not line.startswith("PING") and "PRIVMSG" in line]
    assert sorted(values(chat_messages_only(df), "value")) == sorted(kept)


def test_labelled_csv_with_line_breaks_and_quotes(spark, rows, tmp_path):
    data = [('two\nlines, "quoted" \\ done', "positive"), ("plain", "neutral"), ("crlf\r\nend", "negative")]
    path = str(tmp_path / "csv")
    rows(data, "Comment string, Sentiment string").write.options(**CSV_OPTIONS).csv(path)
    assert values(read_labelled_csv(spark, path)) == sorted(data, key=repr)


def test_conform(rows):
    df = rows([("t", "0.5", "x"), ("s", "high", "y")], "text string, confidence string, extra string")
    out = conform(df)
    assert out.schema == RESULT
    assert sorted((r.text, r.confidence, r.user) for r in out.collect()) == [("s", None, None), ("t", 0.5, None)]


def test_results_are_stored_by_date(spark, rows, tmp_path):
    from chatterlens.operators.dashboards import newest, since

    df = rows([("a", "2024-01-01 10:00:00"), ("b", "2024-01-03 10:00:00"), ("c", None)], "text string, event_time string")
    path = str(tmp_path / "results")
    write_results(conform(df), path, gather=False)
    write_results(conform(df.repartition(8)), str(tmp_path / "gathered"))
    assert values(read_results(spark, str(tmp_path / "gathered"))) == values(read_results(spark, path))
    assert len(list((tmp_path / "gathered").glob("*/*.parquet"))) == 3
    stored = read_results(spark, path)
    assert stored.count() == 3
    assert stored.filter(F.col("event_time") == newest(stored)).first().text == "b"
    recent = since(stored, F.lit("2024-01-03 10:30:00").cast("timestamp"))
    assert values(recent, "text") == ["b"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def _rows_scanned(df):
    """Rows that the scan of a plan gives on, after it has skipped what bounds and Bloom filters exclude."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_look_ups_read_little(spark, tmp_path):
    path, number = str(tmp_path / "table"), F.col("id")
    rows = spark.range(60_000).select(
        F.md5(number.cast("string")).alias("id"),
        F.concat(F.lit("u"), F.md5((number % 30_000).cast("string"))).alias("user"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.hash("id") % 1_000_000).alias("event_time"),
        F.repeat(F.md5((-number).cast("string")), F.lit(10)).alias("text"),
    )
    write_for_look_up(rows.repartition(4), path, block="256k")
    wanted = rows.first()
    found = look_up(spark, path, "id", wanted.id)
    assert [tuple(r) for r in found.collect()] == [tuple(wanted)] and _rows_scanned(found) <= 6000
    assert look_up(spark, path, "user", wanted.user).count() == 2
    recent = spark.read.parquet(path).filter(F.col("event_time") >= F.lit(wanted.event_time)).filter(F.col("event_time") <= F.lit(wanted.event_time))
    assert _rows_scanned(recent) <= 6000 and look_up(spark, path, "id", "none").count() == 0
