import pytest
from conftest import values
from pyspark.sql import functions as F

from chatterlens.operators import dashboards as d

DATA = [
    ("2024-01-01 00:01:00", "positive", "ann", "s1", "Great product, great price", 1),
    ("2024-01-01 00:04:59", "positive", "bob", "s1", "great  PRODUCT", 2),
    ("2024-01-01 00:05:00", "negative", "ann", "s2", "the worst", 3),
    ("2024-01-01 00:21:00", "neutral", "ann", "s2", "the worst", 4),
    (None, "neutral", None, "s2", None, 5),
]


@pytest.fixture
def results(rows):
    df = rows(DATA, "event_time string, sentiment string, user string, source string, text string, id int")
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def test_counts(results):
    assert d.row_count(results).first().n == 5
    shares = {r.sentiment: (r.n, r.share) for r in d.distribution(results).collect()}
    assert shares == {"positive": (2, 0.4), "negative": (1, 0.2), "neutral": (2, 0.4)}
    assert values(d.volume_by(results)) == [("s1", 2), ("s2", 3)]


def clock(df):
    return df.withColumn("bucket", F.date_format("bucket", "HH:mm"))


def test_sentiment_over_time(results):
    assert values(clock(d.sentiment_over_time(results))) == [
        ("00:00", "positive", 2),
        ("00:05", "negative", 1),
        ("00:20", "neutral", 1),
    ]


def test_filled_buckets(results):
    filled = clock(d.sentiment_over_time(results, labels=["positive", "negative"], fill=True))
    found = values(filled)
    assert len(found) == 11
    assert ("00:10", "positive", 0) in found and ("00:00", "positive", 2) in found and ("00:20", "neutral", 1) in found
    with pytest.raises(ValueError):
        d.sentiment_over_time(results, fill=True)


def test_far_dates_are_counted_but_nothing_is_filled_up_to_them(rows):
    times = [("2024-01-01 00:01:00", "a"), ("2024-01-03 00:01:00", "a"), ("9999-12-31 00:01:00", "b"), (None, "a")]
    df = rows(times, "t string, sentiment string").withColumn("event_time", F.col("t").cast("timestamp"))
    filled = d.sentiment_over_time(df, labels=["a"], fill=True)
    assert filled.count() == 2 * 288 + 1 + 1
    assert [tuple(r) for r in filled.filter("n > 0").groupBy("sentiment").agg(F.sum("n")).orderBy("sentiment").collect()] == [("a", 2), ("b", 1)]


def test_sentiment_columns(results):
    wide = clock(d.sentiment_columns(results, ["negative", "neutral", "positive"]))
    assert values(wide) == [("00:00", 0, 0, 2), ("00:05", 1, 0, 0), ("00:20", 0, 1, 0)]


def test_time_ranges(results):
    assert sorted(values(d.last_hour(results, d.newest(results)), "id")) == [1, 2, 3, 4]
    assert d.last_hour(results).count() == 0
    at = F.lit("2024-01-01 00:21:00").cast("timestamp")
    assert sorted(values(d.since(results, at, "16 minutes"), "id")) == [3, 4]


def test_latest_and_preview(results):
    assert values(d.latest_rows(results, n=2), "id") == [4, 3]
    assert values(d.latest_rows(results, n=9), "id")[-1] == 5
    assert values(d.preview(results, ["text"], "id", 2, 5)) == [(1, "Great"), (2, "great")]


def test_top_values_break_ties_by_name(results):
    assert [tuple(r) for r in d.top_values(results.dropna(subset="user"), "user", 2).collect()] == [("ann", 3), ("bob", 1)]
    assert [r.source for r in d.top_values(results.filter("id != 5"), "source").collect()] == ["s1", "s2"]
    assert None not in [r.user for r in d.top_values(results, "user").collect()]


def test_top_texts(results, spark):
    top = {r.text: r.n for r in d.top_texts(results, n=1).collect()}
    assert top == {"the worst": 2}
    # One text makes up a third of all rows.
    number = F.col("id")
    many = spark.range(3000).select(F.when(number % 3 == 0, "hot").otherwise(number.cast("string")).alias("text"))
    assert {r.text: r.n for r in d.top_texts(many, n=1).collect()} == {"hot": 1000}


def test_trending_words(results):
    assert [tuple(r) for r in d.trending_words(results, n=3).collect()] == [("great", 3), ("product", 2), ("worst", 2)]


def test_labels_that_are_missing_or_not_listed(rows):
    data = [("2024-01-01 00:01:00", "a"), ("2024-01-01 00:02:00", None), ("2024-01-01 00:11:00", "z"), ("9999-01-01 00:00:00", None)]
    df = rows(data, "event_time string, sentiment string").withColumn("event_time", F.col("event_time").cast("timestamp"))
    filled = d.sentiment_over_time(df, labels=["a", "b"], fill=True)
    found = {(r.at, r.sentiment): r.n for r in filled.select(F.date_format("bucket", "yyyy HH:mm").alias("at"), "sentiment", "n").collect()}
    assert found == {
        ("2024 00:00", "a"): 1, ("2024 00:00", "b"): 0, ("2024 00:00", d.NO_LABEL): 1, ("2024 00:05", "a"): 0, ("2024 00:05", "b"): 0,
        ("2024 00:10", "a"): 0, ("2024 00:10", "b"): 0, ("2024 00:10", "z"): 1, ("9999 00:00", d.NO_LABEL): 1,
    }
    columns = {r.at: (r.a, r.other) for r in d.sentiment_columns(df, ["a"], other="other").select(F.date_format("bucket", "yyyy HH:mm").alias("at"), "a", "other").collect()}
    assert columns == {"2024 00:00": (1, 1), "2024 00:10": (0, 1), "9999 00:00": (0, 1)}


def test_rising_words(rows):
    old = [("2024-01-01 10:00:00", "common words common"), ("2024-01-02 10:00:00", "common film")] * 10
    new = [("2024-01-02 23:30:00", "fresh fresh common the"), ("2024-01-02 23:40:00", "Fresh! film, fresh")] * 2
    df = rows(old + new + [("2023-01-01 00:00:00", "fresh"), (None, "fresh")], "event_time string, text string")
    df = df.withColumn("event_time", F.col("event_time").cast("timestamp"))
    found = d.rising_words(df, F.lit("2024-01-03 00:00:00").cast("timestamp"), least=2).collect()
    assert [(r.word, r.recent, r.earlier) for r in found] == [("fresh", 8, 0), ("film", 2, 10)][: len(found)] and found[0].score > 10
    assert d.rising_words(df, F.lit("2020-01-01").cast("timestamp")).count() == 0
