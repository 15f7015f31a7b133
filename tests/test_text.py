from pyspark.sql import functions as F

from chatterlens.functions import labels, stopwords, text, times


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def apply(rows, function, inputs):
    df = rows([(i, value) for i, value in enumerate(inputs)], "i int, t string")
    return [row.x for row in df.select("i", function(F.col("t")).alias("x")).orderBy("i").collect()]


def test_clean_text_keeps_ascii_letters_and_whitespace(rows):
    inputs = ["Don't STOP!", "a  b\tc\n", "héllo", "🙂", "", None, "İx", "1234"]
    assert apply(rows, text.clean_text, inputs) == ["dont stop", "a  b\tc\n", "hllo", "", "", None, "ix", ""]


def test_dropping_empty_text_agrees_with_cleaning(rows):
    inputs = ["abc", "...", "", None, " ", "é", "K", "1 2", "\n", "ß"]
    df = rows([(t,) for t in inputs], "text string")
    cleaned = text.with_clean_text(df).filter("comment_clean != ''")
    assert text.drop_empty_text(df).exceptAll(cleaned.select("text")).count() == 0
    assert cleaned.select("text").exceptAll(text.drop_empty_text(df)).count() == 0


def test_every_character_is_cleaned_as_stated(spark):
    """The stated rule is: lower case, then remove all but a-z, A-Z and whitespace."""
    points = spark.range(1, 0x30000).filter("id < 55296 or id > 57343")
    one = F.decode(F.encode(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')"), "UTF-8"), "UTF-8")
    df = points.select(one.alias("text"))
    stated = F.regexp_replace(F.lower("text"), "[^a-zA-Z\\s]", "")
    assert df.filter(stated != text.clean_text(F.col("text"))).count() == 0
    kept = text.drop_empty_text(df)
    assert kept.count() == df.filter(stated != "").count() == kept.filter(stated != "").count()


def test_clean_column_is_never_null(rows):
    df = text.with_clean_text(rows([(None,), ("A1",)], "text string"))
    assert sorted(r.comment_clean for r in df.collect()) == ["", "a"]


def test_blank(rows):
    inputs = [None, "", "  ", "\t\r\n", "x", " x ", " "]
    assert apply(rows, text.is_blank, inputs) == [True, True, True, True, False, False, False]


def test_short(rows):
    assert apply(rows, text.is_short, [None, "", "abcd", "abcde", "ééééé"]) == [True, True, True, False, False]


def test_strip_equals_python(rows):
    inputs = ["  a b \n", " x　", "\x1cz\x1f", "\x85", "plain", "", "​q"]
    assert apply(rows, text.strip, inputs) == [value.strip() for value in inputs]


def test_split_once_equals_python(rows):
    inputs = ["a:b:c", ":x", "none", "x:", ""]
    assert apply(rows, lambda c: text.before_first(c, ":"), inputs) == [v.split(":", 1)[0] for v in inputs]
    right = [v.split(":", 1)[1] if ":" in v else None for v in inputs]
    assert apply(rows, lambda c: text.after_first(c, ":"), inputs) == right
    assert apply(rows, lambda c: text.after_first(c, "ab"), ["xabyab", "b"]) == ["yab", None]


def test_remove_and_truncate(rows):
    assert apply(rows, lambda c: text.remove_mark(c, ":"), ["::a:b", "c"]) == ["ab", "c"]
    assert apply(rows, lambda c: text.truncate(c, 2), ["é🙂x", "a", None]) == ["é🙂", "a", None]


def test_report_text(spark):
    assert one(spark, text.model_title(F.lit("Naive_Bayes"))) == "Naive Bayes"
    assert one(spark, text.percent_text(F.lit(0.709534))) == "70.95%"


def test_parse_time(rows):
    inputs = [
        "2024-01-02T03:04:05Z",
        "2024-01-02T03:04:05.123456Z",
        "2024-01-02T03:04:05",
        "2024-01-02T03:04:05+02:00",
        "nope",
        "",
        None,
    ]
    assert apply(rows, lambda c: times.utc_iso(times.parse_time(c)), inputs) == [
        "2024-01-02T03:04:05.000000Z",
        "2024-01-02T03:04:05.123456Z",
        "2024-01-02T03:04:05.000000Z",
        "2024-01-02T01:04:05.000000Z",
        None,
        None,
        None,
    ]


def test_stamp(spark):
    at = F.lit("2024-01-02 03:04:05.9").cast("timestamp")
    assert one(spark, times.stamp(at)) == "2024-01-02 03:04:05"


def test_label_lookup(rows):
    df = rows([(-1.0,), (0.0,), (2.0,), (3.0,), (None,)], "p double")
    names = ["neutral", "it's", "negative"]
    assert [r.x for r in df.select(labels.label_at(F.col("p"), names).alias("x")).collect()] == [
        None,
        "neutral",
        "negative",
        None,
        None,
    ]
    assert [r.x for r in df.select(labels.label_from_map(F.col("p")).alias("x")).collect()] == [
        "neutral",
        "negative",
        "positive",
        "neutral",
        "neutral",
    ]


def test_argmax(rows):
    df = rows([([0.1, 0.7, 0.7],), ([5.0],), ([],), (None,), ([None, 1.0],)], "s array<double>")
    assert [r.x for r in df.select(labels.argmax(F.col("s")).alias("x")).collect()] == [1, 0, None, None, 1]


def test_confidence_of_log_scores(rows):
    df = rows([([0.0, 0.0],), ([-1000.0, -1000.0, -1000.0],), ([5.0, -800.0],), (None,)], "s array<double>")
    found = [r.x for r in df.select(labels.confidence_of(F.col("s")).alias("x")).collect()]
    assert found[:1] + found[2:] == [0.5, 1.0, None] and abs(found[1] - 1 / 3) < 1e-12


def test_stop_words_are_the_default_list(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(stopwords.ENGLISH) == StopWordsRemover.loadDefaultStopWords("english")


def test_content_key_separates_its_parts(rows):
    df = rows([("a", "bc"), ("ab", "c"), ("a", "bc"), (None, "bc")], "x string, y string")
    keys = [r.k for r in df.select(text.content_key("x", "y").alias("k")).collect()]
    assert keys[0] == keys[2] and len(set(keys)) == 3
