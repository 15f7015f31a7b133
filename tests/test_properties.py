"""Column functions against plain Python on generated text; one DataFrame per example keeps this quick."""

import re
from collections import Counter

import pytest
from conftest import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatterlens.functions import text
from chatterlens.operators.features import KEPT_WORDS, WORDS, kept_words
from chatterlens.operators.quality import classification_metrics
from chatterlens.operators.validate import decode_messages, route, validation_report
from chatterlens.sources.chat import chat_lines_to_messages
from chatterlens.sources.topics import encode_messages
from test_sources import reference_parse

quick = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)

any_text = st.text(st.characters(exclude_categories=["Cs"]), max_size=30)
spaced = st.text(st.sampled_from("ab \t\n\r\x0b\x0c\x1c\x85\xa0  é'.:!"), max_size=20)
mixed = st.one_of(any_text, spaced)


def many(strategy):
    return st.lists(strategy, min_size=1, max_size=60)


@quick
@given(many(mixed))
def test_strip_and_splits(spark, texts):
    c = F.col("t")
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select("t", text.strip(c), text.before_first(c, ":"), text.after_first(c, ":"), text.truncate(c, 5))
    for t, stripped, left, right, head in found.collect():
        assert stripped == t.strip()
        assert left == t.split(":", 1)[0]
        assert right == (t.split(":", 1)[1] if ":" in t else None)
        assert head == t[:5]


@quick
@given(many(mixed))
def test_clean_and_tokens(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = kept_words(text.with_clean_text(df)).select("text", "comment_clean", WORDS, KEPT_WORDS)
    for t, clean, words, kept in found.collect():
        assert clean == re.sub(r"[^a-zA-Z \t\n\x0b\f\r]", "", t.lower())
        expected = re.split(r"[ \t\n\x0b\f\r]", clean)
        if clean:
            while expected and expected[-1] == "":
                expected.pop()
        assert words == expected
        assert kept == [w for w in words if w not in text_stop_words()]


def text_stop_words():
    from chatterlens.functions.stopwords import ENGLISH

    return set(ENGLISH)


pieces = st.sampled_from(["PING", "PRIVMSG", ":", "!", " ", "#c", "nick", "x" * 30, "é", "\t"])


@quick
@given(many(st.lists(pieces, max_size=9).map("".join)))
def test_chat_lines(spark, lines):
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    found = values(chat_lines_to_messages(df).select("text", "user"))
    assert found == sorted(filter(None, map(reference_parse, lines)), key=repr)


fields = st.one_of(st.none(), mixed)


@quick
@given(many(st.tuples(fields, fields, fields, fields)))
def test_encode_decode_and_route(spark, messages):
    df = spark.createDataFrame(messages, "text string, user string, timestamp string, location string")
    decoded = decode_messages(encode_messages(df))
    assert values(decoded.select(*df.columns)) == values(df)
    valid, dead = route(decoded)
    assert valid.count() + dead.count() == len(messages)

    def good(value):
        return value is not None and value.strip(" \t\r\n") != ""

    assert valid.count() == sum(good(m[0]) and good(m[1]) for m in messages)
    report = {r.reason: r.n for r in validation_report(decoded).collect()}
    assert report.get("missing_text", 0) == sum(not good(m[0]) for m in messages)
    assert report.get("missing_user", 0) == sum(not good(m[1]) for m in messages)


@quick
@given(many(st.tuples(st.integers(0, 3).map(float), st.integers(0, 3).map(float))))
def test_metrics(spark, pairs):
    df = spark.createDataFrame(pairs, "label double, prediction double")
    found = classification_metrics(df).first()
    support, predicted = Counter(p[0] for p in pairs), Counter(p[1] for p in pairs)
    hits = Counter(p[0] for p in pairs if p[0] == p[1])
    total = len(pairs)
    precision = {c: hits[c] / predicted[c] if predicted[c] else 0.0 for c in support}
    recall = {c: hits[c] / support[c] for c in support}
    f1 = {c: 2 * precision[c] * recall[c] / (precision[c] + recall[c]) if precision[c] + recall[c] else 0.0 for c in support}
    assert found.accuracy == pytest.approx(sum(hits.values()) / total)
    for column, scores in (("precision", precision), ("recall", recall), ("f1_score", f1)):
        assert found[column] == pytest.approx(sum(support[c] * scores[c] for c in support) / total)
