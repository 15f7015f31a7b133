import numpy as np
import pytest
from pyspark.sql import functions as F

from chatterlens.functions.text import with_clean_text
from chatterlens.operators.features import kept_words
from chatterlens.operators.models import classifiers, labels_of, predict, train
from chatterlens.operators.score import joined_words, naive_bayes_scorer, score_messages, score_udf, score_with_udf
from chatterlens.plans.chain import results_of
from chatterlens.schemas import RESULT

COMMENTS = [("love it", "positive"), ("great fun", "positive"), ("hate this thing", "negative"), ("its  ok", "neutral")]
TEXTS = ["love the  fun", "hate", "unknown words", "", "  ", None, "ok  ok", "Great!", "the the"]


@pytest.fixture(scope="module")
def model(spark):
    df = with_clean_text(spark.createDataFrame(COMMENTS, "Comment string, Sentiment string"), "Comment")
    return train(df, classifiers()["Naive_Bayes"])


@pytest.fixture
def messages(rows):
    data = [(t, f"u{i}", "2024-01-01T00:00:00Z", "here") for i, t in enumerate(TEXTS)]
    return rows(data, "text string, user string, timestamp string, location string")


def test_results(messages, model):
    at = F.lit("2024-02-01").cast("timestamp")
    results = score_messages(messages, model, at, keep=("user",)).drop("user")
    assert score_messages(messages, model, at).schema.fieldNames() == RESULT.fieldNames()
    found = {r.text: r for r in score_messages(messages, model, at).collect()}
    assert len(found) == len(TEXTS) and results.count() == len(TEXTS)
    assert found["love the  fun"].sentiment == "positive" and found["hate"].sentiment == "negative"
    assert found["hate"].source == "here" and str(found["hate"].predicted_at) == "2024-02-01 00:00:00"
    assert all(1 / 3 <= r.confidence <= 1 for r in found.values())


def test_plugin_gives_the_class_of_the_pipeline(messages, model):
    words = kept_words(with_clean_text(messages))
    names = dict(enumerate(labels_of(model)))
    scorer = score_udf(naive_bayes_scorer(model), 3, batch_size=2)
    scored = words.withColumn("scores", scorer(joined_words()))
    expected = predict(with_clean_text(messages), model).select("user", "prediction", "rawPrediction")
    for row in scored.select("user", "scores").join(expected, "user").collect():
        assert np.allclose(row.scores, row.rawPrediction.toArray())
    labelled = {r.user: r for r in score_with_udf(words, scorer, joined_words(), names).collect()}
    for row in expected.collect():
        text = labelled[row.user].text
        assert labelled[row.user].sentiment == ("neutral" if text is None or len(text) < 5 else names[int(row.prediction)])
        assert labelled[row.user].model_failed is False


def test_guards_keep_short_texts_from_the_model(messages):
    def load():
        def scores(texts):
            assert all(t is not None and len(t) >= 5 for t in texts)
            return np.tile([0.0, 0.0, 1.0], (len(texts), 1))

        return scores

    found = {r.text: r for r in score_with_udf(messages, score_udf(load, 3)).collect()}
    short = [t for t in TEXTS if t is None or len(t) < 5]
    assert all(found[t].sentiment == "neutral" and not found[t].model_failed for t in short)
    assert all(found[t].sentiment == "positive" for t in TEXTS if t not in short)


def test_failures_are_neutral_and_flagged(messages):
    def load():
        def scores(texts):
            if any("hate" in t or "unknown" in t for t in texts):
                raise RuntimeError("model")
            return np.tile([1.0, 0.0, 0.0], (len(texts), 1))

        return scores

    found = {r.text: (r.sentiment, r.model_failed) for r in score_with_udf(messages, score_udf(load, 3)).collect()}
    assert found["unknown words"] == ("neutral", True)
    assert found["love the  fun"] == ("negative", False) and found["Great!"] == ("negative", False)


def test_whole_chain(rows, model):
    raw = rows([('{"text":"love","user":"u","timestamp":"2024-01-01T00:00:00Z","location":"x"}',), ("no",)], "value string")
    results, dead = results_of(raw, model)
    assert [r.sentiment for r in results.collect()] == ["positive"] and dead.count() == 1
    assert "id" in results.columns
