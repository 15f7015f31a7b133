import pytest
from conftest import values
from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
from pyspark.ml.feature import CountVectorizerModel

from chatterlens.operators import statistics as st
from chatterlens.operators.models import labels_of, train

TEXTS = [
    ("good film good", "positive"), ("bad film", "negative"), ("  twice   blank ", "neutral"), ("good", "positive"),
    ("", "negative"), ("the bad the worst", "negative"), ("film film film plot", "neutral"), ("plot twist", "positive"),
]


@pytest.fixture
def labelled(rows):
    return rows(TEXTS, "comment_clean string, Sentiment string")


def weights(model):
    bayes = next(stage for stage in model.stages if isinstance(stage, NaiveBayesModel))
    terms = next(stage for stage in model.stages if isinstance(stage, CountVectorizerModel)).vocabulary
    return {
        (label, term): (prior, value)
        for label, prior, found in zip(labels_of(model), bayes.pi.toArray(), bayes.theta.toArray())
        for term, value in zip(terms, found)
    }


def found(statistics):
    return {(r.label, r.term): (round(r.prior, 12), round(r.log_likelihood, 12)) for r in st.bayes_weights(statistics).collect()}


def test_merged_parts_give_the_classifier(labelled, rows):
    parts = [st.text_statistics(rows(TEXTS[i::3], labelled.schema)) for i in range(3)]
    expected, got = weights(train(labelled, NaiveBayes(labelCol="label", featuresCol="features"))), found(st.merged(*parts))
    assert set(got) == set(expected)
    for cell, numbers in expected.items():
        assert got[cell] == pytest.approx(numbers, abs=1e-9)


def test_stored_parts_are_replaced_and_forgotten(spark, rows, labelled, tmp_path):
    path = str(tmp_path / "statistics")
    for part in range(2):
        st.write_statistics(st.text_statistics(rows(TEXTS[part::2], labelled.schema)), path, str(part))
    whole = found(st.text_statistics(labelled))
    assert found(st.read_statistics(spark, path)) == whole
    st.write_statistics(st.text_statistics(rows(TEXTS[1::2], labelled.schema)), path, "1")
    assert found(st.read_statistics(spark, path)) == whole
    assert st.drop_statistics(spark, path, "1") and not st.drop_statistics(spark, path, "9")
    assert values(st.read_statistics(spark, path)) == values(st.text_statistics(rows(TEXTS[0::2], labelled.schema)))


def test_statistics_of_odd_rows(rows):
    got = values(st.text_statistics(rows([("a a b", "x"), ("", "x"), ("a", None)], "comment_clean string, Sentiment string")))
    assert got == sorted([("x", "\n", 2, 2), ("x", "", 1, 1), ("x", "b", 1, 1), (None, "\n", 1, 1)], key=repr)  # "a" is a stop word
    assert st.text_statistics(rows([], "comment_clean string, Sentiment string")).count() == 0


def test_new_parts_do_not_read_old_texts(spark, rows, labelled, tmp_path):
    path = str(tmp_path / "statistics")
    st.write_statistics(st.text_statistics(labelled), path, "0")
    plan = st.bayes_weights(st.read_statistics(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "comment_clean" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
