import pytest
from conftest import values
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from chatterlens.operators.models import metric_rows, read_metrics, save_metrics
from chatterlens.operators.quality import (
    best_model,
    classification_metrics,
    confusion_matrix,
    model_outcomes,
    rank_models,
)

CASES = {
    "mixed": [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 0.0), (2.0, 2.0), (0.0, 0.0)],
    "class never predicted": [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (0.0, 0.0)],
    "predicted but never true": [(0.0, 0.0), (0.0, 2.0), (1.0, 1.0)],
    "one class": [(1.0, 1.0), (1.0, 1.0)],
    "all wrong": [(0.0, 1.0), (1.0, 0.0)],
}
NAMES = {"accuracy": "accuracy", "f1_score": "f1", "precision": "weightedPrecision", "recall": "weightedRecall"}


@pytest.mark.parametrize("case", CASES)
def test_metrics_equal_the_evaluator(rows, case):
    df = rows(CASES[case], "label double, prediction double")
    found = classification_metrics(df).first()
    for ours, theirs in NAMES.items():
        assert found[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df), abs=1e-9)
    assert found["recall"] == pytest.approx(found["accuracy"])


def test_metrics_of_nothing(rows):
    found = classification_metrics(rows([], "label double, prediction double")).collect()
    assert len(found) == 1 and found[0].accuracy is None


def test_metrics_per_model(rows):
    df = rows([("a", 0.0, 0.0), ("b", 0.0, 1.0)], "model string, label double, prediction double")
    found = {r.model: r.accuracy for r in classification_metrics(df, by=["model"]).collect()}
    assert found == {"a": 1.0, "b": 0.0}


def test_confusion_matrix(rows):
    df = rows(CASES["mixed"], "label double, prediction double")
    assert (0.0, 0.0, 2) in values(confusion_matrix(df))


# Published scores of the four classifiers.
PUBLISHED = [
    ("Logistic_Regression", 0.6965, 0.6463, 0.6866, 0.6965, 35.76, None, None),
    ("Random_Forest", 0.6333, 0.4986, 0.7589, 0.6333, 62.17, None, None),
    ("Naive_Bayes", 0.7095, 0.7018, 0.7181, 0.7095, 6.92, None, None),
    ("Decision_Tree", 0.6366, 0.5201, 0.6041, 0.6366, 41.85, None, None),
    ("Broken", 0.0, 0.0, 0.0, 0.0, 0.0, None, "failed"),
]


def test_ranking(spark):
    metrics = metric_rows(spark, PUBLISHED)
    order = ["Naive_Bayes", "Logistic_Regression", "Decision_Tree", "Random_Forest"]
    assert [r.model for r in rank_models(metrics).collect()] == order
    assert [r.model for r in rank_models(metrics, "f1_score").collect()] == order
    assert best_model(metrics).first().model == "Naive_Bayes"
    assert tuple(model_outcomes(metrics).first()) == (4, 1)


def test_ranking_ties_and_failures(spark):
    tied = metric_rows(spark, [("b", 0.5, 0.0, 0.0, 0.0, 0.0, None, None), ("a", 0.5, 0.0, 0.0, 0.0, 0.0, None, None)])
    assert [(r.model, r["rank"]) for r in rank_models(tied).collect()] == [("a", 1), ("b", 1)]
    failed = metric_rows(spark, [("x", None, 0.0, 0.0, 0.0, 0.0, None, "e"), ("y", 0.1, 0.0, 0.0, 0.0, 0.0, None, None)])
    assert best_model(failed).first().model == "y"


def test_metrics_survive_json(spark, tmp_path):
    metrics = metric_rows(spark, PUBLISHED)
    save_metrics(metrics, str(tmp_path / "m"))
    assert values(read_metrics(spark, str(tmp_path / "m"))) == values(metrics)
