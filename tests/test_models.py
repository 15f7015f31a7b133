import pytest
from conftest import values
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel
from pyspark.sql import functions as F

from chatterlens.functions.text import with_clean_text
from chatterlens.operators import features as f
from chatterlens.operators import models as m
from chatterlens.schemas import METRIC

GOOD = ["love it so much", "great great fun", "really love this", "fun and great"]
BAD = ["hate it", "awful and slow", "hate the awful lag"]
MEH = ["it is ok", "ok  then"]


@pytest.fixture(scope="module")
def comments(spark):
    data = [(i, t, s) for i, (t, s) in enumerate(
        [(t, "positive") for t in GOOD] + [(t, "negative") for t in BAD] + [(t, "neutral") for t in MEH]
    )]
    return with_clean_text(spark.createDataFrame(data, "id int, Comment string, Sentiment string"), "Comment")


@pytest.fixture(scope="module")
def model(comments):
    return m.train(comments, m.classifiers()["Naive_Bayes"])


def test_tokens(rows):
    df = rows([(1, "hi  There "), (2, " "), (3, ""), (4, "the Cat\tsat")], "i int, comment_clean string")
    found = {r.i: (r.words, r.filtered_words) for r in f.kept_words(df).collect()}
    assert found == {
        1: (["hi", "", "there"], ["hi", ""]),
        2: ([], []),
        3: ([""], [""]),
        4: (["the", "cat", "sat"], ["cat", "sat"]),
    }
    dropped = {r.i: r.filtered_words for r in f.kept_words(df, drop_empty=True).collect()}
    assert dropped == {1: ["hi"], 2: [], 3: [], 4: ["cat", "sat"]}


def test_label_index_order(rows):
    df = rows([("b",), ("b",), ("c",), ("a",)], "Sentiment string")
    assert list(f.fit_label_index(df).labels) == ["b", "a", "c"]


def test_vocabulary_order_and_size(comments):
    words = f.kept_words(comments)
    whole = [tuple(r) for r in f.vocabulary(words).collect()]
    assert whole == sorted(whole, key=lambda r: (-r[1], r[0]))
    assert [tuple(r) for r in f.vocabulary(words, 3).collect()] == whole[:3]
    counter = CountVectorizer(inputCol=f.KEPT_WORDS, outputCol="x", vocabSize=10_000).fit(words)
    assert sorted(counter.vocabulary) == sorted(t for t, _ in whole)


def test_features_equal_the_standard_stages(comments):
    words = f.kept_words(comments)
    ours = f.apply_stages(comments, f.fit_features(comments))
    stages = f.fit_features(comments)
    terms = next(s for s in stages if isinstance(s, CountVectorizerModel)).vocabulary
    counter = CountVectorizer(inputCol=f.KEPT_WORDS, outputCol="c").fit(words)
    theirs = IDF(inputCol="c", outputCol="x").fit(counter.transform(words)).transform(counter.transform(words))

    def named(df, column, vocabulary):
        return {
            r.id: {vocabulary[i]: round(v, 9) for i, v in zip(r[column].indices.tolist(), r[column].values.tolist())}
            for r in df.select("id", column).collect()
        }

    assert named(ours, f.FEATURES, terms) == named(theirs, "x", counter.vocabulary)
    rows = {}
    for r in f.weighted_terms(words, ["id"]).collect():
        rows.setdefault(r.id, {})[r.term] = round(r.tfidf, 9)
    assert rows == named(ours, f.FEATURES, terms)


def test_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(2000)
    train, test = m.split_by_hash(df, "id")
    again, _ = m.split_by_hash(df.repartition(7), "id")
    first = set(values(train, "id"))
    assert first == set(values(again, "id"))
    assert first.isdisjoint(values(test, "id")) and train.count() + test.count() == 2000
    assert 1500 < len(first) < 1700
    unnamed = [part.count() for part in m.split_by_hash(spark.range(5).select(F.lit(None).cast("long").alias("id")), "id")]
    assert unnamed == [5, 0]
    left, right = m.split_at_random(df)
    assert left.count() + right.count() == 2000


def test_pipeline_order_and_labels(model):
    names = [type(s).__name__ for s in model.stages]
    assert names == [
        "StringIndexerModel",
        "Tokenizer",
        "StopWordsRemover",
        "CountVectorizerModel",
        "IDFModel",
        "NaiveBayesModel",
    ]
    assert m.labels_of(model) == ["positive", "negative", "neutral"]
    assert m.labels_of(PipelineModel(model.stages[1:])) == ["negative", "neutral", "positive"]


def test_trained_model_equals_a_plain_pipeline(comments, model):
    indexer = f.StringIndexer(inputCol="Sentiment", outputCol="label")
    counter = CountVectorizer(inputCol=f.KEPT_WORDS, outputCol=f.COUNTS, vocabSize=10_000)
    stages = [indexer, f.tokenizer(), f.stop_word_remover(), counter, IDF(inputCol=f.COUNTS, outputCol=f.FEATURES)]
    plain = Pipeline(stages=[*stages, NaiveBayes(smoothing=1.0, modelType="multinomial")]).fit(comments)
    ours, theirs = (
        {r.id: [round(p, 9) for p in r.probability] for r in fitted.transform(comments).collect()}
        for fitted in (model, plain)
    )
    assert ours == theirs


def test_saved_model_predicts_the_same(comments, model, tmp_path):
    m.save_model(model, str(tmp_path / "nb"))
    m.save_model(model, str(tmp_path / "nb"))
    again = m.load_model(str(tmp_path / "nb"))
    before = {r.id: r.probability for r in m.predict(comments, model).collect()}
    after = {r.id: r.probability for r in m.predict(comments, again).collect()}
    assert before == after


def test_classifier_parameters():
    found = m.classifiers()
    assert list(found) == ["Logistic_Regression", "Random_Forest", "Naive_Bayes", "Decision_Tree"]
    regression, forest, bayes, tree = found.values()
    assert (regression.getMaxIter(), regression.getRegParam(), regression.getElasticNetParam()) == (100, 0.01, 0.8)
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (100, 10, 42)
    assert (bayes.getSmoothing(), bayes.getModelType()) == (1.0, "multinomial")
    assert (tree.getMaxDepth(), tree.getSeed()) == (10, 42)


def test_comparison_survives_a_failing_candidate(comments, tmp_path):
    candidates = {
        "Broken": NaiveBayes(featuresCol="missing"),
        "Naive_Bayes": m.classifiers()["Naive_Bayes"],
        "Decision_Tree": m.classifiers()["Decision_Tree"],
    }
    compared = m.compare_models(comments, comments, candidates, str(tmp_path))
    assert compared.schema == METRIC
    found = {r.model: r for r in compared.collect()}
    assert found["Broken"].accuracy == 0.0 and "missing" in found["Broken"].error
    assert found["Naive_Bayes"].error is None and found["Naive_Bayes"].accuracy > 0.8
    assert found["Naive_Bayes"].recall == pytest.approx(found["Naive_Bayes"].accuracy)
    assert found["Naive_Bayes"].training_time >= found["Naive_Bayes"].fit_time > 0
    loaded = m.load_model(str(tmp_path / "Decision_Tree_model"))
    assert loaded.transform(comments).count() == comments.count()


def test_all_four_classifiers_train(comments):
    small = {
        name: c.copy({c.getParam("numTrees"): 3} if c.hasParam("numTrees") else None)
        for name, c in m.classifiers().items()
    }
    compared = m.compare_models(comments, comments, small, parallelism=4)
    assert [r.model for r in compared.collect()] == list(small)
    assert compared.filter(F.col("error").isNull()).count() == 4


def test_a_model_that_cannot_be_saved_keeps_its_metrics(comments, tmp_path, monkeypatch):
    def no_room(model, path):
        raise OSError("disk is full")

    monkeypatch.setattr(m, "save_model", no_room)
    seen = []
    only = {"Naive_Bayes": m.classifiers()["Naive_Bayes"]}
    compared = m.compare_models(comments, comments, only, str(tmp_path), inspect=lambda name, rows: seen.append((name, rows.count())))
    row = compared.first()
    assert row.accuracy > 0.8 and "disk is full" in row.error
    assert seen == [("Naive_Bayes", comments.count())]


def test_text_is_tokenised_once(comments):
    weighted = f.weighted_terms(f.kept_words(comments), ["id"])
    weighted.collect()
    plan = weighted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Generate ") == 1


def test_training_rows_are_dealt_by_their_number(comments, monkeypatch):
    with f.featurised(comments) as (_, features):
        before = features.rdd.map(lambda row: (row.label, str(row.features))).collect()
    monkeypatch.setattr(f, "PARTITION_ROWS", 2)
    with f.featurised(comments) as (_, features):
        after = features.rdd.glom().collect()
    assert len(after) == -(-len(before) // 2) and max(map(len, after)) <= 4
    assert sorted((row.label, str(row.features)) for part in after for row in part) == sorted(before)
