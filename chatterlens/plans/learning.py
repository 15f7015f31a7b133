"""Queries over text features, classifiers and scoring."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizerModel, IDFModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterlens.functions.text import with_clean_text
from chatterlens.operators.dashboards import preview
from chatterlens.operators.features import (
    FEATURES,
    KEPT_WORDS,
    LABEL,
    LABEL_TEXT,
    TEXT,
    WORDS,
    apply_stages,
    fit_features,
    fit_label_index,
    kept_words,
    term_counts,
    tokenizer,
    vocabulary,
    weighted_terms,
)
from chatterlens.operators.latest import with_document_id
from chatterlens.operators.models import (
    classifiers,
    compare_models,
    labels_of,
    load_model,
    predict,
    save_model,
    split_by_hash,
    train,
)
from chatterlens.operators.quality import classification_metrics, confusion_matrix
from chatterlens.operators.score import joined_words, naive_bayes_scorer, score_udf, score_with_udf, udf_results
from chatterlens.operators.validate import decode_messages, route
from chatterlens.plans.chain import results_of
from chatterlens.plans.dashboard import STOP_WORDS_SQL
from chatterlens.plans.fixtures import CLEAN_SQL, LABELLED_SQL, ROUTED_SQL, at, labelled, messages, raw_values, table
from chatterlens.plans.registry import query
from chatterlens.session import shared_folder

_MODELS: dict[tuple[str, str, str], PipelineModel] = {}


def training(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split_by_hash(labelled(spark, sf_dir), "doc_id")


def fitted(spark: SparkSession, sf_dir: str, name: str = "Naive_Bayes") -> PipelineModel:
    """The named classifier fitted on the training part, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _MODELS:
        _MODELS[key] = train(training(spark, sf_dir)[0], classifiers()[name])
    return _MODELS[key]


# Splitting at single whitespace keeps inner and leading empty words and loses trailing ones.
def _words_sql(clean: str) -> str:
    kept = f"regexp_replace({clean}, '\\s+$', '')"
    return (
        f"CASE WHEN {clean} = '' THEN [''] WHEN {kept} = '' THEN []::VARCHAR[] "
        f"ELSE regexp_split_to_array({kept}, '\\s') END"
    )


_DOCUMENT_WORDS_SQL = f"""cleaned AS (SELECT doc_id, {CLEAN_SQL.format('text')} AS clean FROM documents),
tokens AS (SELECT doc_id, {_words_sql('clean')} AS words FROM cleaned)"""


def _features_sql(rows: str) -> str:
    """Terms, vocabulary and weights of the labelled rows in the relation ``rows``."""
    return f"""all_terms AS (SELECT doc_id, sentiment, unnest({_words_sql('clean')}) AS term FROM {rows}),
terms AS (SELECT * FROM all_terms WHERE term NOT IN ({STOP_WORDS_SQL})),
vocabulary AS (SELECT term, count(*) AS n FROM terms GROUP BY term ORDER BY n DESC, term LIMIT 10000),
tf AS (
  SELECT doc_id, sentiment, term, count(*) AS tf FROM terms
  WHERE term IN (SELECT term FROM vocabulary) GROUP BY ALL),
idf AS (
  SELECT term, count(*) AS df, ln(((SELECT count(*) FROM {rows}) + 1) / (count(*) + 1)) AS idf
  FROM tf GROUP BY term)"""


_SPLIT_SQL = "CAST('0x' || left(md5(CAST(doc_id AS VARCHAR)), 8) AS BIGINT) % 100"

BAYES_SQL = f"""{LABELLED_SQL}, train AS (SELECT * FROM labelled WHERE {_SPLIT_SQL} < 80),
{_features_sql('train')},
classes AS (
  SELECT sentiment,
    ln(count(*) + 1) - ln((SELECT count(*) + count(DISTINCT sentiment) FROM train)) AS prior,
    row_number() OVER (ORDER BY count(*) DESC, sentiment) - 1 AS label FROM train GROUP BY sentiment),
weights AS (SELECT sentiment, term, sum(tf * idf) AS weight FROM tf JOIN idf USING (term) GROUP BY ALL),
totals AS (SELECT sentiment, sum(weight) AS total FROM weights GROUP BY sentiment),
bayes AS (
  SELECT c.sentiment, c.label, c.prior, v.term, i.idf,
    ln(coalesce(w.weight, 0) + 1) - ln(t.total + (SELECT count(*) FROM vocabulary)) AS log_likelihood
  FROM vocabulary v JOIN idf i ON i.term = v.term JOIN classes c ON true JOIN totals t ON t.sentiment = c.sentiment
  LEFT JOIN weights w ON w.sentiment = c.sentiment AND w.term = v.term)"""

SCORED_SQL = f"""{BAYES_SQL}, {ROUTED_SQL},
scoreable AS (SELECT *, {CLEAN_SQL.format('text')} AS clean FROM routed WHERE reason IS NULL),
message_terms AS (
  SELECT event_id, term, count(*) AS tf FROM (SELECT event_id, unnest({_words_sql('clean')}) AS term FROM scoreable)
  GROUP BY ALL),
sums AS (
  SELECT m.event_id, b.sentiment, sum(m.tf * b.idf * b.log_likelihood) AS score
  FROM message_terms m JOIN bayes b ON b.term = m.term GROUP BY ALL),
raw_scores AS (
  SELECT s.event_id, c.sentiment, c.label, c.prior + coalesce(x.score, 0) AS score
  FROM scoreable s JOIN classes c ON true
  LEFT JOIN sums x ON x.event_id = s.event_id AND x.sentiment = c.sentiment),
ranked AS (
  SELECT event_id, sentiment, score, max(score) OVER (PARTITION BY event_id) AS best,
    row_number() OVER (PARTITION BY event_id ORDER BY score DESC, label) AS place FROM raw_scores),
predicted AS (
  SELECT event_id, max(CASE WHEN place = 1 THEN sentiment END) AS sentiment, 1 / sum(exp(score - best)) AS confidence
  FROM ranked GROUP BY event_id),
scored AS (
  SELECT p.event_id, p.sentiment AS predicted, p.confidence, s.text, s."user", s."timestamp", s.location, s.parsed_time
  FROM predicted p JOIN scoreable s ON s.event_id = p.event_id)"""


# Features


@query(
    f"""SELECT doc_id, CASE WHEN key IS NULL OR {_SPLIT_SQL.replace('doc_id', 'key')} < 80 THEN 'train' ELSE 'test' END AS part
    FROM (SELECT doc_id, CASE WHEN doc_id % 37 <> 0 THEN doc_id END AS key FROM documents)"""
)
def split_into_train_and_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some rows have no key."""
    number = F.col("doc_id")
    keyed = table(spark, sf_dir, "documents").select("doc_id", F.when(number % 37 != 0, number).alias("key"))
    train_rows, test_rows = (part.drop("key") for part in split_by_hash(keyed, "key"))
    return train_rows.withColumn("part", F.lit("train")).unionByName(test_rows.withColumn("part", F.lit("test")))


@query(
    f"""WITH {LABELLED_SQL}
    SELECT sentiment, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, sentiment) - 1 AS DOUBLE) AS label
    FROM labelled GROUP BY sentiment"""
)
def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labelled(spark, sf_dir).select(LABEL_TEXT)
    indexed = fit_label_index(rows).transform(rows)
    return indexed.groupBy(F.col(LABEL_TEXT).alias("sentiment"), LABEL).agg(F.count("*").alias("n"))


@query(
    f"""WITH {_DOCUMENT_WORDS_SQL}
    SELECT doc_id, len(words) AS n, md5(array_to_string(words, ' ')) AS words_md5 FROM tokens"""
)
def documents_tokenised(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = with_clean_text(table(spark, sf_dir, "documents"))
    words = tokenizer().transform(documents)
    return words.select("doc_id", F.size(WORDS).cast("long").alias("n"), F.md5(F.array_join(WORDS, " ")).alias("words_md5"))


@query(
    f"""WITH {_DOCUMENT_WORDS_SQL}, placed AS (
      SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM tokens),
    kept AS (
      SELECT doc_id, count(*) AS n, md5(string_agg(word, ' ' ORDER BY place)) AS words_md5 FROM placed
      WHERE word NOT IN ({STOP_WORDS_SQL}) GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n, coalesce(words_md5, md5('')) AS words_md5
    FROM tokens LEFT JOIN kept USING (doc_id)"""
)
def stop_words_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = kept_words(with_clean_text(table(spark, sf_dir, "documents")))
    return words.select(
        "doc_id", F.size(KEPT_WORDS).cast("long").alias("n"), F.md5(F.array_join(KEPT_WORDS, " ")).alias("words_md5")
    )


@query(f"WITH {LABELLED_SQL}, {_features_sql('labelled')} SELECT term, n FROM vocabulary")
def corpus_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary(kept_words(labelled(spark, sf_dir)))


def _term_rows(spark: SparkSession, terms: list[str], columns: list[str], *values) -> DataFrame:
    """One row per vocabulary term with numbers taken from a fitted stage; the vocabulary bounds it."""
    return spark.createDataFrame(list(zip(terms, *values)), ["term", *columns])


@query(f"WITH {LABELLED_SQL}, {_features_sql('labelled')} SELECT term, df, round(idf, 6) AS idf FROM idf")
def inverse_document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = {type(stage): stage for stage in fit_features(labelled(spark, sf_dir))}
    weights = stages[IDFModel]
    frequency = [int(n) for n in weights.docFreq]
    inverse = weights.idf.toArray().tolist()
    rows = _term_rows(spark, stages[CountVectorizerModel].vocabulary, ["df", "idf"], frequency, inverse)
    return rows.withColumn("idf", F.round("idf", 6))


@query(
    f"""WITH {LABELLED_SQL}, {_features_sql('labelled')}
    SELECT term, CAST(count(*) FILTER (WHERE idf <> 0) AS DOUBLE) AS documents, round(sum(tf * idf), 6) AS total
    FROM tf JOIN idf USING (term) GROUP BY term"""
)
def feature_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column sums of the TF-IDF vectors, taken in one distributed pass over the sparse vectors."""
    rows = labelled(spark, sf_dir)
    stages = fit_features(rows)
    features = apply_stages(rows, stages)
    summary = features.select(Summarizer.metrics("sum", "numNonZeros").summary(F.col(FEATURES)).alias("s"))
    found = summary.select("s.sum", "s.numNonZeros").first()
    terms = next(stage for stage in stages if isinstance(stage, CountVectorizerModel)).vocabulary
    totals, documents = found[0].toArray().tolist(), found[1].toArray().tolist()
    return _term_rows(spark, terms, ["total", "documents"], totals, documents).withColumn("total", F.round("total", 6))


@query(
    f"""WITH {LABELLED_SQL}, {_features_sql('labelled')}
    SELECT doc_id, count(*) AS terms, CAST(sum(tf) AS BIGINT) AS words, round(sum(tf * idf), 6) AS weight
    FROM tf JOIN idf USING (term) GROUP BY doc_id"""
)
def document_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = weighted_terms(kept_words(labelled(spark, sf_dir)), ["doc_id"])
    return weighted.groupBy("doc_id").agg(
        F.count("*").alias("terms"), F.sum("tf").alias("words"), F.round(F.sum("tfidf"), 6).alias("weight")
    )


# Models


@query(
    f"""WITH {BAYES_SQL}
    SELECT sentiment, round(prior, 6) AS prior, term, round(log_likelihood, 6) AS log_likelihood FROM bayes"""
)
def naive_bayes_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priors and likelihoods of the fitted model, one row per label and term."""
    model = fitted(spark, sf_dir)
    stages = {type(stage): stage for stage in model.stages}
    bayes, terms = stages[NaiveBayesModel], stages[CountVectorizerModel].vocabulary
    priors, likelihoods = bayes.pi.toArray().tolist(), bayes.theta.toArray().tolist()
    rows = [
        (label, prior, term, value)
        for label, prior, values in zip(labels_of(model), priors, likelihoods)
        for term, value in zip(terms, values)
    ]
    weights = spark.createDataFrame(rows, "sentiment string, prior double, term string, log_likelihood double")
    return weights.withColumn("prior", F.round("prior", 6)).withColumn(
        "log_likelihood", F.round("log_likelihood", 6)
    )


def _test_terms(spark: SparkSession, sf_dir: str, model: PipelineModel) -> DataFrame:
    """(doc_id, feature, value) of the test part: counts times inverse frequency, without any vector."""
    stages = {type(stage): stage for stage in model.stages}
    terms = stages[CountVectorizerModel].vocabulary
    known = _term_rows(spark, terms, ["feature", "idf"], range(len(terms)), stages[IDFModel].idf.toArray().tolist())
    counts = term_counts(kept_words(training(spark, sf_dir)[1]), ["doc_id"])
    joined = counts.join(F.broadcast(known), "term")
    return joined.select("doc_id", "feature", (F.col("tf") * F.col("idf")).alias("value"))


def _first_largest(scores: DataFrame) -> DataFrame:
    """(doc_id, class) of the largest (doc_id, class, score); of equal ones the first class."""
    best = F.max(F.struct("score", (-F.col("class")).alias("minus")))
    return scores.groupBy("doc_id").agg((-best["minus"]).alias("class"))


def _linear_classes(spark: SparkSession, sf_dir: str, model: PipelineModel) -> DataFrame:
    """(doc_id, class) recomputed from the coefficients of a logistic regression."""
    fit = model.stages[-1]
    weights = [
        (feature, number, float(value))
        for number, row in enumerate(fit.coefficientMatrix.toArray())
        for feature, value in enumerate(row)
        if value
    ]
    weights = F.broadcast(spark.createDataFrame(weights, "feature long, class int, weight double"))
    start = spark.createDataFrame(list(enumerate(fit.interceptVector.toArray().tolist())), "class int, start double")
    sums = _test_terms(spark, sf_dir, model).join(weights, "feature").groupBy("doc_id", "class")
    sums = sums.agg(F.sum(F.col("value") * F.col("weight")).alias("sum"))
    cells = training(spark, sf_dir)[1].select("doc_id", F.explode(F.array(*[F.lit(n) for n in range(fit.numClasses)])).alias("class"))
    scores = cells.join(F.broadcast(start), "class").join(sums, ["doc_id", "class"], "left")
    return _first_largest(scores.select("doc_id", "class", (F.col("start") + F.coalesce("sum", F.lit(0.0))).alias("score")))


def _tree_classes(spark: SparkSession, sf_dir: str, model: PipelineModel) -> DataFrame:
    """(doc_id, class) recomputed from the saved rules of a decision tree or forest, level by level."""
    path = shared_folder(spark, "trees")
    fit = model.stages[-1]
    fit.save(path)
    nodes = spark.read.parquet(f"{path}/data")
    nodes = nodes.select("treeID", "nodeData.*") if "nodeData" in nodes.columns else nodes.withColumn("treeID", F.col("id") * 0)
    limit = F.when(F.col("leftChild") >= 0, F.col("split.leftCategoriesOrThreshold")[0])
    nodes = nodes.select(
        "treeID", F.col("id").alias("at"), "leftChild", "rightChild", F.col("split.featureIndex").alias("feature"),
        limit.alias("limit"), "impurityStats",
    )
    values = _test_terms(spark, sf_dir, model).groupBy("doc_id")
    values = values.agg(F.map_from_entries(F.collect_list(F.struct(F.col("feature").cast("int"), "value"))).alias("x"))
    rows = training(spark, sf_dir)[1].select("doc_id").join(values, "doc_id", "left")
    # Not constants, which would turn the first look-up into a join without keys.
    last = F.when(F.col("doc_id").isNotNull(), getattr(fit, "getNumTrees", 1) - 1)
    place = rows.select("doc_id", "x", F.explode(F.sequence(F.lit(0), last)).alias("treeID"))
    place = place.withColumn("at", F.col("treeID") * 0)
    for _ in range(fit.getMaxDepth()):
        inner = F.broadcast(nodes.filter("leftChild >= 0").drop("impurityStats"))
        value = F.coalesce(F.col("x")[F.col("feature")], F.lit(0.0))
        after = F.when(F.col("leftChild").isNull(), F.col("at")).when(value <= F.col("limit"), F.col("leftChild"))
        place = place.join(inner, ["treeID", "at"], "left").select("doc_id", "x", "treeID", after.otherwise(F.col("rightChild")).alias("at"))
    leaves = place.join(F.broadcast(nodes.select("treeID", "at", "impurityStats")), ["treeID", "at"])
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b)
    votes = leaves.select("doc_id", total.alias("total"), F.posexplode("impurityStats").alias("class", "n"))
    return _first_largest(votes.groupBy("doc_id", "class").agg(F.sum(F.col("n") / F.col("total")).alias("score")))


def _checked_predictions(spark: SparkSession, sf_dir: str, name: str, classes: Callable) -> DataFrame:
    """Test documents with their label, whether the model's class is the recomputed one, and whether the model has
    learned: it is right on its training part at least as often as the most frequent label is."""
    model = fitted(spark, sf_dir, name)
    train_rows, test_rows = training(spark, sf_dir)
    right = predict(train_rows, model).agg(
        F.count_if(F.col("prediction") == F.col(LABEL)).alias("right"), F.count_if(F.col(LABEL) == 0).alias("most")
    )
    learned = right.select(F.col("right") >= F.col("most")).scalar()
    scored = predict(test_rows, model).select("doc_id", F.col(LABEL_TEXT).alias("expected"), "prediction")
    joined = scored.join(classes(spark, sf_dir, model), "doc_id", "left")
    same = F.coalesce(F.col("prediction") == F.col("class"), F.lit(False))
    return joined.select("doc_id", "expected", same.alias("same_class"), learned.alias("learned"))


_CHECKED_SQL = f"""WITH {LABELLED_SQL} SELECT doc_id, sentiment AS expected, true AS same_class, true AS learned
    FROM labelled WHERE {_SPLIT_SQL} >= 80"""


@query(_CHECKED_SQL)
def logistic_regression_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_predictions(spark, sf_dir, "Logistic_Regression", _linear_classes)


@query(_CHECKED_SQL)
def random_forest_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_predictions(spark, sf_dir, "Random_Forest", _tree_classes)


@query(_CHECKED_SQL)
def decision_tree_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_predictions(spark, sf_dir, "Decision_Tree", _tree_classes)


class _NoWriter(Transformer):
    """A fitted model that cannot be saved."""

    def __init__(self, fitted_model: Transformer):
        super().__init__()
        self.fitted_model = fitted_model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted_model.transform(dataset)


class _Unsaveable(Estimator):
    def _fit(self, dataset: DataFrame) -> Transformer:
        return _NoWriter(NaiveBayes().fit(dataset))


_COMPARED = {"Logistic_Regression": True, "Random_Forest": True, "Naive_Bayes": True, "Decision_Tree": True}


@query(
    f"""WITH {LABELLED_SQL}, test AS (SELECT count(*) AS n FROM labelled WHERE {_SPLIT_SQL} >= 80)
    SELECT model, judged, saved, judged AS recall_is_accuracy, judged AS as_evaluated, CASE WHEN judged THEN n ELSE 0 END AS judged_rows,
      CASE WHEN judged THEN least(n, 5) ELSE 0 END AS samples
    FROM test, (VALUES {', '.join(f"('{name}', true, true)" for name in _COMPARED)},
      ('Not_Fitting', false, false), ('Not_Saveable', true, false)) m(model, judged, saved)"""
)
def models_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four classifiers, one that cannot be fitted and one that cannot be saved, judged and checked.

    The metrics are held against Spark's evaluator; each model's confusion matrix covers all test rows.
    """
    seen: dict[str, tuple] = {}

    def inspect(name: str, predicted: DataFrame) -> None:
        measures = ("accuracy", "f1", "weightedPrecision", "weightedRecall")
        found = [MulticlassClassificationEvaluator(labelCol=LABEL, metricName=m).evaluate(predicted) for m in measures]
        judged = confusion_matrix(predicted).agg(F.sum("n")).first()[0]
        seen[name] = (*found, judged, preview(predicted, ["Comment", "prediction"], "doc_id").count())

    # Features of this kind are not 0 and 1, which the Bernoulli model refuses.
    candidates = classifiers() | {"Not_Fitting": NaiveBayes(modelType="bernoulli"), "Not_Saveable": _Unsaveable()}
    metrics = compare_models(
        *training(spark, sf_dir), candidates, save_to=shared_folder(spark, "compared"), parallelism=4, inspect=inspect
    )
    schema = "model string, e_accuracy double, e_f1 double, e_precision double, e_recall double, judged_rows long, samples long"
    joined = metrics.join(spark.createDataFrame([(name, *row) for name, row in seen.items()], schema), "model", "left")
    close = [
        F.abs(F.col(ours) - F.col(theirs)) < 1e-9
        for ours, theirs in (("accuracy", "e_accuracy"), ("f1_score", "e_f1"), ("precision", "e_precision"), ("recall", "e_recall"))
    ]
    judged = F.col("judged_rows").isNotNull()
    return joined.select(
        "model",
        judged.alias("judged"),
        F.col("error").isNull().alias("saved"),
        (judged & (F.abs(F.col("recall") - F.col("accuracy")) < 1e-9)).alias("recall_is_accuracy"),
        F.coalesce(close[0] & close[1] & close[2] & close[3], F.lit(False)).alias("as_evaluated"),
        F.coalesce("judged_rows", F.lit(0)).alias("judged_rows"),
        F.coalesce("samples", F.lit(0)).alias("samples"),
    )


@query(f"WITH {BAYES_SQL} SELECT CAST(label AS BIGINT) AS label, sentiment FROM classes")
def labels_in_index_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = labels_of(fitted(spark, sf_dir))
    return spark.createDataFrame(list(enumerate(labels)), "label long, sentiment string")


@query(f"WITH {LABELLED_SQL} SELECT count(*) AS n, 0::BIGINT AS changed FROM labelled WHERE {_SPLIT_SQL} >= 80")
def predictions_after_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of the test part before saving and after loading, compared row by row."""
    path = shared_folder(spark, "model")
    model = fitted(spark, sf_dir)
    save_model(model, path)
    again = load_model(path)
    before = predict(training(spark, sf_dir)[1], model)
    rows = predict(before.select("doc_id", TEXT, LABEL_TEXT, F.col("prediction").alias("before")), again)
    return rows.agg(F.count("*").alias("n"), F.count_if(F.col("before") != F.col("prediction")).alias("changed"))


_TEST_SQL = f"""{BAYES_SQL}, test AS (SELECT * FROM labelled WHERE {_SPLIT_SQL} >= 80),
test_terms AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_words_sql('clean')}) AS term FROM test) GROUP BY ALL),
test_sums AS (
  SELECT x.doc_id, b.label, sum(x.tf * b.idf * b.log_likelihood) AS score
  FROM test_terms x JOIN bayes b ON b.term = x.term GROUP BY ALL),
test_ranked AS (
  SELECT t.doc_id, c.label, row_number() OVER (
    PARTITION BY t.doc_id ORDER BY c.prior + coalesce(s.score, 0) DESC, c.label) AS place
  FROM test t JOIN classes c ON true LEFT JOIN test_sums s ON s.doc_id = t.doc_id AND s.label = c.label),
cells AS (
  SELECT c.label, r.label AS prediction, count(*) AS n FROM test t JOIN classes c ON c.sentiment = t.sentiment
  JOIN test_ranked r ON r.doc_id = t.doc_id AND r.place = 1 GROUP BY ALL)"""


@query(
    f"""WITH {_TEST_SQL}
    SELECT CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction, n FROM cells"""
)
def naive_bayes_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_matrix(predict(training(spark, sf_dir)[1], fitted(spark, sf_dir)))


@query(
    f"""WITH {_TEST_SQL}, sides AS (
      SELECT c.label AS class, coalesce((SELECT sum(n) FROM cells x WHERE x.label = c.label), 0) AS support,
        coalesce((SELECT sum(n) FROM cells x WHERE x.prediction = c.label), 0) AS predicted,
        coalesce((SELECT sum(n) FROM cells x WHERE x.label = c.label AND x.prediction = c.label), 0) AS hits
      FROM classes c),
    rates AS (
      SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS pr,
        CASE WHEN support = 0 THEN 0 ELSE hits / support END AS re FROM sides)
    SELECT round(sum(hits) / sum(support), 6) AS accuracy, round(sum(support * pr) / sum(support), 6) AS precision,
      round(sum(support * re) / sum(support), 6) AS recall,
      round(sum(support * CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END) / sum(support), 6) AS f1_score
    FROM rates"""
)
def naive_bayes_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = classification_metrics(predict(training(spark, sf_dir)[1], fitted(spark, sf_dir)))
    return scores.select(*[F.round(score, 6).alias(score) for score in scores.columns])


# Scoring


@query(
    f"""WITH {SCORED_SQL}
    SELECT md5("user" || chr(1) || "timestamp" || chr(1) || text) AS id, location AS source, predicted AS sentiment,
      round(confidence, 6) AS confidence, '2024-02-01 00:00:00' AS predicted_at FROM scored"""
)
def messages_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain: raw values decoded, routed, cleaned, classified and labelled."""
    results, _ = results_of(raw_values(messages(spark, sf_dir)), fitted(spark, sf_dir), at())
    predicted_at = F.date_format("predicted_at", "yyyy-MM-dd HH:mm:ss").alias("predicted_at")
    return results.select("id", "source", "sentiment", F.round("confidence", 6).alias("confidence"), predicted_at)


@query(
    f"""WITH {SCORED_SQL}
    SELECT md5("user" || chr(1) || "timestamp" || chr(1) || text) AS id,
      CASE WHEN length(text) < 5 THEN 'neutral' ELSE predicted END AS sentiment,
      CASE WHEN length(text) >= 5 THEN round(confidence, 6) END AS confidence, false AS model_failed FROM scored"""
)
def messages_scored_by_plugin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same model as a plugged-in Python scorer behind the text guards."""
    valid, _ = route(decode_messages(raw_values(messages(spark, sf_dir))), at())
    results = with_document_id(scored_by_plugin(valid, fitted(spark, sf_dir)))
    return results.select("id", "sentiment", F.round("confidence", 6).alias("confidence"), "model_failed")


def scored_by_plugin(valid: DataFrame, model: PipelineModel) -> DataFrame:
    """RESULT rows of valid messages by the numpy twin of a fitted naive Bayes pipeline."""
    labels = dict(enumerate(labels_of(model)))
    scorer = score_udf(naive_bayes_scorer(model), len(labels))
    return udf_results(score_with_udf(kept_words(with_clean_text(valid)), scorer, joined_words(), labels), at())
