import numpy as np
import pytest
from pyspark.sql import functions as F

from chatterlens.llm import language_filters as lang
from chatterlens.llm import permutation_index as index
from chatterlens.llm.catalogue import QUERIES

TABLES = "/root/testdata/sf0.01"


def found_by(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.id, r.score))
    return got


def brute(vectors, queries, nearest):
    out = {}
    for q in queries:
        for own in [v for i, v in vectors if i == q]:
            scored = sorted({(-float(np.dot(own, v)), i) for i, v in vectors if i != q})
            out[q] = [i for _, i in scored[:nearest]]
    return out


def test_recall_and_scores(spark):
    rows = spark.read.parquet(f"{TABLES}/embeddings.parquet").collect()
    vectors = [(r.vec_id, np.array(r.embedding, float)) for r in rows]
    got = found_by(QUERIES["op2_nearest_vectors"](spark, TABLES).withColumnRenamed("vec_id", "id"))
    expected = brute(vectors, [i for i, _ in vectors if i % 20 == 0], 20)
    by_id = dict(vectors)
    assert set(got) == set(expected)
    assert np.mean([len({i for i, _ in got[q]} & set(expected[q])) / 20 for q in expected]) >= 0.9
    assert all(abs(s - np.dot(by_id[q], by_id[i])) < 1e-9 for q in got for i, s in got[q])


def test_recall_where_vectors_are_many_and_of_any_norm(rows):
    rng = np.random.default_rng(5)
    vectors = [(i, rng.normal(size=24) * rng.uniform(0.5, 2)) for i in range(3000)]
    df = rows([(i, [float(x) for x in v]) for i, v in vectors], "vec_id long, embedding array<double>")
    queries = list(range(0, 3000, 60))
    got = found_by(index.nearest_vectors(df, F.col("vec_id") % 60 == 0))
    expected = brute(vectors, queries, 20)
    assert np.mean([len({i for i, _ in got[q]} & set(expected[q])) / 20 for q in queries]) >= 0.9


def test_edge_vectors(rows):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0])]
    data += [(6, [1.0, 0.0, 0.0]), (None, [1.0, 0.0])] + [(i, [0.6, 0.8]) for i in range(60, 20, -1)] + [(7, [2.0, 1.0]), (20, [0.6, 0.8])]
    df = rows([(i, v, "x", 1) for i, v in data], "vec_id long, embedding array<double>, score string, rank int")
    got = found_by(index.nearest_vectors(df, F.col("vec_id") % 20 == 0, nearest=5))
    assert [i for i, _ in got[0]] == [7, 20, 21, 22, 23]
    assert [i for i, _ in got[20]] == [7, 21, 22, 23, 24]
    assert [i for i, _ in got[40]] == [7, 20, 21, 22, 23]
    assert set(got) == {0, 20, 40, 60}
    assert index.nearest_vectors(df.limit(0), F.lit(True)).count() == 0
    assert index.nearest_vectors(df.where("vec_id = 7"), F.lit(True)).count() == 0


def test_held_out_languages(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}
    found = [r for r in QUERIES["op3_languages"](spark, TABLES).collect() if r.held_out]
    assert len(found) > 200 and np.mean([docs[r.doc_id] == r.lang_pred for r in found]) >= 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_edge_languages(rows):
    train = [(i, t, l) for i in range(30) for t, l in (("the cat sat on the mat " * 3, "aa"), ("größe über straße und " * 3, "bb"))]
    train += [(99, None, "aa"), (98, "no label here", None), (97, "", "cc")]
    docs = rows(train, "doc_id long, text string, lang string")
    filters = lang.learn(docs, F.lit(True), "doc_id", "text", "lang")
    texts = [("the mat", "aa"), ("ÜBER Größe", "bb"), (None, "und"), ("", "und"), ("123 -- !?", "und"), ("漢字", "aa"), ("the cat " * 40_000, "aa")]
    asked = rows([(t, "old", 1) for t, _ in texts * 2], "text string, lang_pred string, other int")
    out = lang.identify(asked, filters)
    assert out.columns == ["text", "other", "lang_pred", "score"]
    assert sorted((repr(r.text), r.lang_pred) for r in out.collect()) == sorted((repr(t), w) for t, w in texts * 2)
    assert lang.identify(asked.limit(0), filters).count() == 0
    nothing = lang.learn(docs.limit(0), F.lit(True), "doc_id", "text", "lang")
    assert {r.lang_pred for r in lang.identify(asked, nothing).collect()} == {"und"}


@pytest.mark.parametrize("languages", [3, 20])
def test_filters_give_every_language_of_an_n_gram(languages):
    rng = np.random.default_rng(languages)
    grams = [rng.integers(1, 1 << 63, 500, dtype=np.uint64) for _ in range(languages)]
    shared = grams[0][:50]
    grams[-1] = np.concatenate([grams[-1], shared])
    filters = lang.Filters.of([f"l{i}" for i in range(languages)], grams)
    for i, own in enumerate(grams):
        hits = filters.hits(own, np.zeros(len(own), np.int64), 1)[0]
        assert hits[i] == len(own)
    assert filters.hits(shared, np.zeros(50, np.int64), 1)[0][[0, -1]].tolist() == [50, 50]
    other = rng.integers(1, 1 << 63, 20_000, dtype=np.uint64)
    false = filters.hits(other, np.zeros(len(other), np.int64), 1)[0]
    assert (abs(false - len(other) * filters.chance()) <= 20).all()
