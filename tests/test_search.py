import math
import re
from collections import Counter

import pytest
from conftest import values

from chatterlens.operators import search as s

DOCS = [
    (1, "The cat sat on the mat"),
    (2, "the dog sat; the dog ran"),
    (3, "Cats and dogs"),
    (4, None),
    (5, " 123 "),
    (6, "cat " * 40 + "end"),
    (7, "a cat"),
    (8, "a cat"),
]


def brute(docs, query, n):
    words = {key: re.sub(r"[^a-z\s]", "", (text or "").lower()).split() for key, text in docs}
    words = {key: found for key, found in words.items() if found}
    usual = sum(map(len, words.values())) / len(words)
    df = Counter(term for found in words.values() for term in set(found))
    scores = {}
    for term, weight in Counter(re.sub(r"[^a-z\s]", "", query.lower()).split()).items():
        idf = math.log(1 + (len(words) - df[term] + 0.5) / (df[term] + 0.5))
        for key, found in words.items():
            if tf := found.count(term):
                norm = s.SATURATION * (1 - s.LENGTH_SHARE + s.LENGTH_SHARE * len(found) / usual)
                scores[key] = scores.get(key, 0) + weight * idf * tf / (tf + norm)
    best = sorted(scores, key=lambda key: (-round(scores[key], 6), key))[:n]
    return [(rank, key, round(scores[key], 6)) for rank, key in enumerate(best, 1)]


@pytest.fixture
def index(rows, tmp_path):
    path = str(tmp_path / "index")
    s.write_segment(rows(DOCS[:5], "id long, text string"), path, "one")
    s.write_segment(rows(DOCS[5:], "id long, text string"), path, "two", blocks=3)
    return path


def test_scores_equal_brute_force(spark, index):
    queries = ["cat", "the dog", "Cat cat the!", "nothing here", "", "123", "mat end cats"]
    found = s.search(spark, index, queries, n=3).collect()
    for number, query in enumerate(queries):
        got = sorted((r["rank"], r.id, r.score) for r in found if r["query"] == number)
        assert got == brute(DOCS, query, 3)


def test_a_segment_written_again_adds_nothing(spark, rows, index):
    before = values(s.search(spark, index, ["cat dog"]))
    s.write_segment(rows(DOCS[:5], "id long, text string"), index, "one")
    assert values(s.search(spark, index, ["cat dog"])) == before


def test_a_search_reads_only_the_folders_of_its_words(spark, index):
    (term,) = s.query_terms(spark, ["mat"]).collect()
    touched = s.touched_rows(spark, index, [term.term], [term.folder])
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[.*folder#\d+ = {term.folder}\b", plan) and "PushedFilters: [IsNotNull(term), EqualTo(term,mat)]" in plan
    everything = spark.read.parquet(index)
    read = {re.search(r"folder=(\d+)", path)[1] for path in everything.filter(f"folder = {term.folder}").inputFiles()}
    assert len({row.folder for row in everything.select("folder").distinct().collect()}) > 5
    assert [row.df for row in touched.selectExpr("n as df").collect()] == [1] and len(read) >= 1


def test_postings_of_a_frequent_word_lie_in_many_blocks(spark, rows, tmp_path):
    docs = spark.range(5000).selectExpr("id", "concat('same w', id) text")
    s.write_segment(docs, str(tmp_path / "i"), "x", blocks=50)
    held = spark.read.parquet(str(tmp_path / "i")).filter("term = 'same'").select("n").collect()
    assert len(held) == 50 and max(row.n for row in held) < 200 and sum(row.n for row in held) == 5000


def test_an_empty_index(spark, rows, tmp_path):
    s.write_segment(rows([], "id long, text string"), str(tmp_path / "i"), "none", blocks=1)
    s.write_segment(rows([(1, "one")], "id long, text string"), str(tmp_path / "i"), "one", blocks=1)
    assert s.search(spark, str(tmp_path / "i"), ["one"]).count() == 1 and s.search(spark, str(tmp_path / "i"), ["two"]).count() == 0


def test_the_number_of_tasks_grows_with_the_blocks(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(s, "BLOCK", 2)
    seen = []
    partitioned = type(rows([], "id long")).repartition

    def repartition(df, number, *keys):
        seen.append((number, keys))
        return partitioned(df, number, *keys)

    monkeypatch.setattr(type(rows([], "id long")), "repartition", repartition)
    s.write_segment(rows(DOCS, "id long, text string"), str(tmp_path / "index"), "one")
    assert seen == [(4 * s.TASKS, ("term", "block"))]
    found = s.search(spark, str(tmp_path / "index"), ["cat dog the"]).collect()
    assert sorted((r["rank"], r.id, r.score) for r in found) == brute(DOCS, "cat dog the", 10)


def test_rows_of_one_document_add_up(spark, rows, tmp_path):
    docs = [(1, "cat dog cat"), (1, "cat dog cat"), (2, "dog"), (None, "cat end"), (None, "cat end"), (3, None)]
    s.write_segment(rows(docs, "id long, text string"), str(tmp_path / "index"), "one")
    index = spark.read.parquet(str(tmp_path / "index")).selectExpr("term", "n", "explode_outer(postings) p").select("term", "n", "p.*")
    found = {(r.term, r.id): (r.n, r.length, r.tf) for r in index.filter("term <> ''").collect()}
    assert found == {("cat", 1): (2, 3, 4), ("dog", 1): (2, 3, 2), ("dog", 2): (2, 1, 1), ("cat", None): (2, 2, 2), ("end", None): (1, 2, 2)}
