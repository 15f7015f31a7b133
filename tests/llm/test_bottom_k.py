import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from chatterlens.llm import bottom_k as b
from chatterlens.llm import steps
from chatterlens.llm.steps import connected_components, stored


def shingles(text, n):
    w = [x for x in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ").replace("\n", " ").split(" ") if x]
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(docs, n, percent):
    """Smallest id reachable over similar sets, for documents with distinct ids."""
    sets = {i: shingles(t, n) for i, t in docs}
    label = {i: i for i in sets}
    links = [
        (i, j)
        for i in sets
        for j in sets
        if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            if label[i] != low or label[j] != low:
                label[i] = label[j] = low
                changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def near_copies(seed, groups=4, copies=30):
    """Groups of copies with few or many edits, copies of copies, and a passage that most texts share."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage, texts = [word() for _ in range(25)], []
    for _ in range(groups):
        family = [[word() for _ in range(rng.choice((12, 60, 150)))]]
        for _ in range(copies):
            copy = list(rng.choice(family[:1] + family[-3:]))
            for _ in range(rng.randrange(0, max(2, len(copy) // 9))):
                copy[rng.randrange(len(copy))] = word()
            family.append(copy)
        texts += family
    texts += [passage + [word() for _ in range(rng.randrange(3, 80))] for _ in range(60)]
    rng.shuffle(texts)
    return [(i, " ".join(words)) for i, words in enumerate(texts)]


@pytest.mark.parametrize("paired, percent, n", [(32, 85, 3), (4, 85, 3), (3, 80, 5)])
def test_components_equal_brute_force(rows, monkeypatch, paired, percent, n):
    monkeypatch.setattr(b, "PAIRED", paired)
    docs = near_copies(percent + paired)
    found = b.near_duplicates(rows(docs, "doc_id long, text string"), length=n, percent=percent)
    assert {r.id: (r.n_shingles, r.component_id) for r in found.collect()} == brute(docs, n, percent)


EDGE = [
    (5, None),
    (6, ""),
    (7, " \n\t "),
    (8, "One"),
    (9, "one"),
    (10, "one two three four"),
    (10, "one two three four"),
    (None, "one two three  four"),
    (11, "x " * 30_000 + "end of a very long text"),
]


def test_edge_cases(rows):
    docs = rows([(i, t, "a", "b") for i, t in EDGE], "doc_id long, text string, node string, component string")
    found = sorted(((r.id, r.n_shingles, r.component_id) for r in b.near_duplicates(docs, length=3, percent=85).collect()), key=repr)
    expected = [(5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 1, 8), (9, 1, 8), (10, 2, 10), (10, 2, 10), (None, 2, 10), (11, 7, 11)]
    assert found == sorted(expected, key=repr)
    assert b.near_duplicates(docs.limit(0)).count() == 0
    kept = b.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(values(kept, "doc_id")) == [5, 6, 7, 8, 10, 11]


def test_one_document_of_each_group_is_kept(rows):
    docs = near_copies(1)
    kept = {r.doc_id for r in b.keep_one(rows(docs, "doc_id long, text string"), length=5, percent=80).collect()}
    assert kept == {label for _, label in brute(docs, 5, 80).values()}


def test_sketches_miss_almost_nothing():
    for k, percent in ((32, 85), (32, 80), (64, 50)):
        assert 1 <= b.least_shared(k, percent) < k * percent / 100


def test_components(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(300).select(F.lit(1000).alias("a"), (F.col("id") + 1000).alias("b"))
    found = connected_components(chain.union(star).union(chain))
    assert {(r.component, r["count"]) for r in found.groupBy("component").count().collect()} == {(0, 301), (1000, 300)}
    assert connected_components(chain.limit(0)).count() == 0


@pytest.mark.parametrize("links", [[(2, 1), (3, 1), (5, 4), (4, 5), (4, 4)], []])
def test_stars_take_no_round(rows, monkeypatch, links):
    """Each round is several shuffles, which the driver plans, compiles and remembers."""
    written = []
    monkeypatch.setattr(steps, "stored", lambda df, purpose: written.append(purpose) or stored(df, purpose))
    found = connected_components(rows(links, "a long, b long"))
    assert len(written) == 1
    assert {r.node: r.component for r in found.collect()} == ({1: 1, 2: 1, 3: 1, 4: 4, 5: 4} if links else {})


def test_components_go_on_from_known_ones(rows):
    rng = random.Random(5)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)]
    old, new = (rows(part, "a long, b long") for part in (pairs[:35], pairs[35:]))
    whole = connected_components(old.union(new)).collect()
    assert len({r.node for r in whole}) == len(whole)
    assert sorted(connected_components(new, connected_components(old)).collect()) == sorted(whole)
