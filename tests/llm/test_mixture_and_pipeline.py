import hashlib
import math
import random

import pytest
from conftest import values

import corpus_pipeline
from chatterlens.llm import mixing


def brute(docs, max_repeats):
    """The mixture in plain Python: (id, source, epoch, begins)."""
    md5 = lambda *parts: hashlib.md5("|".join(str(p) for p in parts if p is not None).encode()).hexdigest()
    sized = [(i, s, md5(i, hashlib.md5(t.encode()).hexdigest()), len(t.split())) for i, t, s in docs if t and t.split()]
    totals = {}
    for _, s, _, n in sized:
        totals[s] = totals.get(s, 0) + n
    sums = sorted(totals.items(), key=lambda p: (p[0] is None, p[0] or ""))
    budget = sum(totals.values())
    weights = mixing.tempered(sums, mixing.power_for(sums, budget, max_repeats))
    out = []
    for (source, total), weight in zip(sums, weights):
        target, begins = math.floor(budget * weight), 0
        rows = [r for r in sized if r[1] == source]
        blocks = -(-len(rows) // mixing.BLOCK_ROWS)
        for epoch in range(-(-target // total)):
            block = lambda r: int(r[2][:8], 16) % blocks  # noqa: B023, E731
            order = sorted(rows, key=lambda r: (md5(0, epoch, source, block(r)), block(r), md5(0, epoch, r[2])))  # noqa: B023
            for i, _, _, n in order:
                if begins + n <= target:
                    out.append((i, source, epoch, begins))
                begins += n
    return out


def documents(seed=2):
    rng = random.Random(seed)
    sizes = {"big": 120, "mid": 40, "small": 15, None: 8}
    texts = [(" ".join(["w"] * rng.randrange(1, 60)), s) for s, n in sizes.items() for _ in range(n)]
    return [(i, t, s) for i, (t, s) in enumerate(texts)]


@pytest.mark.parametrize("repeats, block_rows", [(1.0, 4096), (1.7, 4096), (3.0, 7), (1.25, 1)])
def test_mixture_equals_brute_force(rows, monkeypatch, repeats, block_rows):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", block_rows)
    docs = documents()
    found = mixing.mixture(rows(docs, "doc_id long, text string, source string"), max_repeats=repeats)
    got = [(r.id, r.source, r.epoch, r.begins) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(brute(docs, repeats), key=repr)


def test_powers_meet_their_target():
    totals = [("a", 10_000), ("b", 3000), ("c", 200)]
    weights = mixing.tempered(totals, mixing.power_for(totals, 13_200, max_repeats=4.0))
    assert mixing.most_repeats(totals, weights, 13_200) == pytest.approx(4.0)
    weights = mixing.tempered(totals, mixing.power_for(totals, 13_200, target_entropy=0.9))
    assert mixing.entropy(weights) == pytest.approx(0.9)
    for wanted in (0.2, 0.01, 1.0):
        power = mixing.power_for(totals, 13_200, target_entropy=wanted, max_repeats=1000)
        assert mixing.entropy(mixing.tempered(totals, power)) == pytest.approx(wanted)
    assert mixing.power_for(totals, 13_200, target_entropy=0.2) > 1
    assert mixing.power_for(totals, 600, max_repeats=4.0) == 0.0
    assert mixing.power_for(totals, 13_200, max_repeats=1.0) == pytest.approx(1.0)
    with pytest.raises(ValueError):
        mixing.power_for(totals, 14_000, max_repeats=1.0)


def test_edge_documents_are_mixed(rows):
    data = [(1, None, "a"), (2, "", "a"), (3, " \n", "b"), (4, "x", "c"), (4, "x", "c"), (None, "y z", None), (5, "w " * 50_000, "c")]
    docs = rows([(i, t, s, 1, "e") for i, t, s in data], "doc_id long, text string, source string, tokens int, epoch string")
    found = mixing.mixture(docs, max_repeats=2.0)
    assert found.columns == ["id", "source", "epoch", "block", "begins", "tokens", "target"]
    assert {r.source for r in found.collect()} <= {"c", None}
    assert values(mixing.mixture(docs, max_repeats=1.0, budget=50_004).where("id = 4"), "tokens") == [1, 1]
    assert mixing.mixture(docs.limit(0), max_repeats=2.0).count() == 0
    with pytest.raises(ValueError):
        mixing.mixture(docs)


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage of the pipeline reads, and at last what it gives, on the smallest tables."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    results = [docs]
    for _, stage in corpus_pipeline.STAGES:
        results.append(corpus_pipeline.stored(stage(spark, results[-1], folder), "test-stage"))
    return results


def test_stages_keep_the_columns_of_documents(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier",
        "MinHash near-dedup",
        "substring dedup",
        "benchmark decontamination",
        "mixing sources to target weights",
    ]
    for result in stages[1:-1]:
        assert result.schema.fieldNames() == stages[0].schema.fieldNames()
    counts = [result.count() for result in stages[:-1]]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.6 * counts[0]


def test_near_duplicates_are_gone(stages):
    def sets(df):
        words = {r.doc_id: r.text.translate({c: c + 32 for c in range(65, 91)}).split() for r in df.collect()}
        return {i: frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for i, w in words.items()}

    before, after = sets(stages[1]), sets(stages[2])
    assert set(after) < set(before)
    near = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    for i in after:
        assert not any(j != i and near(after[i], after[j]) for j in after)
    for i in set(before) - set(after):
        assert any(j != i and near(before[i], before[j]) for j in before)


def test_passages_and_benchmark_windows_are_gone(stages, spark):
    words = lambda text: [w for w in text.lower().split()]
    windows = lambda w, n: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
    seen = {}
    for r in stages[3].collect():
        for window in windows(words(r.text), 50):
            assert seen.setdefault(window, r.doc_id) == r.doc_id
    from chatterlens.llm.decontaminate import scan

    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert scan(stages[3], items).where("size(hit_spans) > 0").count() > 0
    assert scan(stages[4], items).where("size(hit_spans) > 0").count() == 0


def test_mixture_uses_what_was_kept(stages):
    kept = set(values(stages[4], "doc_id"))
    used = values(stages[5], "doc_id")
    assert set(used) <= kept and len(set(used)) > 0.8 * len(kept)


def test_targets_that_cannot_be_met_are_errors():
    totals = [("a", 10_000), ("b", 10_000), ("c", 5)]
    with pytest.raises(ValueError, match="it can be 0.693147 to 1.098612"):
        mixing.power_for(totals, 20_005, target_entropy=0.5)
    with pytest.raises(ValueError, match="no power"):
        mixing.power_for(totals, 20_005, target_entropy=1.2)
    with pytest.raises(ValueError, match="16.0 repeats"):
        mixing.power_for(totals, 20_005, target_entropy=1.09)
    assert mixing.power_for(totals, 20_005, target_entropy=1.09, max_repeats=2000) > 0


def test_mixture_of_a_wanted_entropy(rows):
    docs = rows(documents(), "doc_id long, text string, source string")
    held = {}
    for r in mixing.mixture(docs, target_entropy=1.2).collect():
        held[r.source] = held.get(r.source, 0) + r.tokens
    shares = [n / sum(held.values()) for n in held.values()]
    assert mixing.entropy(shares) == pytest.approx(1.2, abs=0.05)
    with pytest.raises(ValueError):
        mixing.mixture(docs)
