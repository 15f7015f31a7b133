import hashlib
import random
import zlib

import numpy as np
from conftest import values

from chatterlens.llm import periodic_runs as p
from chatterlens.llm.catalogue import QUERIES, with_planted_runs

TABLES = "/root/testdata/sf0.001"


def brute(words):
    """Runs by comparing all words with those each period further on."""
    found, seen = [], set()
    for q in range(1, len(words) // p.TIMES + 1):
        i = 0
        while i + q < len(words):
            end = i
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end + q - i >= max(p.LEAST, p.TIMES * q) and end > i and (i, end + q) not in seen:
                seen.add((i, end + q))
                found.append((i, end + q - i, q))
            i = end + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def text(rng):
    words = []
    for _ in range(rng.randrange(6)):
        base = [f"w{rng.randrange(rng.choice((1, 2, 3, 5, 50)))}" for _ in range(rng.choice((1, 2, 3, 7, 8, 9, 11, 15, 16, 17, 33, 40)))]
        size = rng.randrange(130)
        words += (base * (size // len(base) + 1))[:size]
        words += [f"w{rng.randrange(3)}" for _ in range(rng.choice((0, 1, 30)))]
    return " ".join(words)


def test_convolutions_are_exact():
    rng = np.random.default_rng(0)
    for size in (16, 32, 128, 256, 4096):
        a, b = (rng.integers(0, 10, (2, size)).astype(float) for _ in range(2))
        expected = [[(a[r] * np.roll(b[r], -d)).sum() % p.MODULUS for d in range(size)] for r in range(2)]
        assert (p.back(p._reduced(p.transform(b) * p.transform(a, inverse=True))) == np.array(expected)).all()


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        texts = [text(rng) for _ in range(rng.randrange(1, 6))]
        for one, (n, runs, rest) in zip(texts, p._found(texts)):
            words = one.split()
            assert n == len(words) and runs == brute(words) and rest.decode() == collapsed(words, runs)


def test_periods_longer_than_a_block():
    for period in (p.LONGEST - 1, p.LONGEST, 2 * p.LONGEST, 5 * p.LONGEST + 3):
        words = [f"w{i}" for i in range(5)] + [f"x{i % period}" for i in range(3 * period)] + ["end"]
        assert [runs for _, runs, _ in p._found([" ".join(words)])] == [[(5, 3 * period, period)]]
        del words[-2:]
        assert [runs for _, runs, _ in p._found([" ".join(words)])] == [[]]


def test_edge_cases(rows):
    data = [
        (1, None, 1), (2, "", 1), (3, " \t\n", 1), (None, "a b " * 12, 1), (4, "a " * 23, 1), (5, "a " * 24, 1),
        (5, "a " * 24, 1), (6, "same " * 50_000, 1), (7, "A a " * 20, 1), (8, "é é " * 30, 1), (9, "x\0 " * 30, 1),
    ]
    docs = rows(data, "doc_id long, text string, runs int")
    found = p.periodic_runs(docs)
    assert found.columns == ["id", "n_words", "runs", "collapsed"]
    got = {(r.id, r.n_words): ([tuple(run) for run in r.runs], r.collapsed) for r in found.collect()}
    assert got == {
        (1, 0): ([], ""), (2, 0): ([], ""), (3, 0): ([], ""), (None, 24): ([(0, 24, 2)], "a b"),
        (4, 23): ([], " ".join("a" * 23)), (5, 24): ([(0, 24, 1)], "a"), (6, 50_000): ([(0, 50_000, 1)], "same"),
        (7, 40): ([(0, 40, 2)], "A a"), (8, 30): ([(0, 30, 1)], "é é"), (9, 30): ([(0, 30, 1)], "x\0"),
    }
    assert found.count() == len(data) and p.periodic_runs(docs.limit(0)).count() == 0


def said(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % period] for i in range(n)]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()
    expected = []
    for doc in docs:
        words = said(doc.doc_id, doc.text.encode().split() if doc.text else [])
        words = [word.decode() for word in words]
        runs = brute(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        digest = lambda value: hashlib.sha256(value.encode()).hexdigest()
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        exponent = None if best[0] is None else 1000 * best[1] // best[2]
        expected.append((doc.doc_id, len(runs), *best, exponent, digest(lines), digest(collapsed(words, runs))))
    assert values(QUERIES["op11_periodic_runs"](spark, TABLES)) == sorted(expected, key=repr)
    assert sum(row[1] for row in expected) > 10


def test_planting_keeps_other_columns_out_and_nulls_as_they_are(rows):
    docs = rows([(None, "a b"), (1, None), (2, ""), (10, "a b c")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in with_planted_runs(docs).collect()}
    assert set(got) == {None, 1, 2, 10} and got[None] == "a b" and got[1] is None
