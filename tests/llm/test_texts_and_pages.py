import math
import random
import re

import pytest
import public_tokenizers
from conftest import values
from pyspark.sql import functions as F

from chatterlens.llm import importance, license_scan, token_counts, url_models
from chatterlens.llm.catalogue import QUERIES
from chatterlens.llm.steps import kth_largest

TABLES = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")


# Quality


def test_labelled_documents_are_told_apart(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{TABLES}/labels.parquet").collect()}
    rows = QUERIES["op6_importance_resampling"](spark, TABLES).collect()
    kept = [r.kept for r in rows if labels.get(r.doc_id) == 1]
    bad = [r.kept for r in rows if labels.get(r.doc_id) == 0]
    assert len(rows) == 1000 and sum(kept) / len(kept) >= 0.98 and sum(bad) / len(bad) <= 0.1


def test_threshold_parts_the_classes():
    assert importance.threshold([]) == importance.threshold([(1.0, True)]) == -math.inf
    assert importance.threshold([(1.0, True), (2.0, True), (-4.0, False)]) == -1.5
    assert importance.threshold([(0.0, True), (3.0, True), (1.0, False), (-9.0, False), (-1.0, False)]) in (2.0, -0.5)


@pytest.mark.parametrize("few", [10, 10_000])
def test_kth_largest(spark, few):
    rng = random.Random(few)
    data = [rng.choice((rng.gauss(0, 1), 5.0, -1e9, rng.random() * 1e-9)) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in data], "x double")
    for k in (1, 2, 700, 701, 1500, 2999):
        assert kth_largest(df, "x", k, bins=16, few=few) == sorted(data, reverse=True)[k - 1]
    assert kth_largest(df, "x", 0) == math.inf and kth_largest(df, "x", 3000) == -math.inf


def test_edge_documents_are_weighed(rows):
    good, bad = "the quick brown fox runs over the hill", "### $$$ ### %%% $$$ ###"
    docs = rows([(i, good if i % 2 else bad, "x", 0.5) for i in range(200)], "doc_id long, text string, draw string, good double")
    labels = rows([(i, i % 2) for i in range(150)] + [(None, 1), (3, None), (7, 1), (7, 1)], "doc_id long, quality int")
    out = importance.resample(docs.drop("draw"), labels)
    assert out.columns == ["doc_id", "text", "good"] and set(values(out, "text")) == {good} and out.count() == 100
    odd = rows([(1, None), (2, ""), (2, ""), (None, good), (4, good * 5000)], "doc_id long, text string")
    weighed, _ = importance.weighted(odd, labels)
    assert {r.doc_id: r.log_weight for r in weighed.collect()}[1] == 0.0
    for some in (labels.limit(0), labels.where("quality = 1")):
        assert importance.resample(docs.drop("draw"), some).count() == 200
    assert importance.resample(odd.limit(0), labels).count() == 0


# Tokens


def test_counts_are_those_of_the_library(rows):
    rng = random.Random(8)
    parts = ["a", "th", "é", "1", "!", "'s", " ", " ", "\n", "\t", "\r", "\x1c", "\x85", "\xa0", "\u2003", "\u200b", "<|endoftext|>", "ß", "漢", "🙂", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(3000)]
    texts += ["", " ", "  ", " a", "a ", "word " * 20_000, "x" * 50_000, None, "same text", "same text"]
    df = rows([(i, t, -1, "t") for i, t in enumerate(texts)], "i int, body string, n_tokens int, text string")
    out = token_counts.token_counts(df, PATH, "body")
    assert out.columns == ["i", "text", "n_tokens"]
    encode = token_counts.tokenizer(PATH).encode
    expected = {i: len(encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert {r.i: r.n_tokens for r in out.collect()} == expected
    assert token_counts.token_counts(df.limit(0), PATH, "body").count() == 0


def test_counts_of_whole_documents(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    encode = token_counts.tokenizer(PATH).encode
    for r in QUERIES["op7_token_counts"](spark, folder).collect():
        n = len(encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 1024)


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED", 5)
    lengths = token_counts.Lengths(PATH, {" the": 1})
    texts = ["the end of the world", "of words " * 10, "z" * 200]
    for _ in range(3):
        expected = [len(token_counts.tokenizer(PATH).encode(t).ids) for t in texts]
        assert lengths.of(texts) == expected


# Licences


def test_notices_and_inheritance(rows):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    files = [
        ("top/LICENSE", f"Some words\n{apache}\nmore"),
        ("top/a/x.txt", "nothing here"),
        ("top/b/LICENSE.md", mit),
        ("top/b/COPYING", "MIT License? " + mit.upper()),
        ("top/b/c/d/y.txt", "plain"),
        ("top/b/c/z.txt", f"line\n{apache}\nline"),
        ("top/b/c/z.txt", None),
        ("other/x.txt", "a license to talk about permission"),
        ("x.txt", ""),
        (None, mit),
        ("top/a/long.txt", "word " * 50_000 + "\n" + mit),
        ("top/a/x.txt", "nothing here"),
    ]
    df = rows([(p, t, "old", "f") for p, t in files], "path string, text string, licence string, `from` string")
    out = license_scan.licences(df)
    assert out.columns == ["path", "text", "from", "licence", "licence_from", "licence_how", "licence_score"]
    got = {(r.path, (r.text or "")[:5]): (r.licence, r.licence_how, r.licence_from) for r in out.collect()}
    assert got[("top/LICENSE", "Some ")] == ("Apache-2.0", "own", "top/LICENSE")
    assert got[("top/a/x.txt", "nothi")] == ("Apache-2.0", "inherited", "top")
    assert got[("top/b/c/d/y.txt", "plain")] == ("MIT", "inherited", "top/b")
    assert got[("top/b/c/z.txt", "line\n")] == ("Apache-2.0", "own", "top/b/c/z.txt")
    assert got[("top/b/c/z.txt", "")] == ("MIT", "inherited", "top/b")
    assert got[("other/x.txt", "a lic")] == got[("x.txt", "")] == got[(None, "Relea")] == (None, None, None)
    assert got[("top/a/long.txt", "word ")][0] == "MIT"
    assert out.count() == len(files)
    assert license_scan.licences(df.limit(0)).count() == 0


def named(rows, texts):
    files = rows([(f"d{i}/x.py", text) for i, text in enumerate(texts)], "path string, text string")
    found = {r.path: r.licence for r in license_scan.licences(files).collect()}
    return [found[f"d{i}/x.py"] for i in range(len(texts))]


def test_licences_that_are_easily_confused(rows):
    cases = {
        "Released under the MIT License.": "MIT",
        "Released under the BSD License": None,
        "Released under the BSD 2-Clause License": "BSD-2-Clause",
        "GNU General Public License, version 2": "GPL-2.0",
        "GNU General Public License, version 3": "GPL-3.0",
        "licensed under the GNU Lesser General Public License, version 3": "LGPL-3.0",
        "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
        "Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License": "CC-BY-SA-4.0",
        "Licensed under the Creative Commons Attribution 4.0 International License": "CC-BY-4.0",
        "// SPDX-License-Identifier: MIT": "MIT",
        "# spdx-license-identifier: Apache-2.0.": "Apache-2.0",
        "/* SPDX-License-Identifier: (none) */": None,
        "SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 */ Released under the MIT License.": "GPL-2.0-only WITH Classpath-exception-2.0",
        "released into the public domain, free and unencumbered software": "Unlicense",
        "she was licensed to practise": None,
    }
    assert dict(zip(cases, named(rows, list(cases)))) == cases


def test_every_notice_names_its_licence(rows):
    texts = [text for _, text in license_scan.TEMPLATES]
    assert named(rows, texts) == [licence for licence, _ in license_scan.TEMPLATES]


def test_wrapped_headers(rows):
    import textwrap

    headers = []
    for mark in ("# ", " * ", "// ", "-- "):
        for licence, text in license_scan.NOTICES:
            if len(text) > 100:
                lines = textwrap.wrap(text, 60)
                headers.append((licence, "code()\n" + "".join(f"{mark}{line}\n" for line in lines) + "more = code()\n"))
    assert named(rows, [text for _, text in headers]) == [licence for licence, _ in headers]


def test_names_of_licence_files(rows):
    text = "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989" + " preamble" * 500
    paths = ["a/LICENSE", "b/LICENSE.txt", "c/COPYING", "d/licenses", "e/licensed_users.txt", "f/copyings"]
    files = [(f"{p}", text) for p in paths] + [(f"{p[0]}/x", "plain") for p in paths]
    found = {r.path: r.licence for r in license_scan.licences(rows(files, "path string, text string")).collect()}
    assert [found[f"{p[0]}/x"] for p in paths] == ["GPL-2.0"] * 4 + [None] * 2


# URLs


def brute_verdicts(urls, rules):
    """The models with dictionaries instead of tables, without hash buckets."""

    def parts(url):
        found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        return (found[1].translate({c: c + 32 for c in range(65, 91)}), found[2]) if found else ("", "")

    def rule(host, path):
        fits = [(len(name), -i, name, how) for i, (how, name) in enumerate(rules) for at, _, rest in [name.partition("/")]
                if (host == at or host.endswith("." + at)) and path.startswith("/" + rest)]
        return max(fits)[2:] if fits else (None, None)

    judged = [(*parts(u), *rule(*parts(u))) for u in urls]
    counts = {"allow": {}, "block": {}}
    for url, (_, _, _, how) in zip(urls, judged):
        text = url_models.PAD + (url or "")
        for end in range(url_models.ORDER, len(text) + 1) if how else ():
            for n in range(1, url_models.ORDER + 1):
                run = text[end - n : end]
                counts[how][run] = counts[how].get(run, 0) + 1
    contexts = {how: {} for how in counts}
    for how, runs in counts.items():
        for run, n in runs.items():
            contexts[how][(run[:-1], len(run))] = contexts[how].get((run[:-1], len(run)), 0) + n

    def chance(how, run):
        shorter = chance(how, run[1:]) if len(run) > 1 else 1 / url_models.SYMBOLS
        return (counts[how].get(run, 0) + shorter) / (contexts[how].get((run[:-1], len(run)), 0) + 1)

    def ratio(run):
        while run:
            if run in counts["allow"] or run in counts["block"]:
                return math.log(chance("allow", run) / chance("block", run))
            run = run[1:]
        return 0.0

    def score(url):
        text = url_models.PAD + (url or "")
        ends = range(url_models.ORDER, len(text) + 1)
        return sum(ratio(text[end - url_models.ORDER : end]) for end in ends) / len(url) if url else 0.0

    scores = [score(u) for u in urls]
    classes = {}
    for how in counts:
        own = [s for s, j in zip(scores, judged) if j[3] == how]
        if own:
            mean = sum(own) / len(own)
            classes[how] = mean, math.sqrt(sum((s - mean) ** 2 for s in own) / len(own))
    least = url_models.threshold(classes)
    return [(h, p, r, how or ("allow" if s >= least else "block"), s) for (h, p, r, how), s in zip(judged, scores)]


def test_verdicts_equal_brute_force(spark):
    pages = spark.read.parquet(f"{TABLES}/pages.parquet").select("page_id", "url")
    given = pages.collect()
    expected = {p.page_id: row for p, row in zip(given, brute_verdicts([p.url for p in given], url_models.RULES))}
    got = url_models.judged(pages).collect()
    same = sum((r.host, r.path, r.rule, r.verdict) == expected[r.page_id][:4] for r in got)
    # Runs that share a bucket share their ratio, which may move a URL at the threshold.
    assert all((r.host, r.path, r.rule) == expected[r.page_id][:3] for r in got)
    assert len(got) == len(given) and same >= 0.98 * len(given)
    assert sum(abs(r.score - expected[r.page_id][4]) for r in got) / len(got) < 0.05


def test_runs_are_looked_up_exactly(spark):
    pages = spark.read.parquet(f"{TABLES}/pages.parquet").select("page_id", "url")
    given = pages.collect()
    expected = {p.page_id: row for p, row in zip(given, brute_verdicts([p.url for p in given], url_models.RULES))}
    for r in url_models.judged(pages).collect():
        assert (r.host, r.path, r.rule, r.verdict) == expected[r.page_id][:4]
        assert r.score == pytest.approx(expected[r.page_id][4], abs=1e-9)


EDGE = [None, "", "no scheme/here", "http://EXAMPLE.net", "http://Sub.Example.NET/en/x?q#f", "a://b://c/d", "https://x.org/fr/",
        "https://x.org/frx", "http://notexample.net/en/", "http://example.com.evil/de/", "http://h?x/y", "ü://ß.org/fr/é", "http://x.org/" + "a" * 20_000]


def test_edge_urls(rows):
    pages = rows([(i, u, "h", 1) for i, u in enumerate(EDGE + EDGE)], "page_id int, url string, host string, score int")
    out = url_models.judged(pages)
    assert set(out.columns) == {"page_id", "url", "host", "path", "rule", "verdict", "score"}
    expected = brute_verdicts(EDGE, url_models.RULES)
    for r in out.collect():
        assert (r.host, r.path, r.rule) == expected[r.page_id % len(EDGE)][:3]
        assert r.verdict in ("allow", "block")
    assert out.where("url IS NULL OR url = ''").select(F.max("score")).first()[0] == 0.0
    assert url_models.judged(pages.limit(0)).count() == 0
    alone = url_models.judged(rows([(1, "http://a.com/")], "page_id int, url string"))
    assert alone.first().verdict == "allow"


def test_no_pieces_are_shuffled_and_the_sample_is_bounded(spark, rows, monkeypatch):
    docs = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'the same text', concat('own ', id, ' the end')) text")
    plan = token_counts.token_counts(docs, PATH)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    monkeypatch.setattr(token_counts, "SAMPLE", 100)
    known = token_counts.frequent_pieces(docs, "text", PATH)
    assert known[" the"] == known[" end"] == 1 and len(known) < 300
    monkeypatch.setattr(token_counts, "FREQUENT", 1)
    assert len(token_counts.frequent_pieces(docs, "text", PATH)) == 1
