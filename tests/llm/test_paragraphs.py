import random
import tracemalloc
from pathlib import Path
from urllib.parse import urlparse

import pyarrow as pa
from conftest import values

from chatterlens.llm import bottom_k
from chatterlens.llm import paragraphs as p
from chatterlens.session import _session_folder


def corpus(seed=3):
    """Clean texts, some with one of three passages of 50 words or more at any place, one passage with a word changed."""
    rng = random.Random(seed)
    word = lambda: f"{rng.choice('abcdefg')}{rng.randrange(10**6)}"
    passages = [[word() for _ in range(n)] for n in (50, 55, 90)]
    docs, holders = [], {}
    for i in range(60):
        text = [word() for _ in range(rng.choice((10, 30, 120, 400)))]
        if i % 4 == 0:
            which = rng.randrange(3)
            passage = list(passages[which])
            if which == 2 and i % 8 == 0:
                passage[45] = word()
            at = rng.randrange(len(text))
            text = text[:at] + passage + text[at:]
            holders.setdefault(which, []).append(i)
        docs.append((i, " ".join(text).replace(" a", "\n a")))
    return docs, holders


def windows(text, n=50):
    w = (text or "").lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_planted_passages_are_found_and_clean_texts_are_not(rows):
    docs, holders = corpus()
    found = p.repeated_passages(rows(docs, "doc_id long, text string")).collect()
    expected = {i for ids in holders.values() for i in ids[1:]}
    assert {r.id for r in found} == expected
    for ids in holders.values():
        assert {r.kept_id for r in found if r.id in ids} <= {ids[0]}


def test_no_passage_is_left_twice(rows):
    docs, holders = corpus(4)
    out = p.cut_passages(rows(docs, "doc_id long, text string"))
    after = {r.doc_id: r.text for r in out.collect()}
    seen = {}
    for i, text in after.items():
        for window in windows(text):
            assert seen.setdefault(window, i) == i
    changed = {i for i, text in docs if after.get(i) != text}
    assert changed == {i for ids in holders.values() for i in ids[1:]}


def test_edge_cases(rows):
    long = " ".join(f"v{i}" for i in range(20_000))
    copy = " ".join(f"u{i}" for i in range(40))
    data = [(1, None), (2, ""), (3, "few words"), (3, "few words"), (4, long), (5, "same " * 3000), (6, copy), (7, copy), (None, copy), (6, copy)]
    docs = rows([(i, t, "x", 1) for i, t in data], "doc_id long, text string, `row` string, kept int")
    found = p.repeated_passages(docs)
    assert sorted({(r.id, r.kept_id) for r in found.collect()}, key=repr) == [(7, 6), (None, 6)]
    out = p.cut_passages(docs)
    assert out.columns == docs.columns
    assert sorted(map(repr, values(out, "doc_id"))) == sorted(map(repr, [1, 2, 3, 3, 4, 5, 6, 6]))
    assert p.repeated_passages(docs.limit(0)).count() == 0 and p.cut_passages(docs.limit(0)).count() == 0


def test_bands_reach_their_recall():
    for similarity in (0.6, 0.8, 0.95):
        bands = p.bands_for(similarity)
        assert 1 - (1 - similarity**p.ROWS) ** bands >= p.RECALL


def similar_pairs(sets, percent):
    near = lambda a, b: 100 * len(a & b) >= percent * len(a | b)
    return {(a, b) for a in sets for b in sets if a < b and near(sets[a], sets[b])}


def test_classes_unlike_the_first_of_their_band_are_compared(rows):
    """Triples of texts of one paragraph: two differ in the last word, the third has only the first 19 words of both."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**9)}"
    docs = []
    for i in range(0, 120, 3):
        start = [word() for _ in range(23)]
        texts = [[*start, word()], [*start, word()], [*start[:19], *[word() for _ in range(5)]]]
        docs += [(i + k, " ".join(text)) for k, text in enumerate(texts)]
    found = p.repeated_passages(rows(docs, "doc_id long, text string")).collect()
    got = {(r.id, r.kept_id) for r in found}
    assert got <= {(i + 1, i) for i in range(0, 120, 3)} and len(got) >= p.RECALL * 40


def test_all_classes_of_a_large_band_are_compared(rows):
    """Pairs of similar classes in one band whose first class resembles none."""
    sets, shared = {0: set(range(1000, 1020))}, {1000}
    for i in range(20):
        own = {10_000 + 100 * i + k for k in range(18)} | shared
        sets[2 * i + 1], sets[2 * i + 2] = own | {50_000 + i}, own | {60_000 + i}
    members = rows([(0, node) for node in sets if node], "pivot long, node long")
    data = [(node, sorted(v), None if node % 2 else node) for node, v in sets.items()]
    links, found = p.linked_classes(members, rows(data, "node long, values array<long>, only long"), 80)
    got = {r.node: r.component for r in found.collect()}
    assert {(r.a, r.b) for r in links.collect()} == similar_pairs(sets, 80)
    pairs = similar_pairs(sets, 80)
    assert len(pairs) == 20 and set(got) == {x for pair in pairs for x in pair}
    assert all(got[a] == got[b] for a, b in pairs) and len(set(got.values())) == 20


def test_pairs_of_one_text_alone_are_no_link(rows):
    sets = [(1, list(range(20)), 7), (2, list(range(1, 21)), 7), (3, list(range(2, 22)), None)]
    sets = rows(sets, "node long, values array<long>, only long")
    pairs = rows([(1, 2), (1, 3), (2, 3)], "a long, b long")
    assert values(p.similar_classes(pairs, sets, 80)) == [(1, 3), (2, 3)]


def test_a_repeated_line_is_cut_as_a_whole(rows):
    """Lines of 1 to 30 words, said until they have 200 words or more, each in two documents between other words."""
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(10**9)}"
    docs = []
    for n in (1, 2, 7, 10, 23, 24, 30):
        line = [word() for _ in range(n)]
        for times in (200 // n + 1, 260 // n + 1):
            docs.append((len(docs), " ".join([word() for _ in range(60)] + line * times + [word() for _ in range(60)])))
    after = {r.doc_id: r.text for r in p.cut_passages(rows(docs, "doc_id long, text string")).collect()}
    for i in range(0, len(docs), 2):
        assert after[i] == docs[i][1]
        assert not windows(after[i]) & windows(after[i + 1])
        assert len(after[i + 1].split()) <= 120 + 2 * (p.PASSAGE - p.PARAGRAPH)


def test_passages_are_cut_to_their_ends(rows):
    """Passages of 50 to 120 words between other words, in three documents each; some begin or end their text."""
    rng = random.Random(10)
    word = lambda: f"w{rng.randrange(10**9)}"
    docs, expected = [], {}
    for n in range(50, 121, 2):
        passage = [word() for _ in range(n)]
        for copy in range(3):
            before, behind = ([word() for _ in range(rng.choice((0, 3, 70)))] for _ in range(2))
            if copy:
                expected[len(docs)] = len(docs) - copy, len(before), len(before) + n
            docs.append((len(docs), " ".join(before + passage + behind)))
    found = p.repeated_passages(rows(docs, "doc_id long, text string")).collect()
    assert sorted(r.id for r in found) == sorted(expected)
    for r in found:
        kept, begin, end = expected[r.id]
        assert (r.kept_id, r.begin, r.end) == (kept, begin, end)


def lines_of(text):
    return [tuple(line.lower().split()) for line in (text or "").split("\n")]


def shingles(words):
    return {words[i : i + p.SHINGLE] for i in range(len(words) - p.SHINGLE + 1)}


def test_similar_paragraphs_equal_brute_force(rows):
    """Lines of 400 texts, many of them another text's with a few words changed: what is cut of lines that hold no
    equal run of words is what comparing all pairs of lines gives, but for pairs that no band holds."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10**9)}"
    bases = [[word() for _ in range(rng.choice((20, 24, 30, 50, 60, 90, 150)))] for _ in range(60)]
    docs, pool = [], []
    for i in range(400):
        lines = [[word() for _ in range(rng.choice((3, 30, 60)))] for _ in range(rng.randrange(3))]
        if rng.random() < 0.5:
            changed = list(rng.choice(bases))
            for place in range(rng.randrange(20), len(changed), 20):  # no run of 24 words stays
                changed[place] = word()
            lines.append(changed)
            pool.append((i, tuple(changed)))
        rng.shuffle(lines)
        docs.append((i, "\n".join(map(" ".join, lines))))
    pairs = set()
    for n, (i, one) in enumerate(pool):
        for j, two in pool[:n]:
            a, b = shingles(one), shingles(two)
            if min(len(one), len(two)) >= p.PARAGRAPH and 100 * len(a & b) >= p.PERCENT * len(a | b):
                pairs.add((min(i, j), max(i, j)))
    linked = {i for pair in pairs for i in pair}
    first = {}
    for i in sorted(linked):
        first[i] = min([i, *[first[a] for a, b in pairs if b == i and a in first]])
    expected = {i for i in linked if first[i] != i}
    found = {r.id: r for r in p.repeated_passages(rows(docs, "doc_id long, text string")).collect()}
    assert set(found) <= expected and len(found) >= 0.95 * len(expected) - 1
    for i, r in found.items():
        words = [w for line in lines_of(docs[i][1]) for w in line]
        kept = [w for line in lines_of(docs[r.kept_id][1]) for w in line]
        assert set(words[r.begin : r.begin + p.SHINGLE]) <= set(kept) or r.end - r.begin >= p.PARAGRAPH


def test_recall_of_paragraphs_with_a_changed_word(rows):
    """Texts that share a line but for one word, which is at any place where the similarity stays 0.8 or more."""
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(10**9)}"
    docs, expected = [], {}
    for i in range(0, 800, 2):
        length = (30, 50, 60, 90)[i // 200]
        line = [word() for _ in range(length)]
        whole, similar = shingles(tuple(line)), False
        while not similar:
            at = rng.randrange(length)
            other = [*line[:at], word(), *line[at + 1 :]]
            mine = shingles(tuple(other))
            similar = 100 * len(whole & mine) >= p.PERCENT * len(whole | mine)
        for k, shared in enumerate((line, other)):
            text = [[word() for _ in range(rng.choice((5, 40)))], shared, [word() for _ in range(40)]]
            docs.append((i + k, "\n".join(map(" ".join, text))))
        expected.setdefault(length, set()).add(i + 1)
    found = {r.id for r in p.repeated_passages(rows(docs, "doc_id long, text string")).collect()}
    assert found <= set().union(*expected.values())
    for ids in expected.values():
        assert len(found & ids) >= 0.95 * len(ids)


def test_runs_of_fifty_words_are_always_found(rows):
    rng = random.Random(13)
    word = lambda: f"w{rng.randrange(10**9)}"
    docs = []
    for i in range(0, 240, 2):
        run = [word() for _ in range(50)]
        for k in range(2):
            before, behind = ([word() for _ in range(rng.randrange(60))] for _ in range(2))
            docs.append((i + k, " ".join(before + run + behind)))
    found = {(r.id, r.end - r.begin) for r in p.repeated_passages(rows(docs, "doc_id long, text string")).collect()}
    assert found == {(i + 1, 50) for i in range(0, 240, 2)}


def test_a_line_said_sixty_times_in_twelve_texts(spark, rows):
    """The whole repeated stretch goes from all texts but the first, by joins that grow with the number of lines."""
    rng = random.Random(14)
    word = lambda: f"w{rng.randrange(10**9)}"
    line = " ".join(word() for _ in range(30))
    docs = [(i, "\n".join([" ".join(word() for _ in range(9)), *[line] * 60, " ".join(word() for _ in range(7))])) for i in range(12)]
    found = p.repeated_passages(rows(docs, "doc_id long, text string")).collect()
    assert sorted((r.id, r.kept_id, r.begin, r.end) for r in found) == [(i, 0, 9, 9 + 1800) for i in range(1, 12)]


def test_neighbours_in_order_share_most(rows):
    rng = random.Random(15)
    data = [(rng.randrange(3), rng.choice(("left", "right")), [rng.randrange(2) for _ in range(rng.randrange(6))], rng.random() < 0.3) for _ in range(300)]
    got = {(r["class"], r.side, tuple(r.words)): r.agree for r in p.agreements(rows(data, "class long, side string, words array<int>, kept boolean")).collect()}

    def shared(one, two):
        return next((i for i, (x, y) in enumerate(zip(one, two)) if x != y), min(len(one), len(two)))

    for key, side, words, _ in data:
        best = max([shared(words, other) for k, s, other, kept in data if (k, s) == (key, side) and kept], default=0)
        assert got.get((key, side, tuple(words)), 0) == best


def test_long_lines_are_cut_where_their_words_say(rows):
    """A line of 3000 words in two texts, the second with a word changed every 100: most of it is found."""
    rng = random.Random(16)
    word = lambda: f"w{rng.randrange(10**9)}"
    line = [word() for _ in range(3000)]
    other = [word() if i % 100 == 50 else w for i, w in enumerate(line)]
    found = p.repeated_passages(rows([(1, " ".join(line)), (2, "x " * 30 + " ".join(other))], "doc_id long, text string")).collect()
    assert sum(r.end - r.begin for r in found) >= 2900 and {r.id for r in found} == {2}


def test_ids_that_are_no_numbers(rows):
    passage = " ".join(f"u{i}" for i in range(60))
    docs = rows([("7", passage), ("x", passage), ("8", passage)], "doc_id string, text string")
    assert sorted({(r.id, r.kept_id) for r in p.repeated_passages(docs).collect()}, key=repr) == [(8, 7), (None, 7)]


def test_ranked_classes_equal_ranked_sets(rows):
    rng = random.Random(17)
    data = [(node, [rng.randrange(40) if rng.random() < 0.7 else 1000 * node + k for k in range(rng.randrange(1, 12))]) for node in range(30)]
    sets = rows([(node, sorted(set(v))) for node, v in data], "node long, values array<long>")
    members = rows([(0, node) for node in range(1, 25)], "pivot long, node long")
    plain = lambda df: sorted((r.node, r.n, r.alone, [(e.spread, e.value if e.spread > 1 else None) for e in r.prefix]) for r in df.collect())
    assert plain(p.ranked_classes(members, sets, 80)) == plain(bottom_k.ranked_sets(members, sets, 80))


def test_groups_of_one_component_are_settled(rows):
    members = rows([(1, 2), (1, 3), (5, 6), (5, 7)], "pivot long, node long")
    components = rows([(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)], "node long, component long")
    assert values(p.unsettled(members, components)) == [(5, 6), (5, 7)]


def test_tables_that_no_later_step_reads_are_deleted(spark, rows, monkeypatch):
    """While the words beside the cut runs are read, only the tables of the named passages and their ends are left."""
    names, texts_with = [], p._texts_with

    def listed(docs, lists, name):
        folder = Path(urlparse(_session_folder(spark)).path)
        names.append((name, {entry.name.rpartition("-")[0] for entry in folder.iterdir()}))
        return texts_with(docs, lists, name)

    monkeypatch.setattr(p, "_texts_with", listed)
    docs, _ = corpus()
    assert p.repeated_passages(rows(docs, "doc_id long, text string")).count()
    before, left = dict(names)["places"], dict(names)["ends"]
    assert {"paragraphs", "classes", "band-groups"} <= before
    assert {"named-paragraphs", "ends"} <= left
    assert not left & {"paragraphs", "classes", "band-groups", "paragraph-sets", "wanted", "held-classes", "kept"}


def test_a_batch_of_texts_takes_little_memory():
    """A worker holds arrays over a slice of its batch only, so an executor's memory does not depend on the batch."""
    texts = [" ".join(f"w{(i * 7919 + j) % 99991}" for j in range(1000)) for i in range(600)]
    n = pa.array(range(600), pa.int64())
    batch = pa.RecordBatch.from_arrays([n, n, pa.array(texts)], names=["id", "row", "text"])
    list(p._found(3)([batch]))
    tracemalloc.start()
    found = sum(out.num_rows for out in p._found(3)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found and peak < 10 << 20
