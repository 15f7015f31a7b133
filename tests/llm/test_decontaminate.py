import re

import pytest
from conftest import values
from pyspark.sql import functions as F

from chatterlens.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, window):
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, item_text in items:
            iw = words(item_text)
            n = min(window, len(iw))
            for start in range(len(iw) - n + 1) if n else ():
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == iw[start : start + n]:
                        hit.update(range(at, at + n))
                        found |= {item} - {None}
        out.append((doc, len(w), len(hit), sorted(found)))
    return out


ITEMS = [
    (1, "a b c d e f"),
    (2, "Ünï b, C x"),
    (3, None),
    (4, "..."),
    (5, "short one"),
    (6, "a b c d e f"),
    (6, "again the same id here"),
    (None, "p q r s t"),
]
DOCS = [
    (1, "zz A-b C d; E f zz"),
    (2, None),
    (3, ""),
    (4, "short one and ünï B c x and Short  One"),
    (5, "a b c d"),
    (6, "clean text with nothing of it"),
    (6, "clean text with nothing of it"),
    (7, "p q r s t"),
    (8, "a b c\x00d"),
    (9, ("x " * 5000) + "b c d e f " + ("a b c d e f " * 300)),
    (None, "again the same id here"),
]


@pytest.mark.parametrize("block_bytes", [1 << 20, 30])
def test_scan_equals_brute_force(rows, block_bytes):
    docs = rows([(i, t, "mine", 5) for i, t in DOCS], "doc_id long, text string, n_words string, extra int")
    found = d.scan(docs, rows(ITEMS, "item_id long, text string"), window=4, block_bytes=block_bytes)
    got = found.select("doc_id", "n_words", d.n_hit().alias("hit"), "hit_items").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(DOCS, ITEMS, 4), key=repr)
    assert found.columns == ["doc_id", "text", "extra", "n_words", "hit_spans", "hit_items"]


def test_empty_tables(rows):
    docs, items = rows(DOCS, "doc_id long, text string"), rows(ITEMS, "item_id long, text string")
    none = d.scan(docs, items.limit(0))
    assert none.count() == len(DOCS) and none.where(F.size("hit_spans") > 0).count() == 0
    assert d.scan(docs.limit(0), items).count() == 0


def test_hits_are_cut_until_none_is_left(rows):
    item = "one two three four five six seven eight nine ten eleven twelve"
    keep = " ".join(f"w{i}" for i in range(40))
    nested = "one two three four five six " + item + " seven eight nine ten eleven twelve"
    docs = rows([(1, f"{keep} {item} tail"), (2, keep), (3, item), (4, None), (5, f"{keep} {nested} {keep}")], "doc_id long, text string")
    out = d.decontaminate(docs, rows([(1, item)], "item_id long, text string"))
    found = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == docs.columns and set(found) == {1, 2, 4, 5}
    assert found[1].split() == keep.split() + ["tail"] and found[2] == keep and found[4] is None
    assert found[5].split() == keep.split() * 2
    assert values(d.decontaminate(docs.limit(0), rows([(1, item)], "item_id long, text string"))) == []
