import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from conftest import values
from tokenizers import Tokenizer

from chatterlens.llm import token_alignment as t
from chatterlens.llm.catalogue import QUERIES

TABLES = "/root/testdata/sf0.001"
A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(text, libraries):
    """Ids of the whole text by both libraries, groups and links byte by byte."""
    a, b = libraries
    alphabet = t.byte_alphabet()
    if not text:
        return [], [], [], []
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in a_ids]
    spelled = lambda i: bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    b_bytes = [spelled(i) for i in b_ids]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return [], [], [], []
    a_of, b_of = ([i for i, part in enumerate(parts) for _ in part] for parts in (a_bytes, b_bytes))
    begins, groups = [0], []
    for byte in range(1, len(a_of) + 1):
        if byte == len(a_of) or a_of[byte] != a_of[byte - 1] and b_of[byte] != b_of[byte - 1]:
            sides = (sorted(set(of[begins[-1] : byte])) for of in (a_of, b_of))
            groups.append("|".join(",".join(str(ids[i]) for i in side) for ids, side in zip((a_ids, b_ids), sides)))
            begins.append(byte)
    links = [(a_ids[i], b_ids[j]) for i, j in set(zip(a_of, b_of))]
    return a_ids, b_ids, groups, links


def expected(docs, libraries):
    found = [(key, *brute(text, libraries)) for key, text in docs]
    counts = Counter(link for *_, links in found for link in links)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    for key, a, b, groups, links in found:
        best = sum(counts[link] == highest[link[1]] for link in links)
        yield key, len(a), len(b), len(groups), len(links), best, sum(counts[x] for x in links), ";".join(groups)


def odd_texts(n, seed):
    rng = random.Random(seed)
    signs = [*"abcdefgh'tsre", *"     ", "\n", "\t", "  ", "\r\n", "1", "23", "é", "ß", "中文", "кий", "🙂", "́", " ", " ",
             "\x1c", "\x00", ".", "...", "=" * 9, "<s>", "<|endoftext|>", "the ", "Hello", "ﬁ"]
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_alignment_equals_brute_force(rows, libraries):
    texts = [None, "", " ", "  x", "x ", "a▁b", "same " * 2000, "one two", "one two", *odd_texts(400, 1)]
    docs = list(enumerate(texts)) + [(None, "a null id"), (3, "  x")]
    found = t.with_link_scores(t.align(rows([(*doc, "x", 1) for doc in docs], "doc_id long, text string, pairs string, __row int"), A, B))
    assert found.columns == ["id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    columns = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert values(found.select(columns)) == sorted(expected(docs, libraries), key=repr)
    assert sum(row.n_a > 0 for row in found.collect()) > 300


def test_counts_joined_by_shuffle_are_the_same(rows, libraries, monkeypatch):
    monkeypatch.setattr(t, "BROADCAST_PAIRS", 0)
    docs = list(enumerate(odd_texts(60, 2)))
    found = t.with_link_scores(t.align(rows(docs, "doc_id long, text string"), A, B))
    columns = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert values(found.select(columns)) == sorted(expected(docs, libraries), key=repr)


def test_pieces_and_cache(monkeypatch):
    for text in odd_texts(200, 3):
        assert "".join(t.pieces(text)) == " " + text
    aligner = t.Aligner(open(A).read(), open(B, "rb").read())
    before = aligner.aligned(["a few words here", "x" * 500])
    assert all(len(piece) <= t.SHORT for piece in aligner.known)
    monkeypatch.setattr(t, "CACHED", 2)
    for _ in range(3):
        assert aligner.aligned(["a few words here", "x" * 500]) == before and not aligner.known
    assert aligner.before


def test_empty_table(rows):
    assert t.with_link_scores(t.align(rows([], "doc_id long, text string"), A, B)).count() == 0


def test_query_equals_brute_force(spark, libraries):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest() if text else ""
    short = [(d.doc_id, d.text) for d in docs]
    wanted = sorted(((*row[:-1], digest(row[-1])) for row in expected(short, libraries)), key=repr)
    assert values(QUERIES["op12_token_alignment"](spark, TABLES)) == wanted
