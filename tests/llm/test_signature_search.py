"""Ranked search against a plain scan of all documents, and its bounds against exact scores."""

import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from delayworks.llm import signature_search
from delayworks.llm.signature_search import block_of, places, query_of, search, signature_bits, signatures, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def brute(docs, items, most=50):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    documents, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weight = {t: floor(1000 * log((2 * documents + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c in counts:
            m = 50 + 50 * sum(c.values()) * documents // length
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(plain_terms(text)) if t in c)
            if score > 0 and doc_id is not None:
                found.append((-score, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, doc_id) in enumerate(sorted(found)[:most], 1)]
    return sorted(out, key=repr)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def corpus(rng, n, vocabulary=400):
    """Documents of skewed words, one to some thousands each, with copies."""
    texts = []
    for _ in range(n):
        size = rng.choice([1, 5, 20, 80, 200, 200, 900])
        texts.append(" ".join(f"w{int(vocabulary * rng.random() ** 3)}" for _ in range(size)))
    return texts + texts[: n // 5]


@pytest.mark.parametrize("most, per_block", [(5, 7), (50, 512)])
def test_search_equals_a_plain_scan(spark, documents, monkeypatch, most, per_block):
    monkeypatch.setattr(signature_search, "DOCS_PER_BLOCK", per_block)
    monkeypatch.setattr(signature_search, "QUERIES_AT_ONCE", 4)
    rng = random.Random(most)
    docs = list(enumerate(corpus(rng, 250)))
    items = [(i, " ".join(f"W{int(400 * rng.random() ** 2)}" for _ in range(rng.randrange(1, 30)))) for i in range(9)]
    frame = documents([(i, t, "s", i) for i, t in docs], ", score long").repartition(5)
    got = found(search(frame, spark.createDataFrame(items, "item_id long, text string"), most))
    assert got == brute(docs, items, most)


def test_terms_are_those_of_the_pattern():
    text = "".join(map(chr, [*range(1, 0x250), 0x2028, 0x3000, 0x1F600])) + " Ñandú İstanbul x²"
    assert [t.decode() for t in terms(text)] == plain_terms(text) and terms(None) == []


def test_nulls_repeated_rows_and_empty_tables(spark, documents):
    docs = [(1, "alpha beta"), (1, "alpha beta"), (2, None), (3, " .,; "), (None, "alpha alpha"), (4, "gamma"), (5, "ALPHA, gamma")]
    items = [(7, "Alpha"), (7, "Alpha"), (None, "gamma zeta"), (8, None), (9, "zeta")]
    frame = documents([(i, t, None) for i, t in docs])
    queries = spark.createDataFrame(items, "item_id long, text string")
    assert found(search(frame, queries)) == brute(docs, items)
    assert found(search(documents([]), queries)) == []
    assert found(search(documents([(1, None, "s")]), queries)) == []
    assert found(search(frame, queries.limit(0))) == []


def test_equal_scores_come_by_id(spark, documents):
    docs = [(i, "same words here") for i in random.Random(2).sample(range(1000), 80)]
    items = [(1, "words")]
    got = found(search(documents([(i, t, "s") for i, t in docs]).repartition(6), spark.createDataFrame(items, "item_id long, text string")))
    assert got == brute(docs, items) and [r[2] for r in sorted(got, key=lambda r: r[1])] == sorted(i for i, _ in docs)[:50]


def test_bounds_are_never_exceeded_and_exclude(spark, documents):
    rng = random.Random(9)
    texts = corpus(rng, 600, 3000) + ["word " * 5000 + "w1 w2"]
    frame = documents([(i, t, "s") for i, t in enumerate(texts)])
    query = query_of([" ".join(f"w{rng.randrange(600)}" for _ in range(12)) for _ in range(6)], frame)
    close = total = 0
    for block in signatures(frame).collect():
        bounds = query.bounds(block.asDict())
        exact = np.array([query.scores(texts[i], range(6)) for i in block["ids"]]).T
        assert (bounds >= exact).all()
        close, total = close + exact.sum(), total + bounds.sum()
    assert close > 0.75 * total


def test_most_documents_are_excluded(spark, documents, monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(2000)]
    passed = []
    scored = signature_search.scored

    def counting(df, query, pairs, *rest):
        passed.append(pairs.count())
        return scored(df, query, pairs, *rest)

    monkeypatch.setattr(signature_search, "scored", counting)
    items = [(i, texts[i]) for i in range(5)]
    docs = list(enumerate(texts))
    got = found(search(documents([(i, t, "s") for i, t in docs]), spark.createDataFrame(items, "item_id long, text string"), 10))
    assert got == brute(docs, items, 10) and passed[0] == 5 * 40 and passed[1] < 0.1 * 5 * 2000


def test_a_signature_of_a_very_long_text_is_bounded(monkeypatch):
    monkeypatch.setattr(signature_search, "MOST_BITS", 8)
    assert signature_bits(1) == 7 and signature_bits(10**9) == 8
    hashes = np.arange(1, 5000, dtype=np.uint64)
    block = block_of([(1, 4999, hashes, np.ones(4999 - 0, np.int64)[: len(hashes)])], 8)
    assert len(block["slices"]) == 256
    table = np.unpackbits(np.frombuffer(block["slices"], np.uint8).reshape(256, -1), axis=1, count=1)[:, 0]
    assert all(table[p].all() for p in places(hashes, 0, 8))
