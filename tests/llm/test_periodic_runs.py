"""Runs against brute force over all periods and starts."""

import hashlib
import random
import zlib
from pathlib import Path

import numpy as np
import pytest

from delayworks.llm.periodic_runs import kept_words, least_lcp, numbered, periodic_runs, runs_of, suffixes
from delayworks.llm.queries import op11_periodic_runs

SMALL = "/root/testdata/sf0.001"


def brute(words, min_length=24, min_exponent=3):
    found, n = [], len(words)
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length < max(min_length, min_exponent * q):
                continue
            if not any(all(words[k] == words[k + p] for k in range(start, start + length - p)) for p in range(1, q)):
                found.append((start, length, q))
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


@pytest.mark.parametrize("min_length, min_exponent", [(24, 3), (4, 2), (2, 2), (6, 3), (9, 4)])
def test_runs_equal_brute_force(min_length, min_exponent):
    rng = random.Random(min_length)
    for _ in range(400):
        letters, n = rng.choice([1, 2, 3, 5]), rng.randrange(90)
        words = [rng.randrange(letters) for _ in range(n)]
        if n > 10 and rng.random() < 0.6:
            a, p = rng.randrange(n), rng.randrange(1, 8)
            words = [w if i < a else words[min(n - 1, a + (i - a) % p)] for i, w in enumerate(words)]
        got = runs_of(np.array(words, np.int64), min_length, min_exponent)
        assert got == brute(words, min_length, min_exponent)


def test_overlapping_runs_and_long_periods():
    rng = random.Random(4)
    block = [f"w{rng.randrange(9**6)}" for _ in range(500)]
    words = block * 3 + ["x"] * 30 + ["x", "y"] * 20
    ids = numbered(" ".join(words).encode())[0]
    assert runs_of(ids) == brute(words) and (0, 1500, 500) in runs_of(ids)
    assert runs_of(numbered(" ".join(block * 3)[:-2].encode())[0]) == []  # one word short of three periods


def test_least_lcp_by_hand():
    assert least_lcp(24, 3) == 16 and least_lcp(2, 2) == 1


def test_suffixes_and_their_lcp():
    rng = random.Random(0)
    for n in (0, 1, 2, 50):
        words = [rng.randrange(2) for _ in range(n)]
        order, lcp = suffixes(np.array(words, np.int64))
        assert order.tolist() == sorted(range(n), key=lambda i: words[i:])
        for at, common in enumerate(lcp.tolist()):
            i, j = order[at], order[at + 1]
            assert words[i : i + common] == words[j : j + common] and words[i : i + common + 1] != words[j : j + common + 1]


def test_a_run_keeps_its_first_period():
    assert kept_words(8, [(1, 6, 2)]).tolist() == [True, True, True, False, False, False, False, True]
    assert kept_words(0, []).tolist() == []


def test_long_texts_are_numbered_as_short_ones(monkeypatch):
    text = "é b\x0bé b  b\n\té".encode()
    ids, forms = numbered(text)
    monkeypatch.setattr("delayworks.llm.periodic_runs.LONG", 1)
    assert [forms[i].decode() for i in ids] == ["é", "b", "é b", "b", "é"]
    assert numbered(text)[0].tolist() == ids.tolist() and numbered(text)[1] == forms


def test_nulls_repeated_rows_and_clashing_columns(spark, documents):
    rows = [(1, "a b " * 20, "s", 1), (1, "a b " * 20, "s", 1), (None, "z " * 30, None, 2), (2, None, "s", 3), (3, "", "s", 4), (4, " \n ", "s", 5)]
    got = periodic_runs(documents(rows, ", runs int")).collect()
    assert sorted((r["id"] or 0, [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got) == [
        (0, [(0, 30, 1)], "z"),
        (1, [(0, 40, 2)], "a b"),
        (1, [(0, 40, 2)], "a b"),
        (2, [], ""),
        (3, [], ""),
        (4, [], ""),
    ]
    assert periodic_runs(documents([])).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(documents([]), min_exponent=1)


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")
def test_query_equals_brute_force(spark):
    expected = {}
    for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        words = [w.decode() for w in (row["text"] or "").encode().split()]
        n, h = len(words), zlib.crc32(str(row["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = runs_of(numbered(" ".join(words).encode())[0]) if n > 600 else brute(words)
        best = None
        for run in runs:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        digest = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{m},{q}\n" for s, m, q in runs), collapsed(words, runs))]
        milli = 1000 * best[1] // best[2] if best else None
        expected[row["doc_id"]] = (len(runs), *(best or (None,) * 3), milli, *digest)
    got = {r[0]: tuple(r)[1:] for r in op11_periodic_runs(spark, SMALL).collect()}
    assert got == expected and sum(r[0] > 0 for r in expected.values()) > 10
