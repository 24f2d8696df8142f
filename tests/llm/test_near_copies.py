"""Fingerprints, their index, and components, against brute force."""

import random

import numpy as np
import pytest
import xxhash

from delayworks.llm import simhash
from delayworks.llm.components import components, forest, merge_labels
from delayworks.llm.simhash import BLOCKS, drop_near_copies, fingerprint, links, near_groups, search, shingle_hashes


def union(n, pairs):
    labels = np.arange(n)
    if len(pairs):
        a, b = np.array(pairs).T
        merge_labels(labels, a, b)
    return labels


def text(rng, n, vocabulary=5000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def changed(rng, words, share):
    return " ".join(f"x{rng.randrange(9**6)}" if rng.random() < share else w for w in words.split())


def test_fingerprint_bits_by_hand():
    sentence = "The  cat\tsat\non The cat sat"
    words = sentence.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    expected = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert fingerprint(shingle_hashes(sentence, 3))[0] == expected


@pytest.mark.parametrize("value", [None, "", " \t\n\x0b\x0c\r "])
def test_no_words_give_zero(value):
    assert fingerprint(shingle_hashes(value, 3))[0] == 0


def test_only_ascii_letters_are_lowered_and_other_spaces_are_no_spaces():
    assert (shingle_hashes("ÄB C\xa0D", 3) == shingle_hashes("Äb c\xa0d", 3)).all()
    assert (shingle_hashes("Ä", 3) != shingle_hashes("ä", 3)).all()
    assert len(shingle_hashes("a\xa0b c d e", 3)) == 2


def test_spark_hash_of_a_shingle_is_the_same(spark):
    row = spark.sql("SELECT xxhash64('déjà vu encore') AS h").first()
    assert row["h"] % 2**64 == shingle_hashes("Déjà vu ENCORE", 3)[0]


@pytest.mark.parametrize("radius, flips", [(3, 4), (8, 9)])
def test_search_equals_brute_force_under_each_key(radius, flips):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 2**63, 40).astype(np.uint64)
    prints = rng.choice(centres, 900)
    for _ in range(flips):
        prints = prints ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64))
    keys, ids = rng.integers(0, 3, 900), rng.permutation(900) * 7
    a, b = search(keys, prints[:, None], ids, radius)
    near = (np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius) & (keys[:, None] == keys[None, :])
    expected = union(900, np.argwhere(near))
    position = np.argsort(ids)
    found = union(900, np.c_[position[np.searchsorted(ids[position], a)], position[np.searchsorted(ids[position], b)]])
    assert (expected == found).all()


def test_search_of_nothing_and_of_equal_rows():
    none = np.zeros(0, np.int64)
    assert len(search(none, none.astype(np.uint64)[:, None], none, 3)[0]) == 0
    same = np.zeros(500, np.int64)
    a, b = search(same, same.astype(np.uint64)[:, None], np.arange(500), 3)
    assert len(a) == 499 and set(b) == {0}


@pytest.mark.parametrize("partitions", ["2", "13"])
def test_links_across_tasks_lose_nothing(spark, monkeypatch, partitions):
    """A hot band value that spans many tasks."""
    monkeypatch.setattr(simhash, "ROWS_PER_TASK", 200)
    rng = np.random.default_rng(5)
    centre = np.uint64(0x123456789ABCDEF0)
    prints = np.full(500, centre)
    for _ in range(5):
        prints = prints ^ (np.uint64(1) << rng.integers(16, 64, 500).astype(np.uint64))
    prints = np.unique(prints)
    rows = [(i, int(p) - 2**64 * (int(p) >> 63), int(r)) for i, (p, r) in enumerate(zip(prints, simhash.gray_rank(prints)))]
    frame = spark.createDataFrame(rows, "id long, f0 long, rank long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = links(frame, BLOCKS, 3).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    assert (union(len(prints), np.argwhere(near)) == union(len(prints), [tuple(r) for r in got])).all()


def test_groups_by_fingerprint(spark, documents):
    rows = [(5, "a b c d", "s"), (3, "A B C D", "s"), (9, "", "s"), (7, None, "t"), (None, "a b c d", "s"), (11, "q r s", None)]
    got = {(r["id"], r["component"]) for r in near_groups(documents(rows)).collect()}
    assert got == {(5, 3), (3, 3), (None, 3), (9, 7), (7, 7), (11, 11)}
    assert near_groups(documents([])).collect() == []


def test_one_of_each_group_stays(spark, documents):
    """Equal to brute force over all pairs of fingerprints, one large group of near copies included."""
    rng = random.Random(3)
    base = [text(rng, rng.randrange(80, 300)) for _ in range(25)]
    texts = list(base)
    for t in base[:12]:
        texts += [t, t.upper()] + [changed(rng, t, share) for share in (0.005, 0.01, 0.02, 0.04, 0.08)]
    texts += [changed(rng, base[0], 0.005) for _ in range(300)]
    texts += ["", " ", "lone words here"]
    rng.shuffle(texts)
    prints = np.array([fingerprint(shingle_hashes(t, 3))[0] for t in texts])
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    expected = set(np.unique(union(len(texts), np.argwhere(near))).tolist())
    frame = documents([(i, t, "s", i) for i, t in enumerate(texts)], ", component long")
    kept = drop_near_copies(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)


def test_repeated_rows_and_null_ids(spark, documents):
    rows = [(1, "a b c d e f", "s"), (1, "a b c d e f", "s"), (2, "a b c d e f", "s"), (None, "a b c d e f", "s"), (3, None, "s")]
    got = sorted((r["doc_id"] or 0) for r in drop_near_copies(documents(rows)).collect())
    assert got == [0, 1, 3]
    assert drop_near_copies(documents([])).collect() == []


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)]
    pairs += [(600, i) for i in range(601, 680)] + [(1, 1), (None, 4)]
    frame = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    got = {r["id"]: r["component"] for r in components(frame).collect()}
    real = [p for p in pairs if None not in p and p[0] != p[1]]
    labels = union(700, real)
    assert got == {v: int(labels[v]) for p in real for v in p}
    assert components(frame.where("a < 0")).collect() == []


def test_forest_joins_what_was_joined():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 300, (2, 400))
    c, d = forest(a, b)
    assert (union(300, np.c_[a, b]) == union(300, np.c_[c, d])).all() and len(c) < 300
