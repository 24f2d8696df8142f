"""Exact duplicates over several runs and micro-batches, against plain dictionaries."""

import random

import pytest
from pyspark.sql import functions as F

from delayworks.llm import exact_stream
from delayworks.llm.exact_stream import decisions, maybe_among, sha256, state, take

SCHEMA = "doc_id long, text string, source string"


def three_letters(text):
    """A digest that takes different texts for equal."""
    return F.substring(sha256(F.substring(text, 1, 3)), 1, 4)


@pytest.fixture
def table(spark, tmp_path):
    """Adds a file of (doc_id, text) to the table, and takes it."""
    path, folder = f"{tmp_path}/a table", f"{tmp_path}/held"

    def add(rows):
        spark.createDataFrame([(*r, "s") for r in rows], SCHEMA).coalesce(1).write.mode("append").parquet(path)

    def run(**how):
        take(spark, path, folder, spark.createDataFrame([], SCHEMA).schema, **how)
        rows = decisions(spark, folder).collect()
        return sorted(((r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in rows), key=repr)

    return add, run, folder


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    return sorted(
        (
            (i, max(ids), len(ids), i == max(ids))
            for ids in groups.values()
            for i in ids
        ),
        key=repr,
    )


@pytest.mark.parametrize("digest, files_per_batch", [(sha256, 1), (three_letters, 1), (three_letters, 100)])
def test_runs_and_micro_batches_equal_brute_force(table, digest, files_per_batch):
    add, run, _ = table
    rng, rows, at = random.Random(5), [], 0
    for _ in range(3):
        for _ in range(2):
            part = []
            for _ in range(30):
                at += rng.randrange(1, 4)
                part.append((at * (-1) ** at, rng.choice([None, "", "abc", "abcd", "abce", "xyz", f"abc{rng.randrange(9)}", str(at)])))
            add(part)
            rows += part
        assert run(files_per_batch=files_per_batch, digest=digest) == expected(rows)


def test_a_run_without_new_files_changes_nothing(table):
    add, run, _ = table
    add([(1, "a"), (2, "a"), (3, "b")])
    first = run()
    assert first == run() == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True)]


def test_repeated_rows_and_null_ids_leave_one_row(table):
    add, run, _ = table
    add([(1, "a"), (1, "a"), (None, "a"), (None, None), (None, "")])
    got = run()
    assert sum(r[3] for r in got) == 2
    assert sorted((r[:3] for r in got), key=repr) == [(1, 1, 3), (1, 1, 3), (None, 1, 3), (None, None, 2), (None, None, 2)]


def test_empty_and_long_texts(table):
    add, run, _ = table
    add([])
    assert run() == []
    add([(1, "x" * 3_000_000), (2, "x" * 3_000_000), (3, "x" * 2_999_999 + "y")])
    assert run() == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True)]


def test_hits_are_compared_with_the_first_arrival(table, monkeypatch):
    """A hit of a later run is told from the first arrival by the text at its locator."""
    add, run, folder = table
    read = []
    texts_at = exact_stream._texts_at
    monkeypatch.setattr(exact_stream, "_texts_at", lambda *a: read.append(texts_at(*a)) or read[-1])
    add([(1, "abc-one"), (2, "other")])
    run(digest=three_letters)
    add([(3, "abc-two")])
    assert run(digest=three_letters) == [(1, 1, 1, True), (2, 2, 1, True), (3, 3, 1, True)]
    assert {r["text"] for r in read[1].collect()} == {"abc-one"}


def test_a_run_that_was_cut_off_is_repeated(table, monkeypatch):
    add, run, folder = table
    add([(1, "abc"), (2, "abcd")])
    run(digest=three_letters)
    add([(3, "abc"), (4, "abcx")])

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as cut:
        cut.setattr(exact_stream, "maybe_among", lost)
        with pytest.raises(Exception, match="lost"):
            run(digest=three_letters)
    with monkeypatch.context() as cut:
        cut.setattr(exact_stream, "_told_apart", lost)
        with pytest.raises(Exception, match="lost"):
            run(digest=three_letters)
    add([(5, "abcd")])
    assert run(digest=three_letters) == [(1, 3, 2, False), (2, 5, 2, False), (3, 3, 2, True), (4, 4, 1, True), (5, 5, 2, True)]


def test_state_holds_an_entry_per_digest_and_no_text(spark, table):
    add, run, folder = table
    add([(1, "a"), (2, "a"), (3, "b")])
    run()
    entries = {r["n"]: r for r in state(spark, folder).collect()}
    assert entries[2]["first"]["id"] == 1 and entries[2]["keeper"]["id"] == 2
    assert "text" not in str(state(spark, folder).schema)


def test_the_filter_loses_no_digest(spark, monkeypatch):
    monkeypatch.setattr(exact_stream, "FILTER_BITS", 1 << 17)
    rows = spark.range(20_000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), "id")
    few = rows.where("id % 50 = 0")
    got = {r["id"] for r in maybe_among(rows, few.select("digest")).collect()}
    assert set(range(0, 20_000, 50)) <= got and len(got) < 700
    assert maybe_among(rows, few.select("digest").limit(0)).collect() == []
