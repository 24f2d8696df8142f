"""Registered streams take as many micro-batches over many landed files as over few."""

from pathlib import Path

import pytest

import checks.queries as queries

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


def batches_over_many_files(spark, monkeypatch, name):
    """Micro-batches with rows of each run of the query, its input landed in some 60 files."""
    taken, many = [], queries.many

    def counting(query, batches=queries.BATCHES):
        taken.append(sum(p["numInputRows"] > 0 for p in query.recentProgress))
        return many(query, batches)

    monkeypatch.setattr(queries, "many", counting)
    monkeypatch.setattr(queries, "ROWS_PER_FILE", 100)
    monkeypatch.setattr(queries, "_LANDED", {})
    assert queries.QUERIES[name](spark, SMALL).count() > 0
    return taken


@pytest.mark.parametrize("files, file_cap, wanted", [(8, 2, 2), (8, 1, 1), (9, 2, 2), (144, 2, 36), (144, 1, 18), (3, 2, 2)])
def test_the_cap_takes_the_same_share_of_more_files(files, file_cap, wanted):
    source, _ = queries._stream_config("in", "out", file_cap=file_cap, files=files)
    assert source["autoloaderOptions"]["cloudFiles.maxFilesPerTrigger"] == str(wanted)


@pytest.mark.parametrize("name", ["layers_stream", "silver_stream_stored", "bronze_stream_rescued", "bronze_stream_broken_lines", "silver_stream"])
def test_micro_batches_do_not_grow_with_the_landed_files(spark, monkeypatch, name):
    assert max(batches_over_many_files(spark, monkeypatch, name)) <= 2 * queries.BATCHES
