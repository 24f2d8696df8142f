"""Inputs that the registered queries land for their jobs."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import checks.queries as queries
from checks.queries import _with_broken_lines

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


def test_broken_lines_are_landed_compressed(spark, tmp_path):
    path = _with_broken_lines(spark, SMALL, f"{tmp_path}/in")
    files = [p.name for p in Path(path).glob("part-*")]
    assert files and all(name.endswith(".gz") for name in files)
    lines = spark.read.text(path)
    assert lines.count() > 0
    assert lines.where("value LIKE '{broken %'").count() > 0


def test_files_in_order_of_dates_grow_with_the_rows_and_share_no_date(spark, monkeypatch):
    monkeypatch.setattr(queries, "ROWS_PER_FILE", 500)
    monkeypatch.setattr(queries, "_LANDED", {})
    path = queries.landed_by_year(spark, SMALL, "flights")
    rows = spark.read.parquet(path).select("FlightDate", "_metadata.file_modification_time", "_metadata.file_name")
    files = rows.groupBy("file_name", "file_modification_time").agg(
        F.min("FlightDate").alias("first"), F.max("FlightDate").alias("last"), F.count("*").alias("rows")
    )
    spans = files.orderBy("file_modification_time").collect()
    assert sum(s["rows"] for s in spans) == spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    assert len(spans) >= 10 and len({s["file_modification_time"] for s in spans}) == len(spans)
    assert all(before["last"] < after["first"] for before, after in zip(spans, spans[1:]))


def test_by_file_stream_infers_a_micro_batch_once(spark, tmp_path, monkeypatch):
    from delayworks.sources import files as sources
    from delayworks.streaming import bronze_stream, read_bronze
    from delayworks.streaming import jobs

    asked, read_batch = [], sources.read_batch

    def counting(spark, path, fmt="parquet", schema=None, *how, **more):
        if fmt == "json" and schema is None:
            asked.append(path)
        return read_batch(spark, path, fmt, schema, *how, **more)

    for module in (sources, jobs):
        monkeypatch.setattr(module, "read_batch", counting)
    path = _with_broken_lines(spark, SMALL, f"{tmp_path}/in")
    job = queries._stream_config(path, f"{tmp_path}/out", rescue_column="_rescued_data")
    job[0]["autoloaderOptions"]["cloudFiles.format"] = "json"
    query = bronze_stream(spark, *job, by_file_schema=True)
    assert len(asked) == sum(p["numInputRows"] > 0 for p in query.recentProgress)
    assert read_bronze(spark, f"{tmp_path}/out/table").count() == spark.read.text(path).count()
