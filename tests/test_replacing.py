"""Tables replaced at once or by partition, counts of streams, records that can't be parsed."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from delayworks.plans import bronze_batch, gold_batch, silver_batch
from delayworks.schema import FLIGHT_SCHEMA
from delayworks.sinks import read_current, write_batch, write_version
from delayworks.sources import read_batch, read_stream
from delayworks.sources.files import CORRUPT_RECORD, with_corrupt_record
from delayworks.streaming import bronze_stream, gold_stream, read_bronze, read_counts, silver_stream

RUN = date(2024, 3, 5)


@pytest.fixture
def config(tmp_path):
    def build(source, name, options=None, **output):
        return (
            {"datasetInputPath": source, "autoloaderOptions": {"cloudFiles.maxFilesPerTrigger": "1", **(options or {})}},
            {"datasetOuputPath": f"{tmp_path}/{name}", "checkpointPath": f"{tmp_path}/{name}_checkpoint", **output},
        )

    return build


# --- whole tables ---


def failing(df):
    """The frame, of which the last task fails while it is written."""
    return df.repartition(4, "id").withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))


def test_a_write_cut_off_half_way_leaves_the_table_whole(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_version(spark.range(100), path)
    with pytest.raises(Exception, match="lost"):
        write_version(failing(spark.range(50, 150)), path)
    assert sorted(r["id"] for r in read_current(spark, path).collect()) == list(range(100))
    write_version(spark.range(7), path, keep=1)
    assert read_current(spark, path).count() == 7
    assert len(list((tmp_path / "t").glob("version=*"))) == 1  # what was cut off is gone too


def test_a_reader_keeps_its_version_while_the_next_one_is_written(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_version(spark.range(5), path)
    before = read_current(spark, path)
    write_version(spark.range(9), path)
    assert (before.count(), read_current(spark, path).count()) == (5, 9)


def test_partition_values_of_a_version_keep_their_type(spark, tmp_path):
    rows = spark.createDataFrame([(1, "007"), (2, None)], "n int, code string")
    write_version(rows, f"{tmp_path}/t", partition_by=["code"])
    got = read_current(spark, f"{tmp_path}/t")
    assert got.columns == ["n", "code"] and sorted(map(tuple, got.collect())) == [(1, "007"), (2, None)]


def test_a_plain_table_is_read_as_it_is(spark, tmp_path):
    write_batch(spark.range(3), f"{tmp_path}/t")
    assert read_current(spark, f"{tmp_path}/t").count() == 3


def test_jobs_read_tables_written_by_version(spark, flights, tmp_path):
    flights({}, {}, {"CRSDepTime": 601}).write.parquet(f"{tmp_path}/raw")
    paths = [f"{tmp_path}/{layer}_YYYY_MM_DD" for layer in ("bronze", "silver", "gold")]
    for _ in range(2):
        bronze_batch(spark, f"{tmp_path}/raw", paths[0], RUN, replace="version")
        silver_batch(spark, *paths[:2], RUN, replace="version")
        gold = gold_batch(spark, "daily_route", *paths[1:], RUN, partition_by=["OriginCityName"], replace="version")
    (row,) = read_current(spark, gold).collect()
    assert row["flights_count"] == 2
    with pytest.raises(ValueError, match="replace"):
        bronze_batch(spark, f"{tmp_path}/raw", paths[0], RUN, replace="all")


# --- partitions ---


def test_a_rerun_of_one_date_leaves_the_other_files_untouched(spark, flights, tmp_path):
    def run(day, *rows):
        flights(*rows).write.mode("overwrite").parquet(f"{tmp_path}/raw")
        bronze_batch(spark, f"{tmp_path}/raw", f"{tmp_path}/bronze", date(2024, 3, day), partition_by=["ingestion_date"], replace="partitions")

    def files():
        return {p: p.stat().st_mtime_ns for p in (tmp_path / "bronze").rglob("*.parquet")}

    for day in (1, 2, 3):
        run(day, {"CRSDepTime": day})
    before = files()
    run(2, {"CRSDepTime": 20}, {"CRSDepTime": 21})
    after = files()
    same = {p for p in before if after.get(p) == before[p]}
    assert {p.parent.name for p in same} == {"ingestion_date=2024-03-01", "ingestion_date=2024-03-03"}
    got = read_batch(spark, f"{tmp_path}/bronze").select("ingestion_date", "CRSDepTime").collect()
    assert sorted((r[0].day, r[1]) for r in got) == [(1, 1), (2, 20), (2, 21), (3, 3)]


def test_only_a_partitioned_overwrite_replaces_partitions(spark, tmp_path):
    for how in ({}, {"partition_by": ["id"], "mode": "append"}):
        with pytest.raises(ValueError):
            write_batch(spark.range(3), f"{tmp_path}/t", replace_partitions=True, **how)


def test_a_whole_overwrite_replaces_whatever_the_session_says(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n int, k string")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_batch(rows, f"{tmp_path}/t", partition_by=["k"])
        write_batch(rows.where("n = 1"), f"{tmp_path}/t", partition_by=["k"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert read_batch(spark, f"{tmp_path}/t").count() == 1


# --- counts of streams ---


@pytest.mark.parametrize("stored", [False, True])
def test_counts_of_micro_batches(spark, flights, config, tmp_path, stored):
    for rows in ([{}, {}], [{}, {"CRSDepTime": 601}], [{}, {}, {}]):
        flights(*rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    job = config(f"{tmp_path}/in", "silver")
    silver_stream(spark, *job, stored=stored)
    silver_stream(spark, *job, stored=stored)  # nothing new
    flights({"CRSDepTime": 602}).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    silver_stream(spark, *job, stored=stored)
    got = sorted((r["rows_in"], r["rows_out"]) for r in read_counts(spark, job[1]["datasetOuputPath"]).collect())
    assert sum(n for n, _ in got) == 8 and sum(n for _, n in got) == 3 and len(got) == 4
    assert read_counts(spark, f"{tmp_path}/none").collect() == []


def test_counts_of_bronze_and_of_gold_by_arrival(spark, flights, config, tmp_path):
    flights({}, {}, {"DestCityName": "Lima"}).coalesce(1).write.parquet(f"{tmp_path}/in")
    bronze, gold = config(f"{tmp_path}/in", "bronze"), config(f"{tmp_path}/in", "gold")
    bronze_stream(spark, *bronze)
    gold_stream(spark, *gold, by_arrival=True)
    totals = [read_counts(spark, job[1]["datasetOuputPath"]).agg(F.sum("rows_in"), F.sum("rows_out")).first() for job in (bronze, gold)]
    assert [tuple(t) for t in totals] == [(3, 3), (3, 2)]
    assert read_batch(spark, bronze[1]["datasetOuputPath"]).count() == 3  # the counts beside it aren't rows of it


# --- records that can't be parsed ---

LINES = ['{"Year": 2024, "Distance": 9.5}', '{"Year": 20', "", '{"Year": "x", "more": 1}', "{}"]


def stored_rows(frame):
    return sorted(((r["Year"], r["Distance"], r["_rescued_data"]) for r in frame.collect()), key=repr)


EXPECTED = sorted(
    [
        (2024, 9.5, None),
        (None, None, '{"_corrupt_record":"{\\"Year\\": 20"}'),
        (None, None, '{"Year":"x","more":1}'),
        (None, None, None),
    ],
    key=repr,
)


def test_broken_json_lines_stay_in_batch(spark, tmp_path):
    (tmp_path / "in.json").write_text("\n".join(LINES))
    how = {"input_fmt": "json", "rescue_column": "_rescued_data"}
    path = bronze_batch(spark, f"{tmp_path}/in.json", f"{tmp_path}/out", RUN, **how)
    got = read_batch(spark, path)
    assert stored_rows(got) == EXPECTED and got.columns == [*FLIGHT_SCHEMA.names, "_rescued_data"]


@pytest.mark.parametrize("by_file_schema", [False, True])
def test_broken_json_lines_stay_on_streams(spark, config, tmp_path, by_file_schema):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("\n".join(LINES))
    job = config(f"{tmp_path}/in", "bronze", {"cloudFiles.format": "json", "cloudFiles.rescuedDataColumn": "_rescued_data"})
    bronze_stream(spark, *job, by_file_schema=by_file_schema)
    path = job[1]["datasetOuputPath"]
    assert stored_rows(read_bronze(spark, path) if by_file_schema else read_batch(spark, path)) == EXPECTED


def test_csv_lines_of_another_width_stay(spark, config, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("Year,Distance\n2024,9.5\n2023,1.5,left over\n2022\n")
    options = {"cloudFiles.format": "csv", "header": "true", "cloudFiles.rescuedDataColumn": "_rescued_data"}
    job = config(f"{tmp_path}/in", "bronze", options)
    bronze_stream(spark, *job)
    assert stored_rows(read_batch(spark, job[1]["datasetOuputPath"])) == [
        (2022, None, '{"_corrupt_record":"2022"}'),
        (2023, 1.5, '{"_corrupt_record":"2023,1.5,left over"}'),
        (2024, 9.5, None),
    ]


def test_the_corrupt_column_stands_once(spark):
    once = with_corrupt_record("a int, _corrupt_record string")
    assert once.names == ["a", CORRUPT_RECORD] == with_corrupt_record(once).names


def test_parquet_has_no_corrupt_records(spark, flights, tmp_path):
    flights({}).write.parquet(f"{tmp_path}/in")
    assert read_batch(spark, f"{tmp_path}/in", corrupt_records=True).columns == FLIGHT_SCHEMA.names
    stream = read_stream(spark, f"{tmp_path}/in", FLIGHT_SCHEMA, corrupt_records=True)
    assert stream.columns == FLIGHT_SCHEMA.names


@pytest.mark.parametrize("glob, rows", [(None, 3), ("*.parquet", 1)])
def test_by_file_schema_takes_files_of_any_name(spark, flights, config, tmp_path, glob, rows):
    for n, name in enumerate(("a.parquet", "b", "c.PARQUET", "_hidden", ".dot")):
        flights({"CRSDepTime": n}).coalesce(1).write.parquet(f"{tmp_path}/w{n}")
        (tmp_path / "in").mkdir(exist_ok=True)
        next((tmp_path / f"w{n}").glob("*.parquet")).rename(tmp_path / "in" / name)
    options = {"cloudFiles.rescuedDataColumn": "_rescued_data"} | ({"pathGlobFilter": glob} if glob else {})
    job = config(f"{tmp_path}/in", "bronze", options)
    bronze_stream(spark, *job, by_file_schema=True)
    assert read_bronze(spark, job[1]["datasetOuputPath"]).count() == rows


# --- files that were taken ---


def test_consumed_files_are_archived_and_old_ones_still_taken(spark, flights, config, tmp_path):
    import os
    import time

    def add(n, days=0):
        flights({"CRSDepTime": n}).coalesce(1).write.parquet(f"{tmp_path}/w{n}")
        file = next((tmp_path / f"w{n}").glob("*.parquet"))
        os.utime(file, (time.time() - days * 86_400,) * 2)
        (tmp_path / "in dir").mkdir(exist_ok=True)
        file.rename(tmp_path / "in dir" / f"a b%{n}.parquet")

    job = config(f"{tmp_path}/in dir", "bronze", {"archivePath": f"{tmp_path}/archive"})
    add(1)
    add(2, days=40)
    bronze_stream(spark, *job)
    bronze_stream(spark, *job)  # nothing new
    add(3, days=30)
    bronze_stream(spark, *job)
    add(4)
    bronze_stream(spark, *job)
    got = sorted(r["CRSDepTime"] for r in read_batch(spark, job[1]["datasetOuputPath"]).collect())
    assert got == [1, 2, 3, 4]
    assert len(list((tmp_path / "in dir").glob("*.parquet"))) == 1
    assert len([p for p in (tmp_path / "archive").rglob("*.parquet") if p.is_file()]) == 3


def test_files_that_a_stream_took_are_not_renewed(spark, flights, config, tmp_path):
    import os
    import time

    from delayworks.sources import renew_old_files

    flights({}).coalesce(1).write.parquet(f"{tmp_path}/in")
    job = config(f"{tmp_path}/in", "bronze")
    assert renew_old_files(spark, f"{tmp_path}/in", job[1]["checkpointPath"], 3600) == 0
    for file in (tmp_path / "in").glob("*.parquet"):
        os.utime(file, (time.time() - 86_400,) * 2)
    bronze_stream(spark, *job)
    assert renew_old_files(spark, f"{tmp_path}/in", job[1]["checkpointPath"], 3600) == 0
    assert renew_old_files(spark, f"{tmp_path}/in", f"{tmp_path}/other", 3600) == 1
