from datetime import date

import pytest

from delayworks.operators import profile_counts
from delayworks.plans import (
    GOLD_PLANS,
    bronze_batch,
    gold_batch,
    gold_daily_route,
    gold_monthly_carrier,
    gold_route_performance,
    silver_batch,
    silver_transform,
)
from delayworks.schema import FLIGHT_SCHEMA
from delayworks.sinks import write_batch
from delayworks.sources import dated_path, read_batch

RUN = date(2024, 3, 5)


def test_silver_cleans_flags_and_removes_duplicates(flights):
    df = flights(
        {"ArrDelayMinutes": None, "DepDelay": -3.0, "Distance": float("nan")},
        {"CRSDepTime": 601, "ArrDelayMinutes": 15.0},
        {"CRSDepTime": 601, "ArrDelayMinutes": 90.0},
    )
    silver = silver_transform(df, order_by=["ArrDelayMinutes"])
    assert silver.columns == [*FLIGHT_SCHEMA.names, "is_delayed_15"]
    got = [
        (r["CRSDepTime"], r["DepDelay"], r["ArrDelayMinutes"], r["Distance"], r["is_delayed_15"])
        for r in silver.orderBy("CRSDepTime").collect()
    ]
    assert got == [(600, 0.0, 0.0, 0.0, 0), (601, 0.0, 15.0, 500.0, 1)]


def test_silver_is_idempotent(flights):
    df = flights({"DepDelay": -3.0}, {"CRSDepTime": 601, "AirTime": None}, {"CRSDepTime": 601})
    once = silver_transform(df, order_by=["AirTime"])
    twice = silver_transform(once, order_by=["AirTime"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_daily_route(flights):
    df = flights(*({"ArrDelayMinutes": m, "TaxiOut": m} for m in (14.999, 15.0, 15.001, None)))
    (row,) = gold_daily_route(df).collect()
    assert row["flights_count"] == 4
    assert row["arr_delay_gt15_count"] == 1
    assert row["arr_delay_gt15_pct"] == 25.0
    assert row["avg_taxi_out"] == pytest.approx(15.0)
    assert row["avg_taxi_in"] == 5.0


def test_monthly_carrier_late_with_null(flights):
    df = flights(
        {"DepDelayMinutes": None, "ArrDelayMinutes": 5.0},
        {"DepDelayMinutes": 2.0, "ArrDelayMinutes": None, "Distance": 100.0},
        {"DepDelayMinutes": None, "ArrDelayMinutes": 0.0, "Distance": None},
        {"Marketing_Airline_Network": "DL"},
    )
    rows = {r["Marketing_Airline_Network"]: r for r in gold_monthly_carrier(df).collect()}
    assert (rows["AA"]["total_flights"], rows["AA"]["delay_flights"]) == (3, 2)
    assert rows["AA"]["delay_rate_pct"] == pytest.approx(200 / 3)
    assert rows["AA"]["avg_departure_delay_min"] == 2.0
    assert rows["AA"]["total_distance_miles"] == 600.0
    assert rows["AA"]["avg_distance_miles"] == 300.0
    assert rows["DL"]["delay_flights"] == 0


def test_route_performance_average_skips_half_known_rows(flights):
    df = flights(
        {"DepDelayMinutes": None, "ArrDelayMinutes": 5.0},
        {"DepDelayMinutes": 2.0, "ArrDelayMinutes": 4.0, "AirTime": 60.0},
    )
    (row,) = gold_route_performance(df).collect()
    assert row["avg_overall_delay_min"] == 6.0
    assert row["delay_flights"] == 2
    assert row["avg_air_time_min"] == 70.0


def test_counts_of_every_gold_table_add_up(flights):
    silver = silver_transform(
        flights(*({"CRSDepTime": i, "Month": i % 3, "OriginCityName": f"c{i % 4}"} for i in range(40)))
    )
    for kind, plan in GOLD_PLANS.items():
        name = "flights_count" if kind == "daily_route" else "total_flights"
        assert sum(r[name] for r in plan(silver).collect()) == 40


def test_dated_path():
    assert dated_path("a/YYYY_MM_DD/b_YYYY_MM_DD", RUN) == "a/2024_03_05/b_2024_03_05"
    assert dated_path("a/b", RUN) == "a/b"


def test_batch_jobs_from_files_to_gold(spark, flights, tmp_path):
    raw = flights({}, {}, {"CRSDepTime": 601, "ArrDelayMinutes": 30.0}).drop("ingestion_date")
    write_batch(raw, f"{tmp_path}/raw")
    bronze, silver, gold = (f"{tmp_path}/{layer}_YYYY_MM_DD.parquet" for layer in "bsg")
    assert bronze_batch(spark, f"{tmp_path}/raw", bronze, RUN) == f"{tmp_path}/b_2024_03_05.parquet"
    silver_path = silver_batch(spark, bronze, silver, RUN)
    gold_path = gold_batch(spark, "daily_route", silver, gold, RUN, partition_by=["OriginCityName"])
    stored = read_batch(spark, silver_path)
    assert [r["ingestion_date"] for r in stored.collect()] == [RUN, RUN]
    counts = profile_counts(read_batch(spark, dated_path(bronze, RUN)), stored)
    assert [r["rows"] for r in counts.collect()] == [3, 2]
    result = read_batch(spark, gold_path)
    assert result.columns[-1] == "OriginCityName"
    assert [(r["flights_count"], r["arr_delay_gt15_count"]) for r in result.collect()] == [(2, 1)]


def test_a_second_run_replaces_the_day(spark, flights, tmp_path):
    write_batch(flights({}), f"{tmp_path}/raw")
    for _ in range(2):
        path = bronze_batch(spark, f"{tmp_path}/raw", f"{tmp_path}/b_YYYY_MM_DD", RUN)
    assert read_batch(spark, path).count() == 1


def test_errors_are_raised(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        silver_batch(spark, f"{tmp_path}/none_YYYY_MM_DD", f"{tmp_path}/s", RUN)


def test_partitioned_write_splits_a_value_that_holds_most_rows(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 10 < 7, "hot").otherwise("cold").alias("city"),
        F.xxhash64("id").alias("a"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        write_batch(rows, f"{tmp_path}/out", partition_by=["city"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = read_batch(spark, f"{tmp_path}/out")
    assert stored.groupBy("city").count().orderBy("city").collect() == [("cold", 120_000), ("hot", 280_000)]
    assert len(list((tmp_path / "out" / "city=hot").glob("*.parquet"))) > 2


def test_silver_shuffle_grows_with_the_bronze_flights(spark, flights, tmp_path, monkeypatch):
    from delayworks.plans import batch

    write_batch(flights(*({"CRSDepTime": t} for t in range(40))), f"{tmp_path}/raw")
    bronze = bronze_batch(spark, f"{tmp_path}/raw", f"{tmp_path}/b_YYYY_MM_DD", RUN)
    monkeypatch.setattr(batch, "ROWS_PER_TASK", 5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        silver = silver_batch(spark, f"{tmp_path}/b_YYYY_MM_DD", f"{tmp_path}/s_YYYY_MM_DD", RUN)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "2"
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert read_batch(spark, silver).count() == read_batch(spark, bronze).count() == 40
    # 40 flights, at most 5 a task: 8 partitions of the flight key, of which two at most before
    assert len(list((tmp_path / "s_2024_03_05").glob("*.parquet"))) > 2
