from datetime import date

import pytest
from pyspark.sql import functions as F

from delayworks.operators import (
    clamp_min,
    conform,
    dedup,
    fill_nulls,
    flag_at_least,
    profile_counts,
    rescue_columns,
    stamp_arrival_time,
    stamp_ingestion,
)
from delayworks.schema import CLEANED_MEASURES, FLIGHT_KEY, FLIGHT_SCHEMA

NAN = float("nan")


def values(df, name):
    return [row[name] for row in df.select(name).collect()]


# --- stamping ---


def test_stamp_comes_first_and_keeps_the_rest(spark):
    stamped = stamp_ingestion(spark.range(2), run_date=date(2024, 3, 15))
    assert stamped.columns == ["ingestion_date", "id"]
    assert values(stamped, "ingestion_date") == [date(2024, 3, 15)] * 2
    assert stamped.schema["ingestion_date"].dataType.typeName() == "date"


def test_stamp_replaces_an_earlier_stamp(flights):
    once = stamp_ingestion(flights({"ingestion_date": date(2020, 1, 1)}), run_date=date(2024, 3, 15))
    assert once.columns.count("ingestion_date") == 1
    assert values(once, "ingestion_date") == [date(2024, 3, 15)]


def test_stamp_with_two_names_uses_the_current_date(spark):
    row = stamp_ingestion(spark.range(1), ["ingestion_date", "fecha"]).withColumn(
        "today", F.current_date()
    ).first()
    assert row["ingestion_date"] == row["fecha"] == row["today"]


def test_arrival_time_is_one_timestamp_per_job(spark):
    stamped = stamp_arrival_time(spark.range(0, 1000, 1, 8))
    assert stamped.schema["eventTime"].dataType.typeName() == "timestamp"
    assert stamped.select("eventTime").distinct().count() == 1


# --- conforming ---


def test_conform_casts_every_declared_column(flights):
    typed = flights({"DepTime": 605, "ingestion_date": date(2024, 3, 15)})
    as_text = typed.select(*(F.col(c).cast("string").alias(c) for c in typed.columns))
    fitted = conform(as_text, FLIGHT_SCHEMA)
    assert fitted.schema == FLIGHT_SCHEMA
    assert fitted.collect() == typed.collect()


def test_conform_skips_absent_and_keeps_undeclared_columns(flights):
    fitted = conform(flights({}).drop("WheelsOn").withColumn("surprise", F.lit("s")), FLIGHT_SCHEMA)
    assert "WheelsOn" not in fitted.columns
    assert fitted.columns[-1] == "surprise" and len(fitted.columns) == 31


def test_conform_on_a_bad_value(spark):
    bad = spark.createDataFrame([("x",), ("7",)], "CRSDepTime string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(bad, FLIGHT_SCHEMA).collect()
    assert values(conform(bad, FLIGHT_SCHEMA, on_error="null"), "CRSDepTime") == [None, 7]
    with pytest.raises(ValueError):
        conform(bad, FLIGHT_SCHEMA, on_error="ignore")


def test_conform_nulls_what_cannot_be_cast_at_all_or_without_loss(spark):
    raw = spark.sql("SELECT DATE'2024-01-02' AS Year, 600.5D AS CRSDepTime, 7.0D AS CRSArrTime")
    assert conform(raw, FLIGHT_SCHEMA, on_error="null").collect() == [(None, None, 7)]


def test_conform_handles_names_with_dots(spark):
    raw = spark.createDataFrame([("b", "7")], "`a.b` string, Year string")
    assert [tuple(r) for r in conform(raw, FLIGHT_SCHEMA).collect()] == [("b", 7)]


def test_rescue_packs_failed_casts_and_unknown_columns(spark):
    rows = [("7", "x", "s"), ("8", "9.5", None), (None, None, None)]
    raw = spark.createDataFrame(rows, "Year string, Distance string, surprise string")
    out = rescue_columns(raw, FLIGHT_SCHEMA)
    assert out.columns == [*FLIGHT_SCHEMA.names, "_rescued_data"]
    assert [f.dataType for f in out.schema][:-1] == [f.dataType for f in FLIGHT_SCHEMA]
    got = [(r["Year"], r["Distance"], r["Month"], r["_rescued_data"]) for r in out.collect()]
    assert got == [
        (7, None, None, '{"Distance":"x","surprise":"s"}'),
        (8, 9.5, None, None),
        (None, None, None, None),
    ]


def test_rescue_with_types_that_spark_refuses_to_cast(spark):
    raw = spark.sql("SELECT DATE'2024-01-02' AS Year, array(1, 2) AS Distance, 3 AS FlightDate")
    row = rescue_columns(raw, FLIGHT_SCHEMA).first()
    assert (row["Year"], row["Distance"], row["FlightDate"]) == (None, None, None)
    assert row["_rescued_data"] == '{"Year":"2024-01-02","FlightDate":3,"Distance":[1,2]}'


def test_rescue_takes_numbers_that_lose_digits(spark):
    raw = spark.sql("SELECT 2020.7D AS Year, 2.0D AS Month, 9007199254740993L AS Distance, 8L AS AirTime")
    row = rescue_columns(raw, FLIGHT_SCHEMA).first()
    assert (row["Year"], row["Month"], row["Distance"], row["AirTime"]) == (None, 2, None, 8.0)
    assert row["_rescued_data"] == '{"Year":2020.7,"Distance":9007199254740993}'


def test_rescue_of_a_fitting_frame_is_null(flights):
    out = rescue_columns(flights({}), FLIGHT_SCHEMA)
    assert values(out, "_rescued_data") == [None]
    assert out.drop("_rescued_data").collect() == flights({}).collect()


# --- cleaning ---


def test_fill_takes_null_and_nan(flights):
    df = flights({"ArrDelayMinutes": None}, {"ArrDelayMinutes": NAN}, {"ArrDelayMinutes": -3.0})
    assert values(fill_nulls(df, ["ArrDelayMinutes"]), "ArrDelayMinutes") == [0.0, 0.0, -3.0]


def test_fill_of_an_unknown_column_fails(flights):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        fill_nulls(flights({}), ["NoSuchColumn"])


def test_clamp_leaves_null_and_nan(flights):
    df = flights(*({"DepDelay": v} for v in (-3.0, None, NAN, 4.0)))
    got = values(clamp_min(df, ["DepDelay"]), "DepDelay")
    assert got[0] == 0.0 and got[1] is None and got[2] != got[2] and got[3] == 4.0


def test_clamp_keeps_the_type(flights):
    clamped = clamp_min(flights({"DepTime": -5}), [*CLEANED_MEASURES, "DepTime"])
    assert [f.dataType for f in clamped.schema] == [f.dataType for f in FLIGHT_SCHEMA]
    assert values(clamped, "DepTime") == [0]


@pytest.mark.parametrize("minutes, flag", [(14.999, 0), (15.0, 1), (15.001, 1), (None, 0)])
def test_flag_threshold(flights, minutes, flag):
    flagged = flag_at_least(flights({"ArrDelayMinutes": minutes}), "ArrDelayMinutes", 15, "late")
    assert values(flagged, "late") == [flag]
    assert flagged.schema["late"].dataType.typeName() == "integer"


# --- duplicates ---


def test_dedup_keeps_the_first_in_order(flights):
    df = flights({"Distance": 3.0}, {"Distance": 1.0}, {"Distance": 2.0}, {"CRSDepTime": 601})
    kept = dedup(df, FLIGHT_KEY, ["Distance"])
    assert sorted(values(kept, "Distance")) == [1.0, 500.0]
    assert kept.columns == df.columns


def test_dedup_without_order_keeps_one_whole_row(flights):
    df = flights({"Distance": 3.0, "AirTime": 3.0}, {"Distance": 1.0, "AirTime": 1.0})
    (row,) = dedup(df, FLIGHT_KEY).collect()
    assert row["Distance"] == row["AirTime"]


@pytest.mark.parametrize("order", [None, ["Distance"]])
def test_dedup_treats_null_keys_as_equal(flights, order):
    df = flights({"CRSDepTime": None}, {"CRSDepTime": None, "Distance": 7.0}, {})
    assert dedup(df, FLIGHT_KEY, order).count() == 2


def test_dedup_of_a_hot_key_agrees_with_brute_force(spark):
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("k"),
        (F.col("id") * 7919 % 60_000).alias("v"),
    )
    expected = {}
    for k, v in rows.collect():
        expected[k] = min(v, expected.get(k, v))
    assert {r["k"]: r["v"] for r in dedup(rows, ["k"], ["v"]).collect()} == expected


def test_profile_counts(spark):
    counted = profile_counts(spark.range(7), spark.range(4))
    assert [tuple(r) for r in counted.collect()] == [("before", 7), ("after", 4)]


def test_day_instants_do_not_depend_on_the_time_zone(spark, flights):
    from delayworks.functions import flight_day_instant, instant_day

    df = flights(*({"FlightDate": d} for d in (date(1969, 7, 20), date(2024, 3, 31), date(2045, 1, 1))))
    days = df.select("FlightDate", flight_day_instant("FlightDate").alias("t"))
    back = days.select("FlightDate", instant_day(F.window("t", "1 day").start).alias("day"))
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert all(r["FlightDate"] == r["day"] for r in back.collect())
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
