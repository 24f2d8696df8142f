"""Every registered query against its SQL, and the plans behind them."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from checks.compare import differences
from checks.queries import QUERIES

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    assert differences(spark, SMALL, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= contract.queries().keys()
    assert set(QUERIES) <= contract.oracle_sql().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() == 414
    assert result.columns[:3] == ["Year", "Month", "Marketing_Airline_Network"]


@pytest.fixture
def plan(spark, capsys):
    def text(df):
        df.explain("formatted")
        return capsys.readouterr().out

    return text


def test_silver_is_one_shuffle_with_copies_dropped_before_it(spark, tmp_path, plan):
    from delayworks.fixtures import FLIGHT_ORDER, derive_flights
    from delayworks.plans import silver_transform

    derive_flights(spark, SMALL, keep_order=True).write.parquet(f"{tmp_path}/f")
    text = plan(silver_transform(spark.read.parquet(f"{tmp_path}/f"), FLIGHT_ORDER))
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 1
    assert tree.count("WindowGroupLimit") == 2
    assert "Cartesian" not in tree and "NestedLoop" not in tree and "Python" not in tree


def test_unordered_dedup_of_flights_is_a_hash_aggregate(spark, tmp_path, plan):
    from delayworks.fixtures import derive_flights
    from delayworks.operators import dedup
    from delayworks.schema import FLIGHT_KEY

    derive_flights(spark, SMALL).write.parquet(f"{tmp_path}/f")
    tree = plan(dedup(spark.read.parquet(f"{tmp_path}/f"), FLIGHT_KEY)).split("\n\n")[0]
    assert tree.count("HashAggregate") == 2 and "SortAggregate" not in tree


@pytest.mark.parametrize(
    "kind, columns",
    [
        ("daily_route", 8 + 1),
        ("monthly_carrier", 6),
        ("route_performance", 7),
    ],
)
def test_gold_scans_only_its_columns(spark, tmp_path, plan, kind, columns):
    from delayworks.fixtures import derive_flights
    from delayworks.plans import GOLD_PLANS, clean_flights

    clean_flights(derive_flights(spark, SMALL)).write.parquet(f"{tmp_path}/s")
    text = plan(GOLD_PLANS[kind](spark.read.parquet(f"{tmp_path}/s")))
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert schema.count(":") == columns
    assert text.split("\n\n")[0].count("Exchange") == 1


def test_gold_partials_are_one_shuffle(spark, tmp_path, plan):
    from delayworks.fixtures import derive_flights
    from delayworks.streaming import daily_route_partials

    derive_flights(spark, SMALL).write.parquet(f"{tmp_path}/s")
    tree = plan(daily_route_partials(spark.read.parquet(f"{tmp_path}/s"))).split("\n\n")[0]
    assert tree.count("Exchange") == 1 and tree.count("HashAggregate") == 2


def test_counted_step_reads_its_input_once(spark, tmp_path):
    from delayworks.operators import profile_step
    from delayworks.sinks import write_batch

    seen = spark.sparkContext.accumulator(0)

    def tap(rows):
        for row in rows:
            seen.add(1)
            yield row

    before = spark.createDataFrame(spark.range(50).rdd.mapPartitions(tap), "id long")
    seen.value = 0
    counts = profile_step(before, lambda d: d.where("id % 5 = 0"), lambda d: write_batch(d, f"{tmp_path}/o"))
    assert [tuple(r) for r in counts.collect()] == [("before", 50), ("after", 10)]
    assert seen.value == 50 and spark.read.parquet(f"{tmp_path}/o").count() == 10
