import sys
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from delayworks.schema import FLIGHT_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("delayworks-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# One flight; tests override what they are about.
FLIGHT = {
    "Year": 2024,
    "Month": 1,
    "DayofMonth": 2,
    "FlightDate": date(2024, 1, 2),
    "Marketing_Airline_Network": "AA",
    "OriginCityName": "Lima",
    "DestCityName": "Quito",
    "CRSDepTime": 600,
    "DepDelay": 0.0,
    "DepDelayMinutes": 0.0,
    "TaxiOut": 10.0,
    "TaxiIn": 5.0,
    "ArrDelay": 0.0,
    "ArrDelayMinutes": 0.0,
    "CRSElapsedTime": 100.0,
    "ActualElapsedTime": 100.0,
    "AirTime": 80.0,
    "Distance": 500.0,
}


@pytest.fixture
def flights(spark):
    """Builds a frame with the flight schema from dictionaries of overrides."""

    def build(*overrides):
        rows = [tuple({**FLIGHT, **o}.get(n) for n in FLIGHT_SCHEMA.names) for o in overrides]
        return spark.createDataFrame(rows, FLIGHT_SCHEMA)

    return build
