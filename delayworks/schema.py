"""The flight table: declared fields and the column sets the layers use."""

from pyspark.sql.types import StructType

# Declared flight fields, in table order. Every field is nullable.
FLIGHT_SCHEMA = (
    StructType()
    .add("ingestion_date", "date")
    .add("Year", "long")
    .add("Month", "long")
    .add("DayofMonth", "long")
    .add("FlightDate", "date")
    .add("Marketing_Airline_Network", "string")
    .add("OriginCityName", "string")
    .add("DestCityName", "string")
    .add("CRSDepTime", "long")
    .add("DepTime", "long")
    .add("DepDelay", "double")
    .add("DepDelayMinutes", "double")
    .add("TaxiOut", "double")
    .add("WheelsOff", "long")
    .add("WheelsOn", "long")
    .add("TaxiIn", "double")
    .add("CRSArrTime", "long")
    .add("ArrTime", "long")
    .add("ArrDelay", "double")
    .add("ArrDelayMinutes", "double")
    .add("CRSElapsedTime", "double")
    .add("ActualElapsedTime", "double")
    .add("AirTime", "double")
    .add("Distance", "double")
    .add("DistanceGroup", "long")
    .add("CarrierDelay", "double")
    .add("WeatherDelay", "double")
    .add("NASDelay", "double")
    .add("SecurityDelay", "double")
    .add("LateAircraftDelay", "double")
    .add("__index_level_0__", "long")
)

# Columns that identify one scheduled flight.
FLIGHT_KEY = (
    "FlightDate",
    "Marketing_Airline_Network",
    "OriginCityName",
    "DestCityName",
    "CRSDepTime",
)

# Measures whose NULL, NaN and negative values become zero.
CLEANED_MEASURES = (
    "DepDelay",
    "DepDelayMinutes",
    "TaxiOut",
    "TaxiIn",
    "ArrDelay",
    "ArrDelayMinutes",
    "CRSElapsedTime",
    "ActualElapsedTime",
    "AirTime",
    "Distance",
    "CarrierDelay",
    "WeatherDelay",
    "NASDelay",
    "SecurityDelay",
    "LateAircraftDelay",
)

# Group keys of the three gold tables.
DAILY_ROUTE_KEY = ("Year", "Month", "DayofMonth", "OriginCityName", "DestCityName")
MONTHLY_CARRIER_KEY = ("Year", "Month", "Marketing_Airline_Network")
ROUTE_CARRIER_KEY = ("OriginCityName", "DestCityName", "Marketing_Airline_Network")

# Silver flags arrivals from this many minutes, gold counts those beyond it.
LATE_ARRIVAL_MINUTES = 15
