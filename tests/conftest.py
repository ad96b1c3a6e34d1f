from __future__ import annotations

import datetime as dt

import pytest

from medallion.session import build_session

RAW_SCHEMA = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz,"
    " passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string,"
    " PULocationID bigint, DOLocationID bigint, payment_type bigint, fare_amount double,"
    " extra double, mta_tax double, tip_amount double, tolls_amount double,"
    " improvement_surcharge double, total_amount double, congestion_surcharge double,"
    " Airport_fee double, cbd_congestion_fee double"
)
BASE_TRIP = {
    "VendorID": 1,
    "tpep_pickup_datetime": dt.datetime(2025, 1, 5, 10, 0),
    "tpep_dropoff_datetime": dt.datetime(2025, 1, 5, 10, 20),
    "passenger_count": 1.0,
    "trip_distance": 4.0,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 1,
    "DOLocationID": 2,
    "payment_type": 1,
    "fare_amount": 20.0,
    "extra": 0.0,
    "mta_tax": 0.5,
    "tip_amount": 3.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 25.0,
    "congestion_surcharge": 2.5,
    "Airport_fee": 0.0,
    "cbd_congestion_fee": 0.75,
}
ZONE_ROWS = [
    ("1", "EWR", "Newark Airport", "EWR"),
    ("2", " Queens ", "Jamaica Bay", "Boro Zone"),
    ("264", "Unknown", "N/A", "N/A"),
    ("265", "N/A", "Outside", "N/A"),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_trips(spark):
    """Raw trips: the base trip with the given changes, one row per dict."""

    def make(*changes: dict):
        rows = [tuple({**BASE_TRIP, **change}.values()) for change in changes]
        return spark.createDataFrame(rows, RAW_SCHEMA)

    return make


def plan(df) -> str:
    """The physical plan; after an action the one that really ran."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
