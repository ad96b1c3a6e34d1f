import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import plan
from verification import fixtures

SCHEMA = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
    " l_discount double, l_tax double, l_returnflag string, o_custkey long, o_orderdate timestamp"
)


def test_lines_move_before_trips_are_made_of_them(spark):
    day = lambda month: dt.datetime(2025, month, 3)
    rows = [(50 * i + k, 7, 8, 1, 3.0, 900.0, 0.1, 0.1, "N", 5, day(1 + i)) for i in (0, 1) for k in (0, 1, 2)]
    lines = spark.createDataFrame(rows, SCHEMA)
    month = F.expr(fixtures.FILE_MONTH["file_month"])
    trips = fixtures.trips_by_month(lines.withColumn("file_month", month))
    assert trips.columns == [*fixtures.TRIPS, "file_month"]
    found = plan(trips)
    assert 0 <= found.index("Generate inline") < found.index("REBALANCE_PARTITIONS_BY_COL")
    # Of each three lines one comes twice, and one has a twin with another total.
    assert sorted(r.file_month for r in trips.collect()) == ["2025-01"] * 5 + ["2025-02"] * 5
    made = fixtures._made(lines, fixtures.TRIPS)
    assert sorted(map(str, trips.drop("file_month").collect())) == sorted(map(str, made.collect()))
