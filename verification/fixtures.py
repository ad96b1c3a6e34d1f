"""Trip- and zone-shaped inputs derived from whole test tables.

No row of a table is left out.  The residues below only choose which rows carry which
fault (a missing value, a copy, an unknown code), so every rule meets some rows at every
scale.  The expressions are plain SQL, and the oracle builds its input from the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MINUTE = "(INTERVAL '1' MINUTE)"
PICKUP = f"o_orderdate + {MINUTE} * cast(l_partkey % 1440 as int)"
DROPOFF = f"o_orderdate + {MINUTE} * cast(l_partkey % 1440 + l_quantity * 8 - 20 as int)"
FARE = "floor(l_extendedprice) / 200 - 10"

# cp is 0 for each line, 1 for a copy, 2 for a twin with another total.
TRIPS = {
    "VendorID": "cast(l_suppkey % 4 as double)",
    "tpep_pickup_datetime": f"case when l_orderkey % 101 <> 0 then {PICKUP} end",
    "tpep_dropoff_datetime": f"case when l_orderkey % 89 <> 0 then {DROPOFF} end",
    "passenger_count": "case when l_linenumber <> 7 then cast(l_linenumber - 1 + cp as double) end",
    "trip_distance": "case when l_orderkey % 97 = 0 then null when l_partkey % 107 = 0"
    " then cast(0 as double) else l_extendedprice / 1000 end",
    "RatecodeID": "cast(case when l_partkey % 8 = 7 then 99 else l_partkey % 8 end as double)",
    "store_and_fwd_flag": "case l_returnflag when 'R' then ' y ' when 'N' then 'n' end",
    "PULocationID": "case when l_suppkey <> 50 then l_suppkey % 27 end",
    "DOLocationID": "case when o_custkey % 109 <> 0 then o_custkey % 25 end",
    "payment_type": "cast(l_linenumber as bigint)",
    "fare_amount": f"case when l_partkey % 103 <> 0 then {FARE} end",
    "extra": "cast(l_linenumber * 0.5 as double)",
    "mta_tax": "cast(0.5 as double)",
    "tip_amount": "l_discount * 50 - case when l_orderkey % 31 = 0 then 1 else 0 end",
    "tolls_amount": "cast(floor(l_discount * 100) as double)",
    "improvement_surcharge": "cast(1 as double)",
    "total_amount": f"case when l_partkey % 113 <> 0 then {FARE} + floor(l_tax * 1000)"
    " + floor(l_discount * 1000) + case when cp = 2 then 1 else 0 end end",
    "congestion_surcharge": "cast(2.5 as double)",
    "Airport_fee": "cast(case l_suppkey % 10 when 0 then 1.75 when 1 then null else 0 end"
    " as double)",
    "cbd_congestion_fee": "cast(0.75 as double)",
}

# Every column as text, and some of it unusable.
BAD_TEXT = {
    "VendorID": "case when l_partkey % 19 = 0 then 'x' else {} end",
    "passenger_count": "case when l_partkey % 23 = 0 then '3000000000' else {} end",
    "tpep_pickup_datetime": "case when l_partkey % 29 = 0 then 'bad' else {} end",
    "total_amount": "case when l_partkey % 31 = 0 then '' else {} end",
}
TRIPS_TEXT = {
    name: BAD_TEXT.get(name, "{}").format(f"cast({expr} as string)") for name, expr in TRIPS.items()
}

FILE_MONTH = {
    "file_month": "concat(cast(year(o_orderdate) as string), '-',"
    " right(concat('0', cast(month(o_orderdate) as string)), 2))"
}

# Names come from the source key: key 6 borrows those of key 5.
SOURCE_KEY = "case n_nationkey when 6 then 5 else n_nationkey end"
ZONES = {
    "LocationID": "cast(n_nationkey as string)",
    "Borough": "case n_nationkey when 23 then 'N/A' when 24 then ''"
    " else concat(' ', source_region, ' ') end",
    "Zone": "source_name",
    "service_zone": "case n_nationkey when 22 then 'N/A'"
    " else concat('Zone ', cast(n_regionkey as string)) end",
}
# One row more for key 3 under another name, and one whose id is no number.
ZONES_EXTRA = {
    3: ("'3'", "'Elsewhere'", "'Second name'", "'Zone 9'"),
    4: ("'x'", "'Nowhere'", "'No id'", "'Zone 9'"),
}


def _columns(expressions: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in expressions.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A bench stores the raw trips of a folder once and names the place here.
STORED: dict[str, str] = {}


def trips(
    spark: SparkSession, sf_dir: str, expressions: dict[str, str] | None = None
) -> DataFrame:
    """One raw trip per line of an order, plus copies of some.

    The columns come out of a generator, so that Catalyst treats them like those of a
    file: filters and casts above do not repeat the expressions they are made of.
    """
    if expressions is None and sf_dir in STORED:
        return spark.read.parquet(STORED[sf_dir])
    return _made(_lines(spark, sf_dir), expressions or TRIPS)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines with their orders."""
    lines = table(spark, sf_dir, "lineitem")
    # Orders grow with the data, so both sides are shuffled whatever the file sizes say.
    orders = table(spark, sf_dir, "orders").hint("merge")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])


def _made(lines: DataFrame, expressions: dict[str, str]) -> DataFrame:
    copies = F.expr(
        "explode(case l_orderkey % 50 when 0 then array(0, 1) when 1 then array(0, 2)"
        " else array(0) end)"
    )
    made = ", ".join(_columns(expressions))
    return lines.withColumn("cp", copies).selectExpr(f"inline(array(struct({made})))")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw lookup row per nation, two of them sharing a name, plus two faulty rows."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    named = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").alias("source_key"),
        F.col("n_name").alias("source_name"),
        F.col("r_name").alias("source_region"),
    )
    rows = nation.join(named, F.expr(SOURCE_KEY) == F.col("source_key")).selectExpr(
        *_columns(ZONES)
    )
    for key, values in ZONES_EXTRA.items():
        extra = nation.filter(F.col("n_nationkey") == key)
        rows = rows.unionByName(extra.selectExpr(*_columns(dict(zip(ZONES, values)))))
    return rows


def months(spark: SparkSession, sf_dir: str) -> list[str]:
    """Every month from the first to the last order date, as a run configuration names them."""
    span = (
        table(spark, sf_dir, "orders")
        .agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
        .first()
    )
    first = span["first"].year * 12 + span["first"].month - 1
    last = span["last"].year * 12 + span["last"].month - 1
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first, last + 1)]


MONTH_FOLDERS = "file_month={month}"


def write_months(
    spark: SparkSession, sf_dir: str, root: str, without: str | None = None, odd: bool = False
) -> None:
    """Write the trips as one folder of Parquet files per month of their order date.

    With ``odd`` the first month lacks the congestion fee and has the vendor id as integer.
    """
    lines = _lines(spark, sf_dir).withColumns({n: F.expr(e) for n, e in FILE_MONTH.items()})
    if without:
        lines = lines.filter(F.col("file_month") != without)
    if odd:
        first = months(spark, sf_dir)[0]
        early = _made(lines.filter(F.col("file_month") == first), TRIPS).drop("cbd_congestion_fee")
        early.withColumn("VendorID", F.col("VendorID").cast("int")).write.parquet(f"{root}/file_month={first}")
        lines = lines.filter(F.col("file_month") != first)
    trips_by_month(lines).write.mode("append").partitionBy("file_month").parquet(root)


def trips_by_month(lines: DataFrame) -> DataFrame:
    """Trips with their ``file_month``, collected by it.

    The lines move before trips are made of them, which have twice the columns, and copies.
    """
    return _made(lines.hint("rebalance", "file_month"), {**TRIPS, "file_month": "file_month"})


def write_zones(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the lookup as CSV, keeping the blanks around names."""
    (
        zones(spark, sf_dir)
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
