"""The same results in plain SQL for DuckDB, written against the semantics, not the plans."""

from __future__ import annotations

from verification.fixtures import FILE_MONTH, SOURCE_KEY, TRIPS, TRIPS_TEXT, ZONES, ZONES_EXTRA


def _select(expressions: dict[str, str]) -> str:
    return ",\n    ".join(f"{expr} AS {name}" for name, expr in expressions.items())


def _raw_trips(expressions: dict[str, str]) -> str:
    return f"""
  SELECT {_select(expressions)}
  FROM (
    SELECT *, 0 AS cp FROM lineitem
    UNION ALL SELECT *, 1 FROM lineitem WHERE l_orderkey % 50 = 0
    UNION ALL SELECT *, 2 FROM lineitem WHERE l_orderkey % 50 = 1
  ) lines JOIN orders ON l_orderkey = o_orderkey"""


RAW_ZONES = f"""
  SELECT {_select(ZONES)}
  FROM nation JOIN (
    SELECT n_nationkey AS source_key, n_name AS source_name, r_name AS source_region
    FROM nation JOIN region ON n_regionkey = r_regionkey) named ON {SOURCE_KEY} = source_key
""" + "".join(
    f"  UNION ALL SELECT {', '.join(values)} FROM nation WHERE n_nationkey = {key}\n"
    for key, values in ZONES_EXTRA.items()
)

# A Spark CSV scan with default options reads an empty field as NULL, quoted or not.
RAW_ZONES_CSV = f"""
  SELECT {', '.join(f"nullif({c}, '') AS {c}" for c in ZONES)} FROM ({RAW_ZONES}) z"""

ZONES_CLEAN = """
  SELECT location_id,
    CASE WHEN borough IN ('Unknown', 'N/A', '') THEN 'Unknown' ELSE borough END AS borough,
    zone,
    CASE WHEN service_zone IN ('Unknown', 'N/A', '') THEN 'Unknown' ELSE service_zone END
      AS service_zone
  FROM (SELECT try_cast(LocationID AS INTEGER) AS location_id, trim(Borough) AS borough,
          trim(Zone) AS zone, trim(service_zone) AS service_zone FROM raw_zones) z
  WHERE location_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY borough NULLS LAST,
    zone NULLS LAST, service_zone NULLS LAST) = 1"""

# Column names and types.
INTEGERS = ["VendorID", "passenger_count", "RatecodeID", "PULocationID", "DOLocationID", "payment_type"]


def _typed(source: str) -> str:
    columns = []
    for name in TRIPS:
        if name == "cbd_congestion_fee":
            columns.append(name)
        elif name in INTEGERS:
            columns.append(f"try_cast(trunc(try_cast({name} AS DOUBLE)) AS INTEGER) AS {name}")
        elif name == "store_and_fwd_flag":
            columns.append(f"upper(trim({name})) AS {name}")
        elif name.startswith("tpep_"):
            columns.append(f"try_cast({name} AS TIMESTAMP) AS {name}")
        else:
            columns.append(f"try_cast({name} AS DOUBLE) AS {name}")
    return f"\n  SELECT {', '.join(columns)} FROM {source}"


# Key and survivor order.
KEY = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "total_amount",
]
SURVIVOR = [
    "passenger_count",
    "RatecodeID",
    "payment_type",
    "store_and_fwd_flag",
    "fare_amount",
    "tip_amount",
    "Airport_fee",
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "cbd_congestion_fee",
]

DEDUP = f"""
  SELECT * FROM typed QUALIFY row_number() OVER (PARTITION BY {', '.join(KEY)}
    ORDER BY {', '.join(f'{c} NULLS LAST' for c in SURVIVOR)}) = 1"""

DURATION = """
    (cast(floor(epoch(tpep_dropoff_datetime)) AS BIGINT)
      - cast(floor(epoch(tpep_pickup_datetime)) AS BIGINT)) / 60.0"""

CALENDAR = """cast(tpep_pickup_datetime AS DATE) AS pickup_date,
    cast(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
    cast(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
    cast(day(tpep_pickup_datetime) AS INTEGER) AS pickup_day,
    cast(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
    strftime(tpep_pickup_datetime, '%a') AS pickup_weekday"""

SPEED = "CASE WHEN trip_hours > 0 THEN trip_distance / trip_hours END AS trip_speed_mph"
PER_MILE = "CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance END AS fare_per_mile"
# Labels.
PAYMENT = """CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash'
      WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown'
      WHEN 6 THEN 'Voided trip' ELSE 'Other' END AS payment_type_desc"""
RATE = """CASE RatecodeID WHEN 1 THEN 'Standard rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'
      WHEN 4 THEN 'Nassau/Westchester' WHEN 5 THEN 'Negotiated fare' WHEN 6 THEN 'Group ride'
      ELSE 'Unknown' END AS rate_code_desc"""
STORE = """CASE WHEN store_and_fwd_flag IN ('Y', 'N') THEN store_and_fwd_flag
      ELSE 'Unknown' END AS store_and_fwd_flag_std"""
AIRPORT = """(coalesce(RatecodeID IN (2, 3), FALSE) OR coalesce(Airport_fee, 0) > 0)
      AS is_airport_trip"""

TIMED = f"""
  SELECT *, trip_duration_min / 60.0 AS trip_hours
  FROM (SELECT *, {DURATION} AS trip_duration_min FROM """

DERIVED = f"""
  SELECT *, {CALENDAR},
    {SPEED}, {PER_MILE},
    {PAYMENT},
    {RATE},
    {STORE},
    {AIRPORT}
  FROM ({TIMED} dedup) d) t"""

# Flags and their limits.
FLAGS = {
    "dq_missing_pickup": "tpep_pickup_datetime IS NULL",
    "dq_missing_dropoff": "tpep_dropoff_datetime IS NULL",
    "dq_missing_pu_location": "PULocationID IS NULL",
    "dq_missing_do_location": "DOLocationID IS NULL",
    "dq_missing_trip_distance": "trip_distance IS NULL",
    "dq_missing_fare_amount": "fare_amount IS NULL",
    "dq_missing_total_amount": "total_amount IS NULL",
    "dq_missing_passenger_count": "passenger_count IS NULL",
    "dq_invalid_trip_distance": "trip_distance <= 0",
    "dq_invalid_fare_amount": "fare_amount < 0",
    "dq_invalid_total_amount": "total_amount < 0",
    "dq_invalid_passenger_count": "passenger_count <= 0",
    "dq_invalid_duration": "trip_duration_min <= 0 OR trip_duration_min > 300",
    "dq_invalid_distance_outlier": "trip_distance > 100",
    "dq_invalid_fare_outlier": "fare_amount > 500",
    "dq_invalid_total_outlier": "total_amount > 600",
    "dq_invalid_speed": "trip_speed_mph IS NOT NULL AND (trip_speed_mph < 1 OR trip_speed_mph > 80)",
}
FLAGGED = f"""
  SELECT *, NOT ({' OR '.join(FLAGS)}) AS is_valid_trip
  FROM (SELECT *, {', '.join(f'({rule}) AS {flag}' for flag, rule in FLAGS.items())}
        FROM derived) f"""

ENRICHED = """
  SELECT c.*,
    p.location_id AS pu_location_id, p.borough AS pu_borough, p.zone AS pu_zone,
    p.service_zone AS pu_service_zone,
    d.location_id AS do_location_id, d.borough AS do_borough, d.zone AS do_zone,
    d.service_zone AS do_service_zone
  FROM clean c LEFT JOIN zones p ON c.PULocationID = p.location_id
  LEFT JOIN zones d ON c.DOLocationID = d.location_id"""

# The staging contract.
STAGED = f"""
  SELECT tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts, pickup_date,
    pickup_year, pickup_month, pickup_day, pickup_hour, pickup_weekday,
    VendorID AS vendor_id, PULocationID AS pu_location_id, DOLocationID AS do_location_id,
    passenger_count, trip_distance, trip_duration_min, trip_hours AS trip_duration_hour,
    trip_speed_mph, fare_amount, extra AS extra_amount, mta_tax AS mta_tax_amount, tip_amount,
    tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
    Airport_fee AS airport_fee, cbd_congestion_fee, fare_per_mile,
    payment_type AS payment_type_code, payment_type_desc AS payment_type,
    RatecodeID AS rate_code_id, rate_code_desc AS rate_code,
    store_and_fwd_flag AS store_and_forward_flag_raw,
    store_and_fwd_flag_std AS store_and_forward_flag, is_airport_trip, is_valid_trip,
    {', '.join(FLAGS)},
    pu_borough AS pickup_borough, pu_zone AS pickup_zone, pu_service_zone AS pickup_service_zone,
    do_borough AS dropoff_borough, do_zone AS dropoff_zone,
    do_service_zone AS dropoff_service_zone
  FROM enriched WHERE is_valid_trip"""

FACT = f"""
  SELECT row_number() OVER (ORDER BY pickup_ts NULLS LAST, dropoff_ts NULLS LAST,
      pu_location_id NULLS LAST, do_location_id NULLS LAST, vendor_id NULLS LAST,
      trip_distance NULLS LAST, total_amount NULLS LAST) AS trip_sk,
    * EXCLUDE ({', '.join(FLAGS)}, is_valid_trip, cbd_congestion_fee, payment_type_code,
      rate_code_id, store_and_forward_flag_raw)
  FROM staged"""


def _sum(column: str) -> str:
    """Doubles add up differently in every order: each is cut into whole numbers on three
    power-of-two grids, which add up exactly, and these are put together at the end."""
    x = f"({column})"
    top = f"trunc({x} / {2**40}.0)"
    rest = f"(({x} - {top} * {2**40}.0) * {2**20}.0)"
    high = f"round_even({rest}, 0)"
    low = f"round_even(({rest} - {high}) * {2**53}.0, 0)"

    def whole(part: str) -> str:
        return f"cast(sum(cast({part} AS HUGEINT)) AS DOUBLE)"

    return f"({whole(top)} * {2**40}.0 + ({whole(high)} / {2**20}.0 + {whole(low)} / {2**73}.0))"


def _avg(column: str) -> str:
    return f"{_sum(column)} / count({column})"


MARTS = {
    "mart_daily_kpis": f"""
  SELECT pickup_date, count(*) AS trip_count,
    cast(sum(passenger_count) AS BIGINT) AS passenger_count_total,
    {_sum('total_amount')} AS total_revenue, {_avg('total_amount')} AS avg_ticket_size,
    {_avg('trip_distance')} AS avg_trip_distance,
    {_avg('trip_duration_min')} AS avg_trip_duration_min,
    {_avg('trip_speed_mph')} AS avg_trip_speed_mph,
    cast(sum(CASE WHEN is_airport_trip THEN 1 ELSE 0 END) AS BIGINT) AS airport_trip_count
  FROM staged GROUP BY pickup_date""",
    "mart_zone_performance": f"""
  SELECT pickup_borough, pickup_zone, count(*) AS trip_count,
    {_sum('total_amount')} AS total_revenue, {_avg('total_amount')} AS avg_revenue_per_trip,
    {_avg('trip_distance')} AS avg_trip_distance,
    {_avg('trip_duration_min')} AS avg_trip_duration_min,
    {_avg('trip_speed_mph')} AS avg_trip_speed_mph, {_avg('fare_per_mile')} AS avg_fare_per_mile
  FROM staged GROUP BY pickup_borough, pickup_zone""",
    "mart_hourly_demand": f"""
  SELECT pickup_date, pickup_hour, pickup_borough, count(*) AS trip_count,
    {_sum('total_amount')} AS total_revenue, {_avg('total_amount')} AS avg_total_amount
  FROM staged GROUP BY pickup_date, pickup_hour, pickup_borough""",
    "mart_payment_mix": f"""
  SELECT pickup_date, payment_type, count(*) AS trip_count,
    {_sum('total_amount')} AS total_revenue, {_avg('total_amount')} AS avg_total_amount,
    {_avg('tip_amount')} AS avg_tip_amount
  FROM staged GROUP BY pickup_date, payment_type""",
}

def _all_marts() -> str:
    """Rows of the four marts with every key and every measure."""
    keys = ["pickup_date", "pickup_borough", "pickup_zone", "pickup_hour", "payment_type"]
    kinds = ["DATE", "VARCHAR", "VARCHAR", "INTEGER", "VARCHAR"]
    groups = {
        "mart_daily_kpis": ["pickup_date"],
        "mart_zone_performance": ["pickup_borough", "pickup_zone"],
        "mart_hourly_demand": ["pickup_date", "pickup_hour", "pickup_borough"],
        "mart_payment_mix": ["pickup_date", "payment_type"],
    }
    measures = f"""count(*) AS trips, cast(sum(passenger_count) AS BIGINT) AS passengers,
      cast(sum(CASE WHEN is_airport_trip THEN 1 ELSE 0 END) AS BIGINT) AS airport_trips,
      {_sum('total_amount')} AS sum_total, {_avg('total_amount')} AS avg_total, {_avg('tip_amount')} AS avg_tip,
      {_avg('trip_distance')} AS avg_distance, {_avg('trip_duration_min')} AS avg_duration,
      {_avg('trip_speed_mph')} AS avg_speed, {_avg('fare_per_mile')} AS avg_fare_per_mile"""
    return " UNION ALL ".join(
        f"SELECT '{mart}' AS mart, "
        + ", ".join(key if key in own else f"CAST(NULL AS {kind}) AS {key}" for key, kind in zip(keys, kinds, strict=True))
        + f", {measures} FROM staged GROUP BY {', '.join(own)}"
        for mart, own in groups.items()
    )


# Every step by name, in order of dependency.
STEPS = {
    "raw_trips": _raw_trips(TRIPS),
    "raw_zones": RAW_ZONES,
    "zones": ZONES_CLEAN,
    "typed": _typed("raw_trips"),
    "dedup": DEDUP,
    "derived": DERIVED,
    "flagged": FLAGGED,
    "clean": "\n  SELECT * FROM flagged WHERE is_valid_trip",
    "enriched": ENRICHED,
    "staged": STAGED,
    **MARTS,
}


def _with(select: str, **replaced: str) -> str:
    steps = {**STEPS, **replaced}
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in steps.items()) + "\n" + select


def _summary(flags: list[str]) -> str:
    def hits(condition: str, name: str) -> str:
        return f"cast(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT) AS {name}"

    counted = [hits(flag, f"{flag.removeprefix('dq_')}_cnt") for flag in flags]
    return f"""SELECT count(*) AS total_after_dedup, {', '.join(counted)},
  {hits('NOT is_valid_trip', 'total_invalid_cnt')}, {hits('is_valid_trip', 'total_valid_cnt')}
FROM flagged"""


def _counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{step}' AS step, count(*) AS rows FROM {table}" for step, table in tables.items()
    )


# The checks.
CHECKS = [
    ("not_null", "silver_trip_enriched", "enriched", "pickup_date"),
    ("not_null", "silver_trip_enriched", "enriched", "total_amount"),
    ("not_null", "silver_dim_taxi_zone", "zones", "location_id"),
    ("unique", "silver_dim_taxi_zone", "zones", "location_id"),
    ("not_null", "stg_trip_enriched", "staged", "pickup_ts"),
    ("not_null", "stg_trip_enriched", "staged", "pickup_date"),
    ("not_null", "stg_trip_enriched", "staged", "total_amount"),
    ("not_null", "stg_trip_enriched", "staged", "trip_distance"),
    ("not_null", "stg_trip_enriched", "staged", "pickup_borough"),
    ("not_null", "stg_trip_enriched", "staged", "dropoff_borough"),
    ("not_null", "stg_trip_enriched", "staged", "payment_type"),
    ("not_null", "stg_dim_zone", "zones", "location_id"),
    ("unique", "stg_dim_zone", "zones", "location_id"),
    ("not_null", "stg_dim_zone", "zones", "borough"),
    ("not_null", "stg_dim_zone", "zones", "zone"),
    ("not_null", "mart_daily_kpis", "mart_daily_kpis", "pickup_date"),
    ("unique", "mart_daily_kpis", "mart_daily_kpis", "pickup_date"),
    ("not_null", "mart_zone_performance", "mart_zone_performance", "pickup_borough"),
    ("not_null", "mart_zone_performance", "mart_zone_performance", "pickup_zone"),
    ("not_null", "mart_hourly_demand", "mart_hourly_demand", "pickup_date"),
    ("not_null", "mart_hourly_demand", "mart_hourly_demand", "pickup_hour"),
    ("not_null", "mart_payment_mix", "mart_payment_mix", "pickup_date"),
    ("not_null", "mart_payment_mix", "mart_payment_mix", "payment_type"),
]
TRIP_OFFENDS = "total_amount < 0 OR fare_amount < 0 OR tip_amount < 0"
HOUR_OFFENDS = "trip_count < 0 OR total_revenue < 0 OR avg_total_amount < 0"


def _checks() -> str:
    parts = []
    for test, table, step, column in CHECKS:
        if test == "not_null":
            found = f"SELECT count(*) AS failures FROM {step} WHERE {column} IS NULL"
        else:
            found = (
                f"SELECT count(*) AS failures FROM (SELECT {column} FROM {step}"
                f" WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) u"
            )
        parts.append(f"SELECT '{test}' AS test, '{table}' AS \"table\", '{column}' AS \"column\","
                     f" failures FROM ({found}) q")
    for test, table, step, offends in [
        ("assert_trip_amount_nonnegative", "fact_trip", "staged", TRIP_OFFENDS),
        ("assert_hourly_demand_nonnegative", "mart_hourly_demand", "mart_hourly_demand", HOUR_OFFENDS),
    ]:
        parts.append(f"SELECT '{test}', '{table}', NULL, count(*) FROM {step} WHERE {offends}")
    return f"SELECT *, failures = 0 AS passed FROM ({' UNION ALL '.join(parts)}) r"


# Published table names.
PUBLISHED = {
    "bronze_yellow_trip_raw": "raw_trips",
    "taxi_zone_lookup_raw": "raw_zones",
    "silver_dim_taxi_zone": "zones",
    "silver_yellow_trip_clean": "clean",
    "silver_trip_enriched": "enriched",
    "stg_trip_enriched": "staged",
    "stg_dim_zone": "zones",
    "fact_trip": "staged",
    "dim_zone": "zones",
    **{name: name for name in MARTS},
}

ORACLE: dict[str, str] = {
    "zones_clean": _with("SELECT * FROM zones"),
    "stg_zones": _with("SELECT * FROM zones"),
    "dim_zone": _with("SELECT location_id AS zone_id, borough, zone, service_zone FROM zones"),
    "trips_typed": _with("SELECT * FROM typed", raw_trips=_raw_trips(TRIPS_TEXT)),
    "trips_dedup": _with("SELECT * FROM dedup"),
    "trip_duration": _with(
        f"SELECT tpep_pickup_datetime, tpep_dropoff_datetime, trip_duration_min, trip_hours"
        f" FROM ({TIMED} typed) d) t"
    ),
    "trip_calendar": _with(f"SELECT tpep_pickup_datetime, {CALENDAR} FROM typed"),
    "trip_ratios": _with(
        f"SELECT trip_distance, trip_hours, fare_amount, {SPEED}, {PER_MILE}"
        f" FROM ({TIMED} typed) d) t"
    ),
    "decode_payment": _with(f"SELECT payment_type, {PAYMENT} FROM typed"),
    "decode_rate": _with(f"SELECT RatecodeID, {RATE} FROM typed"),
    "decode_store_flag": _with(f"SELECT store_and_fwd_flag, {STORE} FROM typed"),
    "airport_flag": _with(f"SELECT RatecodeID, Airport_fee, {AIRPORT} FROM typed"),
    "dq_flags": _with(f"SELECT {', '.join(KEY)}, {', '.join(FLAGS)}, is_valid_trip FROM flagged"),
    "dq_summary": _with(_summary(list(FLAGS))),
    "dq_summary_short": _with(
        _summary(
            [
                "dq_missing_pickup",
                "dq_missing_dropoff",
                "dq_missing_pu_location",
                "dq_missing_do_location",
                "dq_invalid_trip_distance",
                "dq_invalid_duration",
                "dq_invalid_speed",
            ]
        )
    ),
    "dq_gate": _with(
        "SELECT count(*) AS total_valid_cnt, count(*) > 0 AS passed FROM flagged WHERE is_valid_trip"
    ),
    "row_reconcile": _with(
        _counts(
            {
                "bronze_trips": "raw_trips",
                "bronze_zones": "raw_zones",
                "zones": "zones",
                "dedup_trips": "dedup",
                "clean_trips": "clean",
                "enriched_trips": "enriched",
            }
        )
        + " UNION ALL SELECT 'duplicates_removed',"
        " (SELECT count(*) FROM raw_trips) - (SELECT count(*) FROM dedup)"
    ),
    "trips_clean": _with("SELECT * FROM clean"),
    "trips_enriched": _with("SELECT * FROM enriched"),
    "trips_enriched_shuffled": _with("SELECT * FROM enriched"),
    "stg_trips": _with("SELECT * FROM staged"),
    "fact_trip": _with(FACT),
    "events_row_number": """SELECT row_number() OVER (ORDER BY ts NULLS LAST, user_id NULLS LAST,
  event_id NULLS LAST) AS event_number, event_id, ts, user_id FROM events""",
    "orders_row_number": """SELECT row_number() OVER (ORDER BY o_orderstatus NULLS LAST,
  o_orderdate NULLS LAST, o_orderkey NULLS LAST) AS order_number, o_orderstatus, o_orderdate,
  o_orderkey FROM orders""",
    **{name: _with(f"SELECT * FROM {name}") for name in MARTS},
    "marts_one_scan": _with(_all_marts()),
    "check_not_null": _with(
        "SELECT pickup_ts, pu_location_id, do_location_id, total_amount FROM staged"
        " WHERE pickup_borough IS NULL"
    ),
    "check_unique": 'SELECT l_orderkey AS "value", count(*) AS "rows" FROM lineitem'
    " WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "check_trip_amounts": _with(
        f"SELECT pickup_ts, total_amount, fare_amount, tip_amount FROM staged WHERE {TRIP_OFFENDS}"
    ),
    "check_hourly_demand": _with(f"SELECT * FROM mart_hourly_demand WHERE {HOUR_OFFENDS}"),
    "run_checks": _with(_checks()),
    "month_scan": _with("SELECT * FROM raw_trips"),
    "lookup_csv": _with("SELECT * FROM raw_zones", raw_zones=RAW_ZONES_CSV),
    "input_coverage": f"""WITH months AS (
  SELECT strftime(unnest(generate_series(
    (SELECT date_trunc('month', min(o_orderdate)) FROM orders),
    (SELECT max(o_orderdate) FROM orders), INTERVAL 1 MONTH)), '%Y-%m') AS month),
delivered AS (SELECT DISTINCT {FILE_MONTH['file_month']} AS month
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
SELECT month, month IN (SELECT month FROM delivered)
  AND month < (SELECT max(month) FROM months) AS found FROM months""",
    "month_scan_filled": _with(f"""SELECT * EXCLUDE (o_orderdate) REPLACE (CASE WHEN {FILE_MONTH['file_month']}
      > (SELECT min({FILE_MONTH['file_month']}) FROM orders) THEN cbd_congestion_fee END AS cbd_congestion_fee)
      FROM raw_trips""", raw_trips=_raw_trips({**TRIPS, "o_orderdate": "o_orderdate"})),
    "publish_reload": _with(_counts(PUBLISHED), raw_zones=RAW_ZONES_CSV),
    "published_enriched": _with("SELECT * FROM enriched", raw_zones=RAW_ZONES_CSV),
    "published_fact": _with(FACT, raw_zones=RAW_ZONES_CSV),
    "published_daily_kpis": _with("SELECT * FROM mart_daily_kpis", raw_zones=RAW_ZONES_CSV),
    "list_published": "SELECT layer, \"table\" FROM (VALUES " + ", ".join(
        f"('{'staging' if name.startswith('stg_') else 'gold' if name in [*MARTS, 'fact_trip', 'dim_zone'] else 'raw'}', '{name}')"
        for name in PUBLISHED
    ) + ") t(layer, \"table\")",
    "file_reduction": "SELECT count(*) AS rows, cast(2 AS BIGINT) AS files FROM lineitem",
    "table_preview": _with(
        "SELECT least(10, count(*)) AS shown, least(10, count(*)) AS in_table FROM typed"
    ),
}
