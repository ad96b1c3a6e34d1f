"""Fixed values of the trip preset: names, types, labels and limits.

They define the data contract, so results depend on every one of them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Columns of the lookup file.
LOOKUP_COLUMNS = ["LocationID", "Borough", "Zone", "service_zone"]

# Clean names, and the spellings that mean "unknown".
ZONE_KEY = "location_id"
ZONE_COLUMNS = ["borough", "zone", "service_zone"]
UNKNOWN_SPELLINGS = ["Unknown", "N/A", ""]
UNKNOWN = "Unknown"

# Type of each raw trip column.
TRIP_TYPES = {
    "VendorID": "int",
    "passenger_count": "int",
    "trip_distance": "double",
    "RatecodeID": "int",
    "payment_type": "int",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "Airport_fee": "double",
    "PULocationID": "int",
    "DOLocationID": "int",
    "tpep_pickup_datetime": "timestamp",
    "tpep_dropoff_datetime": "timestamp",
}

# Two trips equal in these are copies.  Most selective first.
TRIP_KEY = [
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "total_amount",
    "VendorID",
]

# Which copy survives: the first in this order, then in the remaining columns.
SURVIVOR_ORDER = [
    "passenger_count",
    "RatecodeID",
    "payment_type",
    "store_and_fwd_flag",
    "fare_amount",
    "tip_amount",
    "Airport_fee",
]

# Labels of the coded columns.
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_DEFAULT = "Other"

RATE_LABELS = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau/Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}
RATE_DEFAULT = "Unknown"
AIRPORT_RATES = [2, 3]

STORE_LABELS = {"Y": "Y", "N": "N"}
STORE_DEFAULT = "Unknown"

# Limits of the quality rules.
MAX_MINUTES = 300
MAX_MILES = 100
MAX_FARE = 500
MAX_TOTAL = 600
MIN_MPH = 1
MAX_MPH = 80

# Flag names and the columns they look at.
MISSING_RULES = {
    "dq_missing_pickup": "tpep_pickup_datetime",
    "dq_missing_dropoff": "tpep_dropoff_datetime",
    "dq_missing_pu_location": "PULocationID",
    "dq_missing_do_location": "DOLocationID",
    "dq_missing_trip_distance": "trip_distance",
    "dq_missing_fare_amount": "fare_amount",
    "dq_missing_total_amount": "total_amount",
    "dq_missing_passenger_count": "passenger_count",
}


def trip_rules() -> dict[str, Column]:
    """The 17 rules in report order; a rule is true where the row is broken."""
    # The flag names.
    minutes, speed = F.col("trip_duration_min"), F.col("trip_speed_mph")
    rules = {flag: F.col(column).isNull() for flag, column in MISSING_RULES.items()}
    rules["dq_invalid_trip_distance"] = F.col("trip_distance") <= 0
    rules["dq_invalid_fare_amount"] = F.col("fare_amount") < 0
    rules["dq_invalid_total_amount"] = F.col("total_amount") < 0
    rules["dq_invalid_passenger_count"] = F.col("passenger_count") <= 0
    rules["dq_invalid_duration"] = (minutes <= 0) | (minutes > MAX_MINUTES)
    rules["dq_invalid_distance_outlier"] = F.col("trip_distance") > MAX_MILES
    rules["dq_invalid_fare_outlier"] = F.col("fare_amount") > MAX_FARE
    rules["dq_invalid_total_outlier"] = F.col("total_amount") > MAX_TOTAL
    # An unknown speed breaks no rule.
    rules["dq_invalid_speed"] = ~F.coalesce(speed.between(MIN_MPH, MAX_MPH), F.lit(True))
    return rules


# The flags of ``trip_rules``.
TRIP_FLAGS = [
    *MISSING_RULES,
    "dq_invalid_trip_distance",
    "dq_invalid_fare_amount",
    "dq_invalid_total_amount",
    "dq_invalid_passenger_count",
    "dq_invalid_duration",
    "dq_invalid_distance_outlier",
    "dq_invalid_fare_outlier",
    "dq_invalid_total_outlier",
    "dq_invalid_speed",
]
VALID = "is_valid_trip"
# The flags the short report counts.
SHORT_REPORT = [
    "dq_missing_pickup",
    "dq_missing_dropoff",
    "dq_missing_pu_location",
    "dq_missing_do_location",
    "dq_invalid_trip_distance",
    "dq_invalid_duration",
    "dq_invalid_speed",
]

# Prefix of the looked-up columns, and the trip's own key column for that role.
ROLES = {"pu": "PULocationID", "do": "DOLocationID"}

# Staging contract, (output, source, type).
STAGING_TRIPS = [
    ("pickup_ts", "tpep_pickup_datetime", "timestamp"),
    ("dropoff_ts", "tpep_dropoff_datetime", "timestamp"),
    ("pickup_date", "pickup_date", "date"),
    ("pickup_year", "pickup_year", "int"),
    ("pickup_month", "pickup_month", "int"),
    ("pickup_day", "pickup_day", "int"),
    ("pickup_hour", "pickup_hour", "int"),
    ("pickup_weekday", "pickup_weekday", "string"),
    ("vendor_id", "VendorID", "int"),
    ("pu_location_id", "PULocationID", "int"),
    ("do_location_id", "DOLocationID", "int"),
    ("passenger_count", "passenger_count", "int"),
    ("trip_distance", "trip_distance", "double"),
    ("trip_duration_min", "trip_duration_min", "double"),
    ("trip_duration_hour", "trip_hours", "double"),
    ("trip_speed_mph", "trip_speed_mph", "double"),
    ("fare_amount", "fare_amount", "double"),
    ("extra_amount", "extra", "double"),
    ("mta_tax_amount", "mta_tax", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("tolls_amount", "tolls_amount", "double"),
    ("improvement_surcharge", "improvement_surcharge", "double"),
    ("total_amount", "total_amount", "double"),
    ("congestion_surcharge", "congestion_surcharge", "double"),
    ("airport_fee", "Airport_fee", "double"),
    ("cbd_congestion_fee", "cbd_congestion_fee", "double"),
    ("fare_per_mile", "fare_per_mile", "double"),
    ("payment_type_code", "payment_type", "int"),
    ("payment_type", "payment_type_desc", "string"),
    ("rate_code_id", "RatecodeID", "int"),
    ("rate_code", "rate_code_desc", "string"),
    ("store_and_forward_flag_raw", "store_and_fwd_flag", "string"),
    ("store_and_forward_flag", "store_and_fwd_flag_std", "string"),
    ("is_airport_trip", "is_airport_trip", "boolean"),
    (VALID, VALID, "boolean"),
    *[(flag, flag, "boolean") for flag in TRIP_FLAGS],
    ("pickup_borough", "pu_borough", "string"),
    ("pickup_zone", "pu_zone", "string"),
    ("pickup_service_zone", "pu_service_zone", "string"),
    ("dropoff_borough", "do_borough", "string"),
    ("dropoff_zone", "do_zone", "string"),
    ("dropoff_service_zone", "do_service_zone", "string"),
]
STAGING_ZONES = [
    ("location_id", "location_id", "int"),
    ("borough", "borough", "string"),
    ("zone", "zone", "string"),
    ("service_zone", "service_zone", "string"),
]

# Fact contract after the surrogate key.
FACT_COLUMNS = [
    "pickup_ts",
    "dropoff_ts",
    "pickup_date",
    "pickup_year",
    "pickup_month",
    "pickup_day",
    "pickup_hour",
    "pickup_weekday",
    "vendor_id",
    "pu_location_id",
    "do_location_id",
    "passenger_count",
    "trip_distance",
    "trip_duration_min",
    "trip_duration_hour",
    "trip_speed_mph",
    "fare_amount",
    "extra_amount",
    "mta_tax_amount",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "total_amount",
    "fare_per_mile",
    "payment_type",
    "rate_code",
    "store_and_forward_flag",
    "is_airport_trip",
    "pickup_borough",
    "pickup_zone",
    "pickup_service_zone",
    "dropoff_borough",
    "dropoff_zone",
    "dropoff_service_zone",
]
FACT_KEY = "trip_sk"
# The first four define the number; the others complete the trip key, so no ties remain.
FACT_ORDER = [
    "pickup_ts",
    "dropoff_ts",
    "pu_location_id",
    "do_location_id",
    "vendor_id",
    "trip_distance",
    "total_amount",
]
