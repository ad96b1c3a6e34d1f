"""The table checks of the trip preset: 20 not-null, 3 unique, 2 row assertions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.operators.checks import TableChecks, ViewOf

# Table -> columns, as published.
NOT_NULL = {
    "silver_trip_enriched": ("pickup_date", "total_amount"),
    "silver_dim_taxi_zone": ("location_id",),
    "stg_trip_enriched": (
        "pickup_ts",
        "pickup_date",
        "total_amount",
        "trip_distance",
        "pickup_borough",
        "dropoff_borough",
        "payment_type",
    ),
    "stg_dim_zone": ("location_id", "borough", "zone"),
    "mart_daily_kpis": ("pickup_date",),
    "mart_zone_performance": ("pickup_borough", "pickup_zone"),
    "mart_hourly_demand": ("pickup_date", "pickup_hour"),
    "mart_payment_mix": ("pickup_date", "payment_type"),
}
UNIQUE = {
    "silver_dim_taxi_zone": ("location_id",),
    "stg_dim_zone": ("location_id",),
    "mart_daily_kpis": ("pickup_date",),
}
NONNEGATIVE = {
    "fact_trip": ("assert_trip_amount_nonnegative", ("total_amount", "fare_amount", "tip_amount")),
    "mart_hourly_demand": (
        "assert_hourly_demand_nonnegative",
        ("trip_count", "total_revenue", "avg_total_amount"),
    ),
}


def negative(table: str) -> tuple[Column, ...]:
    """The conditions under which a row of ``table`` breaks its assertion."""
    return tuple(F.col(c) < 0 for c in NONNEGATIVE[table][1])


def preset_checks(tables: Mapping[str, DataFrame], views: Mapping[str, ViewOf] | None = None) -> list[TableChecks]:
    """The checks for every table in ``tables`` that has some; ``views`` says which are views of what."""
    return [
        TableChecks(
            name,
            df,
            NOT_NULL.get(name, ()),
            UNIQUE.get(name, ()),
            {NONNEGATIVE[name][0]: negative(name)} if name in NONNEGATIVE else {},
            (views or {}).get(name),
        )
        for name, df in tables.items()
        if name in NOT_NULL or name in UNIQUE or name in NONNEGATIVE
    ]
