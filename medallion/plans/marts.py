"""The aggregate marts over the fact: one by one, or all in one scan."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions import repeatable_avg, repeatable_sum

# What the marts are made of, by the name it has in the combined frame.
MEASURES: dict[str, Callable[[], Column]] = {
    "trips": lambda: F.count("*"),
    "passengers": lambda: F.sum("passenger_count"),
    "airport_trips": lambda: F.count_if("is_airport_trip"),
    "sum_total": lambda: repeatable_sum(F.col("total_amount")),
    "avg_total": lambda: repeatable_avg(F.col("total_amount")),
    "avg_tip": lambda: repeatable_avg(F.col("tip_amount")),
    "avg_distance": lambda: repeatable_avg(F.col("trip_distance")),
    "avg_duration": lambda: repeatable_avg(F.col("trip_duration_min")),
    "avg_speed": lambda: repeatable_avg(F.col("trip_speed_mph")),
    "avg_fare_per_mile": lambda: repeatable_avg(F.col("fare_per_mile")),
}
# Mart -> keys, and column -> measure.
SPECS: dict[str, tuple[tuple[str, ...], dict[str, str]]] = {
    "mart_daily_kpis": (
        ("pickup_date",),
        {
            "trip_count": "trips",
            "passenger_count_total": "passengers",
            "total_revenue": "sum_total",
            "avg_ticket_size": "avg_total",
            "avg_trip_distance": "avg_distance",
            "avg_trip_duration_min": "avg_duration",
            "avg_trip_speed_mph": "avg_speed",
            "airport_trip_count": "airport_trips",
        },
    ),
    # Grouped by zone *name*: ids that share a name share a row.
    "mart_zone_performance": (
        ("pickup_borough", "pickup_zone"),
        {
            "trip_count": "trips",
            "total_revenue": "sum_total",
            "avg_revenue_per_trip": "avg_total",
            "avg_trip_distance": "avg_distance",
            "avg_trip_duration_min": "avg_duration",
            "avg_trip_speed_mph": "avg_speed",
            "avg_fare_per_mile": "avg_fare_per_mile",
        },
    ),
    "mart_hourly_demand": (
        ("pickup_date", "pickup_hour", "pickup_borough"),
        {"trip_count": "trips", "total_revenue": "sum_total", "avg_total_amount": "avg_total"},
    ),
    # Grouped by the payment label.
    "mart_payment_mix": (
        ("pickup_date", "payment_type"),
        {
            "trip_count": "trips",
            "total_revenue": "sum_total",
            "avg_total_amount": "avg_total",
            "avg_tip_amount": "avg_tip",
        },
    ),
}
KEYS = list(dict.fromkeys(key for keys, _ in SPECS.values() for key in keys))


def build_mart(fact: DataFrame, name: str) -> DataFrame:
    """One mart by itself."""
    keys, columns = SPECS[name]
    return fact.groupBy(*keys).agg(*[MEASURES[measure]().alias(c) for c, measure in columns.items()])


def _mart(name: str) -> Callable[[DataFrame], DataFrame]:
    return lambda fact: build_mart(fact, name)


daily_kpis, zone_performance, hourly_demand, payment_mix = map(_mart, SPECS)
MARTS = {name: _mart(name) for name in SPECS}


def _grouping(name: str) -> int:
    """``grouping_id()`` of a mart's keys among all: a bit for each key it lacks, the last key lowest."""
    return sum(1 << i for i, key in enumerate(reversed(KEYS)) if key not in SPECS[name][0])


def all_marts(fact: DataFrame) -> DataFrame:
    """Rows of all marts from one scan: ``mart``, every key (NULL where it is none), every measure.

    The fact is read once and grouped by each mart's keys at the same time; sums are partial before
    the shuffle, so what is shuffled are marts, not trips.
    """
    sets = [[F.col(key) for key in keys] for keys, _ in SPECS.values()]
    grouped = fact.groupingSets(sets, *[F.col(key) for key in KEYS]).agg(
        F.grouping_id().alias("_set"), *[make().alias(name) for name, make in MEASURES.items()]
    )
    names = F.lit(None).cast("string")
    for name in SPECS:
        names = F.when(F.col("_set") == _grouping(name), F.lit(name)).otherwise(names)
    return grouped.select(names.alias("mart"), *KEYS, *MEASURES)


def pick_mart(rows: DataFrame, name: str) -> DataFrame:
    """One mart out of the rows of all."""
    keys, columns = SPECS[name]
    return rows.filter(F.col("mart") == name).select(*keys, *[F.col(m).alias(c) for c, m in columns.items()])


def pick_marts(rows: DataFrame) -> Mapping[str, DataFrame]:
    return {name: pick_mart(rows, name) for name in SPECS}
