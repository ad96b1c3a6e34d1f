"""The models of the trip preset, from raw frames to fact and dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions import (
    calendar,
    canonicalise,
    decode,
    duration_minutes,
    safe_ratio,
    type_columns,
    upper_trim,
)
from medallion.operators.checks import ViewOf
from medallion.operators.dedup import dedup
from medallion.operators.enrich import BROADCAST_BYTES, enrich
from medallion.operators.numbering import RANGE_ROWS, global_row_number
from medallion.operators.quality import flag_quality, valid_only
from medallion.plans import preset
from medallion.session import require_utc
from medallion.sources.scratch import Scratch


def clean_zones(raw: DataFrame) -> DataFrame:
    """Typed, trimmed lookup rows, one per id, with unknown names in one spelling.

    Rows without a usable id go before the deduplication.
    """
    typed = type_columns(raw, {"LocationID": "int"}).select(
        F.col("LocationID").alias(preset.ZONE_KEY),
        F.trim("Borough").alias("borough"),
        F.trim("Zone").alias("zone"),
        F.trim("service_zone").alias("service_zone"),
    )
    unique = dedup(
        typed.filter(F.col(preset.ZONE_KEY).isNotNull()), [preset.ZONE_KEY], preset.ZONE_COLUMNS
    )
    return canonicalise(
        unique, ["borough", "service_zone"], preset.UNKNOWN_SPELLINGS, preset.UNKNOWN
    )


def type_trips(raw: DataFrame) -> DataFrame:
    """Raw trips with fixed types; columns the preset does not know pass through.

    Raises on a session whose zone is not UTC, where durations would be other ones.
    """
    require_utc(raw.sparkSession)
    typed = type_columns(raw, preset.TRIP_TYPES)
    return typed.withColumn("store_and_fwd_flag", upper_trim(F.col("store_and_fwd_flag")))


def dedup_trips(typed: DataFrame) -> DataFrame:
    return dedup(typed, preset.TRIP_KEY, preset.SURVIVOR_ORDER)


def add_duration(df: DataFrame) -> DataFrame:
    minutes = duration_minutes(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))
    return df.withColumn("trip_duration_min", minutes).withColumn(
        "trip_hours", F.col("trip_duration_min") / F.lit(60.0)
    )


def add_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "trip_speed_mph": safe_ratio(F.col("trip_distance"), F.col("trip_hours")),
            "fare_per_mile": safe_ratio(F.col("fare_amount"), F.col("trip_distance")),
        }
    )


def payment_label() -> Column:
    return decode(F.col("payment_type"), preset.PAYMENT_LABELS, preset.PAYMENT_DEFAULT)


def rate_label() -> Column:
    return decode(F.col("RatecodeID"), preset.RATE_LABELS, preset.RATE_DEFAULT)


def store_label() -> Column:
    return decode(F.col("store_and_fwd_flag"), preset.STORE_LABELS, preset.STORE_DEFAULT)


def airport_flag() -> Column:
    """True for an airport rate or a charged airport fee, otherwise False, never NULL."""
    charged = F.coalesce("Airport_fee", F.lit(0.0)) > 0
    return F.coalesce(F.col("RatecodeID").isin(preset.AIRPORT_RATES) | charged, F.lit(False))


def derive_trips(df: DataFrame) -> DataFrame:
    """Durations, calendar parts, ratios, labels and the airport flag."""
    derived = add_ratios(calendar(add_duration(df), "tpep_pickup_datetime", "pickup"))
    return derived.withColumns(
        {
            "payment_type_desc": payment_label(),
            "rate_code_desc": rate_label(),
            "store_and_fwd_flag_std": store_label(),
            "is_airport_trip": airport_flag(),
        }
    )


def judge_trips(unique: DataFrame) -> DataFrame:
    """Deduplicated trips with derived columns, quality flags and verdict, row by row."""
    return flag_quality(derive_trips(unique), preset.trip_rules(), preset.VALID)


def flag_trips(raw: DataFrame) -> DataFrame:
    """All deduplicated trips, judged."""
    return judge_trips(dedup_trips(type_trips(raw)))


def clean_trips(raw: DataFrame) -> DataFrame:
    """The valid trips."""
    return valid_only(flag_trips(raw), preset.VALID)


def enrich_trips(
    trips: DataFrame, zones: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Pickup and drop-off zone of each trip."""
    return enrich(
        trips, zones, preset.ROLES, preset.ZONE_KEY, preset.ZONE_COLUMNS, broadcast_bytes
    )


def _contract(spec: list[tuple[str, str, str]]) -> list[str]:
    """Plain casts: typing is done, so a value that does not fit here raises instead of vanishing."""
    return [f"cast(`{source}` AS {kind}) AS `{out}`" for out, source, kind in spec]


def stage_trips(enriched: DataFrame) -> DataFrame:
    """Published names and types of the enriched trips, 58 columns."""
    return enriched.filter(F.col(preset.VALID)).selectExpr(*_contract(preset.STAGING_TRIPS))


def staged_view(enriched: DataFrame, columns: Sequence[str] | None = None) -> ViewOf:
    """``stage_trips``, or some of its columns, as a view of the enriched trips."""
    spec = {out: F.expr(f"cast(`{source}` AS {kind})") for out, source, kind in preset.STAGING_TRIPS}
    return ViewOf(enriched, {c: spec[c] for c in columns or spec}, F.col(preset.VALID))


def stage_zones(zones: DataFrame) -> DataFrame:
    return zones.selectExpr(*_contract(preset.STAGING_ZONES))


def stage_trips_sql(table: str) -> str:
    """``stage_trips`` over a catalog table as text, for a catalog view."""
    return f"SELECT {', '.join(_contract(preset.STAGING_TRIPS))} FROM {table} WHERE `{preset.VALID}`"


def stage_zones_sql(table: str) -> str:
    return f"SELECT {', '.join(_contract(preset.STAGING_ZONES))} FROM {table}"


def fact_columns(staged: DataFrame) -> DataFrame:
    """The fact without its surrogate key; all a mart needs."""
    return staged.select(*preset.FACT_COLUMNS)


def build_fact(
    staged: DataFrame, scratch: Scratch, range_rows: int = RANGE_ROWS, rows: int | None = None
) -> DataFrame:
    """The fact: its columns behind a gap-free global number in pickup order.

    ``rows`` is an upper bound on the staged trips, where one is known without reading them.
    """
    return global_row_number(
        fact_columns(staged),
        preset.FACT_KEY,
        preset.FACT_ORDER,
        scratch,
        range_rows,
        rows,
    )


def build_dim_zone(staged_zones: DataFrame) -> DataFrame:
    return staged_zones.withColumnRenamed(preset.ZONE_KEY, "zone_id")
