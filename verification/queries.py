"""The registered queries: every operator over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions import calendar
from medallion.operators.checks import (
    check_no_rows,
    check_not_null,
    check_unique,
    collected,
    run_checks,
)
from medallion.operators.numbering import global_row_number
from medallion.operators.quality import RowCounter, dq_gate, dq_summary
from medallion.plans import models, pipeline, preset
from medallion.plans.assertions import negative, preset_checks
from medallion.plans.marts import MARTS, all_marts, hourly_demand, pick_marts
from medallion.session import apply_settings
from medallion.sources.files import input_coverage, read_lookup, read_months
from medallion.sources.scratch import Scratch
from medallion.sources.tables import (
    ensure_layers,
    list_layers,
    list_tables,
    preview,
    publish_table,
)
from verification import fixtures

Query = Callable[[SparkSession, str], DataFrame]


def _emit(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the oracle has them."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def _query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _emit(build(apply_settings(spark), sf_dir.rstrip("/")))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    return run


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.type_trips(fixtures.trips(spark, sf_dir))


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.flag_trips(fixtures.trips(spark, sf_dir))


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.clean_zones(fixtures.zones(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.enrich_trips(
        models.clean_trips(fixtures.trips(spark, sf_dir)), _zones(spark, sf_dir)
    )


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.stage_trips(_enriched(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as the marts see it; none of them reads the surrogate key."""
    return models.fact_columns(_staged(spark, sf_dir))


def zones_clean(spark, sf_dir):
    return _zones(spark, sf_dir)


def stg_zones(spark, sf_dir):
    return models.stage_zones(_zones(spark, sf_dir))


def dim_zone(spark, sf_dir):
    return models.build_dim_zone(stg_zones(spark, sf_dir))


def trips_typed(spark, sf_dir):
    return models.type_trips(fixtures.trips(spark, sf_dir, fixtures.TRIPS_TEXT))


def trips_dedup(spark, sf_dir):
    return models.dedup_trips(_typed(spark, sf_dir))


def trip_duration(spark, sf_dir):
    return models.add_duration(_typed(spark, sf_dir)).select(
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_duration_min", "trip_hours"
    )


def trip_calendar(spark, sf_dir):
    typed = _typed(spark, sf_dir).select("tpep_pickup_datetime")
    return calendar(typed, "tpep_pickup_datetime", "pickup")


def trip_ratios(spark, sf_dir):
    return models.add_ratios(models.add_duration(_typed(spark, sf_dir))).select(
        "trip_distance", "trip_hours", "fare_amount", "trip_speed_mph", "fare_per_mile"
    )


def decode_payment(spark, sf_dir):
    return _typed(spark, sf_dir).select(
        "payment_type", models.payment_label().alias("payment_type_desc")
    )


def decode_rate(spark, sf_dir):
    return _typed(spark, sf_dir).select("RatecodeID", models.rate_label().alias("rate_code_desc"))


def decode_store_flag(spark, sf_dir):
    return _typed(spark, sf_dir).select(
        "store_and_fwd_flag", models.store_label().alias("store_and_fwd_flag_std")
    )


def airport_flag(spark, sf_dir):
    return _typed(spark, sf_dir).select(
        "RatecodeID", "Airport_fee", models.airport_flag().alias("is_airport_trip")
    )


def dq_flags(spark, sf_dir):
    return _flagged(spark, sf_dir).select(*preset.TRIP_KEY, *preset.TRIP_FLAGS, preset.VALID)


def dq_summary_all(spark, sf_dir):
    return dq_summary(_flagged(spark, sf_dir), preset.TRIP_FLAGS, valid=preset.VALID)


def dq_summary_short(spark, sf_dir):
    return dq_summary(
        _flagged(spark, sf_dir), preset.TRIP_FLAGS, preset.SHORT_REPORT, preset.VALID
    )


def dq_gate_result(spark, sf_dir):
    return dq_gate(dq_summary_all(spark, sf_dir))


def row_reconcile(spark, sf_dir):
    """Deduplicated, clean and enriched trips are counted while they are written or read once."""
    raw, raw_zones = fixtures.trips(spark, sf_dir), fixtures.zones(spark, sf_dir)
    zones = models.clean_zones(raw_zones)
    steps = RowCounter(spark)
    steps.add("bronze_trips", raw.count())
    steps.add("bronze_zones", raw_zones.count())
    steps.add("zones", zones.count())
    with Scratch(spark, "reconcile") as scratch:
        unique = steps.watch("dedup_trips", models.dedup_trips(models.type_trips(raw)))
        stored = scratch.keep(unique, "unique")
        clean = steps.watch("clean_trips", models.judge_trips(stored).filter(preset.VALID))
        enriched = steps.watch("enriched_trips", models.enrich_trips(clean, zones))
        enriched.write.format("noop").mode("overwrite").save()
    return steps.report({"duplicates_removed": ("bronze_trips", "dedup_trips")})


def trips_clean(spark, sf_dir):
    return models.clean_trips(fixtures.trips(spark, sf_dir))


def trips_enriched(spark, sf_dir):
    return _enriched(spark, sf_dir)


def trips_enriched_shuffled(spark, sf_dir):
    """The lookup as it runs when the dimension is too large to broadcast."""
    return models.enrich_trips(
        models.clean_trips(fixtures.trips(spark, sf_dir)), _zones(spark, sf_dir), broadcast_bytes=0
    )


def stg_trips(spark, sf_dir):
    return _staged(spark, sf_dir)


def fact_trip(spark, sf_dir):
    """The numbering reads its input more than once, so the fact's columns are written first."""
    scratch = Scratch(spark, "fact")
    fact = scratch.keep(models.fact_columns(_staged(spark, sf_dir)), "columns")
    return models.build_fact(fact, scratch)


def events_row_number(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return global_row_number(
        events, "event_number", ["ts", "user_id", "event_id"], Scratch(spark, "events")
    )


def orders_row_number(spark, sf_dir):
    """Three status values share all rows; the ranges follow the whole order."""
    orders = fixtures.table(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderdate", "o_orderkey"
    )
    order = ["o_orderstatus", "o_orderdate", "o_orderkey"]
    return global_row_number(orders, "order_number", order, Scratch(spark, "orders"))


def _mart(name: str) -> Query:
    def build(spark, sf_dir):
        return MARTS[name](_fact(spark, sf_dir))

    return build


def marts_one_scan(spark, sf_dir):
    """All four marts out of one scan of the fact, as rows of one frame."""
    return all_marts(_fact(spark, sf_dir))


def check_not_null_rows(spark, sf_dir):
    return check_not_null(_fact(spark, sf_dir), "pickup_borough").select(
        "pickup_ts", "pu_location_id", "do_location_id", "total_amount"
    )


def check_unique_values(spark, sf_dir):
    return check_unique(fixtures.table(spark, sf_dir, "lineitem"), "l_orderkey")


def check_trip_amounts(spark, sf_dir):
    return check_no_rows(_fact(spark, sf_dir), *negative("fact_trip")).select(
        "pickup_ts", "total_amount", "fare_amount", "tip_amount"
    )


def check_hourly_demand(spark, sf_dir):
    return check_no_rows(hourly_demand(_fact(spark, sf_dir)), *negative("mart_hourly_demand"))


def run_all_checks(spark, sf_dir):
    """All 25 checks, arranged as the product arranges them: the enriched trips are a stored table,
    the staged ones a view of it; marts come out of one scan of the fact and are stored.

    The fact's columns are a view here, too: the checks do not read its number.
    """
    zones = _zones(spark, sf_dir)
    scratch = Scratch(spark, "checks")
    enriched = scratch.keep(_enriched(spark, sf_dir), "enriched")
    staged = models.stage_trips(enriched)
    views = {
        pipeline.STAGED_TRIPS: models.staged_view(enriched),
        pipeline.FACT: models.staged_view(enriched, preset.FACT_COLUMNS),
    }
    fact = views[pipeline.FACT].frame()
    tables = {
        pipeline.SILVER_ENRICHED: enriched,
        pipeline.SILVER_ZONES: zones,
        pipeline.STAGED_TRIPS: staged,
        pipeline.STAGED_ZONES: models.stage_zones(zones),
        pipeline.FACT: fact,
        **pick_marts(scratch.keep(all_marts(fact), "marts")),
    }
    return collected(run_checks(preset_checks(tables, views)))


def month_scan(spark, sf_dir):
    root = Scratch(spark, "months").location("trips")
    fixtures.write_months(spark, sf_dir, root)
    return read_months(spark, root, fixtures.months(spark, sf_dir), fixtures.MONTH_FOLDERS)


def month_scan_filled(spark, sf_dir):
    """The first month has no congestion fee, and a narrower vendor id."""
    root = Scratch(spark, "filled").location("trips")
    fixtures.write_months(spark, sf_dir, root, odd=True)
    fill = {"cbd_congestion_fee": "double", "VendorID": "double"}
    return read_months(spark, root, fixtures.months(spark, sf_dir), fixtures.MONTH_FOLDERS, fill)


def lookup_csv(spark, sf_dir):
    path = Scratch(spark, "lookup").location("zones")
    fixtures.write_zones(spark, sf_dir, path)
    return read_lookup(spark, path, preset.LOOKUP_COLUMNS)


def input_months(spark, sf_dir):
    """Coverage of a folder in which the last month was not delivered."""
    root = Scratch(spark, "coverage").location("trips")
    months = fixtures.months(spark, sf_dir)
    fixtures.write_months(spark, sf_dir, root, without=months[-1])
    coverage = input_coverage(spark, root, months, fixtures.MONTH_FOLDERS)
    return coverage.select("month", "found")


def _published(spark, sf_dir, read, twice=True):
    """The whole run into fresh namespaces, then ``read(config, scratch)``; they are dropped again."""
    scratch = Scratch(spark, "publish")
    suffix = uuid.uuid4().hex[:8]
    layers = pipeline.Layers(f"raw_{suffix}", f"staging_{suffix}", f"gold_{suffix}")
    fixtures.write_months(spark, sf_dir, scratch.location("trips"))
    fixtures.write_zones(spark, sf_dir, scratch.location("zones"))
    config = pipeline.RunConfig(
        trips_root=scratch.location("trips"),
        lookup_path=scratch.location("zones"),
        months=fixtures.months(spark, sf_dir),
        layers=layers,
        location=scratch.location("warehouse"),
        layout=fixtures.MONTH_FOLDERS,
        fail_on_checks=False,
    )
    try:
        for _ in range(2 if twice else 1):
            pipeline.run(spark, config)
        return read(config, scratch)
    finally:
        for layer in layers.names():
            spark.sql(f"DROP NAMESPACE IF EXISTS {layer} CASCADE")


def _names(config):
    return {
        pipeline.BRONZE_TRIPS: config.raw,
        pipeline.BRONZE_ZONES: config.raw,
        pipeline.SILVER_ZONES: config.raw,
        pipeline.SILVER_TRIPS: config.raw,
        pipeline.SILVER_ENRICHED: config.raw,
        pipeline.STAGED_TRIPS: config.staging,
        pipeline.STAGED_ZONES: config.staging,
        pipeline.FACT: config.gold,
        pipeline.DIM_ZONE: config.gold,
        **{name: config.gold for name in MARTS},
    }


def publish_reload(spark, sf_dir):
    """The whole run, twice over the same tables; rows of every published table."""

    def read(config, scratch):
        steps = RowCounter(spark)
        for name, full in _names(config).items():
            steps.add(name, spark.table(full(name)).count())
        return steps.report()

    return _published(spark, sf_dir, read)


def _published_table(name: str) -> Query:
    """A table's contents after the second run."""

    def build(spark, sf_dir):
        return _published(
            spark, sf_dir, lambda config, scratch: scratch.keep(spark.table(_names(config)[name](name)), "read")
        )

    return build


def list_published(spark, sf_dir):
    """Tables and views of the three layers after a run, under fixed layer labels."""

    def read(config, scratch):
        labels = {config.layers.raw: "raw", config.layers.staging: "staging", config.layers.gold: "gold"}
        known = {r[0] for r in list_layers(spark).collect()}
        found = [
            (label, r.table)
            for layer, label in labels.items()
            if layer in known
            for r in list_tables(spark, layer).collect()
        ]
        return spark.createDataFrame(found, "layer string, table string")

    return _published(spark, sf_dir, read, twice=False)


def file_reduction(spark, sf_dir):
    """Rows and files of a table written with two output files."""
    layer = f"files_{uuid.uuid4().hex[:8]}"
    ensure_layers(spark, [layer], Scratch(spark, "files").location("warehouse"))
    try:
        lines = fixtures.table(spark, sf_dir, "lineitem")
        table = publish_table(lines, f"{layer}.lines", coalesce_to=2)
        return spark.createDataFrame([(table.count(), len(table.inputFiles()))], "rows bigint, files bigint")
    finally:
        spark.sql(f"DROP NAMESPACE {layer} CASCADE")


def table_preview(spark, sf_dir):
    """The feature is the row limit itself: how many rows come, and how many are in the table."""
    typed = _typed(spark, sf_dir)
    key = F.xxhash64(*typed.columns)
    shown = preview(typed).select(key.alias("key"))
    inside = shown.join(typed.select(key.alias("key")).distinct(), "key")
    return shown.agg(F.count("*").alias("rows")).unionByName(inside.agg(F.count("*").alias("rows"))).agg(
        F.max("rows").alias("shown"), F.min("rows").alias("in_table")
    )


QUERIES: dict[str, Query] = {
    "zones_clean": _query(zones_clean),
    "stg_zones": _query(stg_zones),
    "dim_zone": _query(dim_zone),
    "trips_typed": _query(trips_typed),
    "trips_dedup": _query(trips_dedup),
    "trip_duration": _query(trip_duration),
    "trip_calendar": _query(trip_calendar),
    "trip_ratios": _query(trip_ratios),
    "decode_payment": _query(decode_payment),
    "decode_rate": _query(decode_rate),
    "decode_store_flag": _query(decode_store_flag),
    "airport_flag": _query(airport_flag),
    "dq_flags": _query(dq_flags),
    "dq_summary": _query(dq_summary_all),
    "dq_summary_short": _query(dq_summary_short),
    "dq_gate": _query(dq_gate_result),
    "row_reconcile": _query(row_reconcile),
    "trips_clean": _query(trips_clean),
    "trips_enriched": _query(trips_enriched),
    "trips_enriched_shuffled": _query(trips_enriched_shuffled),
    "stg_trips": _query(stg_trips),
    "fact_trip": _query(fact_trip),
    "events_row_number": _query(events_row_number),
    "orders_row_number": _query(orders_row_number),
    **{name: _query(_mart(name)) for name in MARTS},
    "marts_one_scan": _query(marts_one_scan),
    "check_not_null": _query(check_not_null_rows),
    "check_unique": _query(check_unique_values),
    "check_trip_amounts": _query(check_trip_amounts),
    "check_hourly_demand": _query(check_hourly_demand),
    "run_checks": _query(run_all_checks),
    "month_scan": _query(month_scan),
    "lookup_csv": _query(lookup_csv),
    "input_coverage": _query(input_months),
    "month_scan_filled": _query(month_scan_filled),
    "publish_reload": _query(publish_reload),
    "published_enriched": _query(_published_table(pipeline.SILVER_ENRICHED)),
    "published_fact": _query(_published_table(pipeline.FACT)),
    "published_daily_kpis": _query(_published_table("mart_daily_kpis")),
    "list_published": _query(list_published),
    "file_reduction": _query(file_reduction),
    "table_preview": _query(table_preview),
}
