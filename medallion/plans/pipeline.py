"""The whole run: raw copies, clean and enriched trips, staging views, gold tables, checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, Row, SparkSession

from medallion.operators.checks import ViewOf, collected, require_passed, run_checks
from medallion.operators.enrich import BROADCAST_BYTES
from medallion.operators.numbering import RANGE_ROWS
from medallion.operators.quality import RowCounter, require_valid, summary_columns, valid_only
from medallion.plans import models, preset
from medallion.plans.assertions import preset_checks
from medallion.plans.marts import MARTS, all_marts, pick_marts
from medallion.plans.resume import is_done, mark_done, published
from medallion.session import apply_settings
from medallion.sources.files import (
    MONTH_LAYOUT,
    files_state,
    month_path,
    read_lookup,
    read_months,
    require_inputs,
)
from medallion.sources.scratch import Scratch
from medallion.sources.tables import (
    ensure_layers,
    publish_sql_view,
    publish_table,
)


@dataclass(frozen=True)
class Layers:
    """Namespace of each layer; prefix with a catalog name where there is one."""

    raw: str = "raw"
    staging: str = "staging"
    gold: str = "gold"

    def names(self) -> list[str]:
        return [self.raw, self.staging, self.gold]


@dataclass(frozen=True)
class RunConfig:
    """What to read, where to publish, and how."""

    trips_root: str
    lookup_path: str
    months: Sequence[str]
    layers: Layers = field(default_factory=Layers)
    location: str | None = None
    layout: str = MONTH_LAYOUT
    fill: Mapping[str, str] | None = None
    provider: str | None = None
    coalesce_to: int | None = None
    partition_by: Sequence[str] = ()
    allow_empty: bool = False
    broadcast_bytes: int = BROADCAST_BYTES
    range_rows: int = RANGE_ROWS
    check_before_publish: bool = False
    fail_on_checks: bool = True
    resume: bool = False

    def raw(self, table: str) -> str:
        return f"{self.layers.raw}.{table}"

    def staging(self, table: str) -> str:
        return f"{self.layers.staging}.{table}"

    def gold(self, table: str) -> str:
        return f"{self.layers.gold}.{table}"

    def settings(self) -> str:
        """All that decides what the steps make."""
        return repr(replace(self, months=tuple(self.months), fail_on_checks=True, resume=False))


# Published table names.
BRONZE_TRIPS = "bronze_yellow_trip_raw"
BRONZE_ZONES = "taxi_zone_lookup_raw"
SILVER_TRIPS = "silver_yellow_trip_clean"
SILVER_ZONES = "silver_dim_taxi_zone"
SILVER_ENRICHED = "silver_trip_enriched"
STAGED_TRIPS = "stg_trip_enriched"
STAGED_ZONES = "stg_dim_zone"
FACT = "fact_trip"
DIM_ZONE = "dim_zone"


@dataclass(frozen=True)
class SilverReport:
    """Quality summary row and row counts per step of a silver run."""

    summary: Row
    steps: DataFrame


def bronze(spark: SparkSession, config: RunConfig) -> dict[str, DataFrame]:
    """Publish the raw files as tables, uncleaned."""
    apply_settings(spark)
    ensure_layers(spark, [config.layers.raw], config.location)
    trips = read_months(spark, config.trips_root, config.months, config.layout, config.fill)
    zones = read_lookup(spark, config.lookup_path, preset.LOOKUP_COLUMNS)
    return {
        BRONZE_TRIPS: publish_table(
            trips, config.raw(BRONZE_TRIPS), config.provider, coalesce_to=config.coalesce_to
        ),
        BRONZE_ZONES: publish_table(zones, config.raw(BRONZE_ZONES), config.provider),
    }


def silver(spark: SparkSession, config: RunConfig) -> SilverReport:
    """Clean, check and enrich the raw tables.

    The deduplication is the one wide step, so its valid rows are computed once into scratch, and
    the quality summary of all is observed on the way.  What follows is row by row and
    cheaper to repeat than to store: both published trip tables derive from there, and
    count their rows while they are written.  Nothing is replaced before the gate has passed.
    """
    apply_settings(spark)
    raw_trips = spark.table(config.raw(BRONZE_TRIPS))
    raw_zones = spark.table(config.raw(BRONZE_ZONES))
    steps = RowCounter(spark)
    steps.add("bronze_trips", raw_trips.count())
    steps.add("bronze_zones", raw_zones.count())
    with Scratch(spark, "silver") as scratch:
        unique = models.dedup_trips(models.type_trips(raw_trips))
        report = Observation()
        judged = models.judge_trips(unique).observe(
            report, *summary_columns(preset.TRIP_FLAGS, valid=preset.VALID)
        )
        stored = scratch.keep(valid_only(judged, preset.VALID).select(*unique.columns), "unique")
        summary = require_valid(Row(**report.get), config.allow_empty)
        zones = publish_table(
            models.clean_zones(raw_zones), config.raw(SILVER_ZONES), config.provider
        )
        steps.add("zones", zones.count())
        steps.add("dedup_trips", summary["total_after_dedup"])
        clean = models.judge_trips(stored)
        publish_table(
            steps.watch("clean_trips", clean),
            config.raw(SILVER_TRIPS),
            config.provider,
            config.partition_by,
        )
        enriched = models.enrich_trips(clean, zones, config.broadcast_bytes)
        publish_table(
            steps.watch("enriched_trips", enriched),
            config.raw(SILVER_ENRICHED),
            config.provider,
            config.partition_by,
        )
    return SilverReport(
        summary, steps.report({"duplicates_removed": ("bronze_trips", "dedup_trips")})
    )


def staging(spark: SparkSession, config: RunConfig) -> dict[str, DataFrame]:
    """Catalog views with the published names and types."""
    apply_settings(spark)
    ensure_layers(spark, [config.layers.staging], config.location)
    return {
        STAGED_TRIPS: publish_sql_view(
            spark,
            config.staging(STAGED_TRIPS),
            models.stage_trips_sql(config.raw(SILVER_ENRICHED)),
        ),
        STAGED_ZONES: publish_sql_view(
            spark,
            config.staging(STAGED_ZONES),
            models.stage_zones_sql(config.raw(SILVER_ZONES)),
        ),
    }


def _tables(spark: SparkSession, config: RunConfig) -> dict[str, DataFrame]:
    """The published tables the gold checks also cover."""
    return {
        SILVER_ENRICHED: spark.table(config.raw(SILVER_ENRICHED)),
        SILVER_ZONES: spark.table(config.raw(SILVER_ZONES)),
        STAGED_TRIPS: spark.table(config.staging(STAGED_TRIPS)),
        STAGED_ZONES: spark.table(config.staging(STAGED_ZONES)),
    }


def _views(tables: Mapping[str, DataFrame]) -> dict[str, ViewOf]:
    """The staged trips are a view of the enriched ones, so one scan checks both."""
    return {STAGED_TRIPS: models.staged_view(tables[SILVER_ENRICHED])}


def gold(spark: SparkSession, config: RunConfig) -> dict[str, DataFrame]:
    """Publish fact, dimension and marts; the finished fact is scanned once for all marts.

    With ``check_before_publish`` the fact and the marts are built in scratch and all
    checks must pass before the first gold table is replaced.
    """
    apply_settings(spark)
    ensure_layers(spark, [config.layers.gold], config.location)

    def publish(name: str, df: DataFrame) -> DataFrame:
        parts = config.partition_by if name == FACT else ()
        return publish_table(df, config.gold(name), config.provider, parts)

    with Scratch(spark, "gold") as scratch:
        staged = spark.table(config.staging(STAGED_TRIPS))
        # The view only leaves rows out, and a stored table's count comes from its files' footers.
        bound = spark.table(config.raw(SILVER_ENRICHED)).count()
        fact = models.build_fact(staged, scratch, config.range_rows, bound)
        dim = models.build_dim_zone(spark.table(config.staging(STAGED_ZONES)))
        if not config.check_before_publish:
            tables = {FACT: publish(FACT, fact), DIM_ZONE: publish(DIM_ZONE, dim)}
            marts = pick_marts(scratch.keep(all_marts(tables[FACT]), "marts"))
            return {**tables, **{name: publish(name, df) for name, df in marts.items()}}
        ready = {FACT: scratch.keep(fact, FACT), DIM_ZONE: dim}
        ready |= pick_marts(scratch.keep(all_marts(ready[FACT]), "marts"))
        tables = {**_tables(spark, config), **ready}
        require_passed(run_checks(preset_checks(tables, _views(tables))))
        return {name: publish(name, df) for name, df in ready.items()}


def check(spark: SparkSession, config: RunConfig) -> DataFrame:
    """The report of all checks over the published tables."""
    apply_settings(spark)
    names = [FACT, *MARTS]
    tables = {**_tables(spark, config), **{name: spark.table(config.gold(name)) for name in names}}
    return run_checks(preset_checks(tables, _views(tables)))


def _step(
    spark: SparkSession,
    config: RunConfig,
    work: Callable[[SparkSession, RunConfig], object],
    inputs: Sequence[str] | None,
    outputs: Sequence[str],
) -> None:
    settings = config.settings()
    if config.resume and is_done(spark, work.__name__, settings, inputs, outputs):
        return
    work(spark, config)
    mark_done(spark, work.__name__, settings, inputs, outputs)


def run(spark: SparkSession, config: RunConfig) -> DataFrame:
    """Everything in order; returns the check report and raises if a check failed.

    By default the checks follow the publication, so failing tables are visible; see
    ``check_before_publish``.  ``fail_on_checks=False`` only reports.

    With ``resume``, steps are left out that an earlier run finished with the same settings, from the
    same inputs, and whose tables nobody published anew since.  The views and the checks
    are never left out.  Another release of the code is not noticed: do not resume across one.
    """
    apply_settings(spark)
    require_inputs(spark, config.trips_root, config.months, config.layout)
    raw_files = [*[month_path(config.trips_root, m, config.layout) for m in config.months], config.lookup_path]
    raw = [config.raw(BRONZE_TRIPS), config.raw(BRONZE_ZONES)]
    clean = [config.raw(SILVER_ZONES), config.raw(SILVER_TRIPS), config.raw(SILVER_ENRICHED)]
    marts = [config.gold(name) for name in [DIM_ZONE, FACT, *MARTS]]
    _step(spark, config, bronze, [files_state(spark, raw_files)], raw)
    _step(spark, config, silver, published(spark, raw), clean)
    staging(spark, config)
    _step(spark, config, gold, published(spark, clean), marts)
    report = check(spark, config)
    return require_passed(report) if config.fail_on_checks else collected(report)
