import dataclasses
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from medallion.__main__ import configure, main, parse
from medallion.operators.checks import ChecksFailed
from medallion.operators.quality import NoValidRows
from medallion.plans import models, pipeline
from medallion.plans.marts import MARTS
from medallion.session import apply_settings
from medallion.sources.files import MissingInput, month_path
from medallion.sources.scratch import Scratch, application_folder
from medallion.sources.tables import (
    list_catalogs,
    list_layers,
    list_tables,
    preview,
    publish_table,
    publish_view,
)
from tests.conftest import ZONE_ROWS


@pytest.fixture(scope="module")
def config(spark, make_trips, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    day = lambda d, h: dt.datetime(2025, 1, d, h)

    def trip(d, h, **more):
        start = day(d, h)
        return {
            "tpep_pickup_datetime": start,
            "tpep_dropoff_datetime": start + dt.timedelta(minutes=20),
            **more,
        }

    january = make_trips(trip(5, 10), trip(5, 10), trip(5, 11, fare_amount=-1.0), trip(6, 9, payment_type=2))
    february = make_trips(trip(7, 8, PULocationID=264), trip(7, 7, RatecodeID=2.0))
    january.write.parquet(month_path(str(root), "2025-01"))
    february.write.parquet(month_path(str(root), "2025-02"))
    lookup = root / "zones.csv"
    lookup.write_text(
        "\n".join(['"LocationID","Borough","Zone","service_zone"', *[f'{r[0]},"{r[1]}","{r[2]}","{r[3]}"' for r in ZONE_ROWS]])
    )
    return pipeline.RunConfig(
        trips_root=str(root),
        lookup_path=str(lookup),
        months=["2025-01", "2025-02"],
        layers=pipeline.Layers("raw_t", "staging_t", "gold_t"),
        location=str(root / "warehouse"),
        coalesce_to=2,
    )


def contents(spark, config):
    names = [config.raw(pipeline.SILVER_ENRICHED), config.gold(pipeline.FACT), config.gold(pipeline.DIM_ZONE)]
    names += [config.gold(m) for m in MARTS]
    return {n: sorted(map(str, spark.table(n).collect())) for n in names}


def test_whole_run_twice(spark, config):
    report = pipeline.run(spark, config)
    assert report.count() == 25 and report.filter("not passed").count() == 0
    first = contents(spark, config)
    fact = spark.table(config.gold(pipeline.FACT)).sort("trip_sk")
    assert len(fact.columns) == 37
    assert [r.trip_sk for r in fact.collect()] == [1, 2, 3, 4]
    assert [r.pickup_borough for r in fact.collect()] == ["EWR", "EWR", "EWR", "Unknown"]
    assert len(spark.table(config.staging(pipeline.STAGED_TRIPS)).columns) == 58
    assert preview(fact, 3).count() == 3
    kpis = spark.table(config.gold("mart_daily_kpis")).sort("pickup_date").collect()
    assert [(r.trip_count, r.total_revenue, r.airport_trip_count) for r in kpis] == [
        (1, 25.0, 0),
        (1, 25.0, 0),
        (2, 50.0, 1),
    ]
    pipeline.run(spark, config)
    assert contents(spark, config) == first
    assert {r.table for r in list_tables(spark, "gold_t").collect()} == {"fact_trip", "dim_zone", *MARTS}
    assert "gold_t" in {r[0] for r in list_layers(spark).collect()}
    assert list_catalogs(spark).count() >= 1


def test_silver_report(spark, config):
    pipeline.bronze(spark, config)
    report = pipeline.silver(spark, config)
    assert {r.step: r.rows for r in report.steps.collect()} == {
        "bronze_trips": 6,
        "bronze_zones": 4,
        "zones": 4,
        "dedup_trips": 5,
        "clean_trips": 4,
        "enriched_trips": 4,
        "duplicates_removed": 1,
    }
    assert report.summary.invalid_fare_amount_cnt == 1


def test_steps_run_as_separate_jobs(spark, config, tmp_path):
    options = ["--trips-root", config.trips_root, "--lookup", config.lookup_path]
    options += ["--raw", "raw_s", "--staging", "staging_s", "--gold", "gold_s"]
    options += ["--location", str(tmp_path), "--partition-by", "pickup_date", "--months", "2025-01, 2025-02"]
    for step in ["inputs", "bronze", "silver", "staging", "gold", "check"]:
        main([step, *options])
    fact = spark.table("gold_s.fact_trip")
    assert sorted(r.trip_sk for r in fact.collect()) == [1, 2, 3, 4]
    assert any("pickup_date=2025-01-06" in f for f in fact.inputFiles())


def test_gate_stops_before_any_silver_table(spark, config, make_trips, tmp_path):
    make_trips({"fare_amount": -1.0}).write.parquet(month_path(str(tmp_path), "2025-01"))
    bad = dataclasses.replace(
        config,
        trips_root=str(tmp_path),
        months=["2025-01"],
        layers=pipeline.Layers("raw_g", "staging_g", "gold_g"),
        location=str(tmp_path / "warehouse"),
    )
    with pytest.raises(NoValidRows):
        pipeline.run(spark, bad)
    assert {r.table for r in list_tables(spark, "raw_g").collect()} == {
        pipeline.BRONZE_TRIPS,
        pipeline.BRONZE_ZONES,
    }


def test_failed_checks_can_guard_gold(spark, config, make_trips, tmp_path):
    make_trips({"tip_amount": -1.0, "PULocationID": 77}).write.parquet(month_path(str(tmp_path), "2025-01"))
    guarded = dataclasses.replace(
        config,
        trips_root=str(tmp_path),
        months=["2025-01"],
        layers=pipeline.Layers("raw_c", "staging_c", "gold_c"),
        location=str(tmp_path / "warehouse"),
        check_before_publish=True,
    )
    with pytest.raises(ChecksFailed, match="assert_trip_amount_nonnegative"):
        pipeline.run(spark, guarded)
    assert list_tables(spark, "gold_c").count() == 0
    with pytest.raises(ChecksFailed, match="not_null stg_trip_enriched.pickup_borough: 1"):
        pipeline.run(spark, dataclasses.replace(guarded, check_before_publish=False))
    assert spark.table("gold_c.fact_trip").count() == 1
    report = pipeline.run(
        spark, dataclasses.replace(guarded, check_before_publish=False, fail_on_checks=False)
    )
    assert report.filter("not passed").count() == 4


def test_missing_month_stops_the_run(spark, config):
    with pytest.raises(MissingInput, match="2025-03"):
        pipeline.run(spark, dataclasses.replace(config, months=["2025-01", "2025-03"]))


def test_publish_partitioned_and_view(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS parts LOCATION '{tmp_path}/parts'")
    df = spark.range(100).selectExpr("id", "id % 3 as p")
    table = publish_table(df, "parts.t", partition_by=["p"])
    assert table.count() == 100
    assert table.filter("p = 1").inputFiles() and len(table.inputFiles()) <= 6
    assert publish_table(df.limit(5), "parts.t").count() == 5
    assert publish_view(df, "some_view").count() == 100


def test_coalesce_and_partitions_are_refused_together(spark):
    with pytest.raises(ValueError, match="give one"):
        publish_table(spark.range(3), "nowhere.t", partition_by=["id"], coalesce_to=2)


def test_a_failing_write_leaves_the_old_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS swaps LOCATION '{tmp_path}/swaps'")
    publish_table(spark.range(7), "swaps.t")
    broken = spark.range(5).selectExpr("id", "cast(concat('x', id) as int) as bad")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        publish_table(broken, "swaps.t")
    assert spark.table("swaps.t").count() == 7
    assert [r.table for r in list_tables(spark, "swaps").collect()] == ["t"]
    parts = spark.range(9).selectExpr("id", "id % 2 as p")
    for _ in range(2):
        table = publish_table(parts, "swaps.t", partition_by=["p"])
        assert table.filter("p = 0").count() == 5 and spark.table("swaps.t").count() == 9
    assert publish_table(spark.table("swaps.t").filter("p = 1"), "swaps.t").count() == 4


def test_nothing_is_left_in_scratch_after_a_run(spark, config):
    pipeline.run(spark, config)
    before = set(os.listdir(application_folder(spark)))
    pipeline.run(spark, config)
    assert set(os.listdir(application_folder(spark))) == before


def test_stored_trips_are_read_twice(spark, config, monkeypatch):
    """Once for the clean and once for the enriched table; summary and counts come with writes."""
    pipeline.bronze(spark, config)
    actions = []
    keep, count = Scratch.keep, DataFrame.count
    monkeypatch.setattr(Scratch, "keep", lambda self, df, name: actions.append(("keep", name)) or keep(self, df, name))
    monkeypatch.setattr(DataFrame, "count", lambda self: actions.append(("count", self.columns[0])) or count(self))
    monkeypatch.setattr(pipeline, "publish_table", lambda df, name, *a, **k: actions.append(("publish", name)) or publish_table(df, name, *a, **k))
    pipeline.silver(spark, config)
    assert [a for a in actions if a[0] != "count"] == [
        ("keep", "unique"),
        ("publish", config.raw(pipeline.SILVER_ZONES)),
        ("publish", config.raw(pipeline.SILVER_TRIPS)),
        ("publish", config.raw(pipeline.SILVER_ENRICHED)),
    ]
    assert [a[1] for a in actions if a[0] == "count"] == ["VendorID", "LocationID", "location_id"]


def test_only_valid_trips_are_stored(spark, config, monkeypatch):
    """The summary still covers the others."""
    pipeline.bronze(spark, config)
    stored = {}
    keep = Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, name: stored.setdefault(name, keep(self, df, name)))
    rows = []
    publish = lambda df, name, *a, **k: rows.append(stored["unique"].count()) or publish_table(df, name, *a, **k)
    monkeypatch.setattr(pipeline, "publish_table", publish)
    report = pipeline.silver(spark, config)
    assert rows == [4, 4, 4]
    assert (report.summary.total_after_dedup, report.summary.total_invalid_cnt) == (5, 1)


@pytest.fixture
def new_york(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    apply_settings(spark)


def test_steps_work_in_utc_whatever_the_session_zone(spark, config, make_trips, tmp_path, new_york):
    """A trip over the clock change of 2025-03-09 takes 80 minutes, not 20."""
    change = {"tpep_pickup_datetime": dt.datetime(2025, 3, 9, 1, 50), "tpep_dropoff_datetime": dt.datetime(2025, 3, 9, 3, 10)}
    raw = make_trips(change)
    with pytest.raises(ValueError, match="New_York"):
        models.flag_trips(raw)
    raw.write.parquet(month_path(str(tmp_path), "2025-03"))
    spring = dataclasses.replace(
        config, trips_root=str(tmp_path), months=["2025-03"], location=str(tmp_path / "warehouse"),
        layers=pipeline.Layers("raw_z", "staging_z", "gold_z"),
    )
    pipeline.bronze(spark, spring)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    pipeline.silver(spark, spring)
    assert spark.table(spring.raw(pipeline.SILVER_TRIPS)).first().trip_duration_min == 80


def test_an_unreadable_fee_is_not_hidden_by_the_contract(spark, make_trips):
    trips = make_trips({}).withColumn("cbd_congestion_fee", F.lit("much"))
    zones = models.clean_zones(spark.createDataFrame(ZONE_ROWS, "LocationID string, Borough string, Zone string, service_zone string"))
    staged = models.stage_trips(models.enrich_trips(models.clean_trips(trips), zones))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staged.collect()


def test_months_are_required(monkeypatch, capsys):
    monkeypatch.delenv("RAW_TRIP_MONTHS", raising=False)
    with pytest.raises(SystemExit):
        parse(["all", "--trips-root", "r", "--lookup", "l"])
    assert "--months" in capsys.readouterr().err
    options = ["all", "--trips-root", "r", "--lookup", "l", "--months", "2025-01", "--fill", "fee=double", "--allow-empty"]
    made = configure(parse([*options, "--broadcast-bytes", "5", "--range-rows", "7"]))
    assert (made.fill, made.allow_empty, made.broadcast_bytes, made.range_rows) == ({"fee": "double"}, True, 5, 7)
    monkeypatch.setenv("RAW_TRIP_MONTHS", "2025-02")
    assert configure(parse(options[:5])).months == ["2025-02"]
