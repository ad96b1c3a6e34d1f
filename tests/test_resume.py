import dataclasses
import os
import time

import pytest

from medallion.plans import pipeline
from medallion.plans.resume import STEP
from medallion.sources.files import files_state, month_path
from medallion.sources.tables import current_version, publish_table, table_property, versions
from tests.test_pipeline import config, contents  # noqa: F401


class Killed(RuntimeError):
    pass


@pytest.fixture
def steps(monkeypatch):
    """The steps that really ran, in order."""
    ran = []
    for name in ("bronze", "silver", "staging", "gold"):
        real = getattr(pipeline, name)

        def watched(spark, config, real=real, name=name):
            ran.append(name)
            return real(spark, config)

        watched.__name__ = name
        monkeypatch.setattr(pipeline, name, watched)
    return ran


def at(config, name, **more):  # noqa: F811
    layers = pipeline.Layers(f"raw_{name}", f"staging_{name}", f"gold_{name}")
    return dataclasses.replace(config, layers=layers, **more)


def test_a_run_killed_after_silver_goes_on(spark, config, steps, monkeypatch):  # noqa: F811
    whole, broken = at(config, "whole"), at(config, "broken", resume=True)
    pipeline.run(spark, whole)
    steps.clear()
    with monkeypatch.context() as patch:
        def die(*_):
            raise Killed

        patch.setattr(pipeline, "staging", die)
        with pytest.raises(Killed):
            pipeline.run(spark, broken)
    assert steps == ["bronze", "silver"]
    steps.clear()
    report = pipeline.run(spark, broken)
    assert steps == ["staging", "gold"] and report.count() == 25
    own = contents(spark, broken)
    assert [rows for _, rows in sorted(own.items())] and list(own.values()) == list(contents(spark, whole).values())
    steps.clear()
    pipeline.run(spark, broken)
    assert steps == ["staging"] and contents(spark, broken) == own
    steps.clear()
    pipeline.run(spark, dataclasses.replace(broken, resume=False))
    assert steps == ["bronze", "silver", "staging", "gold"]


@pytest.mark.parametrize("table", [pipeline.SILVER_ZONES, pipeline.SILVER_TRIPS, pipeline.SILVER_ENRICHED])
def test_a_step_killed_in_the_middle_is_not_done(spark, config, steps, monkeypatch, table):  # noqa: F811
    own = at(config, f"mid_{table[-5:]}", resume=True)
    pipeline.run(spark, own)
    first = contents(spark, own)
    steps.clear()
    with monkeypatch.context() as patch:
        def publish(df, name, *more, **named):
            if name.endswith(table):
                raise Killed
            return publish_table(df, name, *more, **named)

        patch.setattr(pipeline, "publish_table", publish)
        with pytest.raises(Killed):
            pipeline.run(spark, dataclasses.replace(own, resume=False))
    steps.clear()
    pipeline.run(spark, own)
    # Bronze was finished by the killed run; silver was not, also where it had not published anything yet.
    assert steps == ["silver", "staging", "gold"] and contents(spark, own) == first


def test_whatever_changes_is_made_again(spark, config, steps, tmp_path):  # noqa: F811
    raw = str(tmp_path / "raw")
    for month in config.months:
        spark.read.parquet(month_path(config.trips_root, month)).write.parquet(month_path(raw, month))
    own = at(config, "change", trips_root=raw, resume=True)

    def ran(run_config):
        steps.clear()
        pipeline.run(spark, run_config)
        return list(steps)

    everything = ["bronze", "silver", "staging", "gold"]
    assert ran(own) == everything
    assert ran(own) == ["staging"]
    # Not what the steps make: how they are judged.
    assert ran(dataclasses.replace(own, fail_on_checks=False, months=tuple(own.months))) == ["staging"]
    # A setting, and back again.
    assert ran(dataclasses.replace(own, range_rows=2)) == everything
    assert ran(dataclasses.replace(own, months=own.months[:1])) == everything
    assert ran(own) == everything
    # A raw file of the same length that is newer.
    folder = month_path(raw, own.months[0])
    part = next(os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet"))
    os.utime(part, (time.time() + 60, time.time() + 60))
    assert ran(own) == everything
    # One output of silver, published by someone else.
    publish_table(spark.table(own.raw(pipeline.SILVER_TRIPS)), own.raw(pipeline.SILVER_TRIPS))
    assert ran(own) == ["silver", "staging", "gold"]
    # One mart is gone.
    spark.sql(f"DROP VIEW {own.gold('mart_daily_kpis')}")
    assert ran(own) == ["staging", "gold"]
    assert ran(own) == ["staging"]


def test_the_version_behind_a_name(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS behind LOCATION '{tmp_path}/behind'")
    assert current_version(spark, "behind.t") is None
    publish_table(spark.range(3), "behind.t")
    publish_table(spark.range(4), "behind.t", keep_versions=1)
    assert [current_version(spark, "behind.t")] == versions(spark, "behind.t")[-1:] and len(versions(spark, "behind.t")) == 2
    assert table_property(spark, "behind.t", STEP) is None
    spark.sql("CREATE TABLE behind.other AS SELECT 1 AS a")
    spark.sql("CREATE VIEW behind.view AS SELECT * FROM behind.other")
    assert current_version(spark, "behind.other") is None and current_version(spark, "behind.view") is None


def test_state_of_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1").write_text("x")
    first = files_state(spark, [str(tmp_path)])
    assert files_state(spark, [str(tmp_path)]) == first
    (tmp_path / "a" / "2").write_text("y")
    assert files_state(spark, [str(tmp_path)]) != first
