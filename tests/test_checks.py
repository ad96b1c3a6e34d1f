import dataclasses
import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from medallion.operators.checks import (
    ChecksFailed,
    TableChecks,
    ViewOf,
    check_no_rows,
    check_not_null,
    check_unique,
    require_passed,
    run_checks,
)
from medallion.plans import pipeline
from medallion.plans.assertions import NONNEGATIVE, NOT_NULL, UNIQUE, preset_checks
from tests.conftest import plan
from tests.test_pipeline import config  # noqa: F401


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(1, -1.0), (1, 2.0), (None, None), (None, 3.0)], "k int, v double")


def test_single_checks(table):
    assert check_not_null(table, "k").count() == 2
    assert [tuple(r) for r in check_unique(table, "k").collect()] == [(1, 2)]
    assert check_no_rows(table, F.col("v") < 0).count() == 1


VALUES = {
    "bigint": [0, 1, -1, 63, 64, -64, -65, 2**63 - 1, -(2**63), 2**62, 5],
    "int": [0, 63, 64, -1, 2**31 - 1, -(2**31)],
    "tinyint": [0, 63, 64, 127, -128, -1],
    "string": ["", "a", "A", "a ", "ä", "x" * 300],
    "double": [0.0, 1.5, float("inf"), float("nan"), -1.5],
    "boolean": [True, False],
    "date": [dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2025, 1, 1)],
    "timestamp": [dt.datetime(1969, 12, 31, 23), dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1, 0, 0, 0, 1)],
    "timestamp_ntz": [dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1, 0, 0, 0, 1)],
    "decimal(18,0)": [Decimal(0), Decimal(63), Decimal(64), Decimal(-(10**17))],
    "decimal(38,0)": [Decimal(0), Decimal(10**37), Decimal(10**37 + 1)],
    "decimal(10,2)": [Decimal("0.01"), Decimal("0.02"), Decimal("0.10")],
    "binary": [b"", b"a", b"\x00"],
    "array<int>": [[], [1], [1, 2]],
}


@pytest.mark.parametrize("kind", VALUES)
def test_unique_values_of_every_type(spark, kind):
    values = VALUES[kind]
    frame = lambda rows: spark.createDataFrame([(v,) for v in rows], f"v {kind}")
    clean, dirty = frame([*values, None, None]), frame([*values, values[0], values[-1], values[-1], None, None])
    found = check_unique(clean, "v")
    assert found.collect() == [] and found.columns == ["value", "rows"]
    assert found.schema["value"].dataType == clean.schema["v"].dataType
    assert sorted((str(r.value), r.rows) for r in check_unique(dirty, "v").collect()) == sorted(
        [(str(dirty.first().v), 2), (str(dirty.collect()[len(values) + 1].v), 3)]
    )


def test_equal_zeros_and_nans_repeat(spark):
    frame = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (-float("nan"),)], "v double")
    assert sorted(r.rows for r in check_unique(frame, "v").collect()) == [2, 2]


def test_unique_against_a_plain_count(spark):
    """Values that share words without being equal, scattered over tasks, a third of all rows on one."""
    rng = random.Random(5)
    values = [rng.choice([7, rng.randrange(-3000, 3000), rng.randrange(-3000, 3000)]) for _ in range(3000)]
    counts = {v: n for v, n in Counter(values).items() if n > 1}
    frame = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(7)
    for kind in ("bigint", "string", "double"):
        found = check_unique(frame.select(F.col("v").cast(kind)), "v").collect()
        assert {int(float(r.value)): r.rows for r in found} == counts


def test_a_dense_key_shuffles_words_not_values(spark):
    frame = spark.range(0, 64 * 1000, 1, 4).withColumnRenamed("id", "v")
    words = []
    real = DataFrame.filter

    def watch(self, condition):
        if "_marks" in self.columns:
            words.append(self.count())
        return real(self, condition)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(DataFrame, "filter", watch)
        assert check_unique(frame, "v").count() == 0
    assert words == [1000]


def test_report(table):
    report = run_checks(
        [TableChecks("t", table, ("k", "v"), ("k", "v"), {"nonneg": (F.col("v") < 0,)})]
    )
    assert {tuple(r) for r in report.collect()} == {
        ("not_null", "t", "k", 2, False),
        ("not_null", "t", "v", 1, False),
        ("unique", "t", "k", 1, False),
        ("unique", "t", "v", 0, True),
        ("nonneg", "t", None, 1, False),
    }
    with pytest.raises(ChecksFailed, match="not_null t.k: 2"):
        require_passed(report)
    assert require_passed(report.filter("passed")).count() == 1


def test_preset_has_25_checks():
    assert sum(map(len, NOT_NULL.values())) == 20
    assert sum(map(len, UNIQUE.values())) == 3
    assert len(NONNEGATIVE) == 2


def test_no_checks_is_an_error():
    with pytest.raises(ValueError):
        run_checks([])


def rows(report):
    return sorted(tuple(r) for r in report.collect())


def test_a_view_is_checked_while_its_base_is_read(spark, tmp_path):
    path = str(tmp_path / "base")
    data = [(1, -1.0, True), (2, None, True), (3, -5.0, False), (None, 4.0, True), (5, 1.0, None)]
    spark.createDataFrame(data, "k int, v double, ok boolean").write.parquet(path)
    base, again = spark.read.parquet(path), spark.read.parquet(path)
    view = ViewOf(base, {"v": F.col("k").cast("double"), "half": F.col("v") / 2}, F.col("ok"))
    made = base.filter(F.col("ok")).select(F.col("k").cast("double").alias("v"), (F.col("v") / 2).alias("half"))

    def checks(view, other):
        return run_checks(
            [
                TableChecks("base", base, ("k", "v"), (), {"low": (F.col("v") < 0,)}),
                TableChecks("view", made, ("v", "half"), (), {"low": (F.col("half") < 0, F.col("v") > 4)}, view),
                TableChecks("again", other, ("k",)),
                TableChecks("second", made, ("half",), (), {}, view),
            ]
        )

    together, apart = checks(view, again), checks(None, again.limit(5))
    assert rows(together) == rows(apart)
    assert ("low", "view", None, 1, False) in rows(together) and ("not_null", "view", "half", 1, False) in rows(together)
    assert plan(together).count("FileScan parquet") == 1 < plan(apart).count("FileScan parquet")


def test_a_wrong_claim_about_a_view_is_not_believed(spark, tmp_path):
    path = str(tmp_path / "base")
    spark.createDataFrame([(1, True), (None, False)], "k int, ok boolean").write.parquet(path)
    base = spark.read.parquet(path)
    claim = ViewOf(base, {"k": F.col("k")}, F.col("ok"))
    assert TableChecks("t", base.select("k"), view=claim).lineage() is None
    assert rows(run_checks([TableChecks("t", base.select("k"), ("k",), view=claim)])) == [("not_null", "t", "k", 1, False)]


def test_published_staging_is_checked_with_its_table(spark, config):
    """The catalog view's plan is the one that the models give, so the claim holds for it."""
    pipeline.run(spark, dataclasses.replace(config, fail_on_checks=False))
    tables = pipeline._tables(spark, config)
    claimed = {c.table: c.lineage() for c in preset_checks(tables, pipeline._views(tables))}
    assert claimed[pipeline.STAGED_TRIPS] is not None
    report = pipeline.check(spark, config)
    text = plan(report)
    # Enriched and staged in one scan; the fact, two zone tables with their unique checks, four marts and one unique check.
    trips = [line for line in text.splitlines() if "FileScan" in line and "stg" not in line and "total_amount" in line and "silver" in line]
    assert len(trips) == 1, text
