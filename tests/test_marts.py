"""All marts in one scan are the marts one by one."""

from __future__ import annotations

from pyspark.sql import functions as F

from medallion.plans.marts import MARTS, all_marts, pick_mart
from tests.conftest import plan
from verification.queries import _fact

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


def test_one_scan_gives_every_mart(spark, tmp_path):
    fact = _fact(spark, SF_DIR)
    fact.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    # NULL keys are groups of their own, and not those of a key that a mart lacks.
    fact = fact.withColumn("pickup_zone", F.when(F.col("pickup_hour") != 3, F.col("pickup_zone")))
    fact = fact.withColumn("payment_type", F.when(F.col("pickup_hour") != 4, F.col("payment_type")))
    made = all_marts(fact)
    for name, build in MARTS.items():
        alone = build(fact)
        assert pick_mart(made, name).schema == alone.schema
        assert rows(pick_mart(made, name)) == rows(alone)
    assert made.filter("mart is null").count() == 0
    text = plan(made)
    assert text.count("Scan parquet") == 1 and "Expand" in text


def test_no_trips_no_marts(spark):
    assert all_marts(_fact(spark, SF_DIR).limit(0)).count() == 0
