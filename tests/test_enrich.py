import re

import pytest
from pyspark.sql import functions as F

from medallion.operators.enrich import AmbiguousDimension, enrich
from medallion.plans import models
from tests.conftest import ZONE_ROWS, plan

ZONE_SCHEMA = "LocationID string, Borough string, Zone string, service_zone string"


@pytest.fixture(scope="module")
def zones(spark):
    return models.clean_zones(spark.createDataFrame(ZONE_ROWS, ZONE_SCHEMA))


def test_clean_zones(spark):
    rows = [*ZONE_ROWS, ("x", "No", "No", "No"), ("2", "Zzz", "Later", "Zzz"), (None, "a", "b", "c")]
    cleaned = models.clean_zones(spark.createDataFrame(rows, ZONE_SCHEMA)).sort("location_id")
    assert [tuple(r) for r in cleaned.collect()] == [
        (1, "EWR", "Newark Airport", "EWR"),
        (2, "Queens", "Jamaica Bay", "Boro Zone"),
        (264, "Unknown", "N/A", "Unknown"),
        (265, "Unknown", "Outside", "Unknown"),
    ]


def test_lookup_keeps_every_row_in_both_strategies(make_trips, zones):
    trips = models.clean_trips(
        make_trips({}, {"PULocationID": 77}, {"PULocationID": 264, "DOLocationID": 1})
    )
    small = models.enrich_trips(trips, zones)
    large = models.enrich_trips(trips, zones, broadcast_bytes=0)
    rows = sorted(small.collect(), key=lambda r: r.PULocationID)
    assert [(r.pu_borough, r.do_borough, r.pu_location_id) for r in rows] == [
        ("EWR", "Queens", 1),
        (None, "Queens", None),
        ("Unknown", "EWR", 264),
    ]
    assert sorted(map(str, rows)) == sorted(map(str, large.collect()))
    assert plan(small).count("BroadcastHashJoin") == 2 and "ReusedExchange" in plan(small)
    # One join per role on the distinct keys, one of the trips with those.
    assert "BroadcastHashJoin" not in plan(large) and plan(large).count("SortMergeJoin") == 3


def exchanges_of(df, column):
    """The exchanges in the plan that move ``column``."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    nodes = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text)
    return sum(any(c.split("#")[0].strip() == column for c in node.split(",")) for node in nodes)


def test_several_roles_move_the_facts_once(spark):
    """Also with NULL, unmatched and hot keys, and columns named like the operator's own."""
    rows = [(None, 1, "n"), (1, None, "m"), (None, None, "b"), (7, 9, "none"), (2, 2, "same")]
    rows += [(3, 1 + i % 5, f"hot{i}") for i in range(200)]
    facts = spark.createDataFrame(rows, "a int, b int, _used_a string").repartition(5)
    dim = spark.createDataFrame([(i, f"z{i}") for i in range(1, 6)] + [(None, "nothing")], "k int, name string")
    roles = {"x": "a", "y": "b", "z": "a"}
    large, small = (enrich(facts, dim, roles, "k", ["name"], limit) for limit in (0, 1 << 20))
    assert exchanges_of(large, "_used_a") == 1 + exchanges_of(facts, "_used_a")
    assert large.columns == small.columns == ["a", "b", "_used_a", "x_k", "x_name", "y_k", "y_name", "z_k", "z_name"]
    assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))
    found = {r._used_a: (r.x_name, r.y_name, r.z_k) for r in large.collect()}
    assert found["n"] == (None, "z1", None) and found["b"] == (None, None, None) and found["none"] == (None, None, None)
    assert found["hot3"] == ("z3", "z4", 3) and large.count() == len(rows)


def test_several_roles_of_no_facts(spark):
    dim = spark.createDataFrame([(1, "a")], "k int, v string")
    facts = spark.createDataFrame([], "f int, g int")
    assert enrich(facts, dim, {"x": "f", "y": "g"}, "k", ["v"], 0).count() == 0


def test_null_fact_key_keeps_the_row(spark, zones):
    facts = spark.createDataFrame([(None,), (1,)], "k int")
    for limit in (1 << 20, 0):
        found = enrich(facts, zones, {"a": "k"}, "location_id", ["zone"], limit).collect()
        assert {(r.k, r.a_zone) for r in found} == {(None, None), (1, "Newark Airport")}


def test_repeated_dimension_key_raises(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "k int, v string")
    facts = spark.createDataFrame([(1,)], "f int")
    with pytest.raises(AmbiguousDimension):
        enrich(facts, dim, {"x": "f"}, "k", ["v"])
    unique = dim.filter("v <> 'b'")
    assert enrich(facts, unique, {"x": "f"}, "k", ["v"]).first().x_v == "a"


@pytest.mark.parametrize("roles", [{"a": "k"}, {"a": "k", "b": "l"}])
@pytest.mark.parametrize("hot", [7, None])
def test_a_hot_or_null_key_is_split(spark, hot, roles):
    """A third of all rows on one key: the shuffled lookup spreads them over several tasks."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id") % 500).cast("int")
        facts = spark.range(0, 120_000, 1, 8).select(key.alias("k"), key.alias("l"), F.sha2(F.col("id").cast("string"), 256).alias("load"))
        dim = spark.range(500).select(F.col("id").cast("int").alias("zone"), F.lit("x").alias("name"))
        joined = enrich(facts, dim, roles, "zone", ["name"], broadcast_bytes=0)
        by_task = joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("load"))
        found = joined.agg(F.count("*"), F.count("a_zone"), F.max("load"))
        assert tuple(found.collect()[0])[:2] == (120_000, 120_000 if hot else 80_000)
        assert "skew=true" in plan(found)
        assert max(r.n for r in by_task.collect()) < 40_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
