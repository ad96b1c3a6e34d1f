import math
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from medallion.operators.dedup import dedup
from medallion.plans import models
from tests.conftest import plan


def test_survivor_follows_the_order(make_trips):
    trips = make_trips({"passenger_count": 1.0}, {"passenger_count": 0.0}, {"passenger_count": None})
    rows = models.dedup_trips(models.type_trips(trips)).collect()
    assert [r.passenger_count for r in rows] == [0]
    assert models.clean_trips(trips).count() == 0


def test_null_keys_are_equal(make_trips):
    from medallion.plans.preset import TRIP_KEY

    nothing = {c: None for c in TRIP_KEY}
    assert models.dedup_trips(models.type_trips(make_trips(nothing, nothing))).count() == 1


def test_nan_and_zero_keys_are_equal(spark):
    keys = [None, None, math.nan, math.nan, 0.0, -0.0]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k double, v int")
    assert sorted(r.v for r in dedup(df, ["k"]).collect()) == [0, 2, 4]


def test_without_other_columns(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert sorted(r.k for r in dedup(df, ["k"]).collect()) == [1, 2]


def test_copies_are_dropped_before_the_shuffle(make_trips):
    lines = plan(models.dedup_trips(models.type_trips(make_trips({})))).splitlines()
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    shuffle = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert len(limits) == 2 and limits[0] < shuffle < limits[1]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(
        st.tuples(
            st.integers(0, 3) | st.none(), st.integers(0, 2) | st.none(), st.integers(0, 2) | st.none()
        ),
        min_size=1,
        max_size=40,
    ),
    seed=st.integers(0, 99),
)
def test_same_survivors_for_any_order_and_partitioning(spark, rows, seed):
    def survivors(data, parts):
        df = spark.createDataFrame(data, "k int, a int, b int").repartition(parts)
        return sorted(map(str, dedup(df, ["k"]).collect()))

    shuffled = random.Random(seed).sample(rows, len(rows))
    expected = {}
    for k, a, b in rows:
        rank = (a is None, a or 0, b is None, b or 0)
        if k not in expected or rank < expected[k][0]:
            expected[k] = (rank, (k, a, b))
    first = survivors(rows, 1)
    assert first == survivors(shuffled, 3)
    assert len(first) == len(expected)
    assert {v for _, v in expected.values()} == {
        tuple(r) for r in dedup(spark.createDataFrame(rows, "k int, a int, b int"), ["k"]).collect()
    }
