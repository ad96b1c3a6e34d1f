import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from medallion.operators.numbering import global_row_number
from medallion.sources.scratch import Scratch
from tests.conftest import plan

ORDER = ["ts", "a", "b"]
DAY = dt.datetime(2025, 1, 1, 23, 30)


def frame(spark, hot_share=0.0, rows=600, seed=1):
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        ts = DAY if rng.random() < hot_share else DAY + dt.timedelta(minutes=rng.randrange(0, 300))
        data.append((None if i % 97 == 0 else ts, None if i % 41 == 0 else rng.randrange(5), i))
    rng.shuffle(data)
    return spark.createDataFrame(data, "ts timestamp, a int, b int").repartition(5)


def literal(df):
    window = Window.orderBy(*[F.col(c).asc_nulls_last() for c in ORDER])
    return {(r.n, r.b) for r in df.select(F.row_number().over(window).alias("n"), "b").collect()}


def numbered(df, **limits):
    return global_row_number(df, "n", ORDER, Scratch(df.sparkSession, "numbering"), **limits)


def test_ranges_equal_the_literal_window(spark):
    df = frame(spark)
    result = numbered(df)
    assert {(r.n, r.b) for r in result.collect()} == literal(df)
    assert result.columns == ["n", "ts", "a", "b"]
    assert "SinglePartition" not in plan(result).split("BroadcastExchange")[0]


def test_one_hot_timestamp_is_split_by_the_whole_order(spark):
    df = frame(spark, hot_share=0.4)
    result = numbered(df, range_rows=50)
    assert {(r.n, r.b) for r in result.collect()} == literal(df)
    files = [f for f in result.inputFiles() if "/ranges-n/" in f]
    per_file = df.sparkSession.read.parquet(*files).groupBy(F.input_file_name()).count()
    assert per_file.agg(F.max("count")).first()[0] < 0.4 * 600


def test_the_bound_of_a_range_has_no_ceiling(spark):
    df = spark.range(3000).select(F.col("id").alias("b"), F.lit(None).cast("timestamp").alias("ts"), F.lit(1).alias("a"))
    files = [f for f in numbered(df, range_rows=10).inputFiles() if "/ranges-n/" in f]
    per_file = spark.read.parquet(*files).groupBy(F.input_file_name()).count()
    largest, ranges = per_file.agg(F.max("count"), F.count("*")).first()
    assert largest < 60 and ranges > 100


def test_empty_input(spark):
    assert numbered(frame(spark).filter("b < 0")).count() == 0


def test_numbers_continue_over_hour_and_midnight(spark):
    df = frame(spark)
    rows = numbered(df).sort("n").collect()
    assert [r.n for r in rows] == list(range(1, 601))
    known = [r.ts for r in rows if r.ts]
    assert known == sorted(known) and all(r.ts is None for r in rows[len(known):])


def test_a_known_bound_saves_the_count(spark):
    """The bound sets the number of ranges only; a wrong one changes no number."""
    df = frame(spark, hot_share=0.2)
    for bound in (600, 6000, 0):
        result = numbered(df, range_rows=100, rows=bound)
        assert {(r.n, r.b) for r in result.collect()} == literal(df)


def test_the_input_is_sampled_and_written_but_not_counted(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = frame(spark).coalesce(2).mapInArrow(seen, "ts timestamp, a int, b int")
    numbered(df, rows=600)
    assert read.value == 2 * 600
