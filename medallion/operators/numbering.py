"""A global row number that no single task has to compute.

``row_number()`` over an unpartitioned window moves every row to one task.  The same
numbers come from ranges of the order that are numbered side by side, each starting
after the rows of all earlier ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.sources.scratch import Scratch

RANGE_ROWS = 5_000_000
# monotonically_increasing_id keeps the partition above bit 33, the row below it.
POSITION_BITS = 33


def _starts(sizes: DataFrame, part: str) -> DataFrame:
    """Rows in all earlier ranges.  The window is unpartitioned, over one row per range."""
    earlier = Window.orderBy(F.col(part)).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(part, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))


def global_row_number(
    df: DataFrame,
    name: str,
    order: Sequence[str],
    scratch: Scratch,
    range_rows: int = RANGE_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Prepend ``row_number() over (order by order)``, ascending with NULLs last.

    ``order`` has to be total, and the input repeatable and cheap to read, since it is
    sampled before it is written.  ``rows`` is an upper bound on its rows, which only sets the number
    of ranges; without one they are counted first, in a read of their own.  The rows are
    range-partitioned on the *whole* order, at most about ``range_rows`` a range, which splits
    even a single hot value of the first column, and written once.  One row per range is broadcast.  The result reads from ``scratch``, so
    drop that only when the result is written.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(partitions, -(-(df.count() if rows is None else rows) // range_rows))
    ascending = [F.col(c).asc_nulls_last() for c in order]
    placed = scratch.keep(
        df.repartitionByRange(ranges, *ascending)
        .sortWithinPartitions(*ascending)
        .withColumn("_position", F.monotonically_increasing_id()),
        f"ranges-{name}",
    )
    placed = placed.withColumn("_part", F.shiftrightunsigned("_position", POSITION_BITS))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    local = F.col("_position").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return placed.join(F.broadcast(_starts(sizes, "_part")), "_part", "left").select(
        (F.col("_start") + local + 1).alias(name), *df.columns
    )
