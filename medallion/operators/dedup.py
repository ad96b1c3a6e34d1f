"""Deduplication with a repeatable survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the first in ``order``, then in the remaining columns.

    Every comparison is ascending with NULLs last, so the survivor depends on the rows
    alone and not on partitioning or retries.  NULL keys are equal to each other.

    The rank limit is applied before the shuffle as well as after it, so a key that
    holds a large share of the rows sends at most one row per map task.  Sorting
    compares the keys left to right: name the most selective one first.
    """
    lead = list(order or [])
    named = {c.lower() for c in [*keys, *lead]}
    lead += [c for c in df.columns if c.lower() not in named]
    if not lead:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in lead])
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
