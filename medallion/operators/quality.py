"""Row-level quality rules, their summary, the gate and the row reconciliation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

PREFIX = "dq_"


class NoValidRows(ValueError):
    """The quality gate found nothing to publish."""


def flag_quality(
    df: DataFrame, rules: Mapping[str, Column], valid: str = "is_valid_trip"
) -> DataFrame:
    """Add one flag per rule (NULL where it cannot be decided) and the verdict over all.

    A row is valid when no rule is true, so the verdict itself is never NULL.
    """
    if not rules:
        return df.withColumn(valid, F.lit(True))
    flagged = df.withColumns(dict(rules))
    broken = reduce(lambda a, b: a | b, [F.coalesce(F.col(f), F.lit(False)) for f in rules])
    return flagged.withColumn(valid, ~broken)


def valid_only(df: DataFrame, valid: str = "is_valid_trip") -> DataFrame:
    return df.filter(F.col(valid))


def dq_summary(
    df: DataFrame,
    flags: Iterable[str],
    only: Iterable[str] | None = None,
    valid: str = "is_valid_trip",
) -> DataFrame:
    """One row: total, broken rows per flag, invalid and valid total.

    ``only`` restricts the report to some flags.  Over no rows the sums are NULL.
    """
    return df.agg(*summary_columns(flags, only, valid))


def summary_columns(
    flags: Iterable[str], only: Iterable[str] | None = None, valid: str = "is_valid_trip"
) -> list[Column]:
    """The aggregates of ``dq_summary``, for an aggregation or an observation."""
    wanted = set(flags if only is None else only)

    def hits(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    return [
        F.count("*").alias("total_after_dedup"),
        *[hits(F.col(f)).alias(f"{f.removeprefix(PREFIX)}_cnt") for f in flags if f in wanted],
        hits(~F.col(valid)).alias("total_invalid_cnt"),
        hits(F.col(valid)).alias("total_valid_cnt"),
    ]


def dq_gate(summary: DataFrame) -> DataFrame:
    """One row: ``total_valid_cnt`` (0 over no rows) and whether the gate passes."""
    count = F.coalesce("total_valid_cnt", F.lit(0))
    return summary.select(count.alias("total_valid_cnt"), (count > 0).alias("passed"))


def require_valid(summary: Row, allow_empty: bool = False) -> Row:
    """Return the summary row; raise ``NoValidRows`` when no row passed the rules.

    An empty input fails too, unless ``allow_empty``.
    """
    empty_is_fine = allow_empty and summary["total_after_dedup"] == 0
    if not summary["total_valid_cnt"] and not empty_is_fine:
        raise NoValidRows(f"no valid row among {summary['total_after_dedup']} after deduplication")
    return summary


class RowCounter:
    """Counts the rows of frames while something else reads or writes them.

    ``watch`` the frame of each step, run the actions, then ask for the ``report``.  A
    watched frame counts when its first action ends, so no step needs a pass of its own.
    Watch a frame behind the last shuffle of its action: there a repeated task counts once.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.counts: dict[str, Observation | int] = {}

    def watch(self, step: str, df: DataFrame) -> DataFrame:
        self.counts[step] = Observation()
        return df.observe(self.counts[step], F.count("*").alias("rows"))

    def add(self, step: str, rows: int) -> None:
        self.counts[step] = rows

    def report(self, differences: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
        """``step, rows`` per step in the order they were named, plus differences of two steps."""
        rows = {s: c if isinstance(c, int) else c.get["rows"] for s, c in self.counts.items()}
        found = {name: rows[a] - rows[b] for name, (a, b) in (differences or {}).items()}
        return self.spark.createDataFrame(list({**rows, **found}.items()), "step string, rows bigint")
