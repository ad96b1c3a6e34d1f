"""Casts that never raise, and the derived columns built from them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGERS = {"tinyint", "smallint", "int", "integer", "bigint"}


def _typed(df: DataFrame, name: str, target: str) -> Column:
    source = df.select(name).schema[0].dataType
    column = F.col(name)
    if isinstance(source, T.StringType):
        if target == "timestamp":
            return F.try_to_timestamp(column)
        if target in INTEGERS - {"bigint"}:
            # Text such as '5.0' is no integer literal, but it is a number.
            return column.try_cast("double").try_cast(target)
        if target == "bigint":
            # Going through double alone would lose digits beyond 2^53.
            return F.coalesce(column.try_cast(target), column.try_cast("double").try_cast(target))
    return column.try_cast(target)


def type_columns(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Cast the columns of ``spec``; a value the type cannot hold becomes NULL.

    Columns outside ``spec`` pass through, and the column order is kept.
    """
    return df.withColumns({name: _typed(df, name, target) for name, target in spec.items()})


def upper_trim(column: Column) -> Column:
    return F.upper(F.trim(column))


def canonicalise(df: DataFrame, columns: Iterable[str], bad: Iterable[str], to: str) -> DataFrame:
    """Replace exactly the ``bad`` spellings by ``to``; NULL stays NULL."""
    bad = list(bad)
    return df.withColumns(
        {c: F.when(F.col(c).isin(bad), F.lit(to)).otherwise(F.col(c)) for c in columns}
    )


def decode(column: Column, mapping: Mapping, default: str) -> Column:
    """Label a code; NULL and unlisted codes get ``default``."""
    label = None
    for code, text in mapping.items():
        label = (F if label is None else label).when(column == code, F.lit(text))
    return F.lit(default) if label is None else label.otherwise(F.lit(default))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` where the denominator is positive, else NULL."""
    return F.when(denominator > 0, numerator / denominator)


def duration_minutes(start: Column, end: Column) -> Column:
    """Minutes between two timestamps, each cut to whole seconds first."""
    return (end.cast("bigint") - start.cast("bigint")) / F.lit(60.0)


def calendar(df: DataFrame, timestamp: str, prefix: str) -> DataFrame:
    """Add ``<prefix>_date, _year, _month, _day, _hour, _weekday`` of a timestamp."""
    ts = F.col(timestamp)
    return df.withColumns(
        {
            f"{prefix}_date": F.to_date(ts),
            f"{prefix}_year": F.year(ts),
            f"{prefix}_month": F.month(ts),
            f"{prefix}_day": F.dayofmonth(ts),
            f"{prefix}_hour": F.hour(ts),
            f"{prefix}_weekday": F.date_format(ts, "E"),
        }
    )
