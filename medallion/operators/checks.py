"""Table checks: not-null, unique, no offending rows; alone or many in one report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ChecksFailed(AssertionError):
    """At least one table check found offending rows; ``report`` holds all results."""

    def __init__(self, message: str, report: DataFrame):
        super().__init__(message)
        self.report = report


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """The rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def _code(kind: T.DataType, value: Column) -> Column | None:
    """A whole number for ``value``: equal values have equal ones, and neighbours close ones where it can be."""
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.DecimalType) and kind.scale == 0 and kind.precision <= 18:
        return value.cast("bigint")
    plain = isinstance(kind, T.StringType) and kind == T.StringType()
    if plain or isinstance(kind, (T.BinaryType, T.BooleanType, T.FractionalType, T.TimestampNTZType)):
        return F.xxhash64(value)
    return None


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """``value, rows`` for every non-NULL value that occurs more than once.

    A first pass marks each value in a word of 64 neighbouring numbers: a word with more rows
    than marks holds a repeat, exactly for whole numbers, dates and timestamps, by hash for all else.
    Words are combined before their shuffle, so a dense key moves less than a byte a row where
    its rows lie in order, and a few bytes more than a plain count where they do not.  The pass
    runs at once.  Only if it finds such a word are the values grouped, and only those of such words.
    """
    value = F.col(column)
    keyed = df.filter(value.isNotNull()).select(value.alias("value"))
    code = _code(keyed.schema["value"].dataType, F.col("value"))
    if code is not None:
        marked = keyed.select("value", code.alias("_code"))
        word, bit = F.shiftright("_code", 6), F.col("_code").bitwiseAND(F.lit(63)).cast("int")
        words = marked.groupBy(word.alias("_word")).agg(
            F.count("*").alias("_rows"), F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("_marks")
        )
        suspects = words.filter(F.col("_rows") > F.bit_count("_marks")).select("_word")
        if not suspects.agg(F.count("*")).first()[0]:
            return df.sparkSession.createDataFrame([], T.StructType([keyed.schema["value"], T.StructField("rows", T.LongType(), False)]))
        keyed = marked.withColumn("_word", word).join(suspects, "_word", "left_semi").select("value")
    return keyed.groupBy("value").agg(F.count("*").alias("rows")).filter("rows > 1")


def check_no_rows(df: DataFrame, *offends: Column) -> DataFrame:
    """The rows for which any condition is true; an undecided (NULL) one is no failure."""
    return df.filter(reduce(lambda a, b: a | b, offends))


@dataclass(frozen=True)
class ViewOf:
    """That a table is ``columns`` of those rows of ``base`` for which ``where`` is true."""

    base: DataFrame
    columns: Mapping[str, Column]
    where: Column

    def frame(self) -> DataFrame:
        return self.base.filter(self.where).select(*[c.alias(name) for name, c in self.columns.items()])


@dataclass(frozen=True)
class TableChecks:
    """The checks of one table; ``no_rows`` maps a test name to its conditions.

    ``view`` says what the table is made of.  It is believed only if ``df`` has the very plan
    that follows from it; the rows are then checked while the base is read.
    """

    table: str
    df: DataFrame
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    no_rows: dict[str, tuple[Column, ...]] = field(default_factory=dict)
    view: ViewOf | None = None

    def lineage(self) -> ViewOf | None:
        return self.view if self.view is not None and self.df.sameSemantics(self.view.frame()) else None

    def conditions(self) -> list[tuple[str, str | None, Column]]:
        """(test, column, what offends) of every row check."""
        found = [("not_null", c, F.col(c).isNull()) for c in self.not_null]
        return found + [(test, None, reduce(lambda a, b: a | b, c)) for test, c in self.no_rows.items()]


def _row_checks(source: DataFrame, tables: list[tuple[TableChecks, ViewOf | None]]) -> DataFrame | None:
    """All row conditions of tables over the same rows, in one pass over them.

    Views come first, one by one: their columns are laid over the source's as a struct, which
    the optimizer takes apart again, so only what is checked is read.
    """
    frame, found = source, []

    def flags(checks: TableChecks) -> list[Column]:
        made = []
        for test, column, offends in checks.conditions():
            made.append(F.coalesce(offends, F.lit(False)).alias(f"c{len(found)}"))
            found.append((checks.table, test, column))
        return made

    direct = [c for checks, view in tables if view is None for c in flags(checks)]
    views = [(checks, view) for checks, view in tables if view is not None and checks.conditions()]
    laid = [
        F.when(view.where, F.struct(*[c.alias(name) for name, c in view.columns.items()])).alias(f"v{i}")
        for i, (_, view) in enumerate(views)
    ]
    if not direct and not views:
        return None
    frame = source.select(*direct, *laid)
    for i, (checks, view) in enumerate(views):
        done = [F.col(f"c{n}") for n in range(len(found))]
        rest = [F.col(f"v{n}") for n in range(i, len(views))]
        inside = F.col(f"v{i}").isNotNull()
        own = frame.select(*done, *rest, inside.alias("_inside"), *[F.col(f"v{i}.`{name}`").alias(name) for name in view.columns])
        made = [(F.col("_inside") & flag).alias(f"c{len(done) + n}") for n, flag in enumerate(flags(checks))]
        frame = own.select(*done, *made, *rest[1:])
    counted = frame.agg(*[F.count_if(f"c{i}").alias(f"c{i}") for i in range(len(found))])
    results = F.array(
        *[
            F.struct(
                F.lit(test).alias("test"),
                F.lit(table).alias("table"),
                F.lit(column).cast("string").alias("column"),
                F.col(f"c{i}").alias("failures"),
            )
            for i, (table, test, column) in enumerate(found)
        ]
    )
    return counted.select(F.inline(results))


def _unique_check(checks: TableChecks, column: str) -> DataFrame:
    return (
        check_unique(checks.df, column)
        .agg(F.count("*").alias("failures"))
        .select(
            F.lit("unique").alias("test"),
            F.lit(checks.table).alias("table"),
            F.lit(column).alias("column"),
            "failures",
        )
    )


def run_checks(tables: Iterable[TableChecks]) -> DataFrame:
    """``test, table, column, failures, passed``: one row per check.

    Tables with the same plan share one pass, and so do views with what they are made of.
    """
    shared: list[tuple[DataFrame, list[tuple[TableChecks, ViewOf | None]]]] = []
    parts: list[DataFrame] = []
    for checks in tables:
        view = checks.lineage()
        source = checks.df if view is None else view.base
        for known, group in shared:
            if known.sameSemantics(source):
                group.append((checks, view))
                break
        else:
            shared.append((source, [(checks, view)]))
        parts += [_unique_check(checks, column) for column in checks.unique]
    parts += [rows for source, group in shared if (rows := _row_checks(source, group)) is not None]
    if not parts:
        raise ValueError("no checks given")
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)


def collected(report: DataFrame) -> DataFrame:
    """The report evaluated once, one row per check; later reads run nothing again."""
    order = ["table", "test", "column"]
    return report.sparkSession.createDataFrame(report.sort(*order).collect(), report.schema)


def require_passed(report: DataFrame) -> DataFrame:
    """Return the evaluated report, or raise ``ChecksFailed`` naming what failed."""
    report = collected(report)
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        names = [f"{r.test} {r.table}{'.' + r.column if r.column else ''}: {r.failures}" for r in failed]
        raise ChecksFailed("; ".join(sorted(names)), report)
    return report
