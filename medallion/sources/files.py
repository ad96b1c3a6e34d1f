"""Monthly Parquet files, small lookup files, and the check that they are there."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: where the raw file (or folder of part files) of one month lies.
MONTH_LAYOUT = "year{year}/yellow_tripdata_{month}.parquet"


class MissingInput(ValueError):
    """Raw files that the run needs are not there."""


class SchemaMismatch(ValueError):
    """Monthly files do not have the same columns and types."""


def parse_months(text: str) -> list[str]:
    """Split a comma list such as ``2025-01, 2025-02``; blanks are dropped."""
    return [part.strip() for part in text.split(",") if part.strip()]


def month_path(root: str, month: str, layout: str = MONTH_LAYOUT) -> str:
    return f"{root.rstrip('/')}/{layout.format(year=month[:4], month=month)}"


def _kinds(schema: T.StructType) -> dict[str, str]:
    """Column (lower case, as names are matched) to type."""
    return {f.name.lower(): f.dataType.simpleString() for f in schema}


def _require_same(schemas: Mapping[str, T.StructType], named: set[str]) -> None:
    """Raise ``SchemaMismatch`` for columns outside ``named`` that not all months have alike."""
    kinds = {month: _kinds(schema) for month, schema in schemas.items()}
    faults = []
    for column in dict.fromkeys(c for own in kinds.values() for c in own):
        if column in named:
            continue
        by_kind: dict[str, list[str]] = {}
        for month, own in kinds.items():
            by_kind.setdefault(own.get(column, "missing"), []).append(month)
        if len(by_kind) > 1:
            found = "; ".join(f"{kind} in {', '.join(where)}" for kind, where in by_kind.items())
            faults.append(f"{column}: {found}")
    if faults:
        raise SchemaMismatch("months differ. " + " | ".join(faults))


def read_months(
    spark: SparkSession,
    root: str,
    months: Sequence[str],
    layout: str = MONTH_LAYOUT,
    fill: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read the files of the given months as one table; no column of any month is lost.

    All months must have the same columns and types, else ``SchemaMismatch`` names the
    columns and months.  ``fill``, a map of column to type, lifts that for the columns it
    names, and for no other: where a month lacks one it reads as NULL, where it has another
    type it is cast to the named one, and a value that does not fit raises.

    Months are read in one scan per schema, so the plan does not grow with their number.
    """
    if not months:
        raise MissingInput("no months given")
    paths = {month: month_path(root, month, layout) for month in months}
    with ThreadPoolExecutor(8) as pool:  # each schema is a small job on one footer
        read = pool.map(lambda path: spark.read.parquet(path).schema, paths.values())
        schemas = dict(zip(paths, read))
    fill = {name.lower(): (name, kind) for name, kind in (fill or {}).items()}
    _require_same(schemas, set(fill))
    groups: dict[tuple, list[str]] = {}
    for month, schema in schemas.items():
        groups.setdefault(tuple(sorted(_kinds(schema).items())), []).append(month)
    columns = list(dict.fromkeys(c for s in schemas.values() for c in map(str.lower, s.names)))
    columns += [c for c in fill if c not in columns]
    spelled = {n.lower(): n for s in reversed(schemas.values()) for n in s.names}
    frames = []
    for own in groups.values():
        schema = schemas[own[0]]
        table = spark.read.schema(schema).parquet(*[paths[month] for month in own])
        present = _kinds(schema)

        def column(name: str) -> Column:
            if name not in fill:
                return F.col(spelled[name])
            shown, kind = fill[name]
            made = F.col(shown).cast(kind) if name in present else F.lit(None).cast(kind)
            return made.alias(spelled.get(name, shown))

        frames.append(table.select(*[column(c) for c in columns]) if fill or len(groups) > 1 else table)
    return reduce(DataFrame.unionByName, frames)


def read_lookup(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Read a CSV with a header; every column is a string."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return (
        spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)
    )


def input_coverage(
    spark: SparkSession, root: str, months: Sequence[str], layout: str = MONTH_LAYOUT
) -> DataFrame:
    """One row per month: ``month, path, files, length, found``; reads no file content."""
    pattern = re.escape(layout).replace(r"\{year\}", r"\d{4}").replace(r"\{month\}", r"(\d{4}-\d{2})")
    wanted = spark.createDataFrame(
        [(month, month_path(root, month, layout)) for month in dict.fromkeys(months)],
        "month string, path string",
    )
    try:
        listing = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", True)
            .load(root)
            .select(F.regexp_extract("path", f"/{pattern}(/[^/]*)?$", 1).alias("month"), "length")
        )
    except AnalysisException as error:
        raise MissingInput(f"no raw folder at {root}") from error
    found = listing.groupBy("month").agg(
        F.count("*").alias("files"), F.sum("length").alias("length")
    )
    return wanted.join(found, "month", "left").select(
        "month",
        "path",
        F.coalesce("files", F.lit(0)).alias("files"),
        F.coalesce("length", F.lit(0)).alias("length"),
        F.col("files").isNotNull().alias("found"),
    )


def files_state(spark: SparkSession, paths: Sequence[str]) -> str:
    """Stands for path, length and time of every file below ``paths`` that is not empty; reads no content."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(list(paths))
        .select(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)").alias("file"))
    )
    state = listing.agg(F.count("*"), F.sum("file")).first()
    return f"{state[0]} files, {state[1]}"


def require_inputs(
    spark: SparkSession, root: str, months: Sequence[str], layout: str = MONTH_LAYOUT
) -> DataFrame:
    """``input_coverage``, but raise ``MissingInput`` naming every month without a file."""
    if not months:
        raise MissingInput("no months given")
    coverage = input_coverage(spark, root, months, layout)
    missing = [row.month for row in coverage.filter(~F.col("found")).sort("month").collect()]
    if missing:
        raise MissingInput(f"no raw Parquet file under {root} for: {', '.join(missing)}")
    return coverage
