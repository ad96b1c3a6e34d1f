"""Catalog tables and views: create layers, publish, inspect.

Without a table format that replaces atomically, a published name is a view over one of its
versions.  Every write makes a version, a managed table of its own; the view is then
pointed to it in one catalog operation (``ALTER VIEW``), and versions that were published
before are dropped by the catalog.  Only tables that carry this library's mark are ever
dropped, and no folder is removed except through the table that owns it.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from medallion.sources.scratch import Scratch, delete_folder

# The table property that says of which published name a table is a version.
MARK = "medallion.version.of"
VERSION = r"__v\d{20}[0-9a-f]{8}"
ASIDE = "__aside"


class NotReplaceable(RuntimeError):
    """The name belongs to something that cannot be set aside and kept."""


def ensure_layers(spark: SparkSession, layers: Iterable[str], location: str | None = None) -> None:
    """Create the namespaces that do not exist yet, below ``location`` when given."""
    for layer in dict.fromkeys(layers):
        where = f" LOCATION '{location.rstrip('/')}/{layer}'" if location else ""
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {layer}{where}")


def publish_table(
    df: DataFrame,
    name: str,
    provider: str | None = None,
    partition_by: Sequence[str] = (),
    coalesce_to: int | None = None,
    properties: Mapping[str, str] | None = None,
    keep_versions: int = 0,
) -> DataFrame:
    """Create or fully replace a table and return it read back from the catalog.

    ``provider="iceberg"`` replaces in one atomic step and needs an Iceberg catalog.
    Other providers write a new version and point the published view to it in one catalog
    operation: whatever fails or is killed at whatever step, the name shows the old or the
    new contents.  Afterwards all but the last ``keep_versions`` superseded versions are dropped;
    readers that opened one of those before fail, so keep one where readers overlap.

    A table of that name which this library did not make is set aside under
    ``<name>__aside`` with its files, and never dropped.

    ``coalesce_to`` writes that many files, by as few tasks; partitions are dealt anew by
    their value, so both together are refused.  The rows are made by all tasks of ``df`` and
    wait in scratch, so each of the few reads its share of compressed columns and no more.
    """
    if coalesce_to and partition_by:
        raise ValueError("coalesce_to fixes the number of files, partition_by deals them anew: give one")
    if coalesce_to:
        with Scratch(df.sparkSession, "files") as scratch:
            gathered = _gathered(df, coalesce_to, scratch)
            return publish_table(gathered, name, provider, properties=properties, keep_versions=keep_versions)
    if partition_by:
        # Collect each partition value in few files; the adaptive rebalance splits a
        # value that holds a large share of the rows over several tasks.
        df = df.hint("rebalance", *partition_by)
    if provider == "iceberg":
        writer = df.writeTo(name).using(provider)
        for key, value in {"format-version": "2", **(properties or {})}.items():
            writer = writer.tableProperty(key, value)
        if partition_by:
            writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
        writer.createOrReplace()
    else:
        writer = df.write.format(provider or "parquet").mode("overwrite")
        for key, value in (properties or {}).items():
            writer = writer.option(key, value)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        _write_and_point(df.sparkSession, writer, name, keep_versions)
    return df.sparkSession.table(name)


def _gathered(df: DataFrame, files: int, scratch: Scratch) -> DataFrame:
    """``df`` in that many partitions, all of which have rows if there are enough.

    A table too small to fill them is moved row by row; that is less than a few splits of a scan.
    """
    kept = scratch.keep(df, "rows", compression="zstd")
    few = kept.coalesce(files)
    filled = few.select(F.spark_partition_id().alias("part")).distinct().count()
    return few if filled == files else kept.repartition(files)


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    """The details of a table or view that ``DESCRIBE`` lists behind its columns."""
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def _is_view(spark: SparkSession, name: str) -> bool:
    return _described(spark, name).get("Type") == "VIEW"


def table_property(spark: SparkSession, name: str, key: str) -> str | None:
    """A property of a table or view; None if it has none of that name."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return next((r["value"] for r in rows if r["key"] == key), None)


def _mark(name: str) -> str:
    """A digest, since Spark hides property values that contain words such as ``url`` or ``token``."""
    return hashlib.sha256(name.lower().encode()).hexdigest()


def _marked(spark: SparkSession, version: str, name: str) -> bool:
    """Versions of earlier releases bear the name itself."""
    return table_property(spark, version, MARK) in (_mark(name), name)


def _names(spark: SparkSession, database: str) -> list[str]:
    return [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect() if not r["isTemporary"]]


def versions(spark: SparkSession, name: str) -> list[str]:
    """The finished versions of a published name, oldest first."""
    database, _, table = name.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    own = re.compile(re.escape(table.lower()) + VERSION)
    found = sorted(f"{database}.{t}" for t in _names(spark, database) if own.fullmatch(t.lower()))
    return [v for v in found if _marked(spark, v, name.lower())]


def current_version(spark: SparkSession, name: str) -> str | None:
    """The version that a published name shows; None if it is not a view over one of its own."""
    if not spark.catalog.tableExists(name) or not _is_view(spark, name):
        return None
    shown = re.fullmatch(r"SELECT \* FROM (\S+)", _described(spark, name).get("View Text", ""))
    return shown[1] if shown and shown[1] in versions(spark, name) else None


def _write_and_point(spark: SparkSession, writer: DataFrameWriter, name: str, keep_versions: int) -> None:
    database, _, table = name.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
    version = f"{table}__v{now}{uuid.uuid4().hex[:8]}".lower()
    full = f"{database}.{version}"
    _restore(spark, name)
    try:
        writer.saveAsTable(full)
        spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ('{MARK}' = '{_mark(name)}')")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        # A write that failed before the table was made leaves the folder it would have had.
        delete_folder(spark, f"{spark.catalog.getDatabase(database).locationUri}/{version}")
        raise
    _point(spark, name, full)
    superseded = [v for v in versions(spark, name) if v < full]
    for old in superseded[: len(superseded) - keep_versions]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def _point(spark: SparkSession, name: str, version: str) -> None:
    """Show ``version`` under ``name``: one catalog operation if the name is a view or free."""
    select = f"SELECT * FROM {version}"
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE VIEW {name} AS {select}")
    elif _is_view(spark, name):
        spark.sql(f"ALTER VIEW {name} AS {select}")
    else:
        aside = f"{name}{ASIDE}"
        if spark.catalog.tableExists(aside):
            raise NotReplaceable(f"{name} is a table of someone else, and {aside} is taken: move one of them")
        spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
        try:
            spark.sql(f"CREATE VIEW {name} AS {select}")
        except BaseException:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
            raise


def _restore(spark: SparkSession, name: str) -> None:
    """Undo a replacement that was killed after the old table had been set aside."""
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(f"{name}{ASIDE}"):
        spark.sql(f"ALTER TABLE {name}{ASIDE} RENAME TO {name}")


def unpublish(spark: SparkSession, name: str) -> None:
    """Drop a published name with its versions; nothing that is not the library's own."""
    own = versions(spark, name)
    if spark.catalog.tableExists(name) and _is_view(spark, name):
        spark.sql(f"DROP VIEW {name}")
    for version in own:
        spark.sql(f"DROP TABLE IF EXISTS {version}")


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Register a frame as a session view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def publish_sql_view(spark: SparkSession, name: str, select: str) -> DataFrame:
    """Create or replace a catalog view over catalog tables."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")
    return spark.table(name)


def list_tables(spark: SparkSession, layer: str) -> DataFrame:
    """Published tables and views of a layer: ``namespace, table``; versions are not listed."""
    shown = ~F.col("isTemporary") & ~F.col("tableName").rlike(f"{VERSION}$")
    return spark.sql(f"SHOW TABLES IN {layer}").filter(shown).select(
        F.col("namespace"), F.col("tableName").alias("table")
    )


def list_layers(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW NAMESPACES")


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows, for a look at the table."""
    return df.limit(n)
