"""Session settings the results depend on, and a small session builder."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Durations and dates are taken in the session zone, so it is fixed.  In UTC a zoneless
# Parquet timestamp may be read as the timestamp all rules work on, which saves a costly
# conversion at every use.  Timestamps are stored as micros because INT96 carries no
# statistics to prune row groups by.  The JVM never compiles a method of more than 8000 bytes, and
# generated code for tables this wide is larger: it is then left in smaller pieces.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put ``SETTINGS`` on a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def require_utc(spark: SparkSession) -> None:
    """Raise where durations and dates would depend on another session zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"the session zone is {zone}: call apply_settings(spark), rules work in UTC")


def build_session(app: str = "medallion", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or fetch) a session with ``SETTINGS``; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return apply_settings(builder.getOrCreate())
