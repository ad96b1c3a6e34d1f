"""Intermediate tables in the folder all executors share.

A frame that several jobs read is written once and read back: this cuts the lineage,
keeps it columnar, and a lost executor costs a re-read instead of a recomputation.

All folders of an application lie in one of its own.  It goes with ``release``, and at the
latest when the driver's JVM ends.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session without it gets a temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = _local_folders.get(context.applicationId)
    if folder is None:
        folder = tempfile.TemporaryDirectory(prefix="medallion-", ignore_cleanup_errors=True)
        _local_folders[context.applicationId] = folder
    return folder.name


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def delete_folder(spark: SparkSession, path: str) -> None:
    files, target = _file_system(spark, path)
    files.delete(target, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system drop an existing folder when the driver's JVM ends."""
    files, target = _file_system(spark, path)
    files.deleteOnExit(target)


def application_folder(spark: SparkSession) -> str:
    """The application's own folder below the scratch root."""
    folder = f"{scratch_root(spark)}/medallion-{spark.sparkContext.applicationId}"
    files, target = _file_system(spark, folder)
    if not files.exists(target):
        files.mkdirs(target)
        files.deleteOnExit(target)
    return folder


def release(spark: SparkSession) -> None:
    """Drop all scratch folders of the application; results that read them are then gone."""
    delete_folder(spark, f"{scratch_root(spark)}/medallion-{spark.sparkContext.applicationId}")


_scope: ContextVar[list[Scratch] | None] = ContextVar("scratch_scope", default=None)


@contextmanager
def scratch_scope() -> Iterator[None]:
    """Drop at the end every scratch folder that was made inside, by whatever function.

    For a step whose result is written elsewhere before the end: frames that read those
    folders are gone afterwards.  Scopes nest; each drops its own.
    """
    made: list[Scratch] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for scratch in made:
            scratch.drop()


class Scratch:
    """A fresh folder of the application; as a context manager it is dropped at the end."""

    def __init__(self, spark: SparkSession, label: str = "run"):
        self.spark = spark
        self.path = f"{application_folder(spark)}/{label}-{uuid.uuid4().hex}"
        inside = _scope.get()
        if inside is not None:
            inside.append(self)

    def location(self, name: str) -> str:
        return f"{self.path}/{name}"

    def keep(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Write ``df`` below this folder, with these options of Parquet, and return it read back."""
        target = self.location(name)
        df.write.options(**options).parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def discard(self, name: str) -> None:
        """Drop what ``keep`` wrote under that name."""
        delete_folder(self.spark, self.location(name))

    def drop(self) -> None:
        delete_folder(self.spark, self.path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop()
