"""What several operators share: cutting lineage, Arrow rows, words."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sources.scratch import delete_at_exit, scratch_root

# Characters that are not in one of these end a word: ``[^\x20\x09-\x0D]+``.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = b" \t\n\x0b\x0c\r"


_cut_folders: set[str] = set()


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: what follows reads files all executors share.

    For narrow intermediate results that several jobs read.  The files lie in
    ``spark.checkpoint.dir`` (a session without it gets the scratch folder).  They go with
    the result if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set, and at the
    latest when the driver's JVM ends.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(scratch_root(df.sparkSession))
    folder = context._jsc.sc().getCheckpointDir().get()  # one of the application's own
    if folder not in _cut_folders:
        delete_at_exit(df.sparkSession, folder)
        _cut_folders.add(folder)
    return df.checkpoint(eager=True)


def map_rows(
    df: DataFrame, schema: str, make: Callable[[Iterator[dict]], Iterator[tuple]], rows: int = 4096
) -> DataFrame:
    """``mapInArrow`` for a generator over row dictionaries that yields tuples.

    The generator sees a whole partition as one stream, so it may keep a row back until
    the next one comes.  Output leaves in batches of ``rows``.
    """
    arrow = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    yield from batch.slice(start, 256).to_pylist()

        held: list[tuple] = []
        for row in make(stream()):
            held.append(row)
            if len(held) >= rows:
                yield to_batch(held, arrow)
                held = []
        if held:
            yield to_batch(held, arrow)

    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(schema))


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; a null text has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to be none of ``df``'s."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def text_key(column: str) -> list[Column]:
    """128 bits of a text, as two independent hashes; null differs from empty."""
    text = F.coalesce(F.col(column), F.lit(""))
    null = F.col(column).isNull()
    return [F.xxhash64(null, text), F.xxhash64(F.lit(7), text, null)]


_shipped: dict[str, object] = {}


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, for sessions started without ``--py-files``."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.TemporaryDirectory(prefix="medallion-src-", ignore_cleanup_errors=True)
        target = Path(folder.name, "medallion_src.zip")
        with zipfile.ZipFile(target, "w") as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, source.relative_to(package.parent))
        context.addPyFile(str(target))
        _shipped[context.applicationId] = folder
    return spark
