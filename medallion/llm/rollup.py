"""Token counts kept up to date by signed deltas.

Totals by source, language and tokenizer version are sums, so a change of documents
changes them by what it adds and takes away: an insert counts up, a delete counts down,
a revised count takes the old one away and adds the new.  A batch of changes is summed
by group before it is stored, and the totals are the sum over all committed batches.

A batch has an id and is committed by one rename in the shared folder.  A batch that is
there is there as a whole; committing its id again, after a lost driver say, does nothing.
One writer at a time commits to a rollup.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import tokens
from medallion.llm.common import same

GROUP = ["source", "lang", "tokenizer"]
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def count_tokens(
    docs: DataFrame, version: str, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", lang_col: str = "lang",
) -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens) of every whole text, without special tokens.

    A null text has no tokens.  ``tokenizer`` is a vocabulary file, ``version`` its name in
    the rollup.  Repeated rows are counted as often as they occur.
    """
    file = tokenizer or tokens.path()
    kinds = [docs.schema[c].dataType.simpleString() for c in (id_col, source_col, lang_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(file).ids
        for batch in batches:
            made = pa.array([len(encode(t.as_py() or "")) for t in batch.column(3)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], made], ["doc_id", "source", "lang", "n_tokens"])

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(lang_col).alias("lang"), F.col(text_col))
    counted = picked.mapInArrow(run, f"doc_id {kinds[0]}, source {kinds[1]}, lang {kinds[2]}, n_tokens long")
    return counted.select("doc_id", "source", "lang", F.lit(version).alias("tokenizer"), "n_tokens")


def inserts(counts: DataFrame) -> DataFrame:
    """Deltas (group, n_docs, n_tokens) that add the counted documents."""
    return counts.select(*GROUP, F.lit(1).cast("long").alias("n_docs"), "n_tokens")


def deletes(counts: DataFrame) -> DataFrame:
    """Deltas that take documents away; their counts must be those that were added."""
    return counts.select(*GROUP, F.lit(-1).cast("long").alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Deltas from the old to the new counts of revised documents, in whichever groups they are."""
    return deletes(before).unionByName(inserts(after))


class Rollup:
    """Totals in ``folder`` of the shared file system, one sub-folder per committed batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _batch(self, batch_id: str) -> str:
        if not batch_id or not all(c.isalnum() or c in "-_" for c in batch_id):
            raise ValueError(f"a batch id has letters, digits, - and _ only: {batch_id!r}")
        return f"{self.folder}/batches/batch={batch_id}"

    def committed(self, batch_id: str) -> bool:
        return self._files.exists(self._path(self._batch(batch_id)))

    def commit(self, batch_id: str, deltas: DataFrame) -> bool:
        """Adds the batch's deltas, once: False if the id is there already.

        The deltas are summed by group (with partial sums before the shuffle, so a hot
        group costs a row per task), written beside the batches, and moved in as one.
        Groups whose deltas cancel out are not stored.
        """
        target = self._batch(batch_id)
        if self.committed(batch_id):
            return False
        staged = f"{self.folder}/staged/{uuid.uuid4().hex}"
        summed = deltas.groupBy(*[F.col(c).cast("string").alias(c) for c in GROUP]).agg(
            F.sum("n_docs").cast("long").alias("n_docs"), F.sum("n_tokens").cast("long").alias("n_tokens")
        )
        summed.filter("n_docs <> 0 OR n_tokens <> 0").write.parquet(staged)
        self._files.mkdirs(self._path(f"{self.folder}/batches"))
        if not self._files.rename(self._path(staged), self._path(target)):
            raise RuntimeError(f"batch {batch_id} could not be moved in")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over all batches; empty groups are left out."""
        if not self._files.exists(self._path(f"{self.folder}/batches")):
            return self.spark.createDataFrame([], TOTALS)
        rows = self.spark.read.schema(TOTALS).parquet(f"{self.folder}/batches/*")
        summed = rows.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return summed.filter("n_docs <> 0 OR n_tokens <> 0")

    def apply_stream_batch(self, deltas: DataFrame, epoch: int) -> None:
        """For ``writeStream.foreachBatch``: a repeated epoch is the same batch."""
        self.commit(f"epoch-{epoch}", deltas)


def flagged(counts: DataFrame, labels: DataFrame, flag: str) -> DataFrame:
    """The counts of documents that a label marks."""
    marked = labels.filter(F.col(flag) == 1).select(F.col("doc_id").alias("_id")).distinct()
    return counts.join(marked, same(F.col("doc_id"), F.col("_id")), "left_semi")
