"""From raw documents to packed training sequences, as a chain of stages.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet
and rereads it as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medallion.llm import langid, mixing, packing, simhash, templates
from medallion.llm.common import ship
from medallion.sources.scratch import Scratch, scratch_scope


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go; learned from the labels of all given documents.

    A null text, or one without a letter, is rejected.  Null labels and ids are not learned
    from, but judged.  If nothing can be learned, no language is known and all documents go.
    """
    ship(spark)
    return langid.accepted(docs, langid.fit(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents lose lines whose template recurs; ``n_chars`` follows the text.

    No document goes: one that loses all its lines has an empty text, a null text stays null.
    """
    return templates.drop_recurring_lines(docs, length_col="n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; shingles and radius as the operator's contract has them.

    Null, empty and blank texts are one group.  Rows without an id stay.
    """
    ship(spark)
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to twice.

    A null source is a source; documents without words are drawn with their source.
    """
    return mixing.draw(docs, mixing.mix_sources(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences; each drawn row has pieces of its own.

    A null text counts as empty and is one end id.
    """
    ship(spark)
    return packing.pack_documents(docs, keep_ids=False)


STAGES = [
    ("language id", language),
    ("line dedup", lines),
    ("simhash near-dedup", near_dedup),
    ("source mixing", mix),
    ("best-fit packing", pack),
]
# Trained models, hashes and iterations have no SQL form; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    Once a stage is written, the stage before it goes, and what its operators had stored.
    """
    scratch = Scratch(spark, "corpus")
    docs = ship(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        with scratch_scope():
            docs = scratch.keep(stage(spark, docs, sf_dir), f"stage{number}")
        if number:
            scratch.discard(f"stage{number - 1}")
    return docs
