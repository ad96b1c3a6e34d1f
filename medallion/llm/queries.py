"""The registered queries of this subpackage: each operator over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import alignment, chat, decontaminate, langid, merkle, mixing, packing, phrases, quality, rollup, simhash, templates, warc
from medallion.llm.common import cut, ship
from medallion.sources.scratch import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read back from the formatted text and its loss spans."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    trees = chat.linear_messages(rows.unionByName(probe), "conv_id", "turn", "role", "text")
    made = chat.format_reply_trees(trees)
    read = made.select(
        F.col("tree").alias("conv_id"),
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_trained(F.col("formatted"), F.col("loss_spans")).alias("trained"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids only; the ids themselves come with ``keep_ids``."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"), keep_ids=False)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_edits(_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches over the whole table, the second one committed twice.

    All documents are counted and inserted; all counts are revised from tokens of the text
    to tokens with an end mark, a new tokenizer version; documents labelled toxic are deleted.
    """
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    counts = cut(rollup.count_tokens(docs, "byte_bpe_50k"))
    ended = counts.select(
        "doc_id", "source", "lang", F.lit("byte_bpe_50k+end").alias("tokenizer"), (F.col("n_tokens") + 1).alias("n_tokens")
    )
    totals = rollup.Rollup(spark, Scratch(spark, "rollup").path)
    totals.commit("insert", rollup.inserts(counts))
    for _ in range(2):
        totals.commit("revise", rollup.revisions(counts, ended))
    totals.commit("delete", rollup.deletes(rollup.flagged(ended, labels, "toxic")))
    return totals.totals()


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return templates.drop_recurring_lines(docs, dropped_col="n_dropped")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No source more than twice as often as another; every document at least once."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def held_out(id_col: str = "doc_id") -> Column:
    """The fold never learned from; null for a null id, which is not learned from either."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs, usable=~held_out())
    folded = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    return langid.identify(folded, model, also=("doc_id", "held_out"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_quality_rules": op4_quality_rules,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_warc": op6_warc,
    "op7_token_counts": op7_token_counts,
    "op8_line_dedup": op8_line_dedup,
    "op9_language_id": op9_language_id,
    "op10_mixing": op10_mixing,
    "op11_collocations": op11_collocations,
    "op12_decontamination": op12_decontamination,
    "op13_alignment": op13_alignment,
}

ORACLE: dict[str, str] = {
    "op2_chat_formatting": chat.ORACLE,
    "op6_warc": warc.ORACLE,
    "op8_line_dedup": templates.ORACLE,
    "op11_collocations": phrases.ORACLE,
    "op12_decontamination": decontaminate.ORACLE,
}
