from collections import Counter

import pytest
from tokenizers import Tokenizer

from medallion.llm import queries, rollup, tokens

COUNTS = "doc_id long, source string, lang string, tokenizer string, n_tokens long"


def totals(rollup_):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollup_.totals().collect()}


@pytest.fixture
def store(spark, tmp_path):
    return rollup.Rollup(spark, f"{tmp_path}/rollup")


def test_query_equals_counting_by_hand(spark):
    sf_dir = "/root/testdata/sf0.001"
    exact = Tokenizer.from_file(tokens.path())
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("toxic = 1").collect()}
    docs, n = Counter(), Counter()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        if r.doc_id not in toxic:
            docs[r.source, r.lang] += 1
            n[r.source, r.lang] += len(exact.encode(r.text or "", add_special_tokens=False).ids) + 1
    got = {(r.source, r.lang): (r.tokenizer, r.n_docs, r.n_tokens) for r in queries.op7_token_counts(spark, sf_dir).collect()}
    assert got == {k: ("byte_bpe_50k+end", docs[k], n[k]) for k in docs}


def test_deltas_add_up_and_commits_are_idempotent(spark, store):
    assert totals(store) == {}
    first = spark.createDataFrame([(1, "a", "en", "v1", 10), (2, "a", "en", "v1", 5), (3, "b", None, "v1", 7), (3, "b", None, "v1", 7)], COUNTS)
    assert store.commit("b1", rollup.inserts(first)) is True
    assert store.commit("b1", rollup.inserts(first)) is False
    assert totals(store) == {("a", "en", "v1"): (2, 15), ("b", None, "v1"): (2, 14)}
    revised = spark.createDataFrame([(1, "a", "en", "v2", 12), (2, "c", "en", "v1", 4)], COUNTS)
    store.commit("b2", rollup.revisions(first.filter("doc_id < 3"), revised))
    store.commit("b3", rollup.deletes(first.filter("doc_id = 3")))
    assert totals(store) == {("a", "en", "v2"): (1, 12), ("c", "en", "v1"): (1, 4)}


def test_a_batch_that_was_not_moved_in_does_not_count(spark, store):
    rows = spark.createDataFrame([(1, "a", "en", "v1", 10)], COUNTS)
    store.commit("b1", rollup.inserts(rows))
    rollup.inserts(rows).write.parquet(f"{store.folder}/staged/lost-driver")
    assert totals(store) == {("a", "en", "v1"): (1, 10)}
    with pytest.raises(ValueError, match="batch id"):
        store.commit("../b2", rollup.inserts(rows))


def test_empty_batches_and_cancelled_groups(spark, store):
    rows = spark.createDataFrame([(1, None, None, "v1", 0)], COUNTS)
    store.commit("none", rollup.inserts(rows.limit(0)))
    assert totals(store) == {} and store.committed("none")
    store.commit("both", rollup.revisions(rows, rows))
    assert totals(store) == {}
    store.commit("zero", rollup.inserts(rows))
    assert totals(store) == {(None, None, "v1"): (1, 0)}


def test_a_stream_commits_each_epoch_once(spark, store, tmp_path):
    source, point = f"{tmp_path}/in", f"{tmp_path}/checkpoint"
    rows = spark.createDataFrame([(1, "a", "en", "v1", 3), (2, "a", "en", "v1", 4)], COUNTS)
    rows.write.parquet(source)
    for _ in range(2):  # the second run finds nothing new
        stream = spark.readStream.schema(COUNTS).parquet(source)
        run = stream.writeStream.option("checkpointLocation", point).trigger(availableNow=True)
        run.foreachBatch(lambda df, epoch: store.apply_stream_batch(rollup.inserts(df), epoch)).start().awaitTermination()
    store.apply_stream_batch(rollup.inserts(rows), 0)
    assert totals(store) == {("a", "en", "v1"): (2, 7)}


def test_counting_whole_texts(spark):
    docs = spark.createDataFrame([(1, None, "s", "en", 9), (2, "", "s", None, 9), (3, "a b", None, "en", 9)], "doc_id long, text string, source string, lang string, n_tokens int")
    assert {r.doc_id: r.n_tokens for r in rollup.count_tokens(docs, "v").collect()} == {1: 0, 2: 0, 3: 2}
    assert rollup.count_tokens(docs.limit(0), "v").count() == 0
    labels = spark.createDataFrame([(3, 1), (3, 1), (None, 1), (2, 0)], "doc_id long, toxic int")
    assert [r.doc_id for r in rollup.flagged(rollup.count_tokens(docs, "v"), labels, "toxic").collect()] == [3]
