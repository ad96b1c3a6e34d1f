import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from medallion.llm import langid, simhash, templates
from medallion.sources.scratch import application_folder

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["language id", "line dedup", "simhash near-dedup", "source mixing", "best-fit packing"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's stored result, the documents first."""
    folder = tmp_path_factory.mktemp("stages")
    docs = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs[-1], SF_DIR).write.parquet(f"{folder}/{i}")
        docs.append(spark.read.parquet(f"{folder}/{i}"))
    return docs


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_order_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    assert all(s.columns == stages[0].columns and s.dtypes == stages[0].dtypes for s in stages[:-1])


def test_language_keeps_clean_documents(stages):
    before, after = rows(stages[0]), rows(stages[1])
    assert set(after) <= set(before) and len(after) >= 0.98 * len(before)
    assert all(after[d] == before[d] for d in after)
    model = langid.fit(stages[0])
    assert set(before) - set(after) == {d for d, r in before.items() if model.predict(r.text)[2]}


def test_lines_only_lose_recurring_ones(stages):
    before, after = rows(stages[1]), rows(stages[2])
    assert set(after) == set(before)
    for d, r in after.items():
        left = Counter(r.text.split("\n")) if r.text else Counter()
        assert left <= Counter(before[d].text.split("\n")) + Counter([""]) and r.n_chars == len(r.text)
    lost = {r.doc_id for r in templates.recurring_lines(stages[1]).collect()}
    assert {d for d in after if after[d].text != before[d].text} == lost


def test_one_document_of_each_group_stays(stages):
    before, after = rows(stages[2]), rows(stages[3])
    prints = {d: simhash.fingerprint(r.text) for d, r in before.items()}
    ids = sorted(before)
    root = {d: d for d in ids}
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3 and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    assert set(after) == set(root.values())


def test_mixing_draws_every_document(stages):
    before, after = rows(stages[3]), Counter(r.doc_id for r in stages[4].collect())
    assert set(after) == set(before) and max(after.values()) <= 2


def test_packing_holds_every_draw(stages):
    drawn = Counter(r.doc_id for r in stages[4].collect())
    packed = stages[5].collect()
    assert Counter(r.doc_id for r in packed if r.start == 0) == drawn
    fill = Counter()
    for r in packed:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 1024


def test_registered_run_equals_the_stages(spark, stages):
    before = set(os.listdir(application_folder(spark)))
    made = entry_point.queries()["pipeline"](spark, SF_DIR)
    # All that is left on disk is the last stage.
    (left,) = set(os.listdir(application_folder(spark))) - before
    assert os.listdir(os.path.join(application_folder(spark), left)) == [f"stage{len(corpus_pipeline.STAGES) - 1}"]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, made.select(*columns).collect())) == Counter(map(tuple, stages[5].select(*columns).collect()))
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry_point.oracle_sql()


def test_each_stage_takes_an_empty_table_and_odd_rows(spark, stages, tmp_path):
    schema = stages[0].schema
    odd = [(1, None, "en", None, None), (1, None, "en", None, None), (None, "", None, "s", 0), (2, "one line\n" * 3, None, None, 27)]
    for table in (spark.createDataFrame([], schema), spark.createDataFrame(odd, schema)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, table, SF_DIR).count() >= 0


def test_every_operator_has_a_query():
    names = [k for k in entry_point.queries() if k.startswith("op")]
    assert {int(k[2:].split("_")[0]) for k in names if k[2:].split("_")[0].isdigit()} == set(range(1, 14))


def test_extra_columns_stay_whatever_their_names(spark, stages):
    names = ["_h", "_own", "_id", "_dropped", "_copy", "_times", "h", "epoch", "leaf", "component_id", "Fingerprint", "key"]
    docs = stages[0].limit(40)
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(i))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, SF_DIR)
        assert made.columns == docs.columns and made.select(*names).distinct().collect() == [tuple(range(len(names)))]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= 40
