"""Benchmark decontamination against SQL and a brute-force version."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from medallion.llm import decontaminate as D
from medallion.llm import queries
from verification.compare import connect, differences

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, n_words string"


def said(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORDS.findall(lower)


def brute(docs, items, width=10):
    out = []
    for doc_id, text, *_ in docs:
        words, hit, named = said(text), set(), set()
        for item, content in items:
            w = said(content)
            n = min(width, len(w))
            windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
            for i in range(len(words) - n + 1 if n else 0):
                if tuple(words[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    if item is not None:
                        named.add(str(item))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(named), digest, bool(hit)))
    return sorted(out, key=str)


@pytest.fixture
def invented():
    rng = random.Random(5)
    vocabulary = ["a", "B", "cc", "Été", "漢字", "7", "x_y", "don't", "É"]
    prose = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--", " "]) for _ in range(n))
    items = [(i, prose(rng.choice([1, 2, 3, 9, 10, 11, 25]))) for i in range(9, 30)]
    items += [(1, None), (2, ""), (3, " ,. "), (None, "nobody asked this"), (9, items[4][1]), (100, items[4][1])]
    docs = [(i, prose(rng.choice([0, 1, 5, 40, 200])), "en", "x") for i in range(40)]
    docs += [(50, docs[3][1] + items[6][1] + "z", "en", "x"), (51, None, None, None), (52, "", "en", "x"), (None, "Nobody ASKED this!", "en", "")]
    docs += [docs[7], docs[7], (53, items[5][1].upper(), "en", "x"), (54, "w " * 3000 + items[8][1] + " w" * 3000, "en", "x")]
    return docs, items


def rows(frame):
    return sorted([tuple(r) for r in frame.collect()], key=str)


def test_equals_brute_force(spark, invented):
    docs, items = invented
    d = spark.createDataFrame(docs, DOCS).repartition(5)
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("spans", F.lit(1))
    want = brute(docs, items)
    assert any(r[5] for r in want) and not all(r[5] for r in want)
    assert rows(D.contamination_report(d, b)) == want


def test_blocks_of_windows_give_the_same(spark, invented):
    docs, items = invented
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    whole = rows(D.find_hits(d, b))
    assert rows(D.find_hits(d, b, block_bytes=700)) == whole
    assert rows(D.contamination_report(d, b, block_bytes=700)) == brute(docs, items)


def test_equal_hashes_are_verified_by_words(spark):
    found = D.WindowSet([b"a b c"], [["1"]])
    found.hashes[:] = D.WindowSet([b"x y z"], [["2"]]).hashes
    assert found.scan([b"x y z"])[1] == [[]]


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    result = queries.op12_decontamination(spark, sf_dir)
    with connect(sf_dir) as connection:
        assert differences(result, connection, D.ORACLE) == ""


def test_remove_spans_and_documents(spark):
    items = spark.createDataFrame([(1, "what is the capital of the small country of San Marino"), (2, "Yes!")], "item_id long, text string")
    docs = spark.createDataFrame(
        [
            (1, "Quiz: What is the capital, of the small country of San? End.", 5),
            (2, "Oh yes. No é. YES", 6),
            (3, "clean", 7),
            (4, None, None),
        ],
        "id long, text string, items int",
    )
    left = {r.id: (r.text, r.items) for r in D.remove_spans(docs, items).collect()}
    assert left == {1: ("Quiz: ? End.", 5), 2: ("Oh . No é. ", 6), 3: ("clean", 7), 4: (None, None)}
    assert D.remove_spans(docs, items).schema == docs.schema
    kept = D.remove_documents(docs, items)
    assert sorted(r.id for r in kept.collect()) == [3, 4] and kept.schema == docs.schema
    assert sorted(r.id for r in D.remove_documents(docs, items, min_hit=5).collect()) == [2, 3, 4]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.contamination_report(docs.limit(0), items).count() == 0
    row = D.contamination_report(docs, items.limit(0)).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest()


def test_very_long_text_and_word(spark):
    item = "one two three four five six seven eight nine ten"
    text = "é" * 3_000_000 + " " + "x " * 1_500_000 + item + " y" * 10
    words = D.Words([text.encode()])
    assert len(words.starts) == 1 + 1_500_000 + 10 + 10
    counts, spans, named = D.WindowSet([item.encode()], [["q"]]).scan([text.encode(), b"", item.encode()])
    assert list(counts) == [1_500_021, 0, 10] and named == [["q"], [], ["q"]]
    assert [text[s["start"] : s["stop"]] for s in spans[0]] == [item]
