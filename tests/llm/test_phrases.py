"""Phrase collocations against SQL and a version that counts every phrase in a dictionary."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from medallion.llm import phrases as P
from medallion.llm import queries
from verification.compare import connect, differences

SCHEMA = "doc_id long, text string, lang string, n int, phrase string"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def count_phrases(docs, depth=3):
    counts = defaultdict(Counter)
    for _, text, lang in docs:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for size in range(1, depth + 1):
                for i in range(len(words) - size + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + size])] += 1
    return counts


def brute(docs, least=10, top=2000):
    out = []
    for lang, f in count_phrases(docs).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        rows = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if len(p) == 2 and any(
                len(q) == 3 and c >= least and p in (q[:2], q[1:]) and 100 * c >= 50 * a for q, c in f.items()
            ):
                continue
            score, _, left, right = min(
                (1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
            )
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.fixture(scope="module")
def invented():
    rng = random.Random(11)
    vocabulary = ["the", "The", "new", "york", "times", "é", "漢", "a-b", "x\x0by", " ", "of", "#", "\x1f"]
    weights = [9, 3, 3, 3, 3, 1, 1, 1, 1, 1, 5, 1, 1]
    prose = lambda n: "".join(w + rng.choice([" ", " ", "\t", "  ", ". ", ",", "\n"]) for w in rng.choices(vocabulary, weights, k=n))
    docs = [(i, prose(rng.randrange(0, 120)), rng.choice(["en", "en", "fr", None, "und"])) for i in range(120)]
    docs += [(500 + i, "new york times square", "en") for i in range(40)] + [(600, None, "en"), (601, "", "de"), (602, ".", "xx")]
    return docs + [docs[3], (None, docs[4][1], docs[4][2]), (603, "the " * 5000, "en")]


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, "x") for d in docs], SCHEMA).repartition(3)


def rows(made):
    return sorted(tuple(r) for r in made.select(*COLUMNS).collect())


def test_equals_brute_force(spark, invented):
    want = brute(invented)
    assert len(want) > 100
    assert rows(P.collocations(frame(spark, invented))) == want


def test_small_budgets_split_prefixes_and_change_nothing(spark, invented, monkeypatch):
    want = count_phrases(invented)
    docs = frame(spark, invented)
    levels = []
    add = P.Routes.add
    monkeypatch.setattr(P.Routes, "add", lambda self, rows, budget, first, last: levels.append(last) or add(self, rows, budget, first, last))
    for leaves, classes in ((3, 64), (40, 16), (10_000, 8)):
        counts, totals = P.phrase_counts(docs, min_count=2, group_leaves=leaves, classes=classes)
        found = {(r.lang, tuple(r.phrase.split(" "))): r.n for r in counts.collect()}
        assert found == {(lang, p): n for lang, f in want.items() for p, n in f.items() if n >= 2}
        assert {r.lang: r.n for r in totals.collect() if r.n} == {
            lang: sum(n for p, n in f.items() if len(p) == 1) for lang, f in want.items()
        }
    assert levels[:3] == [False, False, True]


def test_only_the_first_of_each_language(spark, invented):
    assert rows(P.collocations(frame(spark, invented), top=7)) == brute(invented, top=7)


def test_groups_keep_to_the_budget():
    rng = np.random.default_rng(4)
    sizes = rng.zipf(1.3, 64).clip(0, 5000)
    routes = P.Routes(64)
    n = routes.add(sizes, 1000, 5, last=False)
    table = routes.tables[0]
    assert ((table < 0) == ((sizes == 0) | (sizes > 1000))).all()
    held = np.bincount(table[table >= 0], weights=sizes[table >= 0])
    assert held.max() <= 1000 and len(held) == n and (held[5:] > 0).all()


def test_counts_beyond_64_bits_of_product(spark):
    a = 5_000_000_000_000_000
    one = spark.createDataFrame([(a, a + 7, 2 * a)], "a long, l long, r long")
    square = "CAST(CAST({0} AS DECIMAL(19,0)) * CAST({1} AS DECIMAL(19,0)) AS DECIMAL(38,0))"
    made = one.select(F.expr(f"CAST({square.format('a', 'a')} * {P.SCALE}BD AS DECIMAL(38,0)) div {square.format('l', 'r')}")).first()[0]
    assert made == 1_000_000 * a * a // ((a + 7) * 2 * a)


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    result = queries.op11_collocations(spark, sf_dir)
    with connect(sf_dir) as connection:
        assert differences(result, connection, P.ORACLE) == ""


def test_empty_tables(spark):
    assert P.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert P.collocations(spark.createDataFrame([(1, None, None, 1, "")], SCHEMA)).count() == 0


def test_many_words_in_one_fragment():
    made = P._Language()
    made.add(b" ".join(b"w%d" % (i % 2_200_000) for i in range(2_200_002)))
    _, n, words, n_leaves, leaves, counts = made.fragment("en", 3)
    assert n == 2_200_002 and words.count(b"\n") == 2_199_999
    assert np.frombuffer(counts, np.uint8).sum() == n and len(leaves) == 12 * 2_200_002 and n_leaves == n


def test_packed_numbers_come_back():
    for most in (0, 1, 255, 256, 65_535, 65_536, 2**32 - 1, 2**32):
        numbers = np.array([0, most // 2, most], dtype=np.int64)
        raw = P._packed(numbers)
        assert (P._unpacked(pa.scalar(raw), 3) == numbers).all() and len(raw) <= 24
