import math
import random
from collections import defaultdict

import pytest

from medallion.llm import mixing

SCHEMA = "doc_id long, text string, source string, epoch int, start string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, -1, "x") for r in rows], SCHEMA).repartition(4)


def corpus(seed, sizes):
    rng = random.Random(seed)
    names = [s for s, n in sizes.items() for _ in range(n)]
    return [(i, "w " * rng.randrange(1, 40), s) for i, s in enumerate(names)]


def plain_exponent(totals, entropy=None, max_repeat=None):
    whole = sum(totals)
    low, high = 0.0, 1.0

    def measure(e):
        raised = [(t / whole) ** e for t in totals]
        w = [r / sum(raised) for r in raised]
        rate = [(t / whole) ** (e - 1) for t in totals]
        return -sum(x * math.log(x) for x in w), max(rate) / min(rate)

    flat = (lambda e: measure(e)[0] >= entropy) if entropy is not None else (lambda e: measure(e)[1] > max_repeat)
    if flat(1.0):
        return 1.0
    if not flat(0.0):
        return 0.0
    for _ in range(24):
        middle = (low + high) / 2
        low, high = (middle, high) if flat(middle) else (low, middle)
    return low if entropy is not None else high


@pytest.mark.parametrize("target", [{"entropy": 1.0}, {"entropy": 1.3}, {"entropy": 9.0}, {"entropy": 0.0}, {"max_repeat": 2.0}, {"max_repeat": 1.0}, {"max_repeat": 1e9}])
def test_exponent_equals_plain_bisection(spark, target):
    sizes = [900_000, 50_000, 40_000, 700]
    totals = spark.createDataFrame([(str(i), 1, t) for i, t in enumerate(sizes)], "source string, n_docs long, tokens long")
    assert mixing.bisect_exponent(totals, **({"max_repeat": None} | target)) == pytest.approx(plain_exponent(sizes, **target), abs=1e-6)


def by_source(mixed):
    found = defaultdict(list)
    for r in mixed:
        found[r.source].append(r)
    return found


def test_every_document_is_drawn_and_budgets_are_met(spark):
    rows = corpus(1, {"hot": 900, "mid": 200, "small": 60, None: 30})
    tokens = {d: len(t.split()) for d, t, _ in rows}
    mixed = mixing.mix_sources(frame(spark, rows), max_repeat=3.0, block_docs=20).collect()
    assert {r.doc_id for r in mixed} == set(tokens)
    totals = defaultdict(int)
    for d, _, s in rows:
        totals[s] += tokens[d]
    exponent = plain_exponent(list(totals.values()), max_repeat=3.0)
    whole = sum(totals.values())
    once = max(t / (t / whole) ** exponent for t in totals.values())
    for source, drawn in by_source(mixed).items():
        budget = once * (totals[source] / whole) ** exponent
        spent = sum(r.tokens for r in drawn)
        assert budget - 2 <= spent <= budget + max(tokens.values()) + 2
        per_epoch = defaultdict(list)
        for r in drawn:
            per_epoch[r.epoch].append(r.doc_id)
        assert all(len(set(ids)) == len(ids) for ids in per_epoch.values())
        last = max(per_epoch)
        assert all(len(per_epoch[e]) == sum(s == source for _, _, s in rows) for e in range(last))
        assert all(0 <= r.place < 1 for r in drawn)


def test_a_smaller_budget_takes_a_part(spark):
    rows = corpus(2, {"a": 300, "b": 300})
    mixed = mixing.mix_sources(frame(spark, rows), budget=2000, block_docs=50).collect()
    spent = {s: sum(r.tokens for r in d) for s, d in by_source(mixed).items()}
    assert 1990 <= sum(spent.values()) <= 2000 + 2 * 40


def test_epochs_are_permuted_differently_and_repeatably(spark):
    rows = corpus(3, {"big": 400, "small": 100})
    draws = [mixing.mix_sources(frame(spark, rows), max_repeat=3.0, block_docs=10).collect() for _ in range(2)]
    assert sorted(map(tuple, draws[0])) == sorted(map(tuple, draws[1]))
    blocks = defaultdict(dict)
    for r in draws[0]:
        if r.source == "small":
            blocks[r.epoch][r.doc_id] = r.block
    assert blocks[0] != {d: blocks[1].get(d) for d in blocks[0]}


def test_draw_repeats_rows(spark):
    docs = frame(spark, corpus(4, {"big": 100, "small": 10}))
    mixed = mixing.mix_sources(docs)
    drawn = mixing.draw(docs, mixed)
    assert drawn.columns == docs.columns
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert {r.doc_id: r["count"] for r in drawn.groupBy("doc_id").count().collect()} == times
    assert max(times.values()) == 2


def test_nulls_repeats_empty_sources_and_tables(spark):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (2, None, "s"), (3, "", "none"), (None, "c", None), (None, None, None)]
    docs = frame(spark, rows)
    drawn = mixing.draw(docs, mixing.mix_sources(docs)).collect()
    assert {(r.doc_id, r.text, r.source) for r in drawn} == set(rows)
    assert sum(r.doc_id == 1 for r in drawn) % 2 == 0
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    assert mixing.mix_sources(frame(spark, [(1, None, "s")])).count() == 1


def test_given_token_counts(spark):
    docs = spark.createDataFrame([(i, "x", "s", i) for i in range(20)], "doc_id long, text string, source string, n long")
    assert sum(r.tokens for r in mixing.mix_sources(docs, tokens_col="n").collect()) == sum(range(20))
