import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from medallion.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_stats(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(covered),
    )


def test_statistics_equal_their_definition():
    rng = random.Random(1)
    texts = [None, "", " \n ", "a", "a\n\na\n a\na\r"]
    for _ in range(150):
        texts.append("".join(rng.choice(["a ", "b ", "é\n", "#", " ", "\x0b", "<|", "w x "]) for _ in range(rng.randrange(120))))
    texts.append("one two three four five six seven eight nine " * 3)
    for text in texts:
        assert quality.text_stats(text) == plain_stats(text), repr(text)


@pytest.mark.parametrize("p,freedom,value", [(0.95, 5, 11.0705), (0.975, 2, 7.3778), (0.5, 1, 0.4549), (0.99999, 5, 30.8562)])
def test_chi_squared_quantiles(p, freedom, value):
    assert quality.chi_squared_quantile(p, freedom) == pytest.approx(value, abs=1e-3)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(n))


def corpus(rng, n, junk, lang="en", source="s", first=0):
    rows = [(first + i, sentence(rng, rng.randrange(30, 400)), lang, source) for i in range(n)]
    return rows + [
        (first + n + i, " ".join(w + "$$$" for w in sentence(rng, 80).split()), lang, source) for i in range(junk)
    ]


def test_junk_goes_and_clean_documents_stay(spark):
    rng = random.Random(2)
    rows = corpus(rng, 400, 90) + corpus(rng, 60, 5, "de", "tiny", 1000) + corpus(rng, 60, 5, "de", None, 2000)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    result = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    junk = {r[0] for r in rows if "$" in r[1]}
    assert len(result) == len(rows)
    assert {d for d, r in result.items() if not r.kept} == junk
    assert not any(r.base_failed for r in result.values())


VECTORS = f"g_lang string, g_source string, level int, {', '.join(f'{c} long' for c in quality.FEATURES)}"


def log_det(x, scale):
    covariance = np.cov(x.T, bias=True) * scale + np.diag(np.square(quality.LEAST_SPREAD))
    return np.linalg.slogdet(covariance)[1]


def test_least_determinants_against_all_subsets(spark):
    """Groups of 12 documents, 3 of them apart: the best of all 220 subsets of 9."""
    rng = np.random.default_rng(8)
    groups = {}
    for g in range(6):
        clean = rng.multivariate_normal([5, 1.6, 0.3, 0.2, 0.1], np.diag([0.6, 0.2, 0.4, 0.3, 0.2]) ** 2, 9)
        bad = rng.multivariate_normal([5, 1.6, 6, 5, 4], np.eye(5) * 0.04, 3)
        groups[f"g{g}"] = np.rint(np.vstack([clean, bad]) * quality.GRID).astype(int)
    rows = [(g, None, 1, *map(int, v)) for g, own in groups.items() for v in own]
    found = {r.g_lang: r for r in quality.least_determinants(spark.createDataFrame(rows, VECTORS)).collect()}
    scale = quality.consistency(0.75, 5)
    for g, own in groups.items():
        x = own / quality.GRID
        best = min(log_det(x[list(chosen)], scale) for chosen in combinations(range(12), 9))
        assert found[g].n == 12 and found[g].log_det == pytest.approx(best, abs=1e-6), g


def test_small_groups_are_drawn_towards_their_language(spark):
    """Junk that is alone in its source is judged by its language; no usable row is left unjudged."""
    rng = random.Random(9)
    rows = corpus(rng, 300, 0, "en", "big") + corpus(rng, 8, 0, "en", "small", 1000) + corpus(rng, 0, 5, "en", "junk", 2000)
    rows += corpus(rng, 3, 0, "xx", "other", 3000)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    result = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    assert {d for d, r in result.items() if not r.kept} == set(range(2000, 2005))
    assert all(r.distance is not None for r in result.values())


def test_estimates_resist_contamination_and_equal_numpy(spark):
    """The distributed steps against the same concentration over plain arrays."""
    rng = np.random.default_rng(3)
    clean = rng.multivariate_normal([5, 1.6, 0.3, 0.2, 0.1], np.diag([0.6, 0.2, 0.4, 0.3, 0.2]) ** 2, 900)
    bad = rng.multivariate_normal([5, 1.6, 5, 3, 2], np.eye(5) * 0.01, 200)
    grid = np.rint(np.vstack([clean, bad]) * quality.GRID).astype(int)
    rows = [("en", "s", 2, *map(int, v)) for v in grid]
    frame = spark.createDataFrame(rows, VECTORS)
    start = np.median(grid, axis=0) / quality.GRID
    scale = quality.consistency(0.75, 5)
    lower = np.eye(5)[np.tril_indices(5)].tolist()
    estimate = spark.createDataFrame(
        [("en", "s", 2, 0, len(rows), start.tolist(), lower, quality._whiten(np.eye(5)), 0.0)], quality.ESTIMATE
    )
    x, centre, root = grid / quality.GRID, start, np.linalg.inv(np.linalg.cholesky(np.eye(5) + np.diag(np.square(quality.LEAST_SPREAD))))
    for _ in range(4):
        estimate = quality._step(quality._join(frame, estimate), 0.75, scale)
        d = np.maximum((((x - centre) @ root.T) ** 2).sum(axis=1), 1e-9)
        bins = np.floor(np.log2(d) * quality.BINS_PER_OCTAVE)
        order = np.sort(bins)
        inner = x[bins <= order[int(np.ceil(0.75 * len(x))) - 1]]
        centre = inner.mean(axis=0)
        covariance = ((inner.T @ inner) / len(inner) - np.outer(centre, centre)) * scale
        root = np.linalg.inv(np.linalg.cholesky(covariance + np.diag(np.square(quality.LEAST_SPREAD))))
        row = estimate.first()
        assert np.allclose(row.centre, centre, atol=1e-9)
        assert np.allclose(row.root, root[np.tril_indices(5)], atol=1e-9)
    assert np.abs(centre - clean.mean(axis=0)).max() < 0.2
    assert row.n == len(rows)


def test_base_rules(spark):
    twenty = sentence(random.Random(4), 20)
    rows = [(1, twenty), (2, twenty.rsplit(" ", 1)[0]), (3, "a b c d e f g h " * 4), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", "x", 1) for i, t in rows], "doc_id long, text string, lang string, source string, distance string, n_words int")
    result = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    assert {d: r.base_failed for d, r in result.items()} == {1: False, 2: True, 3: True, 4: True, 5: True}
    assert {d: r.kept for d, r in result.items()} == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_null_groups_repeated_rows_and_empty_table(spark):
    rng = random.Random(6)
    text = sentence(rng, 60)
    schema = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame([(None, text, None, None)] * 150 + [(1, text, "en", None)], schema)
    result = quality.quality_rules(docs)
    assert result.count() == 151 and result.filter("kept").count() == 151
    assert quality.quality_rules(docs.limit(0)).count() == 0
