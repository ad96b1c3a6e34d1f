"""Quality rules: base limits, then robust multivariate outliers.

Statistics of every whole text are transformed to a vector of five numbers.  For each
language and source the minimum covariance determinant gives a location and a covariance
that up to a quarter of bad documents cannot move; a document is rejected if its squared
Mahalanobis distance is beyond a quantile of the chi-squared distribution.

The estimate is the usual concentration: from the current centre and covariance take the
three quarters of the documents that are nearest, estimate again from these, repeat.  It runs
from four starts at once, and the one with the least determinant counts.  One round is one
aggregation: distances are put in fine bins, every bin of every group and start holds the
sums that its documents add to a mean and a covariance, and the bins are accumulated from
the nearest outwards until they hold three quarters.  Vectors are whole numbers of 1/1024, so the
sums are exact and no order of rows changes them.

The same is done for each language and for all documents.  An estimate is drawn towards the
one above it by the weight of ``prior`` documents, at every size alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import cut, same, words

SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["length", "word_length", "symbols", "dup_lines", "repeats"]
# Vectors are stored in whole numbers of 1/GRID and limited to +-LIMIT, far beyond any text.
GRID = 1024
LIMIT = 32
# What one unit of noise is worth, per feature: smaller spreads count as this much, so a
# group whose documents all agree does not reject the first one that differs a little.
LEAST_SPREAD = (0.5, 0.1, 0.6, 0.5, 0.5)
COVERAGE = 0.75
# Rounds go on as long as some logarithm of a determinant falls by more than this.  The least
# spreads bound determinants from below, so they end.
SETTLED = 1e-3
# False rejections expected of well-behaved documents: one in a hundred thousand.
TAIL = 1e-5
# What the estimate above a group's own weighs, in documents.
PRIOR = 30
# Usable documents that a table needs for an estimate at all.
LEAST_DOCS = 30
BINS_PER_OCTAVE = 32
MIN_OCTAVE, MAX_OCTAVE = -12, 40
PAIRS = list(combinations_with_replacement(range(len(FEATURES)), 2))


def repeat_words(found: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more in the text, the first one included."""
    n = len(found) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in found], np.int64)
    mixed = np.zeros(n, np.uint64)
    for k in range(window):
        mixed = (mixed ^ ids[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    equal = mixed[order[1:]] == mixed[order[:-1]]
    if not equal.any():
        return 0
    # Equal hashes are compared as words; a collision (never seen) is settled by the words.
    a, b = order[1:][equal], order[:-1][equal]
    offsets = np.arange(window)
    if not (ids[a[:, None] + offsets] == ids[b[:, None] + offsets]).all():
        at: dict[tuple, list[int]] = {}
        for i in range(n):
            at.setdefault(tuple(ids[i : i + window].tolist()), []).append(i)
        starts = np.array([i for own in at.values() if len(own) > 1 for i in own], np.int64)
    else:
        starts = np.union1d(a, b)
    edges = np.zeros(len(found) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; a null text counts as empty."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    found = raw.split()
    blank = sum(raw.count(bytes([c])) for c in b" \t\n\x0b\x0c\r")
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    return (
        len(found),
        len(text) - blank,
        sum(raw.count(s) for s in SYMBOLS),
        len(lines) - len(set(lines)),
        repeat_words(found),
    )


def statistics(docs: DataFrame, text_col: str, also: dict[str, str]) -> DataFrame:
    """Columns ``also`` (new name: column), then the statistics of every whole text."""
    picked = docs.select(*[F.col(c).alias(n) for n, c in also.items()], F.col(text_col).alias("_text"))
    names = [*also, *STATS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([text_stats(t.as_py()) for t in batch.column(len(also))], np.int64)
            made = [pa.array(c) for c in rows.reshape(-1, len(STATS)).T]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(also)], *made], names)

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1]]
    return picked.mapInArrow(run, ", ".join([*kept, *(f"{s} long" for s in STATS)]))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def vector() -> list[Column]:
    """The transformed statistics, each as a whole number of 1/GRID.

    Logarithms of length and mean word length; symbols, repeated lines and repeated words
    as logarithms of their rate, with one added so that few in a long text weigh little.
    """
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    values = [
        F.log(n),
        F.log((F.col("word_chars") + 1) / n),
        F.log1p(100 * F.col("n_symbols") / n),
        F.log1p(100 * F.col("n_dup_lines") / n),
        F.log1p(10 * F.col("n_repeat_words") / n),
    ]
    return [
        F.rint(F.least(F.greatest(v, F.lit(-LIMIT)), F.lit(LIMIT)) * GRID).cast("long").alias(f)
        for v, f in zip(values, FEATURES, strict=True)
    ]


def chi_squared_quantile(p: float, freedom: int) -> float:
    """By bisection of the regularised lower incomplete gamma function's series."""

    def below(x: float) -> float:
        a, y = freedom / 2, x / 2
        term = total = 1 / a
        k = a
        while term > total * 1e-16:
            k += 1
            term *= y / k
            total += term
        return total * math.exp(-y + a * math.log(y) - math.lgamma(a))

    low, high = 0.0, 10.0 * freedom + 200
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def consistency(coverage: float, freedom: int) -> float:
    """Scales the covariance of the nearest ``coverage`` up to that of all normal data."""
    cutoff = chi_squared_quantile(coverage, freedom)
    low, high = 0.0, 1.0
    for _ in range(100):  # P(chi2 with two more degrees <= cutoff), by inverting the quantile
        middle = (low + high) / 2
        low, high = (middle, high) if chi_squared_quantile(middle, freedom + 2) < cutoff else (low, middle)
    return coverage / high


TRIANGLE = [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]


def _full(lower: list[float]) -> np.ndarray:
    """The symmetric matrix of a lower triangle."""
    matrix = np.zeros((len(FEATURES), len(FEATURES)))
    for (i, j), value in zip(TRIANGLE, lower, strict=True):
        matrix[i, j] = matrix[j, i] = value
    return matrix


def _whiten(covariance: np.ndarray) -> list[float]:
    """Lower triangle of W with W'W = inverse covariance, after flooring each spread."""
    floor = np.diag(np.square(LEAST_SPREAD))
    inverse_root = np.linalg.inv(np.linalg.cholesky(covariance + floor))
    return [float(inverse_root[i, j]) for i, j in TRIANGLE]


def _distance(centre: str = "centre", root: str = "root") -> Column:
    """Squared Mahalanobis distance, as plain arithmetic on the columns."""
    total, at = None, 0
    for i in range(len(FEATURES)):
        part = None
        for j in range(i + 1):
            term = F.col(root)[at] * (F.col(FEATURES[j]) / F.lit(float(GRID)) - F.col(centre)[j])
            part, at = (term if part is None else part + term), at + 1
        total = part * part if total is None else total + part * part
    return total


GROUP = ["g_lang", "g_source", "level"]
KEY = [*GROUP, "start"]
ESTIMATE = (
    "g_lang string, g_source string, level int, start int, n long, centre array<double>,"
    " covariance array<double>, root array<double>, log_det double"
)


def _estimate(head: pd.Series, n: int, centre: np.ndarray, covariance: np.ndarray) -> dict:
    """A row of ESTIMATE; the determinant is that of the floored covariance."""
    root = _whiten(covariance)
    log_det = -2 * sum(math.log(value) for value, (i, j) in zip(root, TRIANGLE, strict=True) if i == j)
    lower = [float(covariance[i, j]) for i, j in TRIANGLE]
    key = {c: None if pd.isna(head[c]) else head[c] for c in KEY}
    return {**key, "n": n, "centre": [float(c) for c in centre], "covariance": lower, "root": root, "log_det": log_det}


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[part.split()[0] for part in ESTIMATE.split(",")])


def _concentrate(coverage: float, scale: float):
    """One group's bins, nearest first, to the estimate of the nearest ``coverage``."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        n = int(pdf["n"].sum())
        needed = max(len(FEATURES) + 1, math.ceil(coverage * n))
        last = int(np.searchsorted(pdf["n"].cumsum().to_numpy(), min(needed, n)))
        inner = pdf.iloc[: last + 1]
        h = float(inner["n"].sum())
        mean = np.array([float(inner[f"s{i}"].sum()) for i in range(len(FEATURES))]) / h / GRID
        second = np.zeros((len(FEATURES), len(FEATURES)))
        for i, j in PAIRS:
            second[i, j] = second[j, i] = float(inner[f"q{i}{j}"].sum()) / h / GRID**2
        return _frame([_estimate(pdf.iloc[0], n, mean, (second - np.outer(mean, mean)) * scale)])

    return run


def _bin() -> Column:
    octave = F.greatest(F.lit(MIN_OCTAVE), F.least(F.lit(MAX_OCTAVE), F.log2(F.greatest(_distance(), F.lit(1e-9)))))
    return F.floor(octave * BINS_PER_OCTAVE).cast("int")


def _step(rows: DataFrame, coverage: float, scale: float) -> DataFrame:
    """``rows`` (key, vector and estimate columns) to one estimate per group and start."""
    f = [F.col(c) for c in FEATURES]
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(f)]
    squares = [F.sum(f[i] * f[j]).alias(f"q{i}{j}") for i, j in PAIRS]
    bins = rows.groupBy(*KEY, _bin().alias("bin")).agg(F.count("*").alias("n"), *sums, *squares)
    return bins.groupBy(*KEY).applyInPandas(_concentrate(coverage, scale), ESTIMATE)


def _join(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    """Each row with the estimates of its group, one per start.

    An estimate is a few hundred bytes per group; adaptive execution broadcasts it only if small.
    """
    e = estimates.select(*[F.col(c).alias(f"_{c}") for c in GROUP], "start", "centre", "root")
    on = same(rows["g_lang"], e["_g_lang"]) & same(rows["g_source"], e["_g_source"]) & (rows["level"] == e["_level"])
    return rows.join(e, on, how).drop(*[f"_{c}" for c in GROUP])


def _levels(rows: DataFrame) -> DataFrame:
    """Each row in three groups: all rows (level 0), its language's, and its language's and source's."""
    none = F.lit(None).cast("string")
    lang, source = F.col("lang").cast("string"), F.col("source").cast("string")
    groups = [(none, none, 0), (lang, none, 1), (lang, source, 2)]
    return rows.select(
        F.inline(F.array(*[F.struct(g.alias("g_lang"), s.alias("g_source"), F.lit(k).alias("level")) for g, s, k in groups])), *FEATURES
    )


def _starts(usable: DataFrame) -> DataFrame:
    """Four first estimates of each group, as the concentration's starts.

    0: medians and median absolute deviations; 1: medians and the spatial signs' covariance;
    2: the half nearest to start 0; 3: plain mean and covariance.
    """
    size = len(FEATURES)
    middle = usable.groupBy(*GROUP).agg(*[F.median(c).alias(f"m_{c}") for c in FEATURES])
    middle = cut(middle.select(*[F.col(c).alias(f"_{c}") for c in GROUP], *[f"m_{c}" for c in FEATURES]).coalesce(8))
    at = same(F.col("g_lang"), F.col("_g_lang")) & same(F.col("g_source"), F.col("_g_source")) & (F.col("level") == F.col("_level"))
    apart = usable.join(middle, at).select(*GROUP, *[f"m_{c}" for c in FEATURES], *[(F.col(c) - F.col(f"m_{c}")).alias(c) for c in FEATURES])
    spread = apart.groupBy(*GROUP).agg(
        F.count("*").alias("n"),
        F.array(*[F.first(f"m_{c}") / GRID for c in FEATURES]).alias("centre"),
        F.array(*[1.4826 * F.median(F.abs(F.col(c))) / GRID for c in FEATURES]).alias("mad"),
    )
    spread = cut(spread.coalesce(8))
    # Directions from the medians, in units of the spreads; whole numbers, so sums are exact.
    own = spread.select(*[F.col(c).alias(f"_{c}") for c in GROUP], "mad")
    unit = [F.col(c) / F.sqrt(F.col("mad")[i] * F.col("mad")[i] + LEAST_SPREAD[i] ** 2) for i, c in enumerate(FEATURES)]
    norm = F.sqrt(reduce(Column.__add__, [u * u for u in unit]))
    signs = apart.join(own, at).select(
        *GROUP, *[F.when(norm > 0, F.rint(u / norm * GRID)).otherwise(F.lit(0.0)).cast("long").alias(f"u{i}") for i, u in enumerate(unit)]
    ).groupBy(*GROUP).agg(*[F.sum(F.col(f"u{i}") * F.col(f"u{j}")).alias(f"q{i}{j}") for i, j in PAIRS])
    seen = signs.select(*[F.col(c).alias(f"_{c}") for c in GROUP], *[f"q{i}{j}" for i, j in PAIRS])

    def first_two(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            made = []
            for _, row in pdf.iterrows():
                wide = np.sqrt(np.square(row["mad"]) + np.square(LEAST_SPREAD))
                turned = np.zeros((size, size))
                for i, j in PAIRS:
                    turned[i, j] = turned[j, i] = row[f"q{i}{j}"] / row["n"] / GRID**2 * size * wide[i] * wide[j]
                for start, covariance in enumerate((np.diag(np.square(row["mad"])), turned)):
                    made.append(_estimate(pd.Series({**row[GROUP], "start": start}), int(row["n"]), row["centre"], covariance))
            yield _frame(made)

    both = spread.join(seen, at).select(*GROUP, "n", "centre", "mad", *[f"q{i}{j}" for i, j in PAIRS])
    made = cut(both.mapInPandas(first_two, ESTIMATE).coalesce(8))
    placed = _join(usable, made.filter("start = 0"))
    half = _step(placed.withColumn("start", F.lit(2)), 0.5, 1.0)
    plain = _step(placed.withColumn("start", F.lit(3)), 1.0, 1.0)
    return made.unionByName(half).unionByName(plain)


def least_determinants(usable: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The estimate of the least determinant of each group (``GROUP`` and vector columns).

    Every start is followed until its determinant settles; of equal determinants the first start counts.
    """
    scale = consistency(coverage, len(FEATURES))
    moving = cut(_step(_join(usable, cut(_starts(usable).coalesce(8))), coverage, scale).coalesce(8))
    found = []
    while not moving.isEmpty():
        found.append(moving)
        before = moving.select(*[F.col(c).alias(f"_{c}") for c in KEY], F.col("log_det").alias("_log_det"))
        on = same(F.col("g_lang"), F.col("_g_lang")) & same(F.col("g_source"), F.col("_g_source")) & (F.col("level") == F.col("_level"))
        after = _step(_join(usable, moving), coverage, scale).join(before, on & (F.col("start") == F.col("_start")))
        moving = cut(after.filter(F.col("log_det") < F.col("_log_det") - SETTLED).select(*moving.columns).coalesce(8))
    every = reduce(DataFrame.unionByName, found, moving)
    best = F.min(F.struct("log_det", "start", "n", "centre", "covariance", "root")).alias("best")
    return every.groupBy(*GROUP).agg(best).select(*GROUP, "best.*")


def _shrunk(estimates: DataFrame, prior: float) -> DataFrame:
    """(g_lang, g_source, level, start, centre, root) of each language and source, drawn towards its language's, that towards all."""
    level = lambda k: estimates.filter(F.col("level") == k)
    named = lambda k, *keys: level(k).select(
        *[F.col(c).alias(f"_{c}{k}") for c in keys], F.col("n").alias(f"n{k}"), F.col("centre").alias(f"c{k}"), F.col("covariance").alias(f"v{k}")
    )
    joined = named(2, "g_lang", "g_source").join(named(1, "g_lang"), same(F.col("_g_lang2"), F.col("_g_lang1")))
    joined = joined.join(F.broadcast(named(0)), F.lit(True))  # a single row
    weight = lambda k: F.col(f"n{k}") / (F.col(f"n{k}") + prior)

    def drawn(c: str) -> Column:
        upper = F.zip_with(f"{c}1", f"{c}0", lambda x, y: weight(1) * x + (1 - weight(1)) * y)
        return F.zip_with(F.col(f"{c}2"), upper, lambda x, y: weight(2) * x + (1 - weight(2)) * y)

    both = joined.select(F.col("_g_lang2").alias("g_lang"), F.col("_g_source2").alias("g_source"), drawn("c").alias("centre"), drawn("v").alias("covariance"))

    def whitened(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            roots = [_whiten(_full(list(v))) for v in pdf["covariance"]]
            yield pdf[["g_lang", "g_source", "centre"]].assign(level=2, start=0, root=roots)

    return both.mapInPandas(whitened, "g_lang string, g_source string, centre array<double>, level int, start int, root array<double>")


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    coverage: float = COVERAGE,
    tail: float = TAIL,
    prior: float = PRIOR,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """One row per input row: ``doc_id``, the statistics, ``base_failed``, ``kept``, ``distance``.

    ``kept`` is false for ``base_failed`` rows, which no estimate uses, and for rows whose
    squared distance is beyond the ``1 - tail`` quantile.  Every group (language and source,
    null being a value of either) is judged by its own estimate, drawn towards its
    language's, and that towards the whole table's, each by the weight of ``prior``
    documents.  A table of fewer than ``least_docs`` usable documents has no estimate; all
    of these are kept, with a null distance.

    A null, empty or blank text has no words and fails the base rules.  Repeated rows are
    rows like any other.  Other columns are ignored.  An empty table gives an empty result.
    """
    cutoff = chi_squared_quantile(1 - tail, len(FEATURES))
    stats = statistics(docs, text_col, {"doc_id": id_col, "lang": lang_col, "source": source_col})
    rows = cut(stats.withColumn("base_failed", base_failed()).select("*", *vector()))
    estimates = cut(least_determinants(_levels(rows.filter("not base_failed")), coverage).coalesce(8))
    known = estimates.filter(F.col("level") == 0).agg(F.max("n")).first()[0]
    final = cut(_shrunk(estimates.filter(F.lit((known or 0) >= least_docs)), prior).coalesce(8))
    placed = rows.select(
        "*", F.col("lang").cast("string").alias("g_lang"), F.col("source").cast("string").alias("g_source"), F.lit(2).alias("level")
    )
    judged = _join(placed, final, "left").withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    return judged.select(
        "doc_id", *STATS, "base_failed",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)).alias("kept"),
        "distance",
    )
