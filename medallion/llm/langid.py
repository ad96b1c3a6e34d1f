"""Language ID: averaged hashed subword embeddings with a linear softmax.

Subwords are letter sequences of two to four characters inside a word, its ends included
as marks, hashed into a fixed number of rows of an embedding table.  A text is the mean
of its subwords' embeddings; a linear softmax on top gives a probability per language.
Both are trained together by stochastic gradient descent in numpy, on a bounded sample.
On the part of the sample kept from training, one temperature calibrates the
probabilities, and a rejection threshold is set so that what is accepted is right as
often as asked for.

Averaging and the linear layer commute, so a prediction only needs the product of both
tables: one row of scores per bucket, summed over the text's subwords.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
SIZES = (2, 3, 4)
BUCKETS = 1 << 16
WIDTH = 16
# The bounded sample: at most so many documents of each language, from each of them one
# piece of each length at a place that follows from a hash.
DOCS_PER_LANGUAGE = 1_000
PIECES = (40, 160, 640)
STEPS = 3_000  # gradient steps, however small the sample
BATCH = 16
RATE = 0.5
SEED = 7
VALIDATION = 5  # every fifth sampled document is kept from training
# Labels may be wrong, so scores are judged beside the precision that all pieces reach against them:
# low scores are rejected as far as they are right less often than this share of it, ...
WORSE = 0.6
# ... at most this share of the pieces, and whatever scores below this share of it.
MOST_REJECTED = 0.2
LEAST_CONFIDENCE = 0.5
HOT_LABELS = 1_000
# Multipliers of the subword hash: any odd 32-bit numbers.
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)
BLOCK = 1 << 18


def alphabet() -> np.ndarray:
    """Code point to lower-case code point, 0 if it is no letter; part of the model."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for point in range(sys.maxunicode + 1):
        char = chr(point)
        if char.isalpha():
            table[point] = ord(char.lower()[0])
    return table


def letters(text: str | None, lower: np.ndarray) -> np.ndarray:
    """Lower-case letters, each run of other characters as one 0, a 0 at either end."""
    raw = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.zeros(len(raw) + 2, np.uint32)
    codes[1:-1] = lower[raw]
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    keep[0] = True
    return codes[keep]


def subwords(codes: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of all subwords; none spans two words."""
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    inner = codes != 0
    found = []
    for size in SIZES:
        n = len(codes) - size + 1
        if n <= 0:
            break
        mixed = np.zeros(n, np.uint32)
        whole = np.ones(n, bool)
        for k in range(size):
            part = codes[k : k + n]
            mixed = (mixed ^ part) * np.uint32(MULTIPLIERS[k])
            mixed ^= mixed >> np.uint32(15)
            if 0 < k < size - 1:
                whole &= inner[k : k + n]
        if size == 2:
            whole &= inner[:n] | inner[1:]
        found.append((mixed[whole] * np.uint32(MULTIPLIERS[0] ^ size << 1)) >> shift)
    return np.concatenate(found) if found else np.empty(0, np.uint32)


@dataclass
class LanguageModel:
    """Scores per bucket (embedding times softmax weights), and how to read them."""

    languages: list[str]
    lower: np.ndarray
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def logits(self, text: str | None) -> np.ndarray | None:
        """None if the text has no letter."""
        codes = letters(text, self.lower)
        if not codes.any() or not self.languages:
            return None
        total, count = np.zeros(len(self.languages)), 0
        for start in range(0, len(codes), BLOCK):  # bounded memory for very long texts
            found = subwords(codes[start : start + BLOCK + max(SIZES) - 1], len(self.table))
            total += self.table[found].sum(axis=0, dtype=np.float64)
            count += len(found)
        return total / max(count, 1) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, and whether it is too low to trust."""
        logits = self.logits(text)
        if logits is None:
            return UNKNOWN, 0.0, True
        p = softmax(logits[None] / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.threshold)


def softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], validation: list[bool]) -> LanguageModel:
    """Stochastic gradient descent on the sample; deterministic for a given order of rows."""
    languages, lower = sorted(set(labels)), alphabet()
    if not languages:
        return LanguageModel([], lower, np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 1.0)
    rng = np.random.default_rng(SEED)
    grams = [subwords(letters(t, lower)).astype(np.int64) for t in texts]
    target = np.array([languages.index(x) for x in labels])
    held = np.array(validation, bool) & np.array([len(g) > 0 for g in grams])
    used = np.flatnonzero(~np.array(validation, bool) & np.array([len(g) > 0 for g in grams]))
    embed = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    weight = np.zeros((len(languages), WIDTH), np.float32)
    weight += rng.uniform(-0.1, 0.1, weight.shape).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    done = 0
    while done < STEPS and len(used):
        rng.shuffle(used)
        for start in range(0, len(used), BATCH):
            picked = used[start : start + BATCH]
            sizes = np.array([len(grams[i]) for i in picked])
            ids = np.concatenate([grams[i] for i in picked])
            starts = np.r_[0, np.cumsum(sizes)[:-1]]
            mean = np.add.reduceat(embed[ids], starts, axis=0) / sizes[:, None]
            p = softmax(mean @ weight.T + bias)
            p[np.arange(len(picked)), target[picked]] -= 1
            rate = RATE * max(0.0, 1 - done / STEPS)
            back = (p @ weight / sizes[:, None]).astype(np.float32)
            weight -= rate * (p.T @ mean)
            bias -= rate * p.sum(axis=0)
            np.subtract.at(embed, ids, np.repeat(rate * back, sizes, axis=0))
            done += 1
    table = embed @ weight.T
    model = LanguageModel(languages, lower, table, bias.astype(np.float64), 1.0, LEAST_CONFIDENCE)
    return calibrate(model, [g for g, h in zip(grams, held, strict=True) if h], target[held])


def calibrate(model: LanguageModel, grams: list[np.ndarray], target: np.ndarray) -> LanguageModel:
    """Temperature of least log loss, then a threshold below which scores are worth little.

    Wrong labels lower the precision of high and low scores alike.  So only what is clearly
    worse than the rest is rejected, and never more than a share of the pieces.
    """
    if not len(grams):
        return model
    logits = np.stack([model.table[g].mean(axis=0) for g in grams]) + model.bias
    rows = np.arange(len(target))

    def loss(t):
        return -np.log(np.maximum(softmax(logits / t)[rows, target], 1e-12)).mean()

    model.temperature = float(min(np.geomspace(0.05, 5, 81), key=loss))
    p = softmax(logits / model.temperature)
    top, right = p.max(axis=1), p.argmax(axis=1) == target
    usual = float(right.mean())
    model.threshold = LEAST_CONFIDENCE * usual
    order = np.argsort(top, kind="stable")
    ends = np.flatnonzero(np.r_[np.diff(top[order]) != 0, True])[:-1]  # equal scores go together
    ends = ends[ends < MOST_REJECTED * len(top)]
    below = np.cumsum(right[order])[ends] / (ends + 1)
    bad = np.flatnonzero(below <= WORSE * usual)
    if len(bad):
        # The next score is the first that is accepted.
        model.threshold = max(model.threshold, float(top[order][ends[bad[-1]] + 1]) - 1e-9)
    return model


def _low_ranks(docs: DataFrame, rank: Column, label: Column, per_language: int) -> Column:
    """Which rows can be among the first ``per_language`` of their label, but for a few.

    Labels with many rows are counted, and only ranks below a bound that lets about twice as many
    through are kept, so a hot label costs no task more than its share.  Should too few
    pass, which is as good as impossible, the sample is smaller.
    """
    counts = docs.groupBy(label.alias("label")).count().filter(F.col("count") > 2 * per_language)
    hot = counts.orderBy(F.col("count").desc(), "label").limit(HOT_LABELS).collect()
    if not hot:
        return F.lit(True)
    bounds = [x for r in hot for x in (F.lit(r["label"]), F.lit(-(1 << 63) + int((1 << 64) * (2 * per_language / r["count"]))))]
    return rank <= F.coalesce(F.create_map(*bounds)[label], F.lit((1 << 63) - 1))


def training_sample(
    docs: DataFrame, id_col: str, text_col: str, label_col: str, usable: Column,
    per_language: int = DOCS_PER_LANGUAGE,
) -> DataFrame:
    """(label, validation, text): pieces of at most ``per_language`` documents of each label.

    Documents are chosen by a hash of their id, so the choice does not depend on
    partitions.  Only pieces are shuffled, of about twice as many documents as a label needs.
    """
    rank = F.xxhash64(F.lit(SEED), F.col(id_col).cast("string"), F.length(text_col))
    text = F.col(text_col)
    pieces = F.array(
        *[
            F.substring(
                text,
                (1 + F.pmod(F.xxhash64(rank, F.lit(n)), F.greatest(F.lit(1), F.length(text) - n + 1))).cast("int"),
                F.lit(n),
            )
            for n in PIECES
        ]
    )
    label = F.col(label_col).cast("string")
    known = docs.filter(usable & F.col(label_col).isNotNull() & text.isNotNull())
    chosen = (
        known.filter(_low_ranks(known, rank, label, per_language))
        .select(F.col(label_col).cast("string").alias("label"), rank.alias("rank"), pieces.alias("pieces"))
        .withColumn("nth", F.row_number().over(Window.partitionBy("label").orderBy("rank", "pieces")))
        .filter(F.col("nth") <= per_language)
    )
    return chosen.select(
        "label", (F.col("nth") % VALIDATION == 0).alias("validation"), F.explode("pieces").alias("text")
    )


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
    usable: Column | None = None, per_language: int = DOCS_PER_LANGUAGE,
) -> LanguageModel:
    """A model from the bounded sample: ``per_language`` documents of each label, three pieces each.

    At most ``per_language`` x 840 characters for each label reach the driver, however
    large the table is.  Rows with a null text or label, and those not ``usable``, are
    never learned from.  Without any row left, the model knows no language.
    """
    sample = training_sample(
        docs, id_col, text_col, label_col, F.lit(True) if usable is None else usable, per_language
    )
    rows = sorted(sample.toArrow().to_pylist(), key=lambda r: (r["label"], r["text"]))
    return train([r["text"] for r in rows], [r["label"] for r in rows], [r["validation"] for r in rows])


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """``also`` columns, then ``lang_pred``, ``score`` and ``rejected`` of every whole text.

    A null text, or one without a letter, is ``und`` with score 0 and rejected, as is all
    with a model that knows no language.  Other columns are neither read nor touched;
    one in ``also`` that has a result column's name is refused.
    """
    if clash := {"lang_pred", "score", "rejected"} & {c.lower() for c in also}:
        raise ValueError(f"columns named as results: {sorted(clash)}")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    picked = docs.select(*also, F.col(text_col).alias("_text"))
    names = [*also, "lang_pred", "score", "rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = [shared.value.predict(t.as_py()) for t in batch.column(len(also))]
            lang, score, rejected = zip(*results, strict=True) if results else ((), (), ())
            made = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(also)], *made], names)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return picked.mapInArrow(run, f"{kept + ', ' if kept else ''}lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows whose language is not rejected, with their own columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    position = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(
                pa.array([not shared.value.predict(t.as_py())[2] for t in batch.column(position)], pa.bool_())
            )

    return docs.mapInArrow(run, docs.schema)
