"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Exact-text deduplication carries the work: documents are shuffled by their full text, each
distinct text is tokenised and aligned once, and its pair counts weigh as much as it has
copies.  Measures are made per distinct text and joined to the documents by a hash of the text.

Tokens are kept as packed ids, so that counting pairs and scoring by the counts read
them instead of tokenising again.  The pair counts are broadcast to the scoring step in
blocks of a fixed number of pairs; a pair's share of a text's measures is a sum, so blocks add up.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm import tokens
from medallion.llm.common import arrow_schema, ship
from medallion.sources.scratch import Scratch

BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Texts are tokenised and aligned in slices of so many bytes, a longer text by itself.
SLICE_BYTES = 1 << 20
SLICE_TOKENS = 1 << 18
# Distinct pairs a task counts before it passes them on, and pairs in one broadcast (16 bytes each).
TASK_PAIRS = 1 << 21
BLOCK_PAIRS = 1 << 22
COUNT_LINKS = 1 << 22


class Side:
    """One tokenizer: ids of texts, and the bytes each id stands for."""

    def __init__(self, encode, pieces: list[bytes]):
        self.encode, self.pieces = encode, pieces
        self.lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        self.packed = np.dtype("<u2" if len(pieces) <= 1 << 16 else "<u4")


@cache
def byte_side(file: str) -> Side:
    """Space and text by a byte-level vocabulary file."""
    encoder = tokens.encoder(file, plain=True)
    with open(file, encoding="utf-8") as source:
        spec = json.load(source)
    byte_of, vocab = tokens.byte_of(), dict(spec["model"]["vocab"])
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    pieces = [b""] * (max([*vocab.values(), *added.values()]) + 1)
    for token, i in vocab.items():
        pieces[i] = token.encode() if token in added else bytes(byte_of[c] for c in token)
    for token, i in added.items():
        pieces[i] = token.encode()
    return Side(lambda texts: [encoder.ids(f" {t}") for t in texts], pieces)


@cache
def piece_side(file: str) -> Side:
    """Text by a sentence-piece model, which adds the space itself."""
    model = sentencepiece.SentencePieceProcessor(model_file=file)

    def piece(i: int) -> bytes:
        said = model.id_to_piece(i)
        return bytes([int(said[3:5], 16)]) if model.is_byte(i) else said.replace("▁", " ").encode()

    return Side(
        lambda texts: model.encode(texts, num_threads=1), [piece(i) for i in range(model.get_piece_size())]
    )


class Aligned:
    """The tokens of several texts, whose bytes are equal text by text, laid side by side."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], left: Side, right: Side):
        self.a, self.b = np.concatenate(a).astype(np.int64), np.concatenate(b).astype(np.int64)
        ends_a, ends_b = np.cumsum(left.lengths[self.a]), np.cumsum(right.lengths[self.b])
        self.text_a, self.text_b = (np.cumsum([len(x) for x in side]) for side in (a, b))
        size = int(ends_a[-1])
        end_a, end_b = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        end_a[ends_a - 1] = end_b[ends_b - 1] = True
        self.last_a, self.last_b = end_b[ends_a - 1], end_a[ends_b - 1]  # ends a group
        # What two tokens share has no end inside, so each end is that of one link.
        ends = np.flatnonzero(end_a | end_b)
        in_a, in_b = end_a[ends], end_b[ends]
        self.link_a, self.link_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        self.text_links = np.searchsorted(ends, ends_a[self.text_a - 1] - 1)

    def codes(self, n_right: int) -> np.ndarray:
        """A number for the id pair of each link."""
        return self.a[self.link_a].astype(np.uint64) * np.uint64(n_right) + self.b[self.link_b].astype(np.uint64)

    def per_text(self, ends: np.ndarray) -> np.ndarray:
        return np.diff(ends, prepend=0)

    def groups(self) -> np.ndarray:
        """Number of groups of each text."""
        return self.per_text(np.cumsum(self.last_a)[self.text_a - 1])

    def written(self, left: int, right: int) -> Iterator[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        ends_a, ends_b = np.flatnonzero(self.last_a) + 1, np.flatnonzero(self.last_b) + 1
        group_a, group_b = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        order = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        at_a = np.arange(len(self.a)) + np.concatenate([[0], ends_b])[group_a]
        at_b = np.arange(len(self.b)) + ends_a[group_b]
        order[at_a] = self.a + left * self.last_a.astype(np.int64)
        order[at_b] = 2 * left + self.b + right * self.last_b.astype(np.int64)
        said = _numerals(left, right)[order]
        first = 0
        for last in self.text_a + self.text_b:
            yield said[first:last].tobytes().translate(None, b"\0")[:-1]
            first = last


@cache
def _numerals(left: int, right: int) -> np.ndarray:
    """Every id in decimal with what follows it: inside and at the end of a group's half."""
    return np.array(
        [f"{i}{end}".encode() for n, ends in ((left, ",|"), (right, ",;")) for end in ends for i in range(n)]
    )


def _slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose sizes add up to at most ``most``, or a single row."""
    first, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and held + size > most:
            yield first, i
            first, held = i, 0
        held += size
    if len(sizes):
        yield first, len(sizes)


def tokenize_pairs(texts: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """(key, copies, n_a, n_b, n_groups, n_links, groups_sha256, a, b) of each row (key, copies, text).

    A row whose tokens' bytes by either tokenizer are not space and text is left out.
    """
    schema = "key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a binary, b binary"
    arrow = arrow_schema(texts.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = byte_side(file_a), piece_side(file_b)

        def whole(side: Side, ids: list[int], raw: bytes) -> bool:
            return b"".join(map(side.pieces.__getitem__, ids)) == raw

        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            for first, last in _slices(sizes, SLICE_BYTES):
                part = batch.slice(first, last - first)
                said = part.column("text").to_pylist()
                ids_a, ids_b = left.encode(said), right.encode(said)
                good = [
                    i
                    for i, (text, x, y) in enumerate(zip(said, ids_a, ids_b, strict=True))
                    if whole(left, x, raw := f" {text}".encode()) and whole(right, y, raw)
                ]
                if not good:
                    continue
                a = [np.array(ids_a[i], left.packed) for i in good]
                b = [np.array(ids_b[i], right.packed) for i in good]
                made = Aligned(a, b, left, right)
                kept = part.take(pa.array(good))
                digests = [hashlib.sha256(x).hexdigest() for x in made.written(len(left.pieces), len(right.pieces))]
                columns = [
                    kept.column("key"), kept.column("copies"), made.per_text(made.text_a), made.per_text(made.text_b),
                    made.groups(), made.per_text(made.text_links + 1), digests,
                    [x.tobytes() for x in a], [x.tobytes() for x in b],
                ]
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=arrow.names)

    return texts.select("key", "copies", "text").mapInArrow(run, schema)


def _aligned(batch: pa.RecordBatch, left: Side, right: Side) -> Iterator[tuple[int, int, Aligned]]:
    """Stored tokens, laid side by side again: (first row, last row, alignment)."""
    a = [np.frombuffer(x.as_py(), left.packed) for x in batch.column("a")]
    b = [np.frombuffer(x.as_py(), right.packed) for x in batch.column("b")]
    for first, last in _slices(np.array([len(x) for x in a]), SLICE_TOKENS):
        yield first, last, Aligned(a[first:last], b[first:last], left, right)


def _summed(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    firsts = np.flatnonzero(np.diff(codes, prepend=codes[:1] ^ np.uint64(1)))
    return codes[firsts], np.add.reduceat(weights[order], firsts) if len(firsts) else weights[:0]


def _counted(pairs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """(a_id, b_id, n) of the links of all copies, summed by task."""
    arrow = arrow_schema(pairs.sparkSession, "a_id int, b_id int, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = byte_side(file_a), piece_side(file_b)
        width = np.uint64(len(right.pieces))
        total = np.empty(0, np.uint64), np.empty(0, np.int64)
        single: list[np.ndarray] = []  # pairs of texts with one copy need no weights

        def merge(total, more):
            return _summed(*(np.concatenate(x) for x in zip(total, more, strict=True)))

        def settle(total):
            if not single:
                return total
            codes, n = np.unique(np.concatenate(single), return_counts=True)
            single.clear()
            return merge(total, (codes, n.astype(np.int64)))

        def out(total):
            for at in range(0, len(total[0]), 1 << 16):
                codes, n = (x[at : at + (1 << 16)] for x in total)
                columns = ((codes // width).astype(np.int32), (codes % width).astype(np.int32), n)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=arrow)

        for batch in batches:
            copies = batch.column("copies").to_numpy()
            for first, last, made in _aligned(batch, left, right):
                codes, weights = made.codes(len(right.pieces)), copies[first:last]
                if (weights == 1).all():
                    single.append(codes)
                else:
                    each = np.repeat(weights, made.per_text(made.text_links + 1))
                    total = merge(total, _summed(codes, each))
                if sum(map(len, single)) >= COUNT_LINKS:
                    total = settle(total)
                if len(total[0]) >= TASK_PAIRS:
                    yield from out(total)
                    total = np.empty(0, np.uint64), np.empty(0, np.int64)
        yield from out(settle(total))

    made = pairs.select("copies", "a", "b").mapInArrow(run, "a_id int, b_id int, n long")
    return made.groupBy("a_id", "b_id").agg(F.sum("n").alias("n"))


def _scored(pairs: DataFrame, counts: pa.Table, file_a: str, file_b: str) -> DataFrame:
    """The stored texts with ``n_best`` and ``count_sum`` over the pairs in ``counts``."""
    carry = [f for f in pairs.schema if f.name not in ("a", "b", "copies")]
    added = T.StructType.fromDDL("n_best long, count_sum long")
    columns = [counts[c].to_numpy() for c in ("a_id", "b_id", "n", "best")]
    shared = pairs.sparkSession.sparkContext.broadcast(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = byte_side(file_a), piece_side(file_b)
        a_id, b_id, n, best = shared.value
        codes = a_id.astype(np.uint64) * np.uint64(len(right.pieces)) + b_id.astype(np.uint64)
        order = np.argsort(codes)
        # One entry more: pairs of another block find nothing there.
        codes = np.concatenate([codes[order], [np.uint64(2**64 - 1)]])
        n, best = np.concatenate([n[order], [0]]), np.concatenate([best[order].astype(np.int64), [0]])
        for batch in batches:
            sums: list[np.ndarray] = []
            for _, _, made in _aligned(batch, left, right):
                own = made.codes(len(right.pieces))
                at = np.searchsorted(codes, own)
                at[codes[at] != own] = len(codes) - 1
                firsts = np.concatenate([[0], made.text_links[:-1] + 1])
                sums.append(np.array([np.add.reduceat(x[at], firsts) for x in (best, n)]))
            if sums:
                both = np.concatenate(sums, axis=1)
                kept = [batch.column(f.name) for f in carry]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(both[0]), pa.array(both[1])], names=[*(f.name for f in carry), *added.names]
                )

    columns = [f.name for f in carry]
    return pairs.select(*columns, "a", "b").mapInArrow(run, T.StructType([*carry, *added]))


def _key(text_col: str):
    return F.unhex(F.sha2(F.col(text_col), 256))


class Alignment:
    """Two tokenizers over one set of documents: pair counts, and measures per document.

    Texts that are null or empty, or whose tokens' bytes by either tokenizer are not a space and the
    text, have no tokens.  Rows that repeat a text count as often as they occur.
    """

    def __init__(
        self, docs: DataFrame, text_col: str = "text", file_a: str | None = None, file_b: str | None = None,
        block_pairs: int = BLOCK_PAIRS,
    ):
        ship(docs.sparkSession)
        self.docs, self.text_col, self.block_pairs = docs, text_col, block_pairs
        self.files = file_a or tokens.path(BYTE_FILE), file_b or tokens.path(PIECE_FILE)
        self.scratch = Scratch(docs.sparkSession, "alignment")
        text = F.col(text_col)
        distinct = docs.filter(text.isNotNull() & (text != "")).groupBy(text.alias("text")).agg(F.count("*").alias("copies"))
        self.pairs = self.scratch.keep(tokenize_pairs(distinct.withColumn("key", _key("text")), *self.files), "tokens")
        counted = self.scratch.keep(_counted(self.pairs, *self.files), "counted")
        highest = counted.groupBy("b_id").agg(F.max("n").alias("_highest"))
        ranked = counted.join(highest, "b_id").select("a_id", "b_id", "n", (F.col("n") == F.col("_highest")).alias("best"))
        self.counts = self.scratch.keep(ranked, "counts")

    def pair_counts(self) -> DataFrame:
        """``a_id, b_id, n, best``: links of each id pair; best if no other pair of ``b_id`` has more."""
        return self.counts

    def measures(self, id_col: str = "doc_id") -> DataFrame:
        """One row per document: ``id_col`` and the measures of its text."""
        blocks = max(1, -(-self.counts.count() // self.block_pairs))
        block = F.pmod(F.xxhash64("a_id", "b_id"), F.lit(blocks))
        scores = None
        for number in range(blocks):
            table = (self.counts if blocks == 1 else self.counts.filter(block == number)).toArrow()
            part = _scored(self.pairs, table, *self.files)
            scores = part if scores is None else scores.unionByName(part)
        numbers = ("n_a", "n_b", "n_groups", "n_links")
        if blocks > 1:
            scores = scores.groupBy("key").agg(
                *[F.max(c).alias(c) for c in (*numbers, "groups_sha256")],
                *[F.sum(c).alias(c) for c in ("n_best", "count_sum")],
            )
        own = self.docs.select(F.col(id_col).alias("_id"), _key(self.text_col).alias("_own"))
        joined = own.join(scores, F.col("_own") == F.col("key"), "left")
        return joined.select(
            F.col("_id").alias(id_col),
            *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (*numbers, "n_best", "count_sum")],
            F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
        )


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Each row's tokens by both tokenizers, aligned and scored by corpus-wide pair counts.

    Repeated rows get equal rows; a null id stays; texts without tokens have zeros and an
    empty ``groups_sha256``.  An empty table gives none.
    """
    return Alignment(docs, text_col, **options).measures(id_col)
