"""Best-fit packing of documents into sequences of a fixed number of tokens.

Hierarchical residual packing: every task packs the pieces it holds by best fit,
largest first, and emits the bins that are nearly full.  The underfull bins go on as items
of the next round, dealt anew to far fewer tasks and packed by best fit again, until one
task holds what is left or a round no longer saves bins.  A task packs a bounded number
of items at a time, so memory does not depend on the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm import tokens
from medallion.llm.common import arrow_schema, to_batch
from medallion.sources.scratch import Scratch

CAPACITY = 1024
END = 2
NEARLY_FULL = 4  # a bin with so few tokens of room or less is emitted
ITEMS = 200_000  # packed together in one task
SAVING = 0.01  # a round that saves a smaller share of its bins is the last
LAYER_BITS = 4


def pieces_of(ids: list[int], capacity: int) -> Iterator[tuple[int, int, int]]:
    """(piece, start, length): whole if it fits, else a first remainder and full pieces."""
    first = len(ids) % capacity or min(capacity, len(ids))
    start, length = 0, first
    for piece in count():
        if start >= len(ids):
            return
        yield piece, start, length
        start, length = start + length, capacity


def tokenize(
    docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end: int, capacity: int, keep_ids: bool
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): whole texts, cut only if too long."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if keep_ids else ""
    arrow = arrow_schema(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokenizer).ids
        for batch in batches:
            made, held = [], 0
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = [*encode(text.as_py() or ""), end]
                raw = np.array(ids, "<u4")
                for piece, start, length in pieces_of(ids, capacity):
                    own = raw[start : start + length]
                    row = (doc.as_py(), piece, start, length, zlib.crc32(own.tobytes()))
                    made.append((*row, own.astype(np.int32)) if keep_ids else row)
                held += len(ids) if keep_ids else 0
                if len(made) >= 10_000 or held >= 4_000_000:
                    yield to_batch(made, arrow)
                    made, held = [], 0
            if made:
                yield to_batch(made, arrow)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col)).mapInArrow(run, schema)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the fill of each bin: best fit, largest first.

    ``room`` has a bit for every amount of room that some open bin has, so the tightest
    bin that an item fits is its lowest bit from the item's size on.
    """
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    fill: list[int] = []
    room = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = room >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            own = by_room[free].pop()
            if not by_room[free]:
                room &= ~(1 << free)
        else:
            free, own = capacity, len(fill)
            fill.append(0)
        bins[item], offsets[item] = own, fill[own]
        fill[own] += size
        left = free - size
        if left:
            by_room[left].append(own)
            room |= 1 << left
    return bins, offsets, np.array(fill, np.int64)


def _round(items: DataFrame, size_col: str, layer: int, capacity: int, nearly_full: int, chunk: int) -> DataFrame:
    """``items`` with ``bin``, ``at`` (offset in it), ``open_fill`` (set on one row of each underfull bin)."""
    position = items.columns.index(size_col)
    names = [*items.columns, "bin", "at", "open_fill"]

    def solve(table: pa.Table, first: int) -> tuple[pa.RecordBatch, int]:
        sizes = table.column(position).to_numpy()
        bins, at, fill = best_fit(sizes, capacity)
        underfull = (fill < capacity - nearly_full)[bins] & (at == 0)
        part = TaskContext.get().partitionId()
        made = [
            pa.array(((part << 32) + first + bins) << LAYER_BITS | layer),
            pa.array(at),
            pa.array(fill[bins], mask=~underfull),
        ]
        columns = [c.combine_chunks() for c in table.columns]
        return pa.RecordBatch.from_arrays([*columns, *made], names), first + len(fill)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        first = rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= chunk:
                made, first = solve(pa.Table.from_batches(held), first)
                yield made
                held, rows = [], 0
        if rows:
            yield solve(pa.Table.from_batches(held), first)[0]

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    return items.mapInArrow(run, f"{kept}, bin long, at long, open_fill long")


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end: int = END,
    capacity: int = CAPACITY,
    keep_ids: bool = True,
    nearly_full: int = NEARLY_FULL,
    items: int = ITEMS,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]``.

    A document is its ids and the ``end`` id.  Only one longer than ``capacity`` is cut,
    into full pieces after a first one that holds the rest.  A full piece is a sequence by
    itself; the others are packed.  Pieces of a sequence lie side by side from offset 0.

    A null text counts as empty: just the end id.  Repeated rows, repeated and null ids
    each get their own pieces.  An empty table gives an empty result.  Columns other than
    the two named are ignored, whatever they are called.

    The result reads from the session's scratch folder.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    made = tokenize(docs, id_col, text_col, tokenizer or tokens.path(), end, capacity, keep_ids)
    stored = scratch.keep(made.withColumn("key", F.monotonically_increasing_id()), "pieces")
    slim = stored.drop("ids")
    partial = slim.filter(F.col("length") < capacity)
    placed = scratch.keep(_round(partial, "length", 0, capacity, nearly_full, items), "round0")
    placed = placed.withColumn("sequence", F.col("bin")).withColumn("offset", F.col("at"))
    left = placed.filter("open_fill is not null").select(F.col("bin").alias("item"), F.col("open_fill").alias("size"))
    before = left.count()
    for layer in range(1, 1 << LAYER_BITS):
        if before < 2:
            break
        groups = -(-before // items)
        moved = scratch.keep(
            _round(left.repartition(groups, F.xxhash64("item", F.lit(layer))), "size", layer, capacity, nearly_full, items),
            f"round{layer}",
        )
        link = moved.select(F.col("item"), F.col("bin").alias("next"), F.col("at").alias("shift"))
        placed = placed.join(link, placed["sequence"] == link["item"], "left").select(
            *slim.columns,
            F.coalesce("next", "sequence").alias("sequence"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        )
        left = moved.filter("open_fill is not null").select(F.col("bin").alias("item"), F.col("open_fill").alias("size"))
        bins = moved.agg(F.count_distinct("bin")).first()[0]
        saved, before = before - bins, left.count()
        if groups == 1 or saved < SAVING * (saved + bins):
            break
    columns = ["key", "doc_id", "piece", "start", "length", "ids_crc32"]
    full = slim.filter(F.col("length") == capacity).select(
        *columns, F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    packed = placed.select(*columns, (-1 - F.col("sequence")).alias("sequence_id"), "offset").unionByName(full)
    if keep_ids:
        packed = packed.join(stored.select("key", "ids"), "key")
    return packed.drop("key")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed ids of each sequence, at most one capacity long."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.flatten(F.col("parts.ids"))
    return joined.select("sequence_id", F.size(ids).alias("n_tokens"), ids.alias("ids"))
