"""Near-duplicates by SimHash and covering locality-sensitive hashing.

A fingerprint has 64 bits.  For a radius r, every bit position gets a vector of r + 1
bits, never zero, and every non-zero vector v gives one table whose mask keeps the
positions with an odd scalar product with v.  Of two fingerprints that differ in at most
r positions, those positions' vectors span at most r dimensions, so some v is orthogonal
to all of them, and its mask keeps none of them: the pair collides in that table.  The
2^(r+1) - 1 structured masks thus find *every* pair, with no probability involved.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.common import cut, free_names, words

BITS = 64
SEED = 42
SHINGLE = 3
RADIUS = 3
# Fingerprints of one table's bucket that one task compares directly; larger buckets are
# divided by a second covering of the positions that the first mask leaves open.
BUCKET = 2_000
SMALL_RUN = 8
CHUNK = 1 << 16


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """One mask for each non-zero vector of ``radius + 1`` bits, over ``positions``."""
    vectors = (1 << (radius + 1)) - 1
    assigned = {p: 1 + i % vectors for i, p in enumerate(positions)}
    return [
        sum(1 << p for p, own in assigned.items() if (own & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def nested_masks(radius: int, bits: int = BITS) -> list[tuple[int, list[int]]]:
    """Each mask with the finer masks it divides into: itself and a covering of the rest."""
    result = []
    for mask in covering_masks(list(range(bits)), radius):
        rest = [p for p in range(bits) if not mask >> p & 1]
        result.append((mask, [mask | finer for finer in covering_masks(rest, radius)]))
    return result


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint: a bit is set if more than half of the shingles set it."""
    found = [w.lower() for w in words(text)]  # bytes.lower touches A-Z only
    if not found:
        return 0
    wide = max(1, len(found) - shingle + 1)
    grams = map(b" ".join, zip(*(found[i : i + wide] for i in range(shingle)), strict=True)) if (
        len(found) >= shingle
    ) else iter([b" ".join(found)])
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, wide)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, wide, CHUNK):
        part = hashes[start : start + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > wide, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, fp) per row; the text is read once and does not leave its task."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [_signed(fingerprint(t.as_py(), shingle)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "fp"]
            )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col)).mapInArrow(
        run, f"doc_id {kind}, fp long"
    )


def spanning_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what is connected by pairs within the radius; one per node at most.

    A breadth-first search over the values not reached yet, in memory linear in their
    number: no pair beyond the returned ones is kept.
    """
    left = values.view(np.uint64)
    links: list[tuple[int, int]] = []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            own = front.pop()
            near = np.bitwise_count(left ^ own) <= radius
            if near.any():
                found = left[near]
                links += zip(repeat(int(own)), found.tolist())
                front.extend(found)
                left = left[~near]
    return links


def _links(radius: int):
    """Links inside each bucket of a partition sorted by bucket; a bucket is never cut."""

    def solve(part: np.ndarray, value: np.ndarray) -> tuple[list[int], list[int]]:
        starts = np.flatnonzero(np.r_[True, np.any(part[1:] != part[:-1], axis=1)])
        sizes = np.diff(np.r_[starts, len(part)])
        from_, to = [], []
        for offset in range(1, SMALL_RUN):
            at = starts[(sizes > offset) & (sizes <= SMALL_RUN)]
            room = (sizes - offset)[(sizes > offset) & (sizes <= SMALL_RUN)]
            for k in range(SMALL_RUN - offset):
                i = at[room > k] + k
                near = np.bitwise_count((value[i] ^ value[i + offset]).view(np.uint64)) <= radius
                from_ += value[i[near]].tolist()
                to += value[i[near] + offset].tolist()
        for s, n in zip(starts[sizes > SMALL_RUN], sizes[sizes > SMALL_RUN], strict=True):
            for a, b in spanning_links(value[s : s + n].copy(), radius):
                from_.append(_signed(a))
                to.append(_signed(b))
        return from_, to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_part, held_value = np.empty((0, 2), np.int64), np.empty(0, np.int64)

        def out(part, value):
            a, b = solve(part, value)
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            part = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], 1)
            value = batch.column(2).to_numpy(zero_copy_only=False)
            part = np.concatenate([held_part, part.astype(np.int64)])
            value = np.concatenate([held_value, value])
            last = np.any(part != part[-1], axis=1).nonzero()[0]
            cut_at = last[-1] + 1 if len(last) else 0  # the last bucket may go on
            held_part, held_value = part[cut_at:], value[cut_at:]
            if cut_at:
                yield out(part[:cut_at], value[:cut_at])
        if len(held_part):
            yield out(held_part, held_value)

    return run


def _bucketed(nodes: DataFrame, radius: int, bucket: int) -> DataFrame:
    """(part, key, fp): every fingerprint in every table, large buckets divided further."""
    masks = nested_masks(radius)
    tables = F.array(
        *[F.struct(F.lit(i).alias("part"), F.lit(_signed(m)).alias("mask")) for i, (m, _) in enumerate(masks)]
    )
    keyed = nodes.select("fp", F.inline(tables)).select(
        "part", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"
    )
    full = cut(keyed.groupBy("part", "key").agg(F.count("*").alias("n")).filter(F.col("n") > bucket))
    if full.isEmpty():
        return keyed
    full = full.select("part", "key")
    finer = F.array(
        *[
            F.array(
                *[
                    F.struct(F.lit(len(masks) + i * len(own) + j).alias("finer"), F.lit(_signed(m)).alias("mask"))
                    for j, m in enumerate(own)
                ]
            )
            for i, (_, own) in enumerate(masks)
        ]
    )
    divided = keyed.join(full, ["part", "key"], "left_semi").select(
        "fp", F.inline(F.element_at(finer, F.col("part") + 1))
    )
    return keyed.join(full, ["part", "key"], "left_anti").unionByName(
        divided.select(
            F.col("finer").alias("part"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"
        )
    )


def links_within(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(a, b) over distinct fingerprints ``fp``: connects exactly what pairs within ``radius`` connect.

    A bucket of more than ``bucket`` fingerprints is divided by a second covering; what
    then shares a bucket differs in some 16 open positions only, so a task's bucket is
    bounded by the number of values these can take, whatever the input's size.
    """
    bucketed = _bucketed(nodes, radius, bucket)
    return (
        bucketed.repartition("part", "key")
        .sortWithinPartitions("part", "key", "fp")
        .select("part", "key", "fp")
        .mapInArrow(_links(radius), "a long, b long")
    )


def connect(links: DataFrame) -> DataFrame:
    """(node, root): every node of a link with the smallest node it is connected to.

    Alternates two steps until nothing changes: every node's larger neighbours, then its
    smaller ones, are linked to the smallest neighbour.  Each step is a group minimum and
    a join on the node, so a hub's links are spread by adaptive skew splitting.  The
    number of links never grows.
    """

    def state(df):
        return df.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).cast("string")
        ).first()

    a, b = F.col("a"), F.col("b")
    now = cut(
        links.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    )
    seen = state(now)
    while seen[0]:
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("low", "a").alias("low"))
        large = both.join(least, "a").filter(b > a).select(b.alias("a"), F.col("low").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").filter(b != F.col("low")).select(b.alias("a"), F.col("low").alias("b"))
        now = cut(small.unionByName(low.select("a", F.col("low").alias("b"))).distinct())
        before, seen = seen, state(now)
        if before == seen:
            break
    roots = now.select(a.alias("node"), b.alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    bucket: int = BUCKET,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    Words are maximal runs outside ``\\x20\\x09-\\x0D``, A-Z lower-cased; a text with fewer
    words than ``shingle`` has one shingle, its whole word sequence.  Rows whose
    fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is the
    smallest id reachable over links.

    A null, empty or blank text has no shingle and the fingerprint zero, linked like any
    other.  Repeated rows each get a row.  A null id takes part in linking but is never a
    ``component_id``; a component of null ids only has a null one.  Other columns are
    ignored, whatever they are called.  An empty table gives an empty result.
    """
    rows = cut(fingerprints(docs, id_col, text_col, shingle))
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    roots = connect(links_within(nodes.select("fp"), radius, bucket))
    members = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "doc_id", F.coalesce("root", "fp").alias("root")
    )
    lowest = members.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_print = members.join(lowest, "root").select("fp", "component_id")
    return rows.join(by_print, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
    bucket: int = BUCKET,
) -> DataFrame:
    """One row of each group of linked documents, with all its columns.

    A document is an id with a text: unlike texts under one id are judged by themselves.  The document
    with the smallest id stays, then with the smallest text hash; of its repeated rows the
    first by the remaining columns.  Rows without an id link others, cannot be named as
    copies and stay.
    """
    own, nth, of, at = free_names(docs, "_copy", "_nth", "_of", "_at")
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).isNull(), F.coalesce(F.col(text_col), F.lit(""))).alias("h"))
    named = docs.withColumn(own, F.when(F.col(id_col).isNotNull(), key))
    groups = simhash_groups(named, own, text_col, shingle, radius, bucket)
    stay = groups.filter(F.col("doc_id") == F.col("component_id")).select(
        F.col("doc_id.id").alias(of), F.col("doc_id.h").alias(at)
    )
    same_document = (F.col(f"{own}.id") == F.col(of)) & (F.col(f"{own}.h") == F.col(at))
    kept = named.filter(F.col(own).isNotNull()).join(stay, same_document, "left_semi")
    rest = [f.name for f in docs.schema if f.name not in (id_col, text_col) and not isinstance(f.dataType, T.MapType)]
    order = [F.col(f"`{c}`").asc_nulls_last() for c in rest] or [F.col(own)]
    ranked = kept.withColumn(nth, F.row_number().over(Window.partitionBy(own).orderBy(*order)))
    return ranked.filter(F.col(nth) == 1).drop(own, nth).unionByName(docs.filter(F.col(id_col).isNull()))
