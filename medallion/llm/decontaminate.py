"""Benchmark decontamination: a broadcast hash set of the test items' windows of words.

Words are runs of digits, lower-cased letters A-Z and characters beyond ASCII.  Each
benchmark item gives its windows of ``width`` consecutive words (an item with fewer words is
one window).  The windows' hashes are broadcast, every window of every document's words is
looked up, and a hit counts only if the words themselves are equal.

The broadcast is bounded: windows are measured first, and what exceeds ``block_bytes`` is
dealt into blocks that are scanned for one after another.  A block's hits are kept per
distinct text, so copies of a document do not multiply them.  Documents are never shuffled
if there is one block, and only joined by a hash of their text if there are several.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.common import arrow_schema, cut, free_names, map_rows, ship
from medallion.sources.scratch import Scratch

WIDTH = 10
# What one broadcast may hold, counted as below; a window also costs some bytes of index.
BLOCK_BYTES = 64 * 1024 * 1024
WINDOW_OVERHEAD = 32
# Texts are scanned in slices of so many bytes, a longer text by itself.
SLICE_BYTES = 1 << 20
HASH_BYTES = 1 << 22

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0x100000001B3)
INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))

SPAN = "struct<first:bigint,last:bigint,start:bigint,stop:bigint>"


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    inside = np.zeros(256, dtype=bool)
    inside[ord("0") : ord("9") + 1] = inside[ord("a") : ord("z") + 1] = inside[128:] = True
    return lower, inside


LOWER, INSIDE = _byte_tables()
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept up to the size of a usual block."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, HASH_BYTES), base, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= HASH_BYTES:
            _powers[int(base)] = known
    return known[:n]


class Words:
    """The words of several texts, as places in their joined bytes."""

    def __init__(self, texts: list[bytes]):
        self.joined = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
        inside = INSIDE[self.joined]
        turns = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        self.starts, self.stops = turns[0::2], turns[1::2]
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.text_starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.text_of = np.searchsorted(self.text_starts, self.starts, side="right") - 1
        self.counts = np.bincount(self.text_of, minlength=len(texts))

    def hashes(self) -> np.ndarray:
        """One hash a word, block by block so that a very long text needs little memory."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        first = 0
        while first < len(out):
            begin = int(self.starts[first])
            last = max(first + 1, int(np.searchsorted(self.stops, begin + HASH_BYTES, side="right")))
            block = self.joined[begin : int(self.stops[last - 1])].astype(np.uint64) + np.uint64(1)
            sums = np.zeros(len(block) + 1, dtype=np.uint64)
            np.cumsum(block * _powers_of(BASE, len(block)), out=sums[1:])
            at, to = self.starts[first:last] - begin, self.stops[first:last] - begin
            h = (sums[to] - sums[at]) * _powers_of(INVERSE, len(block))[at]
            h = (h ^ (h >> np.uint64(32))) * MULTIPLIER
            out[first:last] = h ^ (h >> np.uint64(29))
            first = last
        return out

    def windows(self, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of each window that lies in one text."""
        n = len(hashes) - width + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        whole = np.full(n, width, dtype=np.uint64)
        for i in range(width):
            whole = (whole + hashes[i : i + n]) * MULTIPLIER
        at = np.flatnonzero(self.text_of[:n] == self.text_of[width - 1 :])
        return at, whole[at]

    def window(self, first: int, width: int) -> bytes:
        return b" ".join(
            self.joined[a:b].tobytes()
            for a, b in zip(self.starts[first : first + width], self.stops[first : first + width], strict=True)
        )


class WindowSet:
    """Windows of one block: sorted hashes, the words to verify by, the items that have them."""

    def __init__(self, windows: list[bytes], items: list[list[str]]):
        widths = np.array([w.count(b" ") + 1 for w in windows], dtype=np.int64)
        hashes = np.empty(len(windows), dtype=np.uint64)
        for width in np.unique(widths):
            of_width = np.flatnonzero(widths == width)
            for at in np.array_split(of_width, -(-len(of_width) // 4096)):
                words = Words([windows[i] for i in at])
                hashes[at] = words.windows(words.hashes(), int(width))[1]
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.windows = [windows[i] for i in order]
        self.items = [items[i] for i in order]
        self.widths = [int(w) for w in np.unique(widths)]
        self.marks = None

    def find(self, words: Words) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, width, items) of every occurrence of a window."""
        if not len(self.hashes) or not len(words.starts):
            return
        if self.marks is None:
            self.marks = np.zeros(1 << 22, dtype=bool)
            self.marks[self.hashes >> np.uint64(42)] = True
        each = words.hashes()
        for width in self.widths:
            at, found = words.windows(each, width)
            maybe = self.marks[found >> np.uint64(42)]
            at, found = at[maybe], found[maybe]
            left = np.searchsorted(self.hashes, found, side="left")
            right = np.searchsorted(self.hashes, found, side="right")
            for i in np.flatnonzero(left < right):
                said = words.window(int(at[i]), width)
                for k in range(left[i], right[i]):
                    if self.windows[k] == said:
                        yield int(at[i]), width, self.items[k]

    def scan(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[dict]], list[list[str]]]:
        """For each text: its number of words, the spans of its hit words, the items hit."""
        words = Words(texts)
        spans: list[list[dict]] = [[] for _ in texts]
        items: list[set[str]] = [set() for _ in texts]
        cover = None
        for first, width, named in self.find(words):
            if cover is None:
                cover = np.zeros(len(words.starts) + 1, dtype=np.int64)
            cover[first] += 1
            cover[first + width] -= 1
            items[words.text_of[first]].update(named)
        if cover is not None:
            self._fill(spans, texts, words, np.cumsum(cover)[:-1] > 0)
        return words.counts, spans, [sorted(i) for i in items]

    @staticmethod
    def _fill(spans: list[list[dict]], texts: list[bytes], words: Words, hit: np.ndarray) -> None:
        # A run of hit words ends with its text, too.
        turn = np.diff(words.text_of, prepend=-1) != 0
        begins = np.flatnonzero(hit & (np.concatenate([[True], ~hit[:-1]]) | turn))
        ends = np.flatnonzero(hit & np.concatenate([~hit[1:] | turn[1:], [True]])) + 1
        first_word = np.concatenate([[0], np.cumsum(words.counts)])
        for t in np.unique(words.text_of[begins]):
            own = words.text_of[begins] == t
            a, b = begins[own], ends[own]
            raw = np.frombuffer(texts[t], dtype=np.uint8)
            points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points before a byte
            base, offset = int(first_word[t]), int(words.text_starts[t])
            start, stop = points[words.starts[a] - offset], points[words.stops[b - 1] - offset]
            spans[t] = [
                {"first": int(i) - base, "last": int(j) - base, "start": int(x), "stop": int(y)}
                for i, j, x, y in zip(a, b, start, stop, strict=True)
            ]


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(window, items): each distinct window of words and the sorted ids that have it.

    A null text or one without words gives none.  A window of an item without an id still
    marks documents, but is nobody's: its list lacks it.
    """

    def make(rows):
        for row in rows:
            words = Words([row["text"].encode("utf-8", "surrogatepass")])
            n = len(words.starts)
            for first in range(max(1, n - width + 1) if n else 0):
                yield words.window(first, min(width, n)), row["item"]

    ship(benchmark.sparkSession)
    named = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    each = map_rows(named.filter(F.col("text").isNotNull()), "window binary, item string", make)
    return each.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, width: int, block_bytes: int) -> Iterator[WindowSet]:
    """The window sets to broadcast, each measured to be within ``block_bytes``."""
    windows = cut(benchmark_windows(benchmark, id_col, text_col, width))
    names = F.aggregate("items", F.lit(0), lambda n, i: n + F.octet_length(i) + 8)
    weight = F.octet_length("window") + names + WINDOW_OVERHEAD
    total = windows.agg(F.sum(weight)).first()[0] or 0
    # Twice as many blocks as would just do, since a hash does not deal evenly.
    blocks = 1 if total <= block_bytes else -(-2 * total // block_bytes)
    for block in range(blocks):
        part = windows if blocks == 1 else windows.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block)
        table = part.toArrow()
        yield WindowSet(table["window"].to_pylist(), table["items"].to_pylist())


def _slices(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as bytes) in slices of bounded size; a null text is empty."""
    held, size, first = [], 0, 0
    for i, text in enumerate(column.cast(pa.large_binary())):
        raw = text.as_py() or b""
        if held and size + len(raw) > SLICE_BYTES:
            yield first, held
            held, size, first = [], 0, i
        held.append(raw)
        size += len(raw)
    if held:
        yield first, held


def _scan(docs: DataFrame, text_col: str, carry: list[str], names: list[str], found: WindowSet, only_hits: bool) -> DataFrame:
    """``carry`` of each document with the names' columns: words, spans, items."""
    kinds = ("bigint", f"array<{SPAN}>", "array<string>")
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in zip(names, kinds, strict=True))
    arrow = arrow_schema(docs.sparkSession, ddl)
    schema = T.StructType([*docs.select(*carry).schema, *T.StructType.fromDDL(ddl)])
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _slices(batch.column(text_col)):
                counts, where, which = shared.value.scan(texts)
                part = batch.slice(first, len(texts))
                made = [pa.array(v, f.type) for v, f in zip((counts, where, which), arrow, strict=True)]
                out = pa.RecordBatch.from_arrays(
                    [part.column(c) for c in carry] + made, names=[*carry, *names]
                )
                yield out.filter(pa.array([bool(w) for w in where])) if only_hits else out

    columns = list(dict.fromkeys([*carry, text_col]))
    return docs.select(*columns).mapInArrow(run, schema)


def _joined(spans: Column) -> Column:
    """Sorted, disjoint spans; those of several blocks may overlap."""
    empty = F.lit(None).cast(f"array<{SPAN}>")

    def add(made: Column, span: Column) -> Column:
        last = F.element_at(made, -1)
        longer = F.struct(
            last["first"].alias("first"), F.greatest(last["last"], span["last"]).alias("last"),
            last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"),
        )
        apart = (F.size(made) <= 0) | (span["first"] > last["last"])
        head = F.slice(made, 1, F.greatest(F.size(made) - 1, F.lit(0)))
        return F.when(made.isNull(), F.array(span)).when(apart, F.concat(made, F.array(span))).otherwise(
            F.concat(head, F.array(longer))
        )

    return F.coalesce(F.aggregate(F.sort_array(spans), empty, add), F.array().cast(f"array<{SPAN}>"))


def find_hits(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
    benchmark_text_col: str = "text", width: int = WIDTH, keep: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``keep`` (default all) columns of ``docs`` with ``n_words, n_hit, items, spans``.

    ``spans`` are the hit words' disjoint runs, as word numbers (``first`` to before ``last``) and
    code points (``start`` to before ``stop``); ``items`` the sorted ids of the items
    with a window in the document.  One row per row of ``docs``, repeated rows included; a null
    or empty text has no words.  An empty benchmark hits nothing.  Input columns that
    already have one of the four names are replaced.
    """
    ship(docs.sparkSession)
    keep = [c for c in (keep or docs.columns) if c.lower() not in ("n_words", "n_hit", "items", "spans")]
    names = free_names(docs, "_n_words", "_spans", "_items")
    n_words, spans, items = names
    first, rest = None, []
    key, own = free_names(docs, "_key", "_own")
    keyed = docs.withColumn(key, F.sha2(F.col(text_col), 256))
    scratch = None
    for number, block in enumerate(_blocks(benchmark, id_col, benchmark_text_col, width, block_bytes)):
        if number == 0:
            first = _scan(keyed, text_col, [*keep, key], names, block, only_hits=False)
            continue
        scratch = scratch or Scratch(docs.sparkSession, "windows")
        hits = _scan(keyed, text_col, [key], names, block, only_hits=True).dropDuplicates([key])
        rest.append(scratch.keep(hits, f"block{number}"))
    if rest:
        more = rest[0]
        for block in rest[1:]:
            more = more.unionByName(block)
        more = more.groupBy(F.col(key).alias(own)).agg(
            F.flatten(F.collect_list(spans)).alias(f"{spans}2"), F.flatten(F.collect_list(items)).alias(f"{items}2")
        )
        first = first.join(more, F.col(key) == F.col(own), "left")
        none = F.array().cast(f"array<{SPAN}>")
        first = first.withColumn(spans, _joined(F.concat(spans, F.coalesce(F.col(f"{spans}2"), none))))
        second = F.coalesce(F.col(f"{items}2"), F.array().cast("array<string>"))
        first = first.withColumn(items, F.sort_array(F.array_distinct(F.concat(items, second))))
    hit = F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"])
    return first.select(
        *keep, F.col(n_words).alias("n_words"), hit.alias("n_hit"), F.col(items).alias("items"), F.col(spans).alias("spans")
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, min_hit: int = 1, **options) -> DataFrame:
    """The documents with fewer than ``min_hit`` hit words; those without text stay."""
    hits = find_hits(docs.select(F.struct(*docs.columns).alias("row"), F.col(options.get("text_col", "text")).alias("text")),
                     benchmark, **{**options, "text_col": "text"}, keep=["row"])
    return hits.filter(F.col("n_hit") < min_hit).select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """All documents, their hit words and what stands between those of one run cut out.

    What stands before and behind a run stays, blanks included.  A null text stays null.
    """
    text_col = options.get("text_col", "text")
    row, text = F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text")
    hits = find_hits(docs.select(row, text), benchmark, **{**options, "text_col": "text"}, keep=["row", "text"])

    def without(text: str, spans: list[dict]) -> str:
        left, at = [], 0
        for span in spans:
            left.append(text[at : span["start"]])
            at = span["stop"]
        return "".join([*left, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("text"), batch.column("spans"), strict=True)
            texts = [without(t.as_py(), s.as_py()) if len(s) else t.as_py() for t, s in pairs]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    schema = hits.select("row", "text").schema
    changed = hits.select("row", "text", "spans").mapInArrow(run, schema)
    return changed.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per document.

    Rows as in ``find_hits``; the digest is that of the empty string where nothing is hit.
    """
    return find_hits(docs, benchmark, keep=["doc_id"], **options).select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# The same over the tables ``documents`` and ``benchmark``, for DuckDB.
ORACLE = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), windows AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 10) AS width,
    array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS said
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 9, 1))) AS i FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), CAST([] AS VARCHAR[])) AS w FROM documents
), widths AS (
  SELECT DISTINCT width FROM windows
), places AS (
  SELECT r, width, i, array_to_string(w[i + 1 : i + width], ' ') AS said
  FROM (SELECT r, w, width, unnest(range(0, len(w) - width + 1)) AS i
        FROM doc_words, widths WHERE len(w) >= width)
), hits AS (
  SELECT p.r, p.i, p.width, v.item FROM places p JOIN windows v ON p.width = v.width AND p.said = v.said
), hit_words AS (
  SELECT r, count(DISTINCT i) AS n_hit FROM (SELECT r, unnest(range(i, i + width)) AS i FROM hits) GROUP BY r
), hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
  coalesce(t.n_items, 0) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words h ON d.r = h.r LEFT JOIN hit_items t ON d.r = t.r
"""
