"""Phrase collocations, counted by vertical partitioning of a depth-truncated suffix tree.

Every word occurrence starts a suffix, truncated at ``depth`` words or at the end of its piece.
The suffixes of a language form a tree whose leaves are the distinct truncated suffixes.  The
tree is never built as a whole:

1. Texts are read once; each task merges its suffixes to leaves with counts ("fragments").
2. Prefixes of one word are counted in classes by hash.  A class that exceeds the memory
   budget is split by prefixes of two words, and those that still exceed it by three.
   Classes within the budget are put together into groups that fill it.
3. Each group's leaves are shuffled to one task, which builds the group's subtrees by itself
   and reads every node's count from the totals of its leaves.

A node above a split prefix gets its count from several groups, which are added up.  The
routing tables have a fixed size, so what is broadcast does not depend on the input.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import arrow_schema, cut, ship
from medallion.sources.scratch import Scratch

DEPTH = 3
MIN_COUNT = 10
TOP = 2000
COVERED = 50  # per cent of a candidate's occurrences
SCALE = 1_000_000
# Leaf rows that a group may hold, and classes a prefix level is counted in (powers of two).
GROUP_LEAVES = 1 << 20
CLASSES, MOST_CLASSES = 1 << 16, 1 << 22
# Words a task merges to leaves at a time.
TASK_WORDS = 1 << 17
SALTS = 64
# Few but large rows: without these, a task would hold a hundred of them before it writes one.
FILES = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1", "parquet.block.size": str(32 << 20)}

BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
MIX = np.uint64(0x9E3779B97F4A7C15)

FRAGMENT = "lang string, n_words long, words binary, n_leaves int, leaves binary, counts binary"


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the largest one needs."""
    most = int(numbers.max()) if numbers.size else 0
    return numbers.astype(f"<u{next(n for n in (1, 2, 4, 8) if most < 1 << 8 * n)}").tobytes()


def _unpacked(raw: pa.Scalar, n: int) -> np.ndarray:
    return np.frombuffer(raw.as_buffer(), f"<u{len(raw.as_buffer()) // n}") if n else np.empty(0, np.uint8)


class _Language:
    """Words of one language since the last fragment, numbered from 1; 0 ends a piece."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {b".": 0}
        self.read: list[int] = []
        self.n = 0

    def add(self, text: bytes) -> None:
        # A full stop stands for any break: it cannot be in a word.
        found = BREAK.sub(b" . ", text.translate(LOWER)).split()
        numbers = self.numbers
        before = len(self.read)
        self.read += [numbers.setdefault(w, len(numbers)) for w in found]
        self.read.append(0)
        self.n += len(found) - self.read[before:].count(0) + 1

    def fragment(self, lang: str, depth: int) -> tuple:
        at = np.array(self.read, dtype=np.int64)
        at = np.concatenate([at, np.zeros(depth, dtype=np.int64)])
        starts = np.flatnonzero(at)
        leaves = np.zeros((len(starts), depth), dtype=np.uint32)
        inside = np.ones(len(starts), dtype=bool)
        for d in range(depth):
            word = at[starts + d]
            inside &= word != 0
            leaves[:, d] = np.where(inside, word, 0)
        leaves, counts = _merged(leaves, np.ones(len(leaves), dtype=np.int64))
        words = b"\n".join(list(self.numbers)[1:])
        return lang, self.n, words, len(leaves), _packed(leaves), _packed(counts)


def _merged(leaves: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct leaves with the sums of their counts."""
    if not len(leaves):
        return leaves, counts
    if int(leaves.max()) < 1 << 21 and leaves.shape[1] <= 3:
        packed = np.zeros(len(leaves), dtype=np.uint64)
        for column in leaves.T:
            packed = (packed << np.uint64(21)) | column.astype(np.uint64)
        order = np.argsort(packed)
        changed = np.diff(packed[order], prepend=packed[order[:1]] ^ np.uint64(1)) != 0
    else:
        order = np.lexsort(leaves.T[::-1])
        changed = np.concatenate([[True], (np.diff(leaves[order].astype(np.int64), axis=0) != 0).any(axis=1)])
    firsts = np.flatnonzero(changed)
    return leaves[order[firsts]], np.add.reduceat(counts[order], firsts)


def fragments(docs: DataFrame, text_col: str, lang_col: str, depth: int) -> DataFrame:
    """(lang, n_words, words, n_leaves, leaves, counts): truncated suffixes, merged piece by piece of a task.

    ``words`` are joined by line feeds; ``leaves`` are rows of ``depth`` word numbers, 0 behind
    the end of a piece.  A null text has no words, a null language is ``und``.
    """
    arrow = arrow_schema(docs.sparkSession, FRAGMENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Language] = {}

        def out(lang: str):
            row = held.pop(lang).fragment(lang, depth)
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, arrow, strict=True)], schema=arrow)

        for batch in batches:
            for text, lang in zip(batch.column("text").cast(pa.large_binary()), batch.column("lang"), strict=True):
                own = held.setdefault(lang.as_py(), _Language())
                own.add(text.as_py())
                if sum(len(x.read) for x in held.values()) >= TASK_WORDS:
                    yield out(max(held, key=lambda k: len(held[k].read)))
        for lang in list(held):
            yield out(lang)

    text = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    return text.filter(F.col("text").isNotNull()).mapInArrow(run, FRAGMENT)


def _rows(batch: pa.RecordBatch, depth: int, counted: bool = True) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray | None]]:
    """(lang, words, leaves, counts) of the fragments of a batch, one at a time."""
    lang, words, n_leaves, leaves = (batch.column(c) for c in ("lang", "words", "n_leaves", "leaves"))
    counts = batch.column("counts") if counted else None
    for i in range(batch.num_rows):
        said, n = words[i].as_py(), n_leaves[i].as_py()
        made = _unpacked(leaves[i], n * depth).reshape(-1, depth)
        yield lang[i].as_py(), said.split(b"\n") if said else [], made, _unpacked(counts[i], n) if counted else None


def _classes(lang: str, words: list[bytes], leaves: np.ndarray, classes: int) -> Iterator[np.ndarray]:
    """For each depth, the class of every leaf's prefix of so many words."""
    seed = xxhash.xxh64_intdigest(lang.encode())
    hashes = np.array([0, *(xxhash.xxh64_intdigest(w, seed) for w in words)], dtype=np.uint64)
    whole = np.full(len(leaves), seed, dtype=np.uint64)
    for column in leaves.T:
        whole = (whole ^ hashes[column]) * MIX
        whole ^= whole >> np.uint64(29)
        yield (whole >> np.uint64(20)).astype(np.int64) & (classes - 1)


class Routes:
    """The group of every prefix class; a class that is split has none at its own depth."""

    def __init__(self, classes: int):
        self.classes = classes
        self.tables: list[np.ndarray] = []

    def of(self, lang: str, words: list[bytes], leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """(group, prefix length, class at the next depth) of every leaf; group -1 where all known depths split it."""
        group, length = np.full(len(leaves), -1, dtype=np.int64), np.zeros(len(leaves), dtype=np.int64)
        for depth, own in enumerate(_classes(lang, words, leaves, self.classes)):
            if depth == len(self.tables):
                return group, length, own
            open_ = group < 0
            group[open_] = self.tables[depth][own[open_]]
            length[open_] = depth + 1
        return group, length, None

    def add(self, rows: np.ndarray, budget: int, first: int, last: bool) -> int:
        """Put the classes of the next depth into groups, the largest into the emptiest.

        A class above the budget is split unless this is the ``last`` depth.  Returns the number of
        groups so far.
        """
        table = np.full(self.classes, -1, dtype=np.int64)
        fits = (rows > 0) & ((rows <= budget) | last)
        n = -(-int(rows[fits].sum()) // budget)
        groups = [(0, first + i) for i in range(n)]
        for own in sorted(np.flatnonzero(fits).tolist(), key=lambda c: -rows[c]):
            held, group = groups[0]
            if held and held + int(rows[own]) > budget:
                held, group = 0, first + len(groups)
                heapq.heappush(groups, (0, group))
            table[own] = group
            heapq.heapreplace(groups, (held + int(rows[own]), group))
        self.tables.append(table)
        return first + len(groups)


def _class_rows(stored: DataFrame, routes: Routes, depth: int) -> np.ndarray:
    """Leaf rows in every prefix class of the next depth, of leaves that have no group yet."""
    classes = routes.classes
    shared = stored.sparkSession.sparkContext.broadcast(routes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes, dtype=np.int64)
        for batch in batches:
            for lang, words, leaves, _ in _rows(batch, depth, counted=False):
                group, _, own = shared.value.of(lang, words, leaves)
                total += np.bincount(own[group < 0], minlength=classes)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["class", "n"])

    counted = stored.select("lang", "words", "n_leaves", "leaves").mapInArrow(run, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).toArrow()
    rows = np.zeros(classes, dtype=np.int64)
    rows[counted["class"].to_numpy()] = counted["n"].to_numpy()
    return rows


def _routed(stored: DataFrame, routes: Routes, depth: int) -> DataFrame:
    """Each fragment's leaves as one row per group, with the words they need and the group's prefix length."""
    schema = "`group` long, lang string, length int, words binary, n_leaves int, leaves binary, counts binary"
    arrow = arrow_schema(stored.sparkSession, schema)
    shared = stored.sparkSession.sparkContext.broadcast(routes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words, leaves, counts in _rows(batch, depth):
                group, length, _ = shared.value.of(lang, words, leaves)
                order = np.argsort(group, kind="stable")
                made = []
                for at in np.split(order, np.flatnonzero(np.diff(group[order])) + 1) if len(order) else ():
                    used, own = np.unique(leaves[at], return_inverse=True)
                    if used[0]:
                        used, own = np.concatenate([[0], used]), own + 1
                    said = b"\n".join([words[i - 1] for i in used[1:]])
                    made.append((int(group[at[0]]), lang, int(length[at[0]]), said, len(at), _packed(own), _packed(counts[at])))
                for first in range(0, len(made), 64):
                    columns = zip(*made[first : first + 64], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return stored.mapInArrow(run, schema)


def _subtrees(routed: DataFrame, depth: int, min_count: int) -> DataFrame:
    """(lang, size, phrase, n) of the nodes of each group's subtrees.

    A node at or below its group's prefix has all its occurrences here and is left out if it
    has too few; what is above is only a part, to be added up.
    """
    schema = "lang string, size int, phrase binary, n long"
    arrow = arrow_schema(routed.sparkSession, schema)

    def build(table: pa.Table) -> pa.Table:
        by_lang: dict[str, list] = {}
        length = 0  # the same for all leaves of a group
        numbers: dict[str, dict[bytes, int]] = {}
        for batch in table.to_batches():
            lengths = batch.column("length")
            for i, (lang, words, leaves, counts) in enumerate(_rows(batch, depth)):
                own = numbers.setdefault(lang, {b".": 0})
                new = np.array([0, *(own.setdefault(w, len(own)) for w in words)], dtype=np.uint32)
                by_lang.setdefault(lang, []).append((new[leaves], counts.astype(np.int64)))
                length = lengths[i].as_py()
        out = []
        for lang, parts in by_lang.items():
            words = list(numbers[lang])
            own, totals = _merged(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            for size in range(1, depth + 1):
                there = own[:, size - 1] != 0
                prefix, n = own[there, :size], totals[there]
                if not len(n):
                    continue
                firsts = np.flatnonzero(np.concatenate([[True], (prefix[1:] != prefix[:-1]).any(axis=1)]))
                n, prefix = np.add.reduceat(n, firsts), prefix[firsts]
                if size >= length:
                    prefix, n = prefix[n >= min_count], n[n >= min_count]
                phrases = [b" ".join([words[i] for i in row]) for row in prefix.tolist()]
                columns = [pa.array([lang] * len(n)), pa.array([size] * len(n), pa.int32()), pa.array(phrases, pa.binary()), pa.array(n)]
                out.append(pa.Table.from_arrays(columns, schema=arrow))
        return pa.concat_tables(out) if out else arrow.empty_table()

    return routed.groupBy("group").applyInArrow(build, schema)


def phrase_counts(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", depth: int = DEPTH, min_count: int = MIN_COUNT,
    group_leaves: int = GROUP_LEAVES, classes: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(``lang, size, phrase, n`` of phrases of up to ``depth`` words, ``lang, n`` of all words).

    Phrases that occur less than ``min_count`` times are left out.  ``group_leaves`` is the
    memory budget: leaf rows a task holds to build its subtrees.  It is exceeded by a single class of
    full-depth prefixes only (a row a fragment and distinct leaf), and grows
    beyond 10^12 leaf rows, so that the routing tables keep at most ``MOST_CLASSES`` entries.
    """
    spark = ship(docs.sparkSession)
    target = Scratch(spark, "phrases").location("fragments")
    made = fragments(docs, text_col, lang_col, depth)
    made.write.options(compression="zstd", **FILES).parquet(target)
    stored = spark.read.schema(made.schema).parquet(target)
    total = stored.agg(F.sum("n_leaves")).first()[0] or 0
    budget = min(group_leaves, -(-total // int(spark.conf.get("spark.sql.shuffle.partitions"))))
    budget = max(1, budget, 4 * total // MOST_CLASSES)
    classes = classes or min(MOST_CLASSES, max(CLASSES, 1 << (4 * total // budget).bit_length()))
    routes, groups, leaves = Routes(classes), 0, stored.drop("n_words")
    for level in range(1, depth + 1):
        rows = _class_rows(leaves, routes, depth)
        groups = routes.add(rows, budget, groups, last=level == depth)
        if not (routes.tables[-1][rows > 0] < 0).any():
            break
    nodes = _subtrees(_routed(leaves, routes, depth), depth, min_count)
    summed = nodes.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    totals = stored.groupBy("lang").agg(F.sum("n_words").alias("n"))
    text = F.col("phrase").cast("string").alias("phrase")
    return cut(summed.select("lang", "size", text, "n")), cut(totals)


def _first_by(rows: DataFrame, key: str, order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each key with their ``rank``; a hot key is ranked in parts first."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for parts in ([key, "_salt"], [key]):
        window = Window.partitionBy(*parts).orderBy(*order)
        salted = salted.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= most)
    return salted.drop("_salt")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, top: int = TOP,
    covered: int = COVERED, **options,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of two and three words.

    A phrase's score is that of its weakest cut into two parts.  A phrase inside a longer one
    that has ``covered`` per cent of its occurrences is left out.  A null text counts as empty, a
    null language is ``und``; repeated rows count each; an empty table has no phrases.
    """
    counts, totals = phrase_counts(docs, text_col, lang_col, min_count=min_count, **options)
    join = lambda first, n: F.array_join(F.slice("words", first, n), " ")
    long = counts.filter("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = long.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", F.col("n").alias("a"), "k",
        join(F.lit(1), F.col("k")).alias("head"), join(F.col("k") + 1, F.col("size")).alias("tail"),
    )
    part = lambda name, n: counts.select(
        F.col("lang").alias(f"{name}_lang"), F.col("phrase").alias(f"{name}_phrase"), F.col("n").alias(n)
    )
    for name, n in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(part(name, n), (F.col("lang") == F.col(f"{name}_lang")) & (F.col(name) == F.col(f"{name}_phrase")))
    square = "CAST(CAST({0} AS DECIMAL(19,0)) * CAST({1} AS DECIMAL(19,0)) AS DECIMAL(38,0))"
    score = F.expr(f"CAST({square.format('a', 'a')} * {SCALE}BD AS DECIMAL(38,0)) div {square.format('l', 'r')}")
    scored = cuts.withColumn("score", score)
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    shorter = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: join(i, n)),
        )
    )
    inside = (
        long.filter("size > 2").select(F.col("lang").alias("_lang"), "n", F.explode(F.array_distinct(shorter)).alias("_phrase"))
        .groupBy("_lang", "_phrase").agg(F.max("n").alias("longer"))
    )
    mostly = F.col("longer").isNotNull() & (F.lit(100) * F.col("longer") >= F.lit(covered) * F.col("a"))
    kept = weakest.join(
        inside, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")), "left"
    ).filter(~mostly)
    rows = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    best = _first_by(rows, "lang", [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


# The same over the table ``documents``, for DuckDB.
ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), phrases AS (
  SELECT lang, size, array_to_string(w[i + 1 : i + size], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(0, len(w) - size + 1)) AS i FROM words, (VALUES (1), (2), (3)) s(size)
        WHERE len(w) >= size)
), counts AS (
  SELECT lang, size, phrase, count(*) AS a FROM phrases GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND a >= 10
), cuts AS (
  SELECT lang, size, phrase, a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 : size], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, x.a AS l, y.a AS r,
    CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON c.lang = x.lang AND c.head = x.phrase JOIN counts y ON c.lang = y.lang AND c.tail = y.phrase
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, short, max(a) AS a FROM (
    SELECT lang, a, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS short
    FROM candidates WHERE size = 3) GROUP BY lang, short
), kept AS (
  SELECT s.* FROM weakest s LEFT JOIN longer g ON s.lang = g.lang AND s.phrase = g.short
  WHERE g.a IS NULL OR 100 * g.a < 50 * s.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN totals t ON r.lang = t.lang WHERE r.rank <= 2000
"""
