"""Document fingerprints: a Merkle tree over sections, paragraphs and short runs of words.

A text is cut, without losing a character, into sections, these into paragraphs (lines),
these into runs of two words that end with a sentence at the latest.  The leaves are digests of the pieces,
every inner node is the digest of its children's, so two texts are equal exactly if their
roots are, and an edit changes only the branches above it.  Where a paragraph ends a
section depends on its own content, so an edit does not move the sections behind it.

The fingerprint as text is ``root:leaves``: the root's 32 hex digits, then the leaves' digests
cut to eight digits, ``/`` between sections, ``,`` between paragraphs.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import map_rows

LINE = re.compile(r"[^\n]*\n|[^\n]+")
# Up to two words, or pieces of eight characters of longer ones, with the white space behind
# them are a leaf; it ends with a sentence, too.  Possessive, so that no text takes more than linear time.
LEAF = re.compile(r"\s*+(?:\S{1,8}+(?<![.!?])\s*+)?+\S{0,8}+\s*+")
DIGEST = 16
SHOWN = 8
PRINTED = re.compile(rf"[0-9a-f]{{{SHOWN}}}")
SECTION_EVERY = 8  # on average so many paragraphs without a blank line are a section


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=DIGEST).digest()


@dataclass
class Node:
    digest: bytes
    start: int
    end: int
    children: list[Node]


def _inner(children: list[Node]) -> Node:
    return Node(_digest(b"".join(c.digest for c in children)), children[0].start, children[-1].end, children)


def _leaves(line: str) -> tuple[list[str], list[bytes]]:
    """The pieces of a line and their digests."""
    pieces = LEAF.findall(line)
    pieces.pop()  # the empty match at the end
    return pieces, [hashlib.blake2b(b"\0" + p.encode("utf-8", "surrogatepass"), digest_size=DIGEST).digest() for p in pieces]


def _ends_section(line: str, digest: bytes) -> bool:
    return line.isspace() or digest[0] % SECTION_EVERY == 0


def _paragraph(line: str, start: int) -> Node:
    leaves, at = [], start
    for piece, digest in zip(*_leaves(line), strict=True):
        leaves.append(Node(digest, at, at + len(piece), []))
        at += len(piece)
    return _inner(leaves)


def tree(text: str | None) -> Node:
    """The root; a null or empty text has no children."""
    sections, paragraphs, at = [], [], 0
    for match in LINE.finditer(text or ""):
        line = match.group()
        node = _paragraph(line, at)
        at = node.end
        paragraphs.append(node)
        if _ends_section(line, node.digest):
            sections.append(_inner(paragraphs))
            paragraphs = []
    if paragraphs:
        sections.append(_inner(paragraphs))
    return _inner(sections) if sections else Node(_digest(b""), 0, 0, [])


def fingerprint(text: str | None) -> str:
    """The same tree's digests, without its nodes."""
    sections, shown, digests, paragraphs = [], [], [], []
    lines = LINE.findall(text or "")
    for nth, line in enumerate(lines):
        leaves = _leaves(line)[1]
        digest = _digest(b"".join(leaves))
        digests.append(digest)
        paragraphs.append(b"".join([leaf[: SHOWN // 2] for leaf in leaves]).hex())
        if _ends_section(line, digest) or nth == len(lines) - 1:
            sections.append(_digest(b"".join(digests)))
            shown.append(",".join(paragraphs))
            digests, paragraphs = [], []
    return f"{_digest(b''.join(sections)).hex()}:{'/'.join(shown)}"


def likeness(left: str, right: str) -> float:
    """1 for equal roots; else the share of leaves in common (Dice, counted, root included).

    Sections, then paragraphs, that occur on both sides are settled as a whole; only the
    leaves of branches that differ are compared.
    """
    (root_a, _, a), (root_b, _, b) = left.partition(":"), right.partition(":")
    if root_a == root_b:
        return 1.0
    leaves = lambda part: (len(part) - part.count(",") - part.count("/")) // SHOWN
    total, common = leaves(a) + leaves(b) + 2, 0
    for mark in ("/", ","):
        own, other = Counter(filter(None, re.split(f"[{mark}/]", a))), Counter(filter(None, re.split(f"[{mark}/]", b)))
        both = own & other
        common += sum(leaves(part) * n for part, n in both.items())
        a, b = mark.join((own - both).elements()), mark.join((other - both).elements())
    own, other = Counter(PRINTED.findall(a)), Counter(PRINTED.findall(b))
    common += sum([min(n, other[piece]) for piece, n in own.items() if piece in other])
    return 2 * common / total


def edits(left: str | None, right: str | None) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Code point spans of each text that have no equal in the other, found branch by branch."""

    def differing(a: list[Node], b: list[Node]) -> tuple[list[Node], list[Node]]:
        same_start = next((i for i, (x, y) in enumerate(zip(a, b)) if x.digest != y.digest), min(len(a), len(b)))
        a, b = a[same_start:], b[same_start:]
        same_end = next((i for i, (x, y) in enumerate(zip(a[::-1], b[::-1])) if x.digest != y.digest), min(len(a), len(b)))
        a, b = a[: len(a) - same_end], b[: len(b) - same_end]
        common = Counter(n.digest for n in a) & Counter(n.digest for n in b)

        def rest(nodes):
            left_over, out = common.copy(), []
            for node in nodes:
                if left_over[node.digest]:
                    left_over[node.digest] -= 1
                else:
                    out.append(node)
            return out

        return rest(a), rest(b)

    a, b = differing([tree(left)], [tree(right)])
    for _ in range(3):
        a, b = differing([c for n in a for c in n.children], [c for n in b for c in n.children])

    def spans(nodes):
        out: list[tuple[int, int]] = []
        for node in sorted(nodes, key=lambda n: n.start):
            if out and out[-1][1] == node.start:
                out[-1] = (out[-1][0], node.end)
            else:
                out.append((node.start, node.end))
        return out

    return spans(a), spans(b)


def locate_edits(df: DataFrame, left_col: str, right_col: str, also: list[str]) -> DataFrame:
    """``also`` columns, then ``left_spans`` and ``right_spans`` as (start, end), end excluded."""
    spans = "array<struct<start: long, end: long>>"
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*also).schema)

    def make(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            found = edits(row["_left"], row["_right"])
            yield *(row[c] for c in also), *([{"start": s, "end": e} for s, e in own] for own in found)

    picked = df.select(*also, F.col(left_col).alias("_left"), F.col(right_col).alias("_right"))
    return map_rows(picked, f"{kept}, left_spans {spans}, right_spans {spans}", make)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every whole text; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(map(fingerprint, texts), pa.string())],
                ["doc_id", "n_chars", "fingerprint"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col))
    return picked.mapInArrow(run, f"doc_id {kind}, n_chars long, fingerprint string")


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(bucket, donor, doc_id, text), sorted so that every row's successor lies in its task.

    The order is descending id, null ids last, equal ids by text.  Ids are cut into as many
    ranges as the session has shuffle partitions, a few numbers on the driver.  The first
    row of a range goes, as ``donor``, to the end of the range before as well, the very
    first one to the end of the last.  The texts are shuffled once.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_col].dataType.simpleString()
    ids = docs.select(F.col(id_col).alias("doc_id"))
    probabilities = [i / buckets for i in range(1, buckets)]
    found = ids.stat.approxQuantile("doc_id", probabilities, 0.2 / buckets) if buckets > 1 else []
    cuts = sorted({int(c) for c in found})

    def bucket_of(doc: int | None) -> int:
        return len(cuts) - bisect_right(cuts, doc) if doc is not None else len(cuts)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([bucket_of(d) for d in batch.column(0).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([made, batch.column(0)], ["bucket", "doc_id"])

    numbered = ids.mapInArrow(number, f"bucket int, doc_id {kind}")
    firsts = sorted((r[0], r[1]) for r in numbered.groupBy("bucket").agg(F.max("doc_id")).collect())
    before = {doc: firsts[i - 1][0] for i, (_, doc) in enumerate(firsts)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "donor", "doc_id", "text"]
        for batch in batches:
            docs_ = batch.column(0).to_pylist()
            own = pa.array([bucket_of(d) for d in docs_], pa.int32())
            yield pa.RecordBatch.from_arrays([own, pa.array([False] * len(docs_), pa.bool_()), *batch.columns], names)
            lent = [i for i, d in enumerate(docs_) if d in before]
            if lent:
                to = pa.array([before[docs_[i]] for i in lent], pa.int32())
                rows = batch.take(pa.array(lent, pa.int64()))
                yield pa.RecordBatch.from_arrays([to, pa.array([True] * len(lent), pa.bool_()), *rows.columns], names)

    dealt = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(
        deal, f"bucket int, donor boolean, doc_id {kind}, text string"
    )
    order = ["bucket", "donor", F.col("doc_id").desc_nulls_last(), "text"]
    return dealt.repartitionById(len(cuts) + 1, F.col("bucket")).sortWithinPartitions(*order)


def edited(text: str, next_text: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + next_text[:half]


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and its edited text, and what they tell.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``.  The edit takes its new half from the next document in descending id
    (after the last: the first; a single document is its own next).

    A null text counts as empty.  Null ids come last; rows of one id follow each other by
    text, so a repeated row's next is its twin.  Other columns are ignored.  An empty
    table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def make(rows: Iterator[dict]) -> Iterator[tuple]:
        held = None
        for row in rows:
            own = fingerprint(row["text"])
            if held is not None and held[0]["bucket"] == row["bucket"] and not held[0]["donor"]:
                text, print_ = held[0]["text"], held[1]
                changed = edited(text, row["text"])
                changed_print = fingerprint(changed)
                yield (
                    held[0]["doc_id"], len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                    print_, changed_print, likeness(print_, changed_print), likeness(print_, own),
                )
            held = (row, own)

    schema = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double"
    )
    return map_rows(with_next(docs, id_col, text_col), schema, make)
