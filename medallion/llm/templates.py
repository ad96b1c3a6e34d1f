"""Line dedup by a log-template tree, in DataFrame operations only.

A line falls into a leaf of a tree of fixed depth: by its number of tokens, then by its
leading tokens.  A node with many children also has a wildcard child, for lines whose own
path few documents take.  Tokens with a digit are variable fields from the start.  Inside a
leaf, a token that few documents have at its position is a variable field too: absolutely few,
or few beside those that have the line's constant part, so that a field's values stay
variable however often they come in a larger input.  What is left is the line's template.  A
template that is constant enough and occurs in enough documents recurs, and so does a line
that several documents have word for word.  All documents but the first lose such lines.

Everything is counted in documents: a document with many lines of one kind counts once.  Only
distinct lines of leaves with different lines are taken apart, into hashes of their tokens;
lines that differ in their digits only are different, too.
A document with one such line in a leaf counts through its line; only documents with
several are followed one by one.  Templates depend on counts, never on the order of lines.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import cut, free_names, same
from medallion.sources.scratch import Scratch

FIELD = "<*>"
BLANKS = r"[\x20\x09-\x0D]+"
UNEVEN = ("  ", "\t", "\x0b", "\x0c", "\r")
BLANK_CHARS = " \t\n\x0b\x0c\r"
# From the start of a token on, so that every character is looked at a few times at most.
VARIABLE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
DEPTH = 3
# Documents that a template needs, and a line that is the same word for word.
MIN_DOCS, MIN_EQUAL = 3, 2
MIN_CONSTANT = 0.6
# A token is constant from this share of the documents that have the line's constant part.
MIN_SHARE = 0.5
# A node with so many children has a wildcard child.
MANY_CHILDREN = 3
# Keys are marked by a bit in one of this many words (a power of two), which bounds what is broadcast.
MARKS = 1 << 20

DOC = ["doc_id", "h"]


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col).isNull(), F.coalesce(F.col(text_col), F.lit("")))


def _place() -> Column:
    """Documents in order: by id, null last, then by text hash."""
    return F.struct(F.col("doc_id").isNull().alias("null"), *[F.col(c) for c in DOC])


def _once(df: DataFrame, kept: Sequence[str], *made: Column) -> DataFrame:
    """Columns out of a generator, so that no filter, join or lambda above repeats the expressions."""
    return df.select(*kept, F.inline(F.array(F.struct(*made))))


def _spaced_lines(docs: DataFrame, text_col: str, *kept: Column) -> DataFrame:
    """(``kept``, pos, raw) of every line with a token; ``raw`` is the line with single blanks."""
    whole = docs.select(*kept, F.col(text_col).alias("text"))  # what is kept is made once a document
    names = [c for c in whole.columns if c != "text"]
    lines = whole.select(*names, F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    text = F.col("text")
    uneven = reduce(Column.__or__, [text.contains(blank) for blank in UNEVEN])
    trimmed = lines.withColumn("text", F.btrim("text", F.lit(BLANK_CHARS))).filter(text != "")
    spaced = F.when(uneven, F.regexp_replace("text", BLANKS, " ")).otherwise(text)
    return _once(trimmed, [*names, "pos"], spaced.alias("raw"))


def _masked() -> Column:
    """A line with its variable tokens replaced."""
    return F.when(F.col("raw").rlike("[0-9]"), F.regexp_replace("raw", VARIABLE, FIELD)).otherwise(F.col("raw"))


def masked_lines(docs: DataFrame, text_col: str) -> DataFrame:
    """(mask, text) of every line with a token, as in ``parsed_lines``, and nothing else of it."""
    made = _once(_spaced_lines(docs, text_col), [], _masked().alias("text"))
    return _once(made, ["text"], F.xxhash64("text").alias("mask")).select("mask", "text")


def parsed_lines(docs: DataFrame, id_col: str, text_col: str, depth: int) -> DataFrame:
    """(doc_id, h, pos, line, mask, path, wild, text) of every line with a token.

    ``line`` and ``mask`` are hashes of the line with single blanks, and of that with variable tokens
    replaced, which is ``text``; ``path`` is that of its size and leading tokens, ``wild`` those with one
    leading token left open (null where that is variable anyhow).
    """
    raw = _spaced_lines(docs, text_col, F.col(id_col).alias("doc_id"), _text_hash(text_col).alias("h"))
    made = _once(raw, [*DOC, "pos"], F.xxhash64("raw").alias("line"), _masked().alias("text"))
    size = F.octet_length("text") - F.octet_length(F.replace("text", F.lit(" "), F.lit(""))) + 1
    split = _once(
        made, [*DOC, "pos", "line", "text"], size.alias("size"), F.split(F.substring_index("text", " ", depth), " ").alias("lead")
    )

    def open_at(j: int) -> Column:
        others = [F.get("lead", F.lit(i)) for i in range(depth) if i != j]
        token = F.get("lead", F.lit(j))
        return F.when(token.isNotNull() & (token != FIELD), F.xxhash64("size", F.lit(j), *others))

    return split.select(
        *DOC, "pos", "line", F.xxhash64("text").alias("mask"), F.xxhash64("size", F.array_join("lead", " ")).alias("path"),
        F.array(*[open_at(j) for j in range(depth)]).alias("wild"), "text",
    )


def _marked(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key is among ``wanted`` keys, and few others.

    The keys are marked by 64 bits in each of a fixed number of words, so the broadcast is bounded;
    what a neighbour's mark lets through is harmless, as an exact join or count follows.
    """
    word = F.col(key).bitwiseAND(F.lit(MARKS - 1)).cast("int")
    place = F.shiftrightunsigned(F.col(key), 58).cast("int")  # the word is told by the other end of the hash
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    words = wanted.select(word.alias("_mark"), bit.alias("_bit")).groupBy("_mark").agg(F.bit_or("_bit").alias("_bits"))
    marks = F.broadcast(cut(words.coalesce(8)))
    return df.withColumn("_mark", word).join(marks, "_mark").filter(F.col("_bits").bitwiseAND(bit) != 0).drop("_mark", "_bits")


def _paths(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(path, wild, n): the documents that take each path.

    A path of one line has one document; only the lines of other paths move with their documents.
    """
    lines = scratch.keep(rows.groupBy("path", "wild").agg(F.count("*").alias("n")), "paths")
    more = lines.filter(F.col("n") > 1).drop("n")
    docs = _marked(rows.select("path", *DOC), "path", more).distinct().groupBy("path").agg(F.count("*").alias("n"))
    return lines.filter(F.col("n") == 1).unionByName(cut(more.join(docs, "path")))


def _open_paths(paths: DataFrame, min_docs: int) -> DataFrame:
    """(path, leaf, open): the wildcard node of each path that too few documents take.

    Of several nodes with many children the one that most documents reach, counted by child; then the first.
    """
    children = paths.select("path", "n", F.posexplode("wild").alias("open", "leaf")).filter(F.col("leaf").isNotNull())
    nodes = children.groupBy("leaf").agg(F.count("*").alias("children"), F.sum("n").alias("docs"))
    many = cut(nodes.filter(F.col("children") >= MANY_CHILDREN))
    best = F.max_by(F.struct("leaf", "open"), F.struct("docs", -F.col("open")))
    few = _marked(children.filter(F.col("n") < min_docs), "leaf", many)
    found = few.join(many, "leaf").groupBy("path").agg(best.alias("best"))
    return found.select("path", "best.leaf", "best.open")


def _candidates(rows: DataFrame, min_docs: int, min_equal: int, scratch: Scratch) -> DataFrame:
    """(doc_id, h, mask, leaf, open, of_leaf): lines of leaves that may have templates.

    These are leaves of enough documents, but for those that hold one line word for word: this
    recurs by itself where ``min_equal`` documents are enough.
    """
    paths = _paths(rows, scratch)
    opened = cut(_open_paths(paths, min_docs))
    # A line and its mask are the same text unless a token was replaced.
    few = rows.select(*DOC, "mask", "path", (F.col("line") != F.col("mask")).alias("varied"))
    apart = _marked(few, "path", opened).join(opened, "path").select(*DOC, "mask", "leaf", "open", "varied")
    # A path that too few documents take has no template of its own.
    taken = _marked(few, "path", paths.filter(F.col("n") >= min_docs))
    whole = taken.select(*DOC, "mask", F.col("path").alias("leaf"), F.lit(-1).alias("open"), "varied")
    both = scratch.keep(whole.unionByName(apart).distinct(), "placed")
    span = [F.min("mask").alias("lo"), F.max("mask").alias("hi"), F.max("varied").alias("varied")]
    leaves = both.groupBy("leaf", *DOC).agg(*span).groupBy("leaf").agg(
        F.count("*").alias("of_leaf"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("varied").alias("varied")
    )
    different = (F.col("lo") != F.col("hi")) | F.col("varied") | F.lit(min_equal > min_docs)
    useful = cut(leaves.filter((F.col("of_leaf") >= min_docs) & different).select("leaf", "of_leaf"))
    return scratch.keep(_marked(both.drop("varied"), "leaf", useful).join(useful, "leaf"), "candidates")


def _by_document(candidates: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(leaf, mask, n, first) over documents with one line in the leaf; (leaf, mask, doc_id, h) of the others."""
    per = candidates.groupBy("leaf", *DOC).agg(F.min("mask").alias("lo"), F.max("mask").alias("hi"))
    per = scratch.keep(per, "documents")
    single = per.filter(F.col("lo") == F.col("hi")).groupBy("leaf", F.col("lo").alias("mask")).agg(
        F.count("*").alias("n"), F.min(_place()).alias("first")
    )
    several = per.filter(F.col("lo") != F.col("hi")).select(
        F.col("leaf").alias("_leaf"), F.col("doc_id").alias("_doc"), F.col("h").alias("_h")
    )
    own = (F.col("leaf") == F.col("_leaf")) & same(F.col("doc_id"), F.col("_doc")) & (F.col("h") == F.col("_h"))
    return cut(single), cut(candidates.join(several, own, "left_semi").select("leaf", "mask", *DOC))


def _templates(texts: DataFrame, single: DataFrame, several: DataFrame, depth: int, min_docs: int, min_constant: float) -> DataFrame:
    """(leaf, mask, template): each distinct line's template, if it is constant enough.

    A line's tokens are judged against its own frequent part: of so many of them as must be
    constant, the least frequent one gives the number of documents a share is taken of.
    All lines that agree in their tokens of ``min_docs`` documents have the same number, so
    the share only ever joins templates.  A token at its position in a leaf is one hash, and so is a line.
    ``texts`` may bring the ``n`` of ``single``; they are joined otherwise.
    """
    line = ["leaf", "mask"]
    texts = texts if "n" in texts.columns else texts.join(single.select(*line, "n"), line, "left")
    fixed = lambda t: t != FIELD
    tokens = F.split("text", " ")
    leading = F.size(F.filter(F.slice(tokens, 1, depth), fixed)) - F.when(F.col("open") >= 0, 1).otherwise(0)
    later = F.transform(F.slice(tokens, depth + 1, F.size(tokens)), lambda t: F.when(fixed(t), F.xxhash64(t)))
    id_ = F.xxhash64(*line).alias("id")
    heads = texts.select(*line, id_, "of_leaf", F.size(tokens).alias("size"), leading.alias("leading"))
    hashed = cut(texts.select(*line, "n", later.alias("later")))

    def explode(df: DataFrame, *kept: str | Column) -> DataFrame:
        fields = df.select("*", F.posexplode("later").alias("i", "field")).filter(F.col("field").isNotNull())
        return fields.select(*kept, F.xxhash64("leaf", "i", "field").alias("key"))

    # Only lines of documents with several are joined before they are taken apart; tokens are shuffled to be counted.
    once = explode(hashed.filter(F.col("n").isNotNull()), "n").groupBy("key").agg(F.sum("n").alias("n"))
    shared = _marked(hashed.drop("n"), "mask", several).join(several, line)
    followed = explode(shared, *DOC).distinct().groupBy("key").agg(F.count("*").alias("n"))
    counts = cut(once.unionByName(followed).groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs))
    parts = _marked(explode(hashed, id_), "key", counts).join(counts, "key").groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("key", "n"))).alias("parts")
    )
    none = F.array().cast("array<struct<key:bigint,n:bigint>>")
    whole = heads.join(parts, "id", "left").withColumn("parts", F.coalesce("parts", none))
    enough = whole.filter(F.size("parts") + F.col("leading") >= min_constant * F.col("size"))
    needed = F.ceil(min_constant * F.col("size")).cast("int") - F.col("leading")
    ranked = F.sort_array(F.transform("parts", lambda p: p["n"]), asc=False)
    least = F.when(needed > 0, F.get(ranked, needed - 1)).otherwise(F.col("of_leaf"))
    constant = F.filter("parts", lambda p: p["n"] >= MIN_SHARE * F.col("least"))
    return _once(enough, [*line, "parts"], least.alias("least")).select(
        *line, F.xxhash64(F.transform(constant, lambda p: p["key"])).alias("template")
    )


def _recurring_templates(candidates: DataFrame, single: DataFrame, several: DataFrame, templates: DataFrame, min_docs: int) -> DataFrame:
    """(mask, first): lines whose template enough documents have, and the first of these."""
    line, template = ["leaf", "mask"], ["leaf", "template"]
    once = single.join(templates, line).groupBy(*template).agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    followed = several.join(templates, line).select(*template, *DOC).distinct().groupBy(*template).agg(
        F.count("*").alias("n"), F.min(_place()).alias("first")
    )
    both = once.unionByName(followed).groupBy(*template).agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    return templates.join(both.filter(F.col("n") >= min_docs), template).select("mask", "first")


def recurring_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    depth: int = DEPTH, min_docs: int = MIN_DOCS, min_constant: float = MIN_CONSTANT, min_equal: int = MIN_EQUAL,
) -> DataFrame:
    """(doc_id, h, dropped): numbers of the lines each document loses; h is its text's hash."""
    scratch = Scratch(docs.sparkSession, "templates")
    parsed = parsed_lines(docs, id_col, text_col, depth)
    rows = scratch.keep(parsed.drop("text"), "rows")
    candidates = _candidates(rows, min_docs, min_equal, scratch)
    single, several = _by_document(candidates, scratch)
    # One of a line's documents tells its text; only documents that tell one are taken apart again.
    leaves = cut(candidates.groupBy("leaf", "mask", "open", "of_leaf").agg(F.min(F.xxhash64(*DOC)).alias("teller")))
    counted = leaves.drop("teller").join(single.select("leaf", "mask", "n"), ["leaf", "mask"], "left")
    keyed = docs.select(F.xxhash64(F.col(id_col), _text_hash(text_col)).alias("teller"), F.col(text_col).alias("text"))
    tellers = _marked(keyed, "teller", leaves)
    said = _marked(masked_lines(tellers, "text"), "mask", leaves).groupBy("mask").agg(F.min("text").alias("text"))
    texts = scratch.keep(counted.join(said, "mask"), "texts")
    templates = cut(_templates(texts, single, several, depth, min_docs, min_constant))
    by_template = cut(_recurring_templates(candidates, single, several, templates, min_docs))
    # A line that is there fewer times is in fewer documents.
    often = rows.groupBy("line").agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_equal)
    by_line = cut(
        _marked(rows.select("line", *DOC), "line", often).distinct()
        .groupBy("line").agg(F.count("*").alias("_n"), F.min(_place()).alias("_first"))
        .filter(F.col("_n") >= min_equal).drop("_n")
    )
    placed = rows.select(*DOC, "pos", "line", "mask")
    one, other = _marked(placed, "mask", by_template), _marked(placed, "line", by_line)
    kept = (*DOC, "pos")
    by_mask = one.join(by_template, "mask").select(*kept, "first", F.lit(None).cast("long").alias("line"))
    equal = other.join(by_line, "line").select(*kept, F.col("_first").alias("first"), "line")
    # A document's line is in both at most, in a few rows together; a template decides before equality.
    found = by_mask.unionByName(equal).groupBy(*kept).agg(F.min(F.struct(F.col("line").isNotNull().alias("late"), "first")).alias("best"))
    found = found.withColumn("first", F.col("best.first"))
    return found.filter(_place() != F.col("first")).groupBy(*DOC).agg(F.collect_set("pos").alias("dropped"))


def drop_recurring_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None,
    dropped_col: str | None = None,
    depth: int = DEPTH, min_docs: int = MIN_DOCS, min_constant: float = MIN_CONSTANT, min_equal: int = MIN_EQUAL,
) -> DataFrame:
    """All rows and columns of ``docs`` with the recurring lines taken out of the text.

    A line is what stands between two ``\\n``; blank lines are never dropped.  A template
    recurs if at least ``min_docs`` documents have it and at least ``min_constant`` of its
    tokens are constant, a line (but for its blanks) if at least ``min_equal`` documents have
    it.  The document with the smallest id (null last, then by text hash) keeps its lines.  A
    document is an id with a text: repeated rows are one document and are treated alike,
    null ids with different texts are different documents.  A null text stays null; one whose
    lines all go becomes empty.  ``length_col`` gets the new number of code points,
    ``dropped_col`` the number of lines taken out; it replaces a column of that name.
    """
    own, id_, h, dropped, lines = free_names(docs, "_own", "_id", "_h", "_dropped", "_lines")
    lost = recurring_lines(docs, id_col, text_col, depth, min_docs, min_constant, min_equal).select(
        F.col("doc_id").alias(id_), F.col("h").alias(h), F.col("dropped").alias(dropped)
    )
    # Both sides grow with the documents, so neither is broadcast, whatever its size.
    joined = docs.withColumn(own, _text_hash(text_col)).join(
        lost.hint("merge"), same(F.col(id_col), F.col(id_)) & (F.col(own) == F.col(h)), "left"
    )
    # The lines are split once a document, not once for each line that stays.
    joined = _once(joined, ["*"], F.when(F.col(dropped).isNotNull(), F.split(F.col(text_col), "\n")).alias(lines))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(dropped))
    text = F.when(
        F.col(dropped).isNotNull(),
        F.array_join(F.transform(left, lambda i: F.element_at(F.col(lines), i + 1)), "\n"),
    ).otherwise(F.col(text_col))
    changed = joined.withColumn(text_col, text)
    if length_col:
        changed = changed.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    if dropped_col:
        changed = changed.withColumn(dropped_col, F.coalesce(F.size(dropped), F.lit(0)))
    return changed.drop(own, id_, h, dropped, lines)


# The same over the table ``documents``, for DuckDB.
ORACLE = r"""
WITH lines AS (
  SELECT doc_id, text, u.pos, u.line
  FROM documents d,
       LATERAL (SELECT unnest(string_split(d.text, chr(10))) AS line,
                       generate_subscripts(string_split(d.text, chr(10)), 1) AS pos) u
), tokens AS (
  SELECT doc_id, text, pos, line,
    list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS own
  FROM lines
), parsed AS (
  SELECT doc_id, text, pos, array_to_string(own, ' ') AS said, len(own) AS size,
    list_transform(own, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS t
  FROM tokens WHERE len(own) > 0
), keyed AS (
  SELECT *, array_to_string(t, ' ') AS masked, concat_ws(' ', size, array_to_string(t[1:3], ' ')) AS path FROM parsed
), paths AS (
  SELECT path, any_value(size) AS size, any_value(t[1:3]) AS lead, count(DISTINCT (doc_id, text)) AS n FROM keyed GROUP BY path
), children AS (
  SELECT path, n, j, concat_ws(' ', size, 'open', j, array_to_string(list_filter(lead, lambda x, i: i <> j), ' ')) AS leaf
  FROM (SELECT *, unnest(range(1, len(lead) + 1)) AS j FROM paths) WHERE lead[j] <> '<*>'
), nodes AS (
  SELECT leaf, sum(n) AS docs FROM children GROUP BY leaf HAVING count(*) >= 3
), opened AS (
  SELECT c.path, c.leaf FROM children c JOIN nodes o ON c.leaf = o.leaf WHERE c.n < 3
  QUALIFY row_number() OVER (PARTITION BY c.path ORDER BY o.docs DESC, c.j) = 1
), leafed AS (
  SELECT k.*, coalesce(o.leaf, k.path) AS leaf, CASE WHEN o.leaf IS NULL THEN 0 ELSE 1 END AS open
  FROM keyed k LEFT JOIN opened o ON k.path = o.path
), leaves AS (
  SELECT leaf, count(DISTINCT (doc_id, text)) AS of_leaf FROM leafed GROUP BY leaf HAVING of_leaf >= 3 AND min(masked) <> max(masked)
), distinct_lines AS (
  SELECT leaf, masked, any_value(t) AS t, any_value(size) AS size, any_value(of_leaf) AS of_leaf,
    any_value(len(list_filter(t[1:3], lambda x: x <> '<*>')) - open) AS n_lead
  FROM leafed JOIN leaves USING (leaf) GROUP BY leaf, masked
), counts AS (
  SELECT leaf, i, field, count(DISTINCT (doc_id, text)) AS n
  FROM (SELECT leaf, doc_id, text, unnest(t[4:]) AS field, generate_subscripts(t[4:], 1) AS i FROM leafed JOIN leaves USING (leaf))
  WHERE field <> '<*>' GROUP BY leaf, i, field HAVING n >= 3
), parts AS (
  SELECT p.leaf, p.masked, p.i, p.field, c.n
  FROM (SELECT leaf, masked, unnest(t[4:]) AS field, generate_subscripts(t[4:], 1) AS i FROM distinct_lines) p
  JOIN counts c ON p.leaf = c.leaf AND p.i = c.i AND p.field = c.field
), ranked AS (
  SELECT d.leaf, d.masked, d.size, d.n_lead, d.of_leaf, coalesce(p.ns, CAST([] AS BIGINT[])) AS ns
  FROM distinct_lines d LEFT JOIN (SELECT leaf, masked, list(n ORDER BY n DESC) AS ns FROM parts GROUP BY leaf, masked) p
    ON d.leaf = p.leaf AND d.masked = p.masked
), judged AS (
  SELECT leaf, masked, CASE WHEN ceil(0.6 * size) > n_lead THEN ns[CAST(ceil(0.6 * size) AS BIGINT) - n_lead] ELSE of_leaf END AS least
  FROM ranked WHERE len(ns) + n_lead >= 0.6 * size
), templates AS (
  SELECT j.leaf, j.masked, coalesce(string_agg(concat(p.i, ' ', p.field), chr(10) ORDER BY p.i), '') AS template
  FROM judged j LEFT JOIN parts p ON j.leaf = p.leaf AND j.masked = p.masked AND p.n >= 0.5 * j.least GROUP BY j.leaf, j.masked
), by_template AS (
  SELECT l.leaf, t.template, min(l.doc_id) AS first FROM leafed l JOIN templates t ON l.leaf = t.leaf AND l.masked = t.masked
  GROUP BY l.leaf, t.template HAVING count(DISTINCT (l.doc_id, l.text)) >= 3
), by_line AS (
  SELECT said, min(doc_id) AS first FROM parsed GROUP BY said HAVING count(DISTINCT (doc_id, text)) >= 2
), lost AS (
  SELECT l.doc_id, l.text, l.pos FROM leafed l
  LEFT JOIN templates t ON l.leaf = t.leaf AND l.masked = t.masked
  LEFT JOIN by_template b ON t.leaf = b.leaf AND t.template = b.template
  LEFT JOIN by_line e ON l.said = e.said
  WHERE l.doc_id <> coalesce(b.first, e.first)
), rebuilt AS (
  SELECT l.doc_id, l.text AS old, coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (x.pos IS NULL), '') AS text,
    CAST(count(x.pos) AS INTEGER) AS n_dropped
  FROM lines l LEFT JOIN lost x ON l.doc_id = x.doc_id AND l.text = x.text AND l.pos = x.pos
  GROUP BY l.doc_id, l.text
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE r.text END AS text, coalesce(r.n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN rebuilt r ON d.doc_id = r.doc_id AND d.text = r.old
"""
