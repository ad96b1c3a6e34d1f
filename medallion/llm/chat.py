"""Chat formatting of reply trees, in DataFrame operations only.

Messages of a tree name their parent.  Iterative self-joins double, in each round, the
distance at which every message knows its ancestor, and carry the number and the scores
of the messages in between, so a path of n messages takes log2(n) rounds on one row per
message.  The branches of a tree are ranked by that.  Only the chosen ones are spelled out, by
the same jumps from their leaves, joined with their texts once, and formatted as one
conversation each.

Template, per message: ``<s>[INST] role [/INST] text </s>``.  Control strings inside a role
or a text get one backslash behind their first character, those that already look
escaped get one more, and reading takes one away: any text comes back as it was.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import cut, same

ROLE, TEXT, END = "<s>[INST] ", " [/INST] ", " </s>"
# A control string of the template with any number of backslashes behind its first character.
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _blank(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def tree_paths(
    messages: DataFrame, tree_col: str, id_col: str, parent_col: str, score_col: str | None = None,
    branches: int | None = None,
) -> DataFrame:
    """(tree, leaf, message, depth, score): the messages of every chosen root-to-leaf path.

    A message without parent, or whose parent is not in its tree, is a root; a leaf is
    nobody's parent.  ``score`` is the mean score of the path's messages, null counting
    as 0; each tree's ``branches`` best paths are chosen (None: all), ties by leaf id.
    Ids are unique within a tree.  Messages on a cycle, or below one, have no root and are
    on no path.
    """
    score = F.coalesce(F.col(score_col).cast("double"), F.lit(0.0)) if score_col else F.lit(0.0)
    own = messages.select(
        F.col(tree_col).alias("tree"), F.col(id_col).alias("message"), F.col(parent_col).alias("parent"), score.alias("score")
    )
    ids = own.select(F.col("tree").alias("_tree"), F.col("message").alias("_message"))
    known = own.join(ids, same(F.col("tree"), F.col("_tree")) & (F.col("parent") == F.col("_message")), "left").select(
        "tree", "message", F.col("_message").alias("up"), "score"
    )
    known = cut(known)
    parents = known.filter(F.col("up").isNotNull()).select(F.col("tree").alias("_tree"), F.col("up").alias("_up")).distinct()
    leaves = known.join(parents, same(F.col("tree"), F.col("_tree")) & (F.col("message") == F.col("_up")), "left_anti")
    jumps, climbed = _climb(known)
    totals = climbed.select(F.col("tree").alias("_tree"), F.col("message").alias("leaf"), "size", (F.col("total") / F.col("size")).alias("score"))
    ranked = leaves.select("tree", "message").join(totals, same(F.col("tree"), F.col("_tree")) & (F.col("message") == F.col("leaf")))
    if branches is not None:
        rank = Window.partitionBy("tree").orderBy(F.col("score").desc(), "leaf")
        ranked = ranked.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= branches)
    # Only the chosen paths are spelled out: each round adds the messages one jump above those known.
    paths = cut(ranked.select("tree", "leaf", "message", F.lit(0).alias("above"), "size", "score"))
    for nth, jump in enumerate(jumps):
        step = same(F.col("tree"), F.col("_tree")) & (F.col("message") == F.col("_message"))
        longer = paths.join(jump, step).select(
            "tree", "leaf", F.col("_up").alias("message"), (F.col("above") + (1 << nth)).alias("above"), "size", "score"
        )
        paths = cut(paths.unionByName(longer))
    return paths.select("tree", "leaf", "message", (F.col("size") - 1 - F.col("above")).cast("int").alias("depth"), "score")


def _climb(known: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Pointer doubling over all messages, a row per message and round.

    Returns, per round k, (_tree, _message, _up) with the ancestor 2^k above, and (tree, message, size, total)
    with the number of messages from each message to its root and the sum of their scores.
    Messages that never reach a root (those on a cycle or below one) are not among the latter.
    """
    state = known.select("tree", "message", "up", F.lit(1).cast("bigint").alias("size"), F.col("score").alias("total"))
    jumps, done, most = [], [], None
    while True:
        # A message that has reached its root leaves the rounds; it is only looked up.
        done.append(state.filter(F.col("up").isNull()).select("tree", "message", "size", "total"))
        active = state.filter(F.col("up").isNotNull())
        if active.isEmpty():
            break
        most = known.count() if most is None else most
        if 1 << len(jumps) > most:  # only a cycle has ancestors at a distance beyond the number of messages
            break
        jumps.append(active.select(F.col("tree").alias("_tree"), F.col("message").alias("_message"), F.col("up").alias("_up")))
        reached = reduce(DataFrame.unionByName, [active, *(d.withColumn("up", F.lit(None).cast(known.schema["up"].dataType)) for d in done)])
        above = reached.select(
            F.col("tree").alias("_tree"), F.col("message").alias("_message"),
            F.col("up").alias("_up"), F.col("size").alias("_size"), F.col("total").alias("_total"),
        )
        on = same(F.col("tree"), F.col("_tree")) & (F.col("up") == F.col("_message"))
        state = cut(active.join(above, on).select(
            "tree", "message", F.col("_up").alias("up"),
            (F.col("size") + F.col("_size")).alias("size"), (F.col("total") + F.col("_total")).alias("total"),
        ))
    return jumps, reduce(DataFrame.unionByName, done)


def format_messages(messages: Column) -> tuple[Column, Column]:
    """The formatted text of an array of (depth, role, text), and the spans of trained texts.

    Spans are (start, length) in code points of the formatted text.
    """
    parts = F.transform(
        messages, lambda m: F.struct(F.concat(F.lit(ROLE), escape(m["role"]), F.lit(TEXT)).alias("head"), escape(m["text"]).alias("body"), (m["role"] == TRAINED).alias("trained"))
    )
    text = F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    nothing = F.array().cast("array<struct<start: bigint, length: bigint>>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), nothing.alias("spans"))

    def walk(state: Column, p: Column) -> Column:
        begin = state["at"] + F.length(p["head"])
        span = F.struct(begin.alias("start"), F.length(p["body"]).cast("bigint").alias("length"))
        return F.struct(
            (begin + F.length(p["body"]) + len(END)).alias("at"),
            F.when(p["trained"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    return text, F.aggregate(parts, start, walk, lambda s: s["spans"])


def format_reply_trees(
    messages: DataFrame,
    tree_col: str = "tree_id",
    id_col: str = "message_id",
    parent_col: str = "parent_id",
    role_col: str = "role",
    text_col: str = "text",
    score_col: str | None = None,
    branches: int | None = None,
) -> DataFrame:
    """One row per chosen path: ``tree, leaf, score, formatted, loss_spans``.

    The paths and their ranking are those of ``tree_paths``.  ``loss_spans`` are the
    (start, length) spans, in code points of ``formatted``, of the escaped texts whose role
    is ``assistant``.  A null text or role counts as empty; an empty trained text has a
    span of length 0.  A null tree id is a tree of its own.  Other columns are ignored.
    An empty table gives an empty result.
    """
    paths = tree_paths(messages, tree_col, id_col, parent_col, score_col, branches)
    texts = messages.select(
        F.col(tree_col).alias("_tree"), F.col(id_col).alias("_message"), _blank(F.col(role_col)).alias("role"), _blank(F.col(text_col)).alias("text")
    )
    placed = paths.join(texts, same(F.col("tree"), F.col("_tree")) & (F.col("message") == F.col("_message")))
    whole = placed.groupBy("tree", "leaf").agg(
        F.first("score").alias("score"), F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("messages")
    )
    formatted, spans = format_messages(F.col("messages"))
    return whole.select("tree", "leaf", "score", formatted.alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text), unescaped, from a formatted text."""
    turns = F.slice(F.split(formatted, END + "(?=<s>|$)"), 1, F.size(F.split(formatted, END + "(?=<s>|$)")) - 1)
    middle = lambda t: F.instr(t, TEXT)
    return F.transform(
        turns,
        lambda t: F.struct(
            unescape(F.substring(t, F.lit(len(ROLE) + 1), middle(t) - len(ROLE) - 1)).alias("role"),
            unescape(F.substring(t, middle(t) + len(TEXT), F.length(t))).alias("text"),
        ),
    )


def read_trained(formatted: Column, spans: Column) -> Column:
    """The trained texts, unescaped, one after the other, read through the spans."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )


def linear_messages(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Linear conversations as reply trees: every row answers the one before it.

    Rows go by turn (null first), ties by role and text; repeated rows are turns of their own.
    """
    order = Window.partitionBy(conv_col).orderBy(turn_col, role_col, text_col)
    nth = F.row_number().over(order).cast("long")
    return rows.select(
        F.col(conv_col).alias("tree_id"), nth.alias("message_id"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    ).withColumn("parent_id", F.when(F.col("message_id") > 1, F.col("message_id") - 1))


# What op2_chat_formatting returns, for DuckDB over the table ``conversations``.
ORACLE = r"""
WITH messages AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), escaped AS (
  SELECT *, coalesce(role, '') AS r,
    regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS e FROM messages
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (r = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(r) + length(e) + 24) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""
