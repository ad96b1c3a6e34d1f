"""Mixing sources to target weights: temperature, and budgeted block permutations.

Each source's share of the tokens is raised to an exponent between 0 (all alike) and 1 (as
they are) and normalised.  The exponent is found by bisection: the largest at which the
weights' entropy reaches a target, or the smallest at which no source is repeated more
often than allowed.  Six halvings are evaluated in one pass over the sources' totals, so
neither sources nor documents pass through the driver.

The weights are then realised: every source gets its budget of tokens from repeated
epochs over its documents.  In each epoch a source's documents fall into blocks by a hash,
which makes the order of blocks, and of documents in a block, a pseudo-random permutation
of their own for each epoch.  Blocks are taken in order until the budget is spent; in the
one where it ends, documents are.  No source is sorted as a whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import cut, free_names, same

BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"
HALVINGS_A_PASS = 6
PASSES = 4
BLOCK_DOCS = 1_000
MAX_REPEAT = 2.0
SEED = 11


def count_words(text_col: str) -> Column:
    """Words as the measure of a text where no token count is given; null has none."""
    trimmed = F.btrim(F.coalesce(F.col(text_col), F.lit("")), F.lit(BLANK_CHARS))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, BLANKS))).cast("long")


def source_totals(docs: DataFrame, source_col: str, tokens: Column) -> DataFrame:
    """(source, n_docs, tokens) per source; a null source is a source."""
    return docs.groupBy(F.col(source_col).alias("source")).agg(
        F.count("*").alias("n_docs"), F.coalesce(F.sum(tokens), F.lit(0)).cast("long").alias("tokens")
    )


def _measures(totals: DataFrame, exponents: list[float], whole: float) -> dict[float, tuple[float, float]]:
    """For each exponent: entropy of the weights, and the most that a source is repeated
    if the source repeated least is used once.  One pass, one row per exponent."""
    share = F.col("tokens") / F.lit(whole)
    raised = totals.filter("tokens > 0").select(
        share.alias("p"), F.explode(F.array(*[F.lit(float(e)) for e in exponents])).alias("e")
    )
    w, rate = F.pow("p", F.col("e")), F.pow("p", F.col("e") - 1)
    rows = raised.groupBy("e").agg(
        F.sum(w).alias("z"), F.sum(w * F.log(w)).alias("wl"), F.max(rate).alias("most"), F.min(rate).alias("least")
    )
    return {r.e: (math.log(r.z) - r.wl / r.z, r.most / r.least) for r in rows.collect()}


def bisect_exponent(
    totals: DataFrame, entropy: float | None = None, max_repeat: float | None = MAX_REPEAT
) -> float:
    """The exponent in [0, 1] that meets the target.

    ``entropy`` (nats): the largest exponent whose weights have at least that entropy, 0 if
    none has.  Otherwise ``max_repeat``: the smallest at which the source repeated most is
    used at most that many times while the one repeated least is used once.
    Raising the exponent lowers both, so halving the interval finds either.
    """
    whole = totals.agg(F.sum("tokens")).first()[0]
    if not whole:
        return 1.0
    low, high = 0.0, 1.0
    ends = _measures(totals, [0.0, 1.0], float(whole))

    def flat_enough(measure: tuple[float, float]) -> bool:
        return measure[0] >= entropy if entropy is not None else measure[1] > max_repeat

    if flat_enough(ends[1.0]):
        return 1.0
    if not flat_enough(ends[0.0]):
        return 0.0
    for _ in range(PASSES):
        steps = 1 << HALVINGS_A_PASS
        grid = [low + (high - low) * i / steps for i in range(1, steps)]
        found = _measures(totals, grid, float(whole))
        for _ in range(HALVINGS_A_PASS):
            middle = (low + high) / 2
            nearest = min(grid, key=lambda g: abs(g - middle))
            low, high = (nearest, high) if flat_enough(found[nearest]) else (low, nearest)
    return low if entropy is not None else high


def weights(totals: DataFrame, exponent: float, budget: int | None = None) -> DataFrame:
    """(source, n_docs, tokens, weight, source_budget): weights add up to 1.

    Without ``budget`` the sources' budgets add up to the fewest tokens at which every
    source is used at least once as a whole, so no document is left out.
    """
    whole = float(totals.agg(F.sum("tokens")).first()[0] or 0)
    raised = totals.withColumn(
        "raised", F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(whole), F.lit(exponent))).otherwise(0.0)
    )
    once = F.max(F.when(F.col("tokens") > 0, F.col("tokens") / F.col("raised")))
    norm, once = raised.agg(F.sum("raised"), once).first()
    norm, once = norm or 1.0, once or 0.0
    weight = F.col("raised") / F.lit(norm)
    exact = F.rint(weight * F.lit(float(budget) if budget is not None else once * norm)).cast("long")
    # Rounding of the powers must not cost a source its last document.
    full = exact if budget is not None else F.greatest(exact, F.col("tokens"))
    return raised.select("source", "n_docs", "tokens", weight.alias("weight"), full.alias("source_budget"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    tokens_col: str | None = None,
    entropy: float | None = None,
    max_repeat: float | None = MAX_REPEAT,
    budget: int | None = None,
    block_docs: int = BLOCK_DOCS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, h, source, tokens, epoch, block, place, copies): what the mixture draws.

    One row for each time a document is drawn.  ``epoch`` counts from 0.  ``place``, in
    [0, 1), is where the block starts in its source's budget: sorting by ``place``
    interleaves the sources at their weights.  ``h`` is the text's hash: a document is an id with a text, and
    ``copies`` is how many equal rows of the table one row stands for, all drawn together.

    The measure is ``tokens_col``, else words.  A source whose documents have no tokens at
    all has no weight, and its documents are drawn once (with a budget: not).  A null
    source is a source; a null text or count has no tokens.  Documents of no tokens in
    other sources go with their block.  An empty table gives an empty result.
    """
    tokens = F.coalesce(F.col(tokens_col).cast("long"), F.lit(0)) if tokens_col else count_words(text_col)
    h = F.xxhash64(F.col(text_col).isNull(), F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), h.alias("h"), F.col(source_col).alias("source"), tokens.alias("tokens"))
    rows = cut(rows.groupBy("doc_id", "h", "source", "tokens").agg(F.count("*").alias("copies")))
    measure = F.col("tokens") * F.col("copies")
    totals = cut(source_totals(rows, "source", measure).coalesce(8))  # a short row per source
    exponent = bisect_exponent(totals, entropy, max_repeat)
    planned = cut(
        weights(totals, exponent, budget).withColumn(
            "epochs",
            F.when(F.col("tokens") > 0, F.ceil(F.col("source_budget") / F.col("tokens"))).otherwise(F.lit(0 if budget is not None else 1)).cast("int"),
        ).withColumn("blocks", F.ceil(F.col("n_docs") / block_docs).cast("int"))
    )
    plan = planned.select(
        F.col("source").alias("_source"), F.col("tokens").alias("_all"), "source_budget", "epochs", "blocks"
    )
    drawn = (
        rows.join(plan, same(F.col("source"), F.col("_source")))
        .filter("epochs > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)))
        .withColumn("key", F.xxhash64(F.lit(seed), F.col("epoch"), F.col("doc_id").cast("string"), F.col("h")))
        .withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.col("blocks")).cast("int"))
    )
    group = ["source", "epoch", "block"]
    sizes = drawn.groupBy(*group).agg(F.sum(measure).alias("size"), F.first("_all").alias("_all"), F.first("source_budget").alias("source_budget"))
    # A window over one row per block of an epoch: a thousandth of the documents.
    earlier = Window.partitionBy("source", "epoch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn(
        "start", F.col("epoch") * F.col("_all") + F.coalesce(F.sum("size").over(earlier), F.lit(0))
    ).select(*[F.col(c).alias(f"_{c}") for c in group], "start", "size")
    on = same(F.col("source"), F.col("_s")) & (F.col("epoch") == F.col("_epoch")) & (F.col("block") == F.col("_block"))
    placed = drawn.drop("_source").join(starts.withColumnRenamed("_source", "_s"), on)
    columns = ["doc_id", "h", "source", "tokens", "epoch", "block", "start", "source_budget", "copies"]
    whole = placed.filter((F.col("start") + F.col("size") <= F.col("source_budget")) | (F.col("_all") == 0)).select(*columns)
    # The block where the budget ends: its documents in order of their key.
    within = Window.partitionBy(*group).orderBy("key", "doc_id", "h").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        placed.filter((F.col("start") < F.col("source_budget")) & (F.col("start") + F.col("size") > F.col("source_budget")))
        .withColumn("before", F.col("start") + F.coalesce(F.sum(measure).over(within), F.lit(0)))
        .filter(F.col("before") < F.col("source_budget"))
        .select(*columns)
    )
    place = F.when(F.col("source_budget") > 0, F.col("start") / F.col("source_budget")).otherwise(0.0)
    return whole.unionByName(last).select(
        "doc_id", "h", "source", "tokens", "epoch", "block", place.alias("place"), "copies"
    )


def draw(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as the mixture draws it.

    The number of draws per document is joined, not the draws, so no text is shuffled twice.
    """
    own, id_, h, times, nth = free_names(docs, "_own", "_id", "_h", "_times", "_nth")
    counted = mixed.groupBy("doc_id", "h").agg(F.count("*").cast("int").alias(times)).select(
        F.col("doc_id").alias(id_), F.col("h").alias(h), times
    )
    hashed = F.xxhash64(F.col(text_col).isNull(), F.coalesce(F.col(text_col), F.lit("")))
    on = same(F.col(id_col), F.col(id_)) & (F.col(own) == F.col(h))
    joined = docs.withColumn(own, hashed).join(counted, on)
    return joined.withColumn(nth, F.explode(F.array_repeat(F.lit(1), F.col(times)))).select(*docs.columns)
