"""Lookup of one dimension in several roles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 64


class AmbiguousDimension(ValueError):
    """The dimension has several rows for one key, so a lookup would multiply rows."""


def _measure(dim: DataFrame, key: str, columns: Sequence[str]) -> int:
    """Check the key of ``dim`` and return an upper estimate of its size in bytes."""
    text = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in [key, *columns]]
    facts = dim.agg(
        F.count(key).alias("keyed"),
        F.countDistinct(key).alias("distinct_keys"),
        F.coalesce(F.sum(reduce(lambda a, b: a + b, text) + ROW_OVERHEAD), F.lit(0)).alias("bytes"),
    ).first()
    if facts["keyed"] != facts["distinct_keys"]:
        raise AmbiguousDimension(
            f"{facts['keyed'] - facts['distinct_keys']} repeated values in dimension key {key}"
        )
    return facts["bytes"]


def _free(name: str, taken: set[str]) -> str:
    while name.lower() in taken:
        name = f"_{name}"
    return name


def enrich(
    df: DataFrame,
    dim: DataFrame,
    roles: Mapping[str, str],
    key: str,
    columns: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left-join ``dim`` once per role; ``roles`` maps a prefix to the fact's key column.

    Adds ``<prefix>_<key>`` and ``<prefix>_<column>`` for each role.  A row without a
    match keeps NULLs there, and no row is multiplied: a repeated dimension key raises.

    A dimension measured below ``broadcast_bytes`` is broadcast, so the facts are not
    shuffled.  A larger one is joined by shuffle, where adaptive execution splits the
    partitions of hot and NULL keys.  Several roles are then looked up for the distinct
    combinations of keys, which are narrow and combined before their shuffle, so the facts
    themselves move once, not once per role.  Only the plan differs, never the result.
    """
    small = _measure(dim, key, columns) <= broadcast_bytes
    sides = {
        prefix: dim.filter(F.col(key).isNotNull()).select(
            *[F.col(c).alias(f"{prefix}_{c}") for c in [key, *columns]]
        )
        for prefix in roles
    }
    if small or len(roles) == 1:
        for prefix, fact_key in roles.items():
            matched = df[fact_key] == sides[prefix][f"{prefix}_{key}"]
            df = df.join(F.broadcast(sides[prefix]) if small else sides[prefix].hint("merge"), matched, "left")
        return df
    taken = {c.lower() for frame in [df, *sides.values()] for c in frame.columns}
    own = {}
    for fact_key in dict.fromkeys(roles.values()):
        own[fact_key] = _free(f"_used_{fact_key}", taken)
    used = df.select(*[F.col(k).alias(name) for k, name in own.items()]).distinct()
    for prefix, fact_key in roles.items():
        matched = F.col(own[fact_key]) == F.col(f"{prefix}_{key}")
        used = used.join(sides[prefix].hint("merge"), matched, "left")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(name)) for k, name in own.items()])
    return df.join(used.hint("merge"), same, "left").drop(*own.values())
