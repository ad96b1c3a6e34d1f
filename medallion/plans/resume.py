"""Go on where a run broke: what each step was made from is kept with what it made.

After a step, one property of its last table holds a digest of the step's settings, of
the state of its inputs and of the versions it published.  A repeated run that finds the same
digest has nothing to do there.  Any change makes the step run again: a raw file that is
newer, another setting, an input or an output that was published anew in the meantime.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import SparkSession

from medallion.sources.tables import current_version, table_property

STEP = "medallion.step"


def published(spark: SparkSession, names: Sequence[str]) -> list[str] | None:
    """The versions that ``names`` show; None if one has none, as tables of other formats have none."""
    found = [current_version(spark, name) for name in names]
    return None if None in found else found


def _digest(step: str, settings: str, inputs: Sequence[str], outputs: Sequence[str]) -> str:
    return hashlib.sha256("\n".join([step, settings, *inputs, "", *outputs]).encode()).hexdigest()


def is_done(
    spark: SparkSession, step: str, settings: str, inputs: Sequence[str] | None, outputs: Sequence[str]
) -> bool:
    made = published(spark, outputs)
    if inputs is None or made is None:
        return False
    return table_property(spark, outputs[-1], STEP) == _digest(step, settings, inputs, made)


def mark_done(
    spark: SparkSession, step: str, settings: str, inputs: Sequence[str] | None, outputs: Sequence[str]
) -> None:
    """``inputs`` is their state from before the step, so a change during it counts as one."""
    made = published(spark, outputs)
    if inputs is not None and made is not None:
        digest = _digest(step, settings, inputs, made)
        spark.sql(f"ALTER VIEW {outputs[-1]} SET TBLPROPERTIES ('{STEP}' = '{digest}')")
