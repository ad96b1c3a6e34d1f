"""Column expressions: casts, decoding, calendar parts, ratios, repeatable sums."""

from medallion.functions.columns import (
    calendar,
    canonicalise,
    decode,
    duration_minutes,
    safe_ratio,
    type_columns,
    upper_trim,
)
from medallion.functions.sums import repeatable_avg, repeatable_sum

__all__ = [
    "calendar",
    "canonicalise",
    "decode",
    "duration_minutes",
    "repeatable_avg",
    "repeatable_sum",
    "safe_ratio",
    "type_columns",
    "upper_trim",
]
