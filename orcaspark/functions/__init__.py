"""Column expressions shared by every operator (no UDF anywhere)."""

from orcaspark.functions.numbers import (
    brl_text,
    coerce_int,
    coerce_number,
    guarded_percent,
    money,
    percent_text,
    sum_or_zero,
)
from orcaspark.functions.text import (
    clean_text,
    drop_last_segment,
    join_key,
    key_part,
    norm_key,
    slug,
    standard_unit,
    strip_ws,
)

__all__ = [
    "brl_text",
    "clean_text",
    "coerce_int",
    "coerce_number",
    "drop_last_segment",
    "guarded_percent",
    "join_key",
    "key_part",
    "money",
    "norm_key",
    "percent_text",
    "slug",
    "standard_unit",
    "strip_ws",
    "sum_or_zero",
]
