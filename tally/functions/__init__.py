from tally.functions.scalars import (
    band,
    full_name,
    hour_of,
    in_year,
    int_div,
    loosely,
    month_label,
    rank_label,
    ratio,
    trimmed_length,
    year_diff,
)

__all__ = [
    "band",
    "full_name",
    "hour_of",
    "in_year",
    "int_div",
    "loosely",
    "month_label",
    "rank_label",
    "ratio",
    "trimmed_length",
    "year_diff",
]
