"""Column expressions shared by the plans; all of them stay inside the JVM."""

from laborloom.functions.columns import (
    area_geography,
    ieee_div,
    is_any,
    n_unique,
    order_free_sum,
    positive_count,
    reference_date,
    series_columns,
    state_geography,
    sum_or_zero,
)

__all__ = [
    "area_geography",
    "ieee_div",
    "is_any",
    "n_unique",
    "order_free_sum",
    "positive_count",
    "reference_date",
    "series_columns",
    "state_geography",
    "sum_or_zero",
]
