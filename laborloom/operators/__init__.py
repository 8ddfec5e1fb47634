"""DataFrame → DataFrame building blocks of the plans."""

from laborloom.operators.crosswalk import lookup
from laborloom.operators.months import MONTH_COLUMNS, months_long
from laborloom.operators.pairing import implied_employment, level_rate_pairs, observations
from laborloom.operators.rollup import CELL, over_geographies, over_industries, sum_cells
from laborloom.operators.sharing import repeated, shared

__all__ = [
    "CELL",
    "MONTH_COLUMNS",
    "implied_employment",
    "level_rate_pairs",
    "lookup",
    "months_long",
    "observations",
    "over_geographies",
    "over_industries",
    "repeated",
    "shared",
    "sum_cells",
]
