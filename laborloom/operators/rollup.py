"""Roll-ups over overlapping groups.

A cell (geography × industry × quarter) counts towards several totals at once, e.g. one
supersector feeds two domains, so ``rollup``/``cube`` do not apply. Each cell is instead
fanned out to everything it counts towards and summed once. Call these on aggregated
cells: the fan-out then multiplies the small side of the plan, never the raw scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborloom import dimensions
from laborloom.operators.crosswalk import lookup
from laborloom.operators.months import MONTH_COLUMNS

#: A cell; its industry type follows from the code until industries are fanned out.
CELL = ["geographic_type", "geographic_code", "industry_code", "year", "qtr"]


def sum_cells(cells: DataFrame, *more: str) -> DataFrame:
    """Total of each cell, month by month; map-side partial sums absorb hot cells."""
    return cells.groupBy(*CELL, *more).agg(*[F.sum(m).alias(m) for m in MONTH_COLUMNS])


def over_industries(cells: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Fan sector cells out to the industry ``levels`` they count towards."""
    members = cells.withColumnRenamed("industry_code", "member_code")
    closure = dimensions.industry_closure(cells.sparkSession, levels)
    return lookup(members, closure, "member_code").drop("member_code")


def _place(kind: Column, code: Column, applies: Column) -> Column:
    return F.struct(F.when(applies, kind).alias("place_type"), code.alias("place_code"))


def over_geographies(cells: DataFrame, levels: Sequence[str], keep_own: Column | None = None) -> DataFrame:
    """Fan state cells out to their division and region (``levels``).

    Cells for which ``keep_own`` holds also stay as they are; national cells and states
    outside every division reach no other level.
    """
    home = dimensions.states(cells.sparkSession).select(
        F.col("fips").alias("geographic_code"), "division_code", "region_code")
    is_state = F.col("geographic_type") == "state"
    places = [_place(F.lit(level), F.col(f"{level}_code"), is_state & F.col(f"{level}_code").isNotNull())
              for level in levels]
    if keep_own is not None:
        places.append(_place(F.col("geographic_type"), F.col("geographic_code"), keep_own))
    return (
        lookup(cells, home, "geographic_code", how="left")
        .select(F.inline(F.array(*places)), "industry_type", "industry_code", "year", "qtr", *MONTH_COLUMNS)
        .where(F.col("place_type").isNotNull())
        .withColumnsRenamed({"place_type": "geographic_type", "place_code": "geographic_code"})
    )
