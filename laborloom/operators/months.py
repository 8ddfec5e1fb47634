from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborloom.functions import reference_date

MONTH_COLUMNS = ["month1_emplvl", "month2_emplvl", "month3_emplvl"]


def months_long(quarters: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per month with employment from rows holding a quarter's three months.

    Takes ``year``, ``qtr`` and the month columns as numbers next to ``keys``; gives
    ``keys``, ``ref_date`` and ``employment``. Months without a positive count vanish.
    """
    ref_date = reference_date("year", "qtr", "CAST(substring(month_column, 6, 1) AS INT)")
    return (
        quarters.unpivot(
            ids=list(dict.fromkeys([*keys, "year", "qtr"])),
            values=MONTH_COLUMNS,
            variableColumnName="month_column",
            valueColumnName="employment",
        )
        .where(F.col("employment") > 0)
        .select(*keys, ref_date.alias("ref_date"), "employment")
    )
