"""Matching published levels with published rates of the same series.

Everything starts from :func:`observations`: the distinct observations of each series with
the number of times they occur. A well-formed series has one level and one rate per month.
Where it has more, every level meets every rate, as in an inner join on the key; carrying
the multiplicities as counts gives the same sums without materialising those pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborloom.functions import ieee_div, order_free_sum
from laborloom.operators.sharing import repeated, shared

#: Parts that the levels of one key are cut into before each meets all the key's rates.
LEVEL_PARTS = 16
SERIES_KEY = ["geographic_type", "geographic_code", "industry_code", "data_element", "ref_date"]


def observations(rows: DataFrame) -> DataFrame:
    """Distinct (series key, ``rate_or_level``, ``value``) with their number of ``copies``.

    One pass and one shuffle; map-side counting collapses copies before they travel.
    """
    return shared(rows.groupBy(*SERIES_KEY, "rate_or_level", "value").agg(F.count(F.lit(1)).alias("copies")))


def _side(observed: DataFrame, kind: str) -> DataFrame:
    return observed.where(F.col("rate_or_level") == kind).select(
        *SERIES_KEY, F.col("value").alias(kind), F.col("copies").alias(f"{kind}_copies"))


def implied_employment(observed: DataFrame) -> DataFrame:
    """Employment implied by each level and rate: level · 100 / rate.

    Gives one row per key and rate: ``level_value`` and ``employment`` are sums over the
    ``pairs`` of a level and that rate.
    """
    level, copies = F.col("level"), F.col("level_copies")
    levels = _side(observed, "level").groupBy(*SERIES_KEY).agg(
        F.sum(copies).alias("levels"),
        order_free_sum(level * copies).alias("level_sum"),
        # A zero rate is applied level by level, since inf and NaN do not survive factoring out.
        F.sum(ieee_div(level * 100.0, F.lit(0.0))).alias("employment_at_zero"),
    )
    rate, rates = F.col("rate"), F.col("rate_copies")
    employment = F.when(rate == 0, F.col("employment_at_zero")).otherwise(F.col("level_sum") * 100.0 / rate)
    return levels.join(_side(observed, "rate"), on=SERIES_KEY).select(
        *SERIES_KEY,
        (F.col("level_sum") * rates).alias("level_value"),
        rate.alias("rate_value"),
        (F.col("levels") * rates).alias("pairs"),
        (employment * rates).alias("employment"),
    )


def level_rate_pairs(observed: DataFrame) -> DataFrame:
    """Each level next to each rate of its key, with the employment they imply.

    For series whose pairs are themselves output rows, so each of their copies is a row too.
    The levels of one key are cut into parts by value, so that many distinct ones do not meet
    its rates in one task.
    """
    part = F.pmod(F.xxhash64("level"), F.lit(LEVEL_PARTS))
    levels = _side(observed, "level").withColumn("part", part)
    parts = F.sequence(F.lit(0).cast("long"), F.lit(LEVEL_PARTS - 1).cast("long"))
    rates = _side(observed, "rate").withColumn("part", F.explode(parts))
    pairs = levels.join(rates, on=[*SERIES_KEY, "part"])
    copies = F.col("level_copies") * F.col("rate_copies")
    return repeated(pairs.select(*SERIES_KEY, "level", "rate", copies.alias("copies")), "copies").select(
        *SERIES_KEY,
        F.col("level").alias("level_value"),
        F.col("rate").alias("rate_value"),
        ieee_div(F.col("level") * 100.0, F.col("rate")).alias("employment"),
    )
