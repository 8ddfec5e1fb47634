from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(facts: DataFrame, crosswalk: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join facts to a constant crosswalk. ``crosswalk`` comes from
    :func:`laborloom.dimensions.dimension`, whose row bound makes the broadcast safe."""
    return facts.join(F.broadcast(crosswalk), on=on, how=how)
