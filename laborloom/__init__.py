"""Labor statistics on one industry and geography hierarchy, as Spark DataFrames."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from laborloom.plans import jolts, qcew
from laborloom.sinks import write_clustered, write_staged
from laborloom.sources import LakeSource, read_jolts, read_qcew, read_series

__all__ = ["LakeSource", "map_jolts", "map_qcew", "read_jolts", "read_qcew", "read_series", "write_clustered",
           "write_staged"]


def map_qcew(spark: SparkSession, source: DataFrame | Path | str) -> DataFrame:
    """Monthly employment in thousands by industry and geography, from a frame or a path."""
    return qcew.to_ces(source if isinstance(source, DataFrame) else read_qcew(spark, str(source)))


def map_jolts(spark: SparkSession, source: DataFrame | Path | str) -> DataFrame:
    """Hires and separations by industry and geography in output order, from a frame or a path."""
    survey = source if isinstance(source, DataFrame) else read_jolts(spark, str(source))
    return jolts.ordered(jolts.to_ces(survey))
