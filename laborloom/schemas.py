"""Input and output contracts. Codes stay strings: leading zeros carry meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _D, _DATE = T.StringType(), T.DoubleType(), T.DateType()

QCEW_INPUT = _struct(
    area_fips=_S, own_code=_S, industry_code=_S, agglvl_code=_S, year=_S, qtr=_S,
    month1_emplvl=_S, month2_emplvl=_S, month3_emplvl=_S,
)

QCEW_OUTPUT = _struct(
    ref_date=_DATE, geographic_type=_S, geographic_code=_S,
    industry_type=_S, industry_code=_S, employment=_D,
)

JOLTS_INPUT = _struct(
    state_code=_S, industry_code=_S, dataelement_code=_S, ratelevel_code=_S,
    ref_date=_DATE, value=_D,
)

JOLTS_OUTPUT = _struct(
    geographic_type=_S, geographic_code=_S, industry_type=_S, industry_code=_S,
    rate_level=_S, data_element=_S, ref_date=_DATE, value=_D,
)

SERIES_INPUT = _struct(series_id=_S, year=_S, period=_S, value=_S, footnote_codes=_S)
#: With the text of records that do not have the header's number of fields.
SERIES_RECORD = _struct(series_id=_S, year=_S, period=_S, value=_S, footnote_codes=_S, line=_S)
SERIES_REJECT = _struct(problem=_S, series_id=_S, year=_S, period=_S, value=_S, line=_S)

#: The number of ``year`` beside its text, by which clustered census tables are laid out.
YEAR_NUMBER = "year_number"


def strict_cast(name: str, kind: str) -> str:
    """SQL text of a cast that stops on a value it cannot convert, in any session; it casts once."""
    text = f"'malformed {name}: ' || CAST({name} AS STRING)"
    return (f"coalesce(try_cast({name} AS {kind}), "
            f"CASE WHEN {name} IS NOT NULL THEN CAST(raise_error({text}) AS {kind}) END)")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to the columns and types of ``schema``; a missing column is an error."""
    missing = [name for name in schema.fieldNames() if name not in df.columns]
    if missing:
        raise ValueError(f"input lacks columns: {', '.join(missing)}")
    stored = df.schema
    return df.select(*[
        F.col(f.name) if stored[f.name].dataType == f.dataType
        else F.expr(strict_cast(f.name, f.dataType.simpleString())).alias(f.name)
        for f in schema])
