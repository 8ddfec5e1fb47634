from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from laborloom import fixed_values as fixed
from laborloom.schemas import strict_cast


def ieee_div(a: Column, b: Column) -> Column:
    """Float division with IEEE results for a zero divisor: inf, -inf or NaN, never an error.

    ``try_divide`` would give NULL, which a later sum skips; an infinite employment must
    instead drive the derived rate to zero. NaN is tested first because Spark orders it
    above every number.
    """
    at_zero = (
        F.when(a.isNull(), F.lit(None).cast("double"))
        .when(F.isnan(a) | (a == 0), F.lit(float("nan")))
        .when(a > 0, F.lit(float("inf")))
        .otherwise(F.lit(float("-inf")))
    )
    return F.when(b == 0, at_zero).otherwise(a / b)


#: Below this magnitude values are summed as decimals of 12 places, which has no rounding;
#: 10**8 of them fit the 38 digits.
EXACTLY_SUMMED = 1e18


def order_free_sum(c: Column) -> Column:
    """Sum of doubles that does not depend on their order, on retries or on the partitioning.

    Each value is taken to 12 decimal places and the decimals are added exactly. Values of
    ``EXACTLY_SUMMED`` and more, infinite ones and NaN are added as doubles beside them.
    """
    ordinary = F.abs(c) < EXACTLY_SUMMED
    exact = F.sum(F.when(ordinary, c).cast("decimal(38,12)")).cast("double")
    rest = F.sum(F.when(~ordinary, c))
    return F.coalesce(exact + rest, exact, rest)


def sum_or_zero(c: Column) -> Column:
    """Order-free sum that is 0.0, not NULL, for a group without values."""
    return F.coalesce(order_free_sum(c), F.lit(0.0))


def n_unique(name: str) -> Column:
    """Exact distinct count in which NULL is one more value."""
    has_null = F.coalesce(F.max(F.col(name).isNull().cast("int")), F.lit(0))
    return F.count_distinct(F.col(name)) + has_null


def positive_count(name: str) -> Column:
    """A count given as text, 0 when suppressed or below; malformed text stops the query."""
    return F.expr(f"greatest({strict_cast(name, 'DOUBLE')}, 0.0D)")


def area_geography(area: str = "area_fips") -> list[Column]:
    """Geography of an area code: the nation, or the state named by the first two characters."""
    is_nation = f"{area} = '{fixed.NATIONAL_AREA}'"
    return [
        F.expr(f"CASE WHEN {is_nation} THEN 'national' ELSE 'state' END AS geographic_type"),
        F.expr(f"CASE WHEN {is_nation} THEN '{fixed.NATIONAL_CODE}' ELSE substring({area}, 1, 2) END "
               "AS geographic_code"),
    ]


def state_geography(state: str = "state_code") -> list[Column]:
    """Geography of a two-digit state code, where ``00`` is the nation."""
    kind = f"CASE WHEN {state} = '{fixed.NATIONAL_CODE}' THEN 'national' ELSE 'state' END"
    return [F.expr(f"{kind} AS geographic_type"), F.col(state).alias("geographic_code")]


def reference_date(year: str, qtr: str, month_in_qtr: str) -> Column:
    """The 12th of a month, given its quarter and its place (1 to 3) in the quarter; a quarter
    that does not exist stops the query."""
    return F.expr(f"CASE WHEN {qtr} NOT BETWEEN 1 AND 4 THEN CAST(raise_error('no such quarter: ' || {qtr}) AS DATE) "
                  f"ELSE make_date({year}, ({qtr} - 1) * 3 + {month_in_qtr}, 12) END")


def is_any(name: str, codes: list[str]) -> str:
    """SQL text of membership in a list of codes."""
    return f"{name} IN ({', '.join(repr(code) for code in codes)})"


def series_columns(series_id: str = "series_id") -> list[Column]:
    """The fields of a 21-character series id."""
    return [F.expr(f"substring({series_id}, {start}, {length}) AS {field}")
            for field, start, length in fixed.SERIES_FIELDS]
