from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from laborloom import fixed_values as fixed
from laborloom import schemas
from laborloom.plans import qcew


@dataclass(frozen=True)
class LakeSource:
    """Tables of a data lake.

    ``read_*`` go through a Spark catalog named ``catalog``, so executors read the files in
    parallel. ``read_*_jdbc`` go through a query coordinator at ``host:port`` instead, for
    lakes whose files Spark cannot reach; they need its JDBC driver on the class path.
    """

    host: str = "localhost"
    port: int = 8080
    catalog: str = "hive"
    schema: str = "default"
    qcew_table: str = "qcew"
    jolts_table: str = "jolts"
    jdbc_scheme: str = "jdbc:trino"
    fetch_size: int = 10_000

    def _table(self, name: str) -> str:
        return f"{self.catalog}.{self.schema}.{name}"

    def read_qcew(self, spark: SparkSession, start_year: int = 2003, end_year: int = 2025) -> DataFrame:
        """Quarterly census rows of the years ``start_year`` to ``end_year``, both included."""
        return qcew.years_of(spark.table(self._table(self.qcew_table)), start_year, end_year)

    def read_jolts(self, spark: SparkSession) -> DataFrame:
        return schemas.conform(spark.table(self._table(self.jolts_table)), schemas.JOLTS_INPUT)

    def jdbc_url(self) -> str:
        return f"{self.jdbc_scheme}://{self.host}:{self.port}/{self.catalog}/{self.schema}"

    def quarter_predicates(self, start_year: int, end_year: int) -> list[str]:
        """Disjoint slices, one per quarter and one for the rest, each with its own task."""
        quarters = [f"year = '{year:04d}' AND qtr = '{qtr}'"
                    for year in range(start_year, end_year + 1) for qtr in range(1, 5)]
        spelled = ", ".join(f"'{year:04d}'" for year in range(start_year, end_year + 1))
        # Other spellings of these years and other quarters.
        rest = (f"CAST(trim(year) AS INTEGER) BETWEEN {start_year} AND {end_year} "
                f"AND (year NOT IN ({spelled}) OR qtr NOT IN ('1', '2', '3', '4') OR qtr IS NULL)")
        return [*quarters, rest]

    def state_predicates(self) -> list[str]:
        """Disjoint slices, one per state, one for the nation and one for the rest."""
        codes = [fixed.NATIONAL_CODE, *(fips for fips, _, _ in fixed.STATES)]
        listed = ", ".join(f"'{code}'" for code in codes)
        rest = f"state_code NOT IN ({listed}) OR state_code IS NULL"
        return [*(f"state_code = '{code}'" for code in codes), rest]

    def _read_jdbc(self, spark: SparkSession, table: str, predicates: list[str]) -> DataFrame:
        return spark.read.jdbc(self.jdbc_url(), table, predicates=predicates,
                               properties={"fetchsize": str(self.fetch_size)})

    def read_qcew_jdbc(self, spark: SparkSession, start_year: int = 2003, end_year: int = 2025) -> DataFrame:
        rows = self._read_jdbc(spark, self.qcew_table, self.quarter_predicates(start_year, end_year))
        return schemas.conform(rows, schemas.QCEW_INPUT)

    def read_jolts_jdbc(self, spark: SparkSession) -> DataFrame:
        rows = self._read_jdbc(spark, self.jolts_table, self.state_predicates())
        return schemas.conform(rows, schemas.JOLTS_INPUT)
