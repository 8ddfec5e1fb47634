"""Parquet outputs that replace an earlier one only as a whole, and the layout of census tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from laborloom import schemas


class Target:
    """An output folder and its hidden neighbours, in whatever file system it lies.

    New files go to a neighbour. Only when all are written does the earlier output step aside
    and the new one take its name, two renames of folders; then the earlier one is deleted.
    A run that dies between the two leaves the earlier output aside, and the next run, or
    :meth:`recover`, puts it back. In object stores a rename copies, and readers that come
    between the two find nothing.
    """

    def __init__(self, spark: SparkSession, output: str) -> None:
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.path = self._path(str(output))
        self.files = self.path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.path = self.files.makeQualified(self.path)
        self.staging = self._beside(f"staging-{uuid.uuid4().hex}")

    def _beside(self, name: str):
        return self._path(self.path.getParent(), f".{self.path.getName()}.{name}")

    def _move(self, source, target) -> None:
        if not self.files.rename(source, target):
            raise OSError(f"cannot rename {source} to {target}")

    def recover(self) -> None:
        """Put an earlier output back that a run left aside."""
        aside = self.files.globStatus(self._beside("previous-*"))
        if not self.files.exists(self.path) and aside is not None and len(aside):
            self._move(max(aside, key=lambda status: status.getModificationTime()).getPath(), self.path)

    def publish(self) -> None:
        """Let the staged files take the output's place."""
        previous = self._beside(f"previous-{uuid.uuid4().hex}")
        existed = self.files.exists(self.path)
        if existed:
            self._move(self.path, previous)
        try:
            self._move(self.staging, self.path)
        except Exception:
            if existed:
                self._move(previous, self.path)
            raise
        if existed:
            self.files.delete(previous, True)

    def discard(self) -> None:
        self.files.delete(self.staging, True)


def write_counted(rows: DataFrame, output: str, distinct: Sequence[str] = (), partition_by: Sequence[str] = (),
                  allow_empty: bool = False) -> dict[str, int]:
    """Writes ``rows`` as Parquet; their number, under ``rows``, and the exact number of different
    values, NULL one of them, in the columns ``distinct``, all from the run that writes.

    The columns must be ones of few values, such as codes: each task sends its own. The output
    changes only if all rows were written and, unless ``allow_empty``, there are any; after a
    failure or without rows it is what it was.
    """
    target = Target(rows.sparkSession, output)
    target.recover()
    seen = Observation("written")
    values = [F.collect_set(F.struct(F.col(c))).alias(c) for c in distinct]
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *values)
    try:
        counted.write.partitionBy(*partition_by).parquet(target.staging.toString())
        found = {name: value if name == "rows" else len(value) for name, value in seen.get.items()}
        if found["rows"] or allow_empty:
            target.publish()
    finally:
        target.discard()  # what is left of it
    return found


def write_staged(rows: DataFrame, output: str, partition_by: Sequence[str] = (), allow_empty: bool = False) -> int:
    """:func:`write_counted` for the number of rows alone."""
    return write_counted(rows, output, (), partition_by, allow_empty)["rows"]


def clustered(bulk: DataFrame) -> DataFrame:
    """Census rows with the number of their year, those of a year, ownership and level together.

    Large groups are cut, so that none is one task's. Sorted inside, each file has narrow
    statistics of what the plans filter by.
    """
    key = [schemas.YEAR_NUMBER, "own_code", "agglvl_code"]
    numbered = schemas.conform(bulk, schemas.QCEW_INPUT).withColumn(
        schemas.YEAR_NUMBER, F.expr(schemas.strict_cast("year", "INT")))
    return numbered.hint("rebalance", *map(F.col, key)).sortWithinPartitions(*key, "industry_code", "area_fips")


def write_clustered(bulk: DataFrame, output: str) -> int:
    """Writes census rows in folders by the number of their year; :func:`laborloom.read_qcew` reads
    the folders of the years it is asked for. The text of the year is kept as it is."""
    return write_staged(clustered(bulk), output, [schemas.YEAR_NUMBER])
