from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborloom import schemas
from laborloom.operators import shared
from laborloom.plans import qcew

log = logging.getLogger(__name__)

#: Files that a refusal names.
NAMED_FILES = 5
#: Field metadata with the value that a file without the column is read with.
EXISTENCE_DEFAULT = "EXISTS_DEFAULT"


def _or_none(frame: Callable[[], DataFrame], path: str) -> DataFrame | None:
    """The frame, or None if its path does not exist."""
    try:
        return frame()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("input not found: %s", path)
        return None


def _marker(kind: T.DataType) -> str | None:
    """SQL literal at an end of a type's range, which no code or count has."""
    if isinstance(kind, T.IntegralType):
        bits = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}[kind.simpleString()]
        return f"CAST('{-(1 << bits - 1)}' AS {kind.simpleString()})"
    if isinstance(kind, T.DecimalType):
        return f"CAST('-{'9' * (kind.precision - kind.scale)}.{'9' * kind.scale}' AS {kind.simpleString()})"
    return {"string": "'￿'", "double": "-1.7976931348623157E308D", "float": "CAST('-3.4028235E38' AS FLOAT)",
            "date": "DATE'0001-01-01'", "timestamp": "TIMESTAMP'0001-01-01 00:00:00'"}.get(kind.simpleString())


def _folder_columns(stored: DataFrame, path: str) -> set[str]:
    """Columns that folder names below ``path`` hold, the same for every file of a table."""
    files = stored.inputFiles()
    below = files[0].rsplit(path.rstrip("/"), 1)[-1] if files else ""
    return {part.split("=", 1)[0] for part in below.split("/")[:-1] if "=" in part} & set(stored.columns)


def lacking_files(spark: SparkSession, path: str, fields: list[T.StructField], folders: list[T.StructField]) -> DataFrame:
    """(file, columns) of the files with rows that lack some of ``fields``.

    A distributed pass that reads little more than footers, through Spark's own reader and so in
    any store: a file without a column is read with a marker in its place, and files that have
    the column are skipped by their statistics, as no value of theirs is the marker. Files
    that store a column under a type that cannot be read as the stated one stop it.
    """
    literals = {f.name: _marker(f.dataType) for f in fields}
    if unknown := [f.name for f in fields if literals[f.name] is None]:
        raise ValueError(f"columns of unusable types: {', '.join(unknown)}")
    marked = [T.StructField(f.name, f.dataType, True, {EXISTENCE_DEFAULT: literals[f.name]}) for f in fields]
    rows = spark.read.schema(T.StructType([*marked, *folders])).parquet(path)
    tests = {f.name: F.expr(f"`{f.name}` = {literals[f.name]}") for f in fields}
    found = rows.where(reduce(lambda a, b: a | b, tests.values())).groupBy(F.col("_metadata.file_path").alias("file"))
    each = found.agg(*[F.max(test).alias(name) for name, test in tests.items()])
    return each.select("file", F.array_compact(F.array(*[F.when(F.col(n), n) for n in tests])).alias("columns"))


def _parquet(spark: SparkSession, path: str, schema: T.StructType, check: bool = True) -> DataFrame:
    """Parquet under its own schema; a missing path is an empty frame.

    Columns that folders name are read as text, since inferring their types would lose leading
    zeros. With ``check`` a file with rows that lacks a column of ``schema`` is refused by
    name; without it the column is NULL there.
    """
    path = str(path)
    stored = _or_none(lambda: spark.read.parquet(path), path)
    if stored is None:
        return spark.createDataFrame([], schema)
    in_folders = _folder_columns(stored, path)
    kinds = {f.name: f for f in stored.schema}
    folders = [schema[f.name] if f.name in schema.fieldNames() else f for f in stored.schema if f.name in in_folders]
    if check:
        fields = [kinds.get(f.name, f) for f in schema if f.name not in in_folders]
        bad = lacking_files(spark, path, fields, folders).orderBy("file").limit(NAMED_FILES).collect()
        if bad:
            raise ValueError("files lack columns: " + "; ".join(f"{r.file} lacks {', '.join(r.columns)}" for r in bad))
    if folders != [f for f in stored.schema if f.name in in_folders]:
        stored = spark.read.schema(T.StructType([f for f in stored.schema if f.name not in in_folders] + folders)).parquet(path)
    return stored


def read_qcew(spark: SparkSession, path: str, start_year: int | None = None, end_year: int | None = None,
              check: bool = True) -> DataFrame:
    """Census rows, of all years or of ``start_year`` to ``end_year``; a table that
    :func:`laborloom.sinks.write_clustered` wrote is read in the folders of these years only."""
    stored = _parquet(spark, path, schemas.QCEW_INPUT, check)
    return qcew.years_of(stored, start_year, end_year)


def read_jolts(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    return schemas.conform(_parquet(spark, path, schemas.JOLTS_INPUT, check), schemas.JOLTS_INPUT)


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated series files with a header line each, whose names decide and must agree;
    fields are stripped of padding. ``line`` is the text of records with too few or too many
    fields, else NULL. A missing path is an empty frame."""
    options = {"sep": "\t", "header": True, "ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True}
    rows = _or_none(lambda: spark.read.options(**options).csv(str(path)), path)
    if rows is None:
        return spark.createDataFrame([], schemas.SERIES_RECORD)
    header = T.StructType([T.StructField(c.strip(), T.StringType()) for c in rows.columns])
    line = schemas.SERIES_RECORD["line"]
    records = spark.read.schema(header.add(line)).options(
        **options, mode="PERMISSIVE", columnNameOfCorruptRecord=line.name, enforceSchema=False).csv(str(path))
    # Spark counts the fields of a record by the columns it reads, so all are read.
    return shared(schemas.conform(records, schemas.SERIES_RECORD))
