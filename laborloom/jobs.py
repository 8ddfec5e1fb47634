"""Batch jobs for ``spark-submit``.

    spark-submit --py-files laborloom.zip laborloom/jobs.py qcew  --bulk-path IN --output OUT
    spark-submit --py-files laborloom.zip laborloom/jobs.py jolts --jolts-path IN --output OUT
    spark-submit --py-files laborloom.zip laborloom/jobs.py series --series-path IN --output OUT [--rejects REFUSED]
    spark-submit --py-files laborloom.zip laborloom/jobs.py cluster --bulk-path IN --output OUT

Exit code 1 means there was nothing to write. An earlier output is then left alone, as it is when
a job fails.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from laborloom.plans import jolts, qcew
from laborloom.sinks import write_clustered, write_counted, write_staged
from laborloom.sources import read_jolts, read_qcew, read_series


#: What a job says of the numbers it has counted.
COUNTED = {"rows": "rows", "industry_code": "industries", "geographic_code": "geographies"}


def balanced(rows: DataFrame) -> DataFrame:
    """Evenly sized output files: rows that pass a scan unshuffled would leave a file per split."""
    return rows.hint("rebalance")


def run_qcew(spark: SparkSession, bulk_path: str, output: str) -> dict[str, int]:
    """Rows and industries written."""
    return write_counted(balanced(qcew.to_ces(read_qcew(spark, bulk_path))), output, ["industry_code"])


def run_jolts(spark: SparkSession, jolts_path: str, output: str) -> dict[str, int]:
    """Rows, industries and geographies written."""
    rows = jolts.ordered(jolts.to_ces(read_jolts(spark, jolts_path)))
    return write_counted(rows, output, ["industry_code", "geographic_code"])


def run_series(spark: SparkSession, series_path: str, output: str, rejects: str | None = None) -> int:
    """Turns series text files into the Parquet input of the turnover job. Malformed records
    stop it, or go to ``rejects`` where that is given."""
    series = read_series(spark, series_path)
    if rejects is None:
        return write_staged(balanced(jolts.select_series(series)), output)
    refused = write_staged(balanced(jolts.series_rejects(series)), rejects, allow_empty=True)
    print(f"series: {refused} records refused, in {rejects}", file=sys.stderr)
    return write_staged(balanced(jolts.select_series(series, strict=False)), output)


def run_cluster(spark: SparkSession, bulk_path: str, output: str) -> int:
    """Lays census files out by year, so that later reads of some years read those only."""
    return write_clustered(read_qcew(spark, bulk_path), output)


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="laborloom", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)
    for name, option, source, output in [
        ("qcew", "--bulk-path", "data/qcew_bulk.parquet", "data/qcew_ces.parquet"),
        ("jolts", "--jolts-path", "data/jolts.parquet", "data/jolts_ces.parquet"),
        ("series", "--series-path", "data/jolts_series.txt", "data/jolts.parquet"),
        ("cluster", "--bulk-path", "data/qcew_bulk.parquet", "data/qcew_by_year.parquet"),
    ]:
        command = commands.add_parser(name)
        command.add_argument(option, dest="source", default=source)
        command.add_argument("--output", default=output)
        if name == "series":
            command.add_argument("--rejects", help="folder for malformed records, which stop the job without it")
    args = parser.parse_args(argv)

    run = {"qcew": run_qcew, "jolts": run_jolts, "series": run_series, "cluster": run_cluster}[args.command]
    more = {"rejects": args.rejects} if args.command == "series" else {}
    spark = SparkSession.builder.appName(f"laborloom-{args.command}").getOrCreate()
    done = run(spark, args.source, args.output, **more)
    found = done if isinstance(done, dict) else {"rows": done}
    if not found["rows"]:
        print(f"{args.command}: the input gives no rows, nothing written", file=sys.stderr)
        return 1
    counts = [f"{found[name]} {said}" for name, said in COUNTED.items() if name in found]
    print(f"{args.command}: {', '.join(counts)} in {args.output}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
