"""python -m parcelwise {manifest,gate,load,build} FOLDER [--tables ...] [--raw] [--marts]"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans import build as runs
from .quality import gate
from .quality.rules import WARN
from .session import configured
from .sources import files, layout, sinks


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="parcelwise", description=__doc__)
    parser.add_argument("action", choices=("manifest", "gate", "load", "build"))
    parser.add_argument("folder", help="folder with one CSV file per source table")
    parser.add_argument("--tables", nargs="*", help="subset of the source tables")
    parser.add_argument("--raw", help="root of the raw releases")
    parser.add_argument("--marts", help="root of the mart releases")
    parser.add_argument("--encoding", default="UTF-8", help="of the CSV files")
    parser.add_argument("--keep", type=int, default=3, help="releases that stay after a build")
    args = parser.parse_args(argv)

    paths = runs.csv_paths(args.folder, args.tables)
    spark = configured(SparkSession.builder.appName("parcelwise")).getOrCreate()
    if args.action == "manifest":
        files.manifest(spark, paths, layout.EXPECTED_ROWS,
                       encoding=args.encoding).show(truncate=False)
        return 0
    try:
        if args.action == "gate":
            report = gate.report(gate.file_results(spark, paths, layout.EXPECTED_ROWS, WARN,
                                                    encoding=args.encoding))
            print(report.summary())
            return int(report.blocked)
        if args.action == "load":
            load = runs.load_raw(spark, paths, layout.EXPECTED_ROWS, args.raw,
                                 encoding=args.encoding)
            spark.createDataFrame(load.reconciliation).show(truncate=False)
            return 0
        report = runs.build(spark, paths, layout.EXPECTED_ROWS, args.raw, args.marts,
                            encoding=args.encoding, keep=args.keep)
        print(report.summary())
        return 0
    except (gate.GateRed, runs.LoadMismatch, sinks.ReleaseConflict) as stop:
        print(stop, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
