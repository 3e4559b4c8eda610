"""Command line: ``python -m gridlake --folder F --landing DIR --raw DIR [--force]``."""

from __future__ import annotations

import argparse
import sys

from gridlake.plans.ingest import Target, ingest_folder
from gridlake.session import build_session

DEFAULT_FOLDER = "EnergyPrices_12.1.D_r3"


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="gridlake", description="Land delimited market files in the lakehouse.")
    parser.add_argument("--folder", default=DEFAULT_FOLDER, help="landing sub-folder to ingest")
    parser.add_argument("--landing", required=True, help="directory that holds the landing folders")
    parser.add_argument("--raw", required=True, help="raw zone path")
    parser.add_argument("--database", default="bronze")
    parser.add_argument("--warehouse", default=None, help="location of the bronze database")
    parser.add_argument("--format", default="parquet", choices=["parquet", "iceberg"], dest="table_format")
    parser.add_argument("--schema", default=None, help="DDL of the raw columns; inferred when absent")
    parser.add_argument("--force", action="store_true", help="reload files that already landed")
    args = parser.parse_args(argv)

    target = Target(args.raw, args.database, location=args.warehouse, table_format=args.table_format)
    spark = build_session("gridlake-ingest")
    try:
        handled = ingest_folder(spark, args.landing, args.folder, target, args.force, schema=args.schema)
        print(f"ingested {handled.count()} file(s) into {target.full_name(args.folder)}")
        return 0
    except Exception as error:
        print(f"ingestion failed: {error}", file=sys.stderr)
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
