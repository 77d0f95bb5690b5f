"""python -m tapeline import {daily,index-daily,minute,minute-s3} FOLDER --lake LAKE [--new]"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tapeline.sources.lake import PART_ROWS, Lake


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tapeline", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("import", help="CSV and ZIP files into the lake (any file system that Spark reads and writes)")
    load.add_argument("kind", choices=["daily", "index-daily", "minute", "minute-s3"])
    load.add_argument("folder")
    load.add_argument("--lake", required=True)
    load.add_argument("--part-rows", type=int, default=PART_ROWS, help="rows of a file of minute bars at most")
    load.add_argument("--new", action="store_true", help="only files that came since the last such import, by a stream that ends; for a scheduler")
    args = parser.parse_args(argv)
    if args.kind == "minute-s3" and not args.lake.startswith(("s3a://", "s3://")):
        parser.error("minute-s3 writes to a lake at s3a://")
    spark = SparkSession.builder.appName("tapeline").getOrCreate()
    lake = Lake(spark, args.lake, args.part_rows)
    print((lake.import_stream if args.new else lake.import_files)(args.kind.removesuffix("-s3"), args.folder))


if __name__ == "__main__":
    main()
