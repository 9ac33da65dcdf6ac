"""Bring an archive up to date: ``spark-submit`` this module, or ``python -m dryspell``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from dryspell.operators.quality import SAMPLE_ROWS
from dryspell.plans.archive import rebuild


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="dryspell")
    parser.add_argument(
        "--manifest", action="append", required=True, metavar="SOURCE=PATH",
        help="text manifest of one source; repeat per source",
    )
    parser.add_argument("--crosswalk", required=True, help="office to unit crosswalk (Parquet)")
    parser.add_argument("--windows", required=True, help="grazing windows (Parquet)")
    parser.add_argument("--out", required=True, help="folder of the archive")
    parser.add_argument("--base-url", required=True, help="where the archive is published")
    parser.add_argument("--prefix", default="", help="key prefix of the archive in its store")
    parser.add_argument("--posted", help="posted URLs (text, one a line); else the folders are listed")
    parser.add_argument("--remote", help="saved listing responses of the store, to verify the files against")
    parser.add_argument("--salts", type=int, default=1, help="slots per unit and time bin")
    args = parser.parse_args(argv)
    args.manifest = dict(entry.split("=", 1) for entry in args.manifest)
    return args


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = (
        SparkSession.builder.appName("dryspell")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    posted = spark.read.text(args.posted).toDF("url") if args.posted else None
    _, build = rebuild(
        spark, args.manifest, args.crosswalk, args.windows, args.out, args.base_url, args.prefix,
        posted, args.remote, salts=args.salts,
    )
    print(f"version {build.version.number}: {build.built.count()} file(s) built, {build.skipped.count()} skipped")
    build.skipped.orderBy("file").show(SAMPLE_ROWS, truncate=False)


if __name__ == "__main__":
    main()
