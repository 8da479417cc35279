"""Command line: python -m loanseason <step> --root <folder> ... (or through spark-submit)."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .config import SplitBands, TreeSettings
from .operators import quality, splits
from .plans import jobs
from .session import drop_scratch
from .sources import catalog, store


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="loanseason", description=__doc__)
    parser.add_argument("--root", required=True, help="folder that holds the stores and reports")
    steps = parser.add_subparsers(dest="step", required=True)

    step = steps.add_parser("ingest", help="convert a landing folder of vintage files")
    step.add_argument("landing")
    step.add_argument("--only", help="comma-separated years")
    step.add_argument("--overwrite", action="store_true")
    step.add_argument("--compression", default="snappy", choices=store.COMPRESSIONS)

    step = steps.add_parser("market", help="normalise rate series and the price index")
    step.add_argument("--series", action="append", default=[], metavar="NAME=PATH")
    step.add_argument("--price-index")
    step.add_argument("--check", action="store_true", help="only report what is present")

    step = steps.add_parser("features", help="build loan rows")
    step.add_argument("vintages", nargs="*")
    step.add_argument("--overwrite", action="store_true")
    step.add_argument("--publish", action="store_true", help="readers see all of the write or nothing of it")
    step.add_argument("--bucketed", action="store_true", help="read the store by loan")
    step.add_argument("--compression", default="snappy", choices=store.COMPRESSIONS)

    step = steps.add_parser("quality", help="check the contract; fails when a vintage fails")
    step.add_argument("--all-rules", action="store_true")

    step = steps.add_parser("validate", help="profile one stored vintage")
    step.add_argument("vintage")
    step.add_argument("--landing", help="folder of text files to hold the store against")

    step = steps.add_parser("bucket", help="write the raw store once more, bucketed by loan")
    step.add_argument("buckets", type=int)

    step = steps.add_parser("train", help="fit, score and report")
    step.add_argument("--rounds", type=int, default=TreeSettings().rounds)
    step.add_argument("--no-network", action="store_true")

    step = steps.add_parser("evaluate", help="apply the saved models to stored loan rows")
    step.add_argument("--split", default="val,test", help="comma-separated splits")

    steps.add_parser("splits", help="summary per split")
    steps.add_parser("catalog", help="views and their sizes")
    return parser.parse_args()


def main() -> int:
    args = _arguments()
    spark = SparkSession.builder.appName(f"loanseason-{args.step}").getOrCreate()
    try:
        return run(spark, args)
    finally:
        drop_scratch(spark)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    layout = jobs.Layout(args.root)
    if args.step == "ingest":
        years = [int(y) for y in args.only.split(",")] if args.only else None
        status = jobs.ingest(spark, layout, args.landing, years, args.overwrite, args.compression)
        status.show(1000, truncate=False)
        return int(not status.where("status = 'FAIL'").isEmpty())
    if args.step == "market":
        if not args.check:
            jobs.prepare_market(spark, layout, dict(s.split("=", 1) for s in args.series), args.price_index)
        tables = {"rates": layout.rates, "price_index": layout.price_index}
        checked = catalog.source_check(spark, tables)
        checked.show(truncate=False)
        return int(not checked.where("not present").isEmpty())
    if args.step == "features":
        table = "raw_by_loan" if args.bucketed else None
        jobs.build_features(spark, layout, args.vintages, args.overwrite, args.compression, table, args.publish).show(1000)
    elif args.step == "quality":
        contract = None
        if args.all_rules:
            from .config import QualityContract

            contract = QualityContract(all_declared=True)
        report = jobs.check_quality(spark, layout, contract)
        quality.quality_summary(report).show(truncate=False)
        return quality.quality_summary(report).first().exit_status
    elif args.step == "bucket":
        print(jobs.bucket_raw(spark, layout, args.buckets), "rows")
    elif args.step == "validate":
        for name, table in jobs.validate(spark, layout, args.vintage, args.landing).items():
            print(name)
            table.show(100, truncate=False)
    elif args.step == "train":
        settings = TreeSettings(rounds=args.rounds)
        network = None if args.no_network else jobs.NetworkSettings()
        jobs.train_and_evaluate(spark, layout, trees=settings, network=network).show(truncate=False)
    elif args.step == "evaluate":
        jobs.evaluate(spark, layout, shown=args.split.split(",")).show(truncate=False)
    elif args.step == "splits":
        splits.split_summary(store.read_features(spark, layout.features), SplitBands()).show()
    elif args.step == "catalog":
        raw, features = store.read_raw(spark, layout.raw), store.read_features(spark, layout.features)
        catalog.catalog_counts(raw, features).show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
