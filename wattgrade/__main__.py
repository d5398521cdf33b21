"""Batch jobs: python -m wattgrade JOB --option value …, or through spark-submit with the package as --py-files."""

from __future__ import annotations

import argparse

from wattgrade.plans import medallion
from wattgrade.session import build_session


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="wattgrade")
    jobs = root.add_subparsers(dest="job", required=True)
    options = {
        "class-silver": ("bronze", "silver"),
        "class-gold": ("silver", "gold"),
        "dataset-silver": ("bronze", "silver"),
        "consumption-silver": ("document", "silver"),
        "model-gold": ("diagnostics", "consumption", "gold"),
        "sample": ("bronze", "out"),
    }
    for job, names in options.items():
        command = jobs.add_parser(job)
        for name in names:
            command.add_argument(f"--{name}", required=True)
        if job in ("class-silver", "dataset-silver"):
            command.add_argument("--rejected", help="where to keep lines that are no record")
        if job == "class-silver":
            command.add_argument("--versioned", action="store_true", help="readers keep the old table until the new one is whole")
    return root


def main() -> None:
    args = parser().parse_args()
    spark = build_session(f"wattgrade-{args.job}")
    if args.job == "class-silver":
        print(medallion.write_class_silver(spark, args.bronze, args.silver, args.rejected, args.versioned))
    elif args.job == "class-gold":
        medallion.write_class_gold(spark, args.silver, args.gold).show()
    elif args.job == "dataset-silver":
        print(medallion.write_dataset_silver(spark, args.bronze, args.silver, args.rejected))
    elif args.job == "consumption-silver":
        medallion.write_consumption_silver(spark, args.document, args.silver)
    elif args.job == "model-gold":
        medallion.write_model_gold(spark, args.diagnostics, args.consumption, args.gold).show()
    else:
        medallion.write_sample(spark, args.bronze, args.out)
    spark.stop()


if __name__ == "__main__":
    main()
