"""Command line: ``python -m framewright {run,curate,audit,recaption,package} ...``; exit code 0 if the result is good."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from framewright.operators import captions, filters, ranking
from framewright.plans import pipeline
from framewright.plans import run as whole
from framewright.sources import images


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser("framewright", description=__doc__)
    modes = top.add_subparsers(dest="mode", required=True)
    curate = modes.add_parser("curate", help="select a portfolio from tables of metrics and verdicts")
    for name in ("metrics", "verdicts", "output"):
        curate.add_argument(f"--{name}", required=True, help="parquet")
    curate.add_argument("--target", type=int, default=30)
    curate.add_argument("--top-n", type=int, default=100)
    curate.add_argument("--era", default="all", help="YYYY or YYYY-YYYY")
    curate.add_argument("--dims", type=int, default=512, help="length of the feature vectors")
    curate.add_argument("--no-temporal-balance", action="store_true")
    curate.add_argument("--any-eyewear", action="store_true")
    curate.add_argument("--drop-sunglasses", action="store_true")
    run = modes.add_parser("run", help="from a folder of pictures to a curated, exported and captioned folder")
    for name in ("input", "detections", "verdicts", "boxes", "output", "trigger"):
        run.add_argument(f"--{name}", required=True)
    run.add_argument("--answers", help="parquet with stem and content: captions of a model")
    run.add_argument("--target", type=int, default=30)
    run.add_argument("--top-n", type=int, default=100)
    run.add_argument("--era", default="all")
    run.add_argument("--dims", type=int, default=512)
    run.add_argument("--square", action="store_true", help="crop to 1024 x 1024")
    again = modes.add_parser("recaption", help="write the captions of a folder anew")
    for name in ("folder", "trigger", "answers"):
        again.add_argument(f"--{name}", required=True)
    for name, text in (("audit", "audit a folder of captions"), ("package", "check picture and caption pairs of a folder")):
        mode = modes.add_parser(name, help=text)
        mode.add_argument("--folder", required=True)
        mode.add_argument("--trigger", required=True)
    mode.add_argument("--zip", help="write the pairs into this file")
    return top


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("framewright").getOrCreate()
    if a.mode == "curate":
        records = ranking.latest_records(spark.read.parquet(a.metrics))
        filters.require_images(records, a.target)
        found = pipeline.curate(records, spark.read.parquet(a.verdicts), a.target, a.top_n, a.era, a.dims, not a.no_temporal_balance, not a.any_eyewear, a.drop_sunglasses)
        found.write.mode("overwrite").parquet(a.output)
        n = spark.read.parquet(a.output).count()
        print(f"{n} pictures selected")
        return 0 if n else 1
    if a.mode == "run":
        read = spark.read.parquet
        report = whole.curate_folder(spark, a.input, a.output, a.trigger, read(a.detections), read(a.verdicts), read(a.boxes), (lambda _: read(a.answers)) if a.answers else None, target=a.target, top_n=a.top_n, era=a.era, dims=a.dims, preserve_aspect_ratio=not a.square)
        print(report)
        if report["few"]:
            print(f"fewer than {a.target} pictures passed")
        return 0 if report["exported"] and not report["faults"] else 1
    if a.mode == "recaption":
        done = whole.recaption(spark, a.folder, a.trigger, lambda _: spark.read.parquet(a.answers)).first()
        print(f"{done['succeeded']} of {done['total']} captions written")
        return 0 if done["succeeded"] else 1
    told = images.captions(spark, a.folder, a.trigger)
    if a.mode == "audit":
        audited = captions.audit(told, "text", F.lit(a.trigger))
        captions.violation_histogram(audited).orderBy(F.desc("n")).show(truncate=False)
        captions.failed_sample(audited, "stem").show(truncate=False)
        report = captions.audit_report(audited)
        report.show()
        return 0 if captions.audit_passes(report) else 1
    if a.zip:
        n, verdict = whole.pack(spark, a.folder, a.trigger, a.zip)
        print(f"{verdict}: {n} pairs")
        return 0 if n else 1
    files = images.curated(images.scan(spark, a.folder), a.trigger)
    stems = files.select(F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"^(.*)\.[^.]*$", 1).alias("stem"))
    summary = captions.package_summary(captions.pair_status(stems, told, "stem", "text", F.lit(a.trigger)))
    summary.show(truncate=False)
    return 0 if summary.first()["verdict"] == "packaged" else 1


if __name__ == "__main__":
    sys.exit(main())
