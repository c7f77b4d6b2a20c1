"""Whole runs over folders: from pictures to a captioned, checked and packed set, and captions written anew."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions import text
from framewright.operators import captions, export, filters
from framewright.plans import pipeline
from framewright.sources import images, metrics, raster
from framewright.storage import materialize

Provider = Callable[[DataFrame], DataFrame]
#: Pairs of a package at most; larger sets stay folders or tables.
MAX_PACKED = 10_000


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_extract(file_name(path), r"^(.*)\.[^.]*$", 1)


def candidates(spark: SparkSession, folder: str, detections: DataFrame) -> DataFrame:
    """Records of the first pass: pictures of ``folder`` that can be decoded, with their metrics, date and detector results.

    ``detections`` has ``name`` (file name), ``faces``, ``hands`` and ``feature_vector``. A picture without a
    row there, or that cannot be decoded, is refused. ``path`` becomes the file name.
    """
    files = images.facts(images.scan(spark, folder, contents=True)).select(file_name(F.col("path")).alias("path"), "captured_at", "year")
    found = detections.dropDuplicates(["name"]).withColumnRenamed("name", "path")
    pictures = raster.decoded(spark, folder).withColumn("path", file_name(F.col("path"))).join(found, "path")
    measured = metrics.picture_metrics(pictures.withColumn("box", _box()), box="box")
    rows = pictures.drop("data", "channels").join(measured, "path").join(files, "path")
    return materialize(filters.first_pass(rows), "accepted")


def _box() -> Column:
    from framewright.functions import geometry

    return geometry.native_box(F.try_element_at("faces", F.lit(1)), F.col("width"), F.col("height"))


def curate_folder(spark: SparkSession, folder: str, output: str, trigger: str, detections: DataFrame, verdicts: DataFrame, boxes: DataFrame, provider: Provider | None = None, template: str = "{lead}", target: int = 30, top_n: int = 100, era: str | None = None, dims: int = 512, preserve_aspect_ratio: bool = True, **options: bool) -> dict:
    """Scan, measure, filter, curate, export, caption and audit one folder.

    ``verdicts`` and ``boxes`` have the file name in ``path``; ``provider`` writes captions (none are written without one).
    Raises ``filters.TooFewImages`` if the folder has fewer than one and a half times ``target`` pictures or none
    survives. Returns counts: ``scanned``, ``accepted``, ``few`` (fewer survivors than the target), ``exported``,
    ``captioned``, ``pass_rate`` and ``faults`` (see ``export_faults``).
    """
    scanned = filters.require_images(images.scan(spark, folder), target)
    records = candidates(spark, folder, detections).withColumn("lighting_condition", F.lit(None).cast("string"))
    records = records.withColumn("has_sunglasses", F.lit(False)).withColumn("has_face_occlusion", F.lit(False))
    accepted, few = filters.require_survivors(records, target)
    chosen = materialize(pipeline.curate(records, verdicts, target, top_n, era, dims, **options), "chosen")
    plan = materialize(export.export_plan(chosen, boxes, trigger, "png", preserve_aspect_ratio), "plan")
    pictures = raster.decoded(spark, folder).withColumn("path", file_name(F.col("path")))
    images.write_files(raster.rendered(pictures, plan), output)
    report = {"scanned": scanned, "accepted": accepted, "few": few, "exported": plan.count(), "captioned": 0, "pass_rate": 0.0, "faults": export_faults(spark, output, plan).count()}
    if provider is not None:
        facts = chosen.join(plan.select("path", "out_name"), "path")
        opening = text.lead(F.lit(trigger), F.col("composition"))
        asked = facts.select(stem(F.col("out_name")).alias("stem"), text.prompt(template, opening, *text.prompt_notes(F.col("hand_status"), F.col("hands_truncated"), F.col("year"))).alias("prompt"), F.lit(trigger).alias("trigger"), opening.alias("lead"))
        told = materialize(captions.generate(asked, provider), "told")
        images.write_captions(told.select("stem", F.col("caption").alias("text")), output)
        rates = captions.audit_report(captions.audit(told, "caption", F.lit(trigger))).first()
        report |= {"captioned": told.count(), "pass_rate": rates["pass_rate"]}
    return report


def export_faults(spark: SparkSession, folder: str, plan: DataFrame) -> DataFrame:
    """``out_name`` and ``fault`` of what is not in the folder as planned: missing, unreadable or of another size."""
    have = images.facts(images.scan(spark, folder, contents=True)).select(file_name(F.col("path")).alias("out_name"), "width", "height", F.lit(True).alias("here"))
    square = "x" in plan.schema["target"].dataType.fieldNames()
    size = (F.lit(1024), F.lit(1024)) if square else (F.col("target.w"), F.col("target.h"))
    rows = plan.join(have, "out_name", "left")
    fault = F.when(F.col("here").isNull(), "missing").when(F.col("width").isNull(), "unreadable").when((F.col("width") != size[0]) | (F.col("height") != size[1]), "size")
    return rows.select("out_name", fault.alias("fault")).where("fault is not null")


def recaption(spark: SparkSession, folder: str, trigger: str, provider: Provider, template: str = "{lead}", retries: int = 2) -> DataFrame:
    """Captions all pictures of a finished folder anew, in place; one row ``succeeded``, ``total``.

    The pictures are those named after the trigger, or all if none is. The composition is
    read off the old caption (medium without one). A picture for which no answer can be used keeps its
    old caption and counts as not succeeded.
    """
    files = images.curated(images.scan(spark, folder), trigger, fall_back=True).select(stem(F.col("path")).alias("stem")).distinct()
    old = images.captions(spark, folder, trigger).dropDuplicates(["stem"]).withColumnRenamed("text", "old")
    rows = materialize(files.join(old, "stem", "left"), "recaption")  # the old captions are read before they are replaced
    opening = text.lead(F.lit(trigger), text.composition_of_caption(F.coalesce("old", F.lit(""))))
    none = F.lit("")
    asked = rows.select("stem", text.prompt(template, opening, none, none).alias("prompt"), F.lit(trigger).alias("trigger"), opening.alias("lead"))
    told = materialize(captions.generate(asked, provider, retries), "told")
    images.write_captions(told.select("stem", F.col("caption").alias("text")), folder)
    return captions.recaption_report(rows.join(told.select("stem", F.lit(True).alias("ok")), "stem", "left").select(F.coalesce("ok", F.lit(False)).alias("ok")))


def pack(spark: SparkSession, folder: str, trigger: str, target: str) -> tuple[int, str]:
    """Writes the folder's pairs into one zip file if all of them are sound; number of pairs and the verdict.

    All or nothing: with a missing, empty or untriggered caption no file is written. At most ``MAX_PACKED`` pairs.
    """
    files = images.curated(images.scan(spark, folder, contents=True), trigger, fall_back=True).select(file_name(F.col("path")).alias("name"), stem(F.col("path")).alias("stem"), "content")
    told = images.captions(spark, folder, trigger).dropDuplicates(["stem"])
    summary = captions.package_summary(captions.pair_status(files.select("stem"), told, "stem", "text", F.lit(trigger))).first()
    if summary["verdict"] != "packaged":
        return 0, summary["verdict"]
    if summary["images"] > MAX_PACKED:
        raise ValueError(f"more than {MAX_PACKED} pairs")
    pairs = ((r["name"], bytes(r["content"]), text_of(r["text"])) for r in files.join(told, "stem").orderBy("name").toLocalIterator())
    return images.package(pairs, target), "packaged"


def text_of(value: str | None) -> str:
    return (value or "").strip()
