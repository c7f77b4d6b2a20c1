"""Registry of the engine's queries; the SQL that checks them is in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions import geometry, pixels, text, vectors
from framewright.operators import captions, export, filters, ranking, refinement, selection
from framewright.plans import oracle, pipeline
from framewright.sources import images, metrics
from framewright.storage import materialize, read_table, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
POOL, SEATS, DIMS = 100, 30, 64
PICTURES_A_TASK = 100_000
CLOSE = 0.6  # near-duplicate distance of the queries over pools whose vectors are far apart


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)


# ---- tables ------------------------------------------------------------------------------------


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per picture: its latest scan, with tidy compositions."""
    rows = ranking.latest_records(read_table(spark, sf_dir, "image_metrics"))
    tidy = F.regexp_replace(F.lower(F.trim("composition")), "[ _]", "-")
    return rows.withColumn("composition", tidy)


def triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("image_id", "trigger_word", "composition")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions, spread over the cores: their rules are many patterns a row."""
    return spread(read_table(spark, sf_dir, "documents").select("doc_id", "text", "trigger_word", "source"))


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second pass's pool of records with a usable vector."""
    rows = pipeline.pool_of(records(spark, sf_dir).where(vectors.usable(F.col("feature_vector"), DIMS)), POOL, tie="path")
    return materialize(rows.select("path", "place", "composition", "year", "head_pose", "total_score", "feature_vector"), "pool")


def portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pool with the turns of the third pass and the verdicts."""
    rows = pool(spark, sf_dir)
    turns = selection.diverse_selection(rows, SEATS, threshold=CLOSE)
    return materialize(refinement.with_verdicts(rows.join(F.broadcast(turns), "path", "left"), read_table(spark, sf_dir, "vlm_verdicts")), "portfolio")


def key_number(a: int, b: int = 0, m: int = 1000) -> Column:
    return F.pmod(F.col("p_partkey") * a + b, F.lit(m))


def picture_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the arithmetic pictures, dealt out by their hash: pixels and facts made of them meet without being moved."""
    keys = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("img_id"))
    return keys.repartition(max(3 * spark.sparkContext.defaultParallelism, -(-keys.count() // PICTURES_A_TASK)), "img_id")


def pixel_grid(spark: SparkSession, sf_dir: str, size: int = 12, keys: DataFrame | None = None) -> DataFrame:
    """Arithmetic pictures, one per part (or per row of ``keys``)."""
    rows = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("img_id")) if keys is None else keys
    rows = rows.select("img_id", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("y")).select("*", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("x"))
    dark = (F.col("img_id") % 5 == 0) & ((F.col("y") < 1) | (F.col("y") >= size - 1))
    value = lambda a, b, c: F.when(dark, 3).otherwise(((F.col("img_id") * a + F.col("y") * b + F.col("x") * c) % 256).cast("int"))
    return rows.select("img_id", "y", "x", value(13, 5, 3).alias("b"), value(31, 17, 7).alias("g"), value(7, 11, 19).alias("r"))


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# ---- captions ----------------------------------------------------------------------------------


def _audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions.audit(documents(spark, sf_dir), "text", F.col("trigger_word"))


@query
def caption_audit_flags(spark, sf_dir):
    return _audited(spark, sf_dir).select("doc_id", text.word_count(F.col("text")).alias("words"), F.array_join("violations", "; ").alias("violations"), "passed")


@query
def caption_audit_report(spark, sf_dir):
    return captions.audit_report(_audited(spark, sf_dir))


@query
def caption_violation_histogram(spark, sf_dir):
    return captions.violation_histogram(_audited(spark, sf_dir))


@query
def caption_failed_sample(spark, sf_dir):
    return captions.failed_sample(_audited(spark, sf_dir), "doc_id").select("doc_id", F.array_join("violations", "; ").alias("violations"))


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct attempts with trigger, lead, cleaned text and audit."""
    rows = spread(read_table(spark, sf_dir, "caption_attempts").select("attempt_id", "image_id", "attempt", "content")).distinct()
    rows = rows.join(triggers(spark, sf_dir), "image_id", "left").withColumn("trigger", F.coalesce("trigger_word", F.lit("subject")))
    rows = rows.withColumn("lead", text.lead(F.col("trigger"), F.col("composition")))
    rows = rows.withColumn("clean", text.cleaned(F.col("content"), F.col("trigger"), F.col("lead")))
    rows = rows.select("attempt_id", "image_id", "attempt", "content", "trigger", "clean.*")
    return rows.withColumn("violations", text.audit_violations(F.col("text"), F.col("trigger"))).withColumn("passed", F.col("ok") & (F.size("violations") == 0))


@query
def caption_clean(spark, sf_dir):
    return _attempts(spark, sf_dir).select("attempt_id", "ok", "text", "reason")


@query
def caption_sanitize(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.sanitized(F.col("text")).alias("text"))


@query
def first_passing_attempt(spark, sf_dir):
    return captions.chosen_attempt(_attempts(spark, sf_dir), "image_id", "attempt", "ok", "passed", "text")


@query
def recaption_report(spark, sf_dir):
    tries = _attempts(spark, sf_dir).groupBy("image_id").agg(F.bool_or("ok").alias("ok"))
    return captions.recaption_report(tries)


@query
def caption_lead(spark, sf_dir):
    return triggers(spark, sf_dir).select("image_id", text.lead(F.col("trigger_word"), F.col("composition")).alias("lead"))


@query
def caption_composition(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.composition_of_caption(F.col("text")).alias("composition"))


@query
def retry_temperature(spark, sf_dir):
    rows = read_table(spark, sf_dir, "caption_attempts").select("attempt_id", "attempt").distinct()
    return rows.select("attempt_id", F.round(text.retry_temperature(F.col("attempt") - 1), 6).alias("temperature"))


@query
def destination_slug(spark, sf_dir):
    return triggers(spark, sf_dir).select("image_id", text.destination_slug(F.col("trigger_word")).alias("slug"))


@query
def prompt_assembly(spark, sf_dir):
    rows = records(spark, sf_dir)
    hand, era = text.prompt_notes(F.col("hand_status"), F.col("hands_truncated"), F.col("year"))
    opening = text.lead(F.col("trigger_word"), F.col("composition"))
    return rows.select("image_id", text.prompt("Open with '{lead}'. Place the hands{hand_note}.{era_note}", opening, hand, era).alias("prompt"))


@query
def feedback_prompt(spark, sf_dir):
    rows = _audited(spark, sf_dir)
    return rows.select("doc_id", text.feedback_prompt(F.lit("Describe the picture."), F.col("violations")).alias("prompt"))


@query
def verdict_parse(spark, sf_dir):
    rows = read_table(spark, sf_dir, "vlm_verdicts").distinct()
    answer = F.concat_ws(" ", F.when(F.col("is_single"), "SINGLE_PERSON").otherwise("MULTIPLE_PEOPLE"), "lighting", F.when(F.col("has_sunglasses"), "EYEWEAR: SUNGLASSES").otherwise("NO_SUNGLASSES"), F.when(F.col("has_face_occlusion"), "FACE_OCCLUDED"))
    return rows.select("path", "checked_at", text.parsed_verdict(answer).alias("v")).select("path", "checked_at", "v.*")


@query
def pair_validation(spark, sf_dir):
    return _pairs(spark, sf_dir)


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = read_table(spark, sf_dir, "caption_attempts").groupBy("image_id").agg(F.max_by("content", F.struct("attempt", "attempt_id")).alias("content"))
    return captions.pair_status(records(spark, sf_dir).select("image_id", "trigger_word"), told, "image_id", "content", F.col("trigger_word"))


@query
def package_summary(spark, sf_dir):
    return captions.package_summary(_pairs(spark, sf_dir))


# ---- scans, filters, eras ----------------------------------------------------------------------


@query
def distinct_paths(spark, sf_dir):
    return filters.distinct_paths(read_table(spark, sf_dir, "image_metrics").select("path")).select("path", "ord")


@query
def dimension_report(spark, sf_dir):
    return images.dimension_report(records(spark, sf_dir))


@query
def resolution_filter(spark, sf_dir):
    return records(spark, sf_dir).where(filters.large_enough(F.col("width"), F.col("height"))).select("path", "width", "height")


@query
def era_window(spark, sf_dir):
    return filters.era_window(records(spark, sf_dir), "2018-2022").select("path", "year")


@query
def era_window_empty_fallback(spark, sf_dir):
    return filters.era_window(records(spark, sf_dir), "1901").select("path", "year")


@query
def capture_dates(spark, sf_dir):
    stamp = F.date_format("captured_at", "yyyy:MM:dd HH:mm:ss")
    exif = F.when(F.col("image_id") % 7 == 0, F.replace(stamp, F.lit(":"), F.lit("-"))).when(F.col("image_id") % 11 == 0, "no date").otherwise(stamp)
    return records(spark, sf_dir).select("image_id", images.capture_date(exif, F.col("scanned_at")).alias("taken"))


@query
def face_geometry_filter(spark, sf_dir):
    points = F.array(
        F.struct((0.40 - key_number(3, 1, 10) * 0.005).alias("x"), F.lit(0.30).alias("y")), F.struct((0.43 + key_number(7, 2, 10) * 0.005).alias("x"), F.lit(0.31).alias("y")),
        F.struct((0.40 + key_number(11, 3, 20) * 0.005).alias("x"), (0.26 + key_number(13, 0, 20) * 0.01).alias("y")), F.struct(F.lit(0.45).alias("x"), (0.31 + key_number(17, 5, 20) * 0.01).alias("y")))
    face = F.struct((0.5 + key_number(19, 0, 50) * 0.01).alias("score"), F.lit(0.3).alias("x"), (key_number(23, 0, 60) * 0.01).alias("y"), F.lit(0.2).alias("w"), F.lit(0.25).alias("h"), points.alias("keypoints"))
    faces = F.when(key_number(1, 0, 9) == 0, F.array(face, face)).when(key_number(1, 0, 9) == 1, F.lit(None)).otherwise(F.array(face))
    hand = F.transform(F.sequence(F.lit(0), F.lit(20)), lambda i: F.struct((F.pmod(F.col("p_partkey") * 3 + i * 7, F.lit(101)) / 100.0).alias("x"), F.lit(0.5).alias("y")))
    rows = read_table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("path"), (key_number(37, 0, 2000) + 500).cast("int").alias("width"), (key_number(41, 0, 2000) + 500).cast("int").alias("height"), F.lit(False).alias("letterboxed"), faces.alias("faces"), F.array(hand).alias("hands"))
    return filters.first_pass(materialize(rows, "detections")).select("path", "composition", "head_pose", "hand_count", "hands_truncated", "hand_status")


@query
def composition_class(spark, sf_dir):
    return records(spark, sf_dir).select("path", geometry.composition_class(F.col("face_box"), F.col("width"), F.col("height")).alias("composition"))


@query
def composition_class_counts(spark, sf_dir):
    return composition_class(spark, sf_dir).groupBy("composition").agg(F.count("*").alias("n"))


@query
def head_pose(spark, sf_dir):
    rows = read_table(spark, sf_dir, "part")
    return rows.select("p_partkey", geometry.head_pose(key_number(3, 0, 100) / 100.0, key_number(7, 0, 100) / 100.0, key_number(11, 0, 100) / 100.0).alias("head_pose"))


@query
def hand_truncation(spark, sf_dir):
    hand = lambda a: F.transform(F.sequence(F.lit(0), F.lit(20)), lambda i: F.struct((F.pmod(F.col("p_partkey") * a + i * 7, F.lit(101)) / 100.0).alias("x"), (F.pmod(F.col("p_partkey") + i * a, F.lit(97)) / 96.0).alias("y")))
    hands = F.when(key_number(1, 0, 4) == 0, F.lit(None)).when(key_number(1, 0, 4) == 1, F.array(hand(3))).otherwise(F.array(hand(5), hand(9)))
    return read_table(spark, sf_dir, "part").select("p_partkey", geometry.hand_facts(hands).alias("f")).select("p_partkey", "f.*")


# ---- sizes and boxes ---------------------------------------------------------------------------


@query
def canonical_scale(spark, sf_dir):
    size = geometry.canonical_size(F.col("width"), F.col("height"))
    return records(spark, sf_dir).select("path", size.alias("s")).select("path", "s.w", "s.h", F.round("s.scale", 9).alias("scale"))


@query
def detection_scale(spark, sf_dir):
    return records(spark, sf_dir).select("path", geometry.detection_size(F.col("width") * 4, F.col("height") * 4).alias("s")).select("path", "s.*")


@query
def native_boxes(spark, sf_dir):
    rel = F.struct(*[(F.col("face_box")[c] / 3000.0).alias(c) for c in "xywh"])
    return records(spark, sf_dir).where("face_box is not null").select("path", geometry.native_box(rel, F.col("width"), F.col("height")).alias("b")).select("path", "b.*")


@query
def aspect_bucket(spark, sf_dir):
    return records(spark, sf_dir).select("path", geometry.aspect_bucket(F.col("width"), F.col("height")).alias("s")).select("path", "s.*")


@query
def square_crop(spark, sf_dir):
    return records(spark, sf_dir).select("path", geometry.square_crop(F.col("width"), F.col("height"), F.col("face_box")).alias("s")).select("path", "s.*")


def _boxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = read_table(spark, sf_dir, "ocr_boxes").groupBy("path").agg(F.flatten(F.collect_list("boxes")).alias("boxes"))
    return records(spark, sf_dir).select("path", "width", "height").join(boxes, "path")


@query
def watermark_boxes(spark, sf_dir):
    rows = _boxed(spark, sf_dir).select("path", F.explode(geometry.blur_boxes(F.col("boxes"), F.col("width"), F.col("height"))).alias("b")).select("path", "b.*")
    return rows.groupBy("path", "x0", "y0", "x1", "y1").agg(F.count("*").alias("n"))


@query
def watermark_free(spark, sf_dir):
    return _boxed(spark, sf_dir).where(F.size(geometry.blur_boxes(F.col("boxes"), F.col("width"), F.col("height"))) == 0).select("path")


@query
def format_resolution(spark, sf_dir):
    form = export.output_format(F.col("path"), "preserve")
    return records(spark, sf_dir).select("path", form.alias("f")).select("path", "f.*")


@query
def output_numbering(spark, sf_dir):
    rows = records(spark, sf_dir).select("path", "width", "height", "face_box", F.col("path").alias("seat"))
    boxes = read_table(spark, sf_dir, "ocr_boxes").groupBy("path").agg(F.flatten(F.collect_list("boxes")).alias("boxes"))
    return export.export_plan(rows, boxes, "velqo", "preserve", drop_watermarked=True).select("path", "out_name", "format")


# ---- pixels ------------------------------------------------------------------------------------


@query
def pixel_laplacian(spark, sf_dir):
    return rounded(pixels.sharpness(pixel_grid(spark, sf_dir)), "sharpness")


@query
def pixel_face_sharpness(spark, sf_dir):
    keys = picture_keys(spark, sf_dir)
    boxes = keys.select("img_id", (F.col("img_id") % 6 - 2).alias("x0"), (F.col("img_id") % 5).alias("y0"), (F.col("img_id") % 6 + 4).alias("x1"), (F.col("img_id") % 5 + 5).alias("y1"))
    return rounded(pixels.face_sharpness(pixel_grid(spark, sf_dir, keys=keys), boxes), "face_sharpness")


@query
def pixel_exposure(spark, sf_dir):
    return rounded(pixels.exposure(pixel_grid(spark, sf_dir)), "exposure_score")


@query
def pixel_contrast(spark, sf_dir):
    return rounded(pixels.contrast(pixel_grid(spark, sf_dir)), "contrast")


@query
def pixel_colorfulness(spark, sf_dir):
    return rounded(pixels.colorfulness(pixel_grid(spark, sf_dir)), "colorfulness")


@query
def pixel_noise(spark, sf_dir):
    return rounded(pixels.noise(pixel_grid(spark, sf_dir)), "noise")


@query
def picture_metrics(spark, sf_dir):
    """All pixel metrics of the same arithmetic pictures as files, in one Arrow pass."""

    def draw(batches):
        y, x = np.mgrid[0:12, 0:12]
        for pdf in batches:
            data = []
            for k in pdf["img_id"]:
                a = np.stack([(k * p + y * q + x * r) % 256 for p, q, r in ((13, 5, 3), (31, 17, 7), (7, 11, 19))], axis=2)
                a[[0, 11]] = 3 if k % 5 == 0 else a[[0, 11]]
                data.append(a.astype("u1").tobytes())
            yield pd.DataFrame({"img_id": pdf["img_id"], "height": 12, "width": 12, "channels": 3, "data": data})

    files = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("img_id")).mapInPandas(draw, "img_id long, height int, width int, channels int, data binary")
    face = F.struct((F.col("img_id") % 6 - 2).cast("int").alias("x"), (F.col("img_id") % 5).cast("int").alias("y"), F.lit(6).alias("w"), F.lit(5).alias("h"))
    found = metrics.picture_metrics(files.withColumn("box", face), "img_id", "box")
    return rounded(found, "sharpness", "face_sharpness", "exposure_score", "contrast", "colorfulness", "noise")


@query
def letterbox(spark, sf_dir):
    sizes = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("img_id"), F.lit(12).alias("width"), F.lit(12).alias("height"))
    return pixels.letterbox(pixel_grid(spark, sf_dir), sizes)


@query
def sunglasses_patches(spark, sf_dir):
    keys = picture_keys(spark, sf_dir)
    eyes = keys.select("img_id", F.lit(2).alias("rx"), F.lit(4).alias("ry"), (8 + F.col("img_id") % 3).alias("lx"), F.lit(4).alias("ly"), F.lit(6).alias("nx"), F.lit(7).alias("ny"))
    return pixels.eye_patches(pixel_grid(spark, sf_dir, keys=keys), eyes)


# ---- scores and ranks --------------------------------------------------------------------------


@query
def robust_ceiling(spark, sf_dir):
    return rounded(ranking.ceilings(records(spark, sf_dir)), *[f"ceil_{m}" for m in ranking.METRICS])


@query
def composite_score(spark, sf_dir):
    return rounded(ranking.composite_score(records(spark, sf_dir)).select("path", "base_score"), "base_score")


@query
def score_adjustments(spark, sf_dir):
    return rounded(records(spark, sf_dir).select("path", ranking.adjustment().alias("adjustment"), ranking.adjustment(False).alias("adjustment_any_eyewear")), "adjustment", "adjustment_any_eyewear")


def _stratified(spark: SparkSession, sf_dir: str, balance: bool) -> DataFrame:
    return ranking.stratified_top_n(ranking.scored(records(spark, sf_dir)), POOL, balance, tie="path").select("path", "place")


@query
def stratified_topn(spark, sf_dir):
    return _stratified(spark, sf_dir, True)


@query
def stratified_topn_nobalance(spark, sf_dir):
    return _stratified(spark, sf_dir, False)


@query
def year_bins(spark, sf_dir):
    return records(spark, sf_dir).groupBy("year").agg(F.count("*").alias("n"), F.min("path").alias("first_path"))


@query
def composition_quota(spark, sf_dir):
    quota = spark.createDataFrame(list(selection.composition_quota(SEATS).items()), "composition string, seats int")
    have = records(spark, sf_dir).groupBy(ranking.composition_bin(F.col("composition")).alias("composition")).agg(F.count("*").alias("available"))
    return have.join(F.broadcast(quota), "composition")


# ---- selection ---------------------------------------------------------------------------------


@query
def cosine_pairs(spark, sf_dir):
    return rounded(selection.cosine_pairs(pool(spark, sf_dir), "path", "feature_vector"), "distance")


@query
def near_duplicates(spark, sf_dir):
    return rounded(selection.near_duplicates(pool(spark, sf_dir), "path", "feature_vector", CLOSE), "distance")


@query
def greedy_dedup(spark, sf_dir):
    return selection.greedy_dedup(pool(spark, sf_dir), "path", "place", "feature_vector", CLOSE)


@query
def farthest_first(spark, sf_dir):
    return selection.farthest_first(pool(spark, sf_dir), "path", "place", "feature_vector", SEATS)


@query
def quota_farthest_first(spark, sf_dir):
    return selection.diverse_selection(pool(spark, sf_dir), SEATS, threshold=CLOSE)


@query
def median_vector(spark, sf_dir):
    return rounded(selection.median_vector(pool(spark, sf_dir), "feature_vector"), "value")


@query
def consensus_outliers(spark, sf_dir):
    return rounded(selection.consensus_outliers(pool(spark, sf_dir), "path", "feature_vector"), "distance")


# ---- refinement --------------------------------------------------------------------------------


@query
def verdict_join_failopen(spark, sf_dir):
    rows = refinement.with_verdicts(records(spark, sf_dir).select("path"), read_table(spark, sf_dir, "vlm_verdicts"))
    return rows.select("path", "v_single", "v_lighting", "v_sunglasses", "v_occlusion")


@query
def lighting_counts(spark, sf_dir):
    return refinement.lighting_counts(refinement.with_verdicts(records(spark, sf_dir).select("path"), read_table(spark, sf_dir, "vlm_verdicts")))


@query
def outlier_replacement(spark, sf_dir):
    return refinement.refine(portfolio(spark, sf_dir), upto="outliers")


@query
def single_subject_swap(spark, sf_dir):
    return refinement.refine(portfolio(spark, sf_dir), upto="companions")


@query
def face_integrity_swap(spark, sf_dir):
    return refinement.refine(portfolio(spark, sf_dir), upto="faces", drop_sunglasses=True)


@query
def lighting_rebalance(spark, sf_dir):
    return refinement.refine(portfolio(spark, sf_dir), upto="lighting")


@query
def aesthetic_lift(spark, sf_dir):
    return refinement.refine(portfolio(spark, sf_dir))


@query
def curation(spark, sf_dir):
    found = pipeline.curate(records(spark, sf_dir), read_table(spark, sf_dir, "vlm_verdicts"), SEATS, POOL, "2015-2025", DIMS)
    return found.select("seat", "path", "composition", "year", "head_pose", "total_score")
