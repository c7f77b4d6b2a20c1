"""Caption audits, cleaning and sanitising on small cases."""

import re

import pytest
from pyspark.sql import functions as F

from framewright.functions import text
from framewright.operators import captions

GOOD = "tok woman, a close-up shot from eye level, stands by a red door in a blue linen coat with both hands resting in the pockets, lit by soft morning window light."


def violations(spark, caption, trigger="tok"):
    df = spark.createDataFrame([(caption, trigger)], "c string, t string")
    return df.select(text.audit_violations(F.col("c"), F.col("t")).alias("v")).first()["v"]


def clean(spark, raw, trigger, lead):
    df = spark.createDataFrame([(raw, trigger, lead)], "c string, t string, l string")
    return df.select(text.cleaned(F.col("c"), F.col("t"), F.col("l")).alias("r")).first()["r"]


def sanitize(spark, caption):
    return spark.createDataFrame([(caption,)], "c string").select(text.sanitized(F.col("c")).alias("r")).first()["r"]


def test_valid_caption_passes(spark):
    assert violations(spark, GOOD) == []


@pytest.mark.parametrize(
    ("caption", "expected"),
    [
        (None, "Caption is empty"),
        ("   \n", "Caption is empty"),
        ("tok woman.", "Too short"),
        (GOOD + " word" * 80 + ".", "Too long"),
        (GOOD.replace("tok", "someone"), "Missing trigger word 'tok'"),
        (GOOD.replace("a red door", "tok"), "Duplicate trigger word 'tok' (2 occurrences)"),
        (GOOD + " A close-up shot again.", "Duplicate framing phrase 'close-up shot'"),
        (GOOD + " It is a masterpiece.", "quality buzzword"),
        (GOOD + " Dramatic lighting all over.", "subjective lighting buzzword"),
        (GOOD.replace("both hands resting", "gloves"), "Missing explicit hand placement"),
        (GOOD[:-1], "Missing terminal punctuation"),
    ],
)
def test_violations(spark, caption, expected):
    assert any(expected in v for v in violations(spark, caption))


def test_hand_rule_is_a_substring_rule(spark):
    assert not any("hand placement" in v for v in violations(spark, GOOD.replace("both hands resting in the pockets", "a handsome face")))


def test_trigger_with_pattern_characters_and_without(spark):
    assert any("Missing trigger" in v for v in violations(spark, GOOD, "t.k"))
    assert violations(spark, GOOD, None) == violations(spark, GOOD, " ") == []
    assert any("Missing trigger" in v for v in violations(spark, GOOD, r"a\Eb"))


def test_clean_strips_wrapping(spark):
    raw = "Here is the caption:\n```\nohwx woman, a close-up shot. She sits on a **wooden** bench; her hands rest on her lap while warm window light falls from the left side of the room.\n```\nTags: bench, window"
    got = clean(spark, raw, "ohwx woman", "ohwx woman, a close-up shot")
    assert got["ok"] and got["text"].startswith("ohwx woman, a close-up shot") and "Tags" not in got["text"] and "`" not in got["text"] and "*" not in got["text"]
    assert len(re.findall("ohwx", got["text"])) == 1


def test_clean_removes_layered_introductions(spark):
    raw = "tok woman, a waist-up shot, tok woman, a waist-up shot. Tok woman is seen in a portrait of a woman sitting at a table with her arms folded, near a plain wall in soft light from a window."
    got = clean(spark, raw, "tok", "tok woman, a waist-up shot")
    assert got["ok"] and got["text"].lower().count("tok") == 1 and got["text"].count("waist-up shot") == 1


def test_clean_strips_numbered_rubric(spark):
    raw = "1. **Framing and camera angle**: From eye level near a door.\n2. Setting: a narrow room with a lamp and a chair.\n- Lighting: soft light from the right over both hands and the table."
    got = clean(spark, raw, "jujub", "jujub woman, a close-up shot")
    assert got["ok"] and "Framing" not in got["text"] and "Lighting:" not in got["text"] and "2." not in got["text"]


@pytest.mark.parametrize(("raw", "reason"), [(None, "Empty response body"), (" ", "Empty response body"), ("Tags: a, b", "Empty response after stripping preambles and tags"), ("too short here", "Description too short (3 words)"), ("one two three four five six", "Description too short")])
def test_clean_rejects(spark, raw, reason):
    got = clean(spark, raw, "tok", "tok woman, a close-up shot")
    assert not got["ok"] and got["text"] == "" and got["reason"].startswith(reason)


def test_sanitized_caption_passes_audit(spark):
    bad = GOOD.replace("both hands resting in the pockets", "a calm look") [:-1] + ", adding a sense of calm to the image, a masterpiece with dramatic lighting"
    fixed = sanitize(spark, bad)
    assert violations(spark, fixed) == [] and "soft directional lighting" in fixed and fixed.endswith("Hands are out of frame.")


def test_sanitize_null_and_blank(spark):
    assert sanitize(spark, None) == sanitize(spark, " ") == ". Hands are out of frame."


def test_lead_composition_temperature_slug(spark):
    df = spark.createDataFrame([("tok", "close-up"), ("ohwx woman", "medium"), ("Big_Dog", None)], "t string, c string")
    rows = df.select(text.lead(F.col("t"), F.col("c")).alias("l"), text.destination_slug(F.col("t")).alias("s")).collect()
    assert [r["l"] for r in rows] == ["tok woman, a close-up shot", "ohwx woman, a waist-up shot", "Big_Dog woman, a portrait shot"]
    assert rows[2]["s"] == "flux-big-dog-lora"
    temps = spark.range(4).select(F.round(text.retry_temperature(F.col("id")), 2).alias("t")).collect()
    assert [r["t"] for r in temps] == [0.2, 0.35, 0.5, 0.5]


def test_verdict_parsing(spark):
    df = spark.createDataFrame([("MULTIPLE_PEOPLE Outdoor NO_SUNGLASSES",), ("SINGLE_PERSON Indoor EYEWEAR: SUNGLASSES",), (None,), ("FACE_OCCLUDED",)], "r string")
    rows = [tuple(r["v"]) for r in df.select(text.parsed_verdict(F.col("r")).alias("v")).collect()]
    assert rows == [(False, "Outdoor", False, False), (True, "Indoor", True, True), (True, "Indoor", False, False), (True, "Indoor", False, True)]


def test_reports(spark):
    rows = spark.createDataFrame([(1, GOOD), (2, "bad"), (3, None)], "k int, c string")
    audited = captions.audit(rows, "c", F.lit("tok"))
    report = captions.audit_report(audited).first()
    assert (report["total"], report["passed_count"], round(report["pass_rate"], 2)) == (3, 1, 33.33)
    assert captions.audit_report(audited.limit(0)).first()["pass_rate"] == 0.0
    assert not captions.audit_passes(captions.audit_report(audited))
    counts = {r["violation"]: r["n"] for r in captions.violation_histogram(audited).collect()}
    assert counts["Too short"] == 1 and counts["Caption is empty"] == 1
    assert [r["k"] for r in captions.failed_sample(audited, "k", 1).collect()] == [2]


def test_chosen_attempt(spark):
    rows = spark.createDataFrame(
        [(1, 1, True, False, "first bad"), (1, 2, True, True, GOOD), (1, 3, True, True, "later"), (2, 1, True, False, "one"), (2, 2, True, False, "two"), (3, 1, False, False, "never")],
        "k int, n int, ok boolean, passed boolean, c string",
    )
    got = {r["k"]: (r["n"], r["repaired"]) for r in captions.chosen_attempt(rows, "k", "n", "ok", "passed", "c").collect()}
    assert got == {1: (2, False), 2: (2, True)}


def test_pairs_and_package(spark):
    images = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "stem string")
    told = spark.createDataFrame([("a", "a TOK caption"), ("b", " "), ("c", "no trigger")], "stem string, text string")
    status = captions.pair_status(images, told, "stem", "text", F.lit("tok"))
    assert {r["stem"]: r["status"] for r in status.collect()} == {"a": "ok", "b": "empty", "c": "trigger_missing", "d": "missing"}
    assert captions.package_summary(status).first()["verdict"] == "missing captions"
    assert captions.package_summary(status.where("stem = 'a'")).first()["verdict"] == "packaged"
    assert captions.package_summary(status.limit(0)).first()["verdict"] == "no images"


def test_leads_are_stripped_until_the_text_is_stable(spark):
    layers = ["shown in " * 40 + "rain", "tok woman, a close-up shot. shown in " * 20 + "She waits", "She waits", "", None]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(layers)], "k int, x string")
    got = df.select("k", text.without_lead(F.col("x"), F.lit("tok"), F.lit("tok woman, a close-up shot")).alias("y")).orderBy("k")
    assert [r["y"] for r in got.collect()] == ["rain", "She waits", "She waits", "", None]
