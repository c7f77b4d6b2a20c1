"""Caption audits, choice among attempts, pair validation and packaging status."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.functions import text
from framewright.storage import materialize

PASS_RATE = 80.0


def audit(captions: DataFrame, caption: str, trigger: Column) -> DataFrame:
    """Adds ``violations`` (in rule order) and ``passed``."""
    found = text.audit_violations(F.col(caption), trigger)
    return captions.withColumn("violations", found).withColumn("passed", F.size("violations") == 0)


def audit_report(audited: DataFrame) -> DataFrame:
    """One row: ``total``, ``passed_count`` and ``pass_rate`` in per cent, 0 without captions."""
    passed = F.count_if("passed")
    rate = F.when(F.count("*") > 0, F.round(passed * 100.0 / F.nullif(F.count("*"), F.lit(0)), 6)).otherwise(0.0)
    return audited.agg(F.count("*").alias("total"), passed.alias("passed_count"), rate.alias("pass_rate"))


def violation_histogram(audited: DataFrame) -> DataFrame:
    """``violation`` without its numbers, and how often it occurs."""
    return audited.select(F.explode("violations").alias("v")).groupBy(text.violation_key(F.col("v")).alias("violation")).agg(F.count("*").alias("n"))


def failed_sample(audited: DataFrame, key: str, size: int = 5) -> DataFrame:
    """The first failing captions by key."""
    return audited.where(~F.col("passed")).select(key, "violations").orderBy(key).limit(size)


def audit_passes(report: DataFrame) -> bool:
    return report.first()["pass_rate"] >= PASS_RATE


def recaption_report(results: DataFrame, ok: str = "ok") -> DataFrame:
    return results.agg(F.count_if(ok).alias("succeeded"), F.count("*").alias("total"))


def chosen_attempt(attempts: DataFrame, key: str, attempt: str, accepted: str, passed: str, caption: str) -> DataFrame:
    """One caption per key: the first attempt that passes, else the last accepted one, sanitised; neither gives no row.

    Ties on the attempt number go to the smaller caption. Returns ``key``, ``attempt``,
    ``caption`` and ``repaired``.
    """
    good = F.coalesce(F.col(passed), F.lit(False))
    order = Window.partitionBy(key).orderBy(good.desc(), F.when(good, F.col(attempt)).otherwise(-F.col(attempt)), F.col(caption))
    rows = attempts.where(good | F.coalesce(F.col(accepted), F.lit(False))).withColumn("__r", F.row_number().over(order)).where("__r = 1")
    return rows.select(key, attempt, F.when(good, F.col(caption)).otherwise(text.sanitized(F.col(caption))).alias("caption"), (~good).alias("repaired"))


def pair_status(images: DataFrame, captions: DataFrame, key: str, caption: str, trigger: Column) -> DataFrame:
    """``key`` and ``status`` of every image: missing, empty, trigger_missing or ok.

    The caption must hold the trigger anywhere, in any case; without a trigger only
    emptiness counts. ``captions`` has at most one row per key; an image without one is missing.
    """
    told = captions.select(key, F.col(caption).alias("__text"), F.lit(True).alias("__has"))
    rows = images.join(told, key, "left")
    body = F.coalesce(text.strip(F.col("__text")), F.lit(""))
    named = ~text.usable_trigger(trigger) | F.contains(F.lower(body), F.lower(trigger))
    status = F.when(F.col("__has").isNull(), "missing").when(body == "", "empty").when(~named, "trigger_missing").otherwise("ok")
    return rows.select(key, status.alias("status"))


def package_summary(status: DataFrame) -> DataFrame:
    """One row: counts and ``verdict``; all or nothing, missing captions are named before invalid ones."""
    counts = status.agg(F.count("*").alias("images"), F.count_if(F.col("status") == "missing").alias("missing"), F.count_if(F.col("status").isin("empty", "trigger_missing")).alias("invalid"))
    verdict = F.when(F.col("images") == 0, "no images").when(F.col("missing") > 0, "missing captions").when(F.col("invalid") > 0, "invalid captions").otherwise("packaged")
    return counts.withColumn("verdict", verdict)


def generate(requests: DataFrame, provider: Callable[[DataFrame], DataFrame], retries: int = 2) -> DataFrame:
    """Captions from a model, asked again with what was wrong until they pass.

    ``requests`` has ``stem``, ``prompt``, ``trigger`` and ``lead``. ``provider`` takes ``stem``, ``prompt`` and
    ``temperature`` and returns ``stem`` and ``content`` (null where the model failed); it is the caller's
    ``mapInPandas`` over a model or service. Each round asks only for what has not passed yet and is
    written to the shared folder, so that no answer is asked for twice.
    Returns ``stem``, ``attempt``, ``caption`` and ``repaired``; a stem that never got a usable answer has no row.
    """
    open_ = requests.select("stem", "prompt", "trigger", "lead").withColumn("violations", F.array().cast("array<string>"))
    rounds = []
    for attempt in range(retries + 1):
        asked = open_.select("stem", text.feedback_prompt(F.col("prompt"), F.col("violations")).alias("prompt"), text.retry_temperature(F.lit(attempt)).alias("temperature"))
        told = open_.drop("violations").join(provider(asked).select("stem", "content"), "stem", "left")
        told = told.withColumn("clean", text.cleaned(F.col("content"), F.col("trigger"), F.col("lead"))).withColumn("violations", text.audit_violations(F.col("clean.text"), F.col("trigger")))
        told = told.withColumn("violations", F.when(F.col("clean.ok"), F.col("violations")).otherwise(F.array("clean.reason"))).withColumn("passed", F.size("violations") == 0)
        told = materialize(told.withColumn("attempt", F.lit(attempt + 1)), "captions")
        rounds.append(told.select("stem", "attempt", F.col("clean.ok").alias("ok"), "passed", F.col("clean.text").alias("caption")))
        open_ = told.where(~F.col("passed")).select("stem", "prompt", "trigger", "lead", "violations")
    return chosen_attempt(reduce(DataFrame.unionByName, rounds), "stem", "attempt", "ok", "passed", "caption")
