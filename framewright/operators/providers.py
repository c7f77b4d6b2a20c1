"""Calls of a model or service: retries with growing pauses, and answers that fail open."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.functions import text

# Tries of a call and the first pause in seconds, doubled each time.
TRIES, PAUSE = 3, 2.0


def persistent(call: Callable[..., str], tries: int = TRIES, pause: float = PAUSE) -> Callable[..., str | None]:
    """``call`` that is repeated after an error, with pauses that double; None if every try fails."""

    def run(*args: object) -> str | None:
        for k in range(tries):
            try:
                return call(*args)
            except Exception:  # noqa: BLE001  whatever the service raises counts as a failed try
                if k + 1 < tries:
                    time.sleep(pause * 2**k)
        return None

    return run


def provider(call: Callable[[str, str, float], str], tries: int = TRIES, pause: float = PAUSE) -> Callable[[DataFrame], DataFrame]:
    """A provider for ``captions.generate`` from ``call(stem, prompt, temperature)``; failed calls give a null content."""

    def ask(requests: DataFrame) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            steady = persistent(call, tries, pause)
            for pdf in batches:
                yield pd.DataFrame({"stem": pdf["stem"], "content": [steady(*r) for r in zip(pdf["stem"], pdf["prompt"], pdf["temperature"])]}, dtype=object)

        return requests.select("stem", "prompt", "temperature").mapInPandas(run, "stem string, content string")

    return ask


def verdicts(pictures: DataFrame, call: Callable[[str, str], str], key: str = "path", tries: int = TRIES, pause: float = PAUSE) -> DataFrame:
    """A model's verdict on each picture (``key``, ``picture``): asked once a key, parsed, failing open.

    ``call(key, picture)`` returns the model's answer. Where it keeps failing the picture counts
    as a single person indoors with an open face. Returns the columns of a verdict table.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steady = persistent(call, tries, pause)
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "answer": [steady(*r) for r in zip(pdf[key], pdf["picture"])]}, dtype=object)

    told = pictures.dropDuplicates([key]).select(key, "picture").mapInPandas(run, f"{key} string, answer string")
    parsed = text.parsed_verdict(F.col("answer"))
    return told.select(key, parsed["is_single"].alias("is_single"), parsed["lighting"].alias("lighting"), parsed["has_sunglasses"].alias("has_sunglasses"), parsed["has_face_occlusion"].alias("has_face_occlusion"), F.current_timestamp().cast("timestamp_ntz").alias("checked_at"))
