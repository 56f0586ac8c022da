"""Answers of several models side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(answers: DataFrame, models: Sequence[str]) -> DataFrame:
    """A row per prompt with columns ``<model>_response`` and ``<model>_error``.

    The model names are given, so the pivot needs no pass to find them, and the
    answers are folded on the map side before the shuffle.
    """
    return answers.groupBy("prompt_id").pivot("model", list(models)).agg(
        F.first("response", ignorenulls=True).alias("response"),
        F.first("error", ignorenulls=True).alias("error"),
    )
