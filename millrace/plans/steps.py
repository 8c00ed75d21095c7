"""Steps of a batch: functions from DataFrame to DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]


def run_steps(df: DataFrame, *steps: Step) -> DataFrame:
    """The steps one after the other, as one lazy plan."""
    for step in steps:
        df = df.transform(step)
    return df
