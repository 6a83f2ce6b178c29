"""Click rows to one row per learner, course and resource, before and after a cutoff day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from coursewise.schemas import INTERACTION_KEYS


def aggregate_interactions(vle_data: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Total clicks and first and last day of use; rows with a missing key belong to no group."""
    return (
        vle_data.dropna(subset=INTERACTION_KEYS)
        .groupBy(*scope, *INTERACTION_KEYS)
        .agg(
            F.coalesce(F.sum("sum_click"), F.lit(0)).alias("total_resource_clicks"),
            F.min("date").alias("first_used"),
            F.max("date").alias("last_used"),
        )
        .withColumn("click_duration", F.col("last_used") - F.col("first_used"))
    )


def temporal_split(vle_data: DataFrame, cutoff_day: int) -> tuple[DataFrame, DataFrame]:
    """History up to and including the cutoff day, and the future after it."""
    return (
        aggregate_interactions(vle_data.where(F.col("date") <= cutoff_day)),
        aggregate_interactions(vle_data.where(F.col("date") > cutoff_day)),
    )


def ml_temporal_split(
    vle_data: DataFrame, training_cutoff: int, test_cutoff: int
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Click rows of training history, training future, test history and test future."""
    day = F.col("date")
    return (
        vle_data.where(day <= training_cutoff),
        vle_data.where((day > training_cutoff) & (day <= test_cutoff)),
        vle_data.where(day <= test_cutoff),
        vle_data.where(day > test_cutoff),
    )


def fold_split(vle_data: DataFrame, folds: Sequence[dict]) -> DataFrame:
    """Click rows labelled by ``fold`` and ``part`` (history or future) of every fold.

    Each fold is ``{"fold", "cutoff_day", "test_end"}``; a test end of None is open. A row
    goes to all folds it lies in, in one pass over the click table.
    """
    day = F.col("date")
    ends = [f["test_end"] for f in folds]
    if None not in ends:
        vle_data = vle_data.where(day <= max(ends))
    labels = []
    for f in folds:
        inside = day.isNotNull() if f["test_end"] is None else day <= f["test_end"]
        part = F.when(day <= f["cutoff_day"], F.lit("history")).otherwise(F.lit("future"))
        labels.append(
            F.when(inside, F.struct(F.lit(f["fold"]).alias("fold"), part.alias("part")))
        )
    return vle_data.withColumn(
        "label", F.explode(F.array_compact(F.array(*labels)))
    ).select("label.fold", "label.part", *vle_data.columns)


def expanding_folds(cutoff_days: Sequence[int], test_size: int) -> list[dict]:
    return [
        {"fold": n, "cutoff_day": day, "test_end": day + test_size}
        for n, day in enumerate(cutoff_days, start=1)
    ]
