"""Learner features that use nothing later than a cutoff day."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from coursewise.schemas import (
    ASSESSMENT_FEATURES,
    LEARNER_COURSE,
    VLE_FEATURES,
    CourseTables,
)

# Columns that tell of days after the cutoff.
LEAKING_STUDENT_COLUMNS = [
    "registration_duration",
    "final_result",
    "withdrew",
    "date_unregistration",
]
LEAKING_ASSESSMENT_COLUMNS = ["average_score"]


def filter_by_cutoff(tables: CourseTables, cutoff_day: int) -> CourseTables:
    return replace(
        tables,
        student_data=tables.student_data.where(F.col("date_registration") <= cutoff_day).drop(
            *LEAKING_STUDENT_COLUMNS
        ),
        assessment_data=tables.assessment_data.where(F.col("date_submitted") <= cutoff_day).drop(
            *LEAKING_ASSESSMENT_COLUMNS
        ),
        vle_data=tables.vle_data.where(F.col("date") <= cutoff_day),
        interaction_data=None,
    )


def assessment_features(assessment_data: DataFrame) -> DataFrame:
    return (
        assessment_data.dropna(subset=LEARNER_COURSE)
        .groupBy(*LEARNER_COURSE)
        .agg(
            F.avg("score").alias("average_score"),
            F.min("score").alias("min_score"),
            F.max("score").alias("max_score"),
            F.count("id_assessment").alias("assessments_submitted"),
            F.avg("date_submitted").alias("average_submission_date"),
            F.avg("weight").alias("average_assessment_weight"),
            F.count_distinct("assessment_type").alias("assessment_type_diversity"),
        )
    )


def vle_features(vle_data: DataFrame) -> DataFrame:
    """Click features, summed per resource first so that the log shuffles pre-aggregated."""
    per_resource = (
        vle_data.dropna(subset=LEARNER_COURSE)
        .groupBy(*LEARNER_COURSE, "id_site")
        .agg(
            F.sum("sum_click").alias("clicks"),
            F.count("sum_click").alias("visits"),
            F.min("date").alias("first_used"),
            F.max("date").alias("last_used"),
        )
    )
    clicks = F.coalesce(F.sum("clicks"), F.lit(0))
    return (
        per_resource.groupBy(*LEARNER_COURSE)
        .agg(
            clicks.alias("total_resource_clicks"),
            F.try_divide(F.sum("clicks").cast("double"), F.sum("visits")).alias(
                "average_resource_clicks"
            ),
            F.min("first_used").alias("first_used"),
            F.max("last_used").alias("last_used"),
            F.count("id_site").alias("resources_used"),
        )
        .withColumn("interaction_duration", F.col("last_used") - F.col("first_used"))
    )


def student_features(tables: CourseTables, cutoff_day: int = 86) -> DataFrame:
    """One row per learner-course registered by the cutoff; no activity counts as zero."""
    past = filter_by_cutoff(tables, cutoff_day)
    return (
        past.student_data.join(assessment_features(past.assessment_data), LEARNER_COURSE, "left")
        .join(vle_features(past.vle_data), LEARNER_COURSE, "left")
        .withColumn("days_registered", F.lit(cutoff_day) - F.col("date_registration"))
        .fillna(0, subset=[*ASSESSMENT_FEATURES, *VLE_FEATURES])
    )
