"""Merge, clean, type and enrich the raw tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from coursewise.operators.interactions import aggregate_interactions
from coursewise.schemas import COURSE, LEARNER_COURSE, CourseTables, RawTables


def merge_tables(raw: RawTables) -> CourseTables:
    """Attach registrations, assessments, resources and course lengths.

    Lookup sides carry no broadcast hint: Spark broadcasts them while they measure below
    its threshold and sort-merges beyond it.
    """
    return CourseTables(
        student_data=raw.student_info.join(raw.student_registration, LEARNER_COURSE, "left").join(
            raw.courses, COURSE, "left"
        ),
        assessment_data=raw.student_assessment.join(raw.assessments, "id_assessment", "left").join(
            raw.courses, COURSE, "left"
        ),
        vle_data=raw.student_vle.join(raw.vle, ["id_site", *COURSE], "left").join(
            raw.courses, COURSE, "left"
        ),
        resource_data=raw.vle,
    )


def most_frequent(df: DataFrame, column: str) -> Column:
    """The commonest value, the smallest one on a tie, as a scalar subquery.

    The counts are grouped before the top row is taken, so no task holds all values.
    """
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .count()
        .orderBy(F.desc("count"), F.asc(column))
        .limit(1)
        .select(column)
        .scalar()
    )


def clean_tables(tables: CourseTables) -> CourseTables:
    students = tables.student_data.distinct()
    assessments = tables.assessment_data.distinct()
    return replace(
        tables,
        # the mode counts learners who are dropped below for want of a registration date
        student_data=students.withColumn(
            "imd_band", F.coalesce("imd_band", most_frequent(students, "imd_band"))
        )
        .dropna(subset=["date_registration"])
        .withColumn("withdrew", F.col("final_result").eqNullSafe("Withdrawn"))
        .withColumn(
            "date_unregistration",
            F.coalesce("date_unregistration", F.col("module_presentation_length").cast("double")),
        ),
        assessment_data=assessments.dropna(subset=["score"]).withColumn(
            "date", F.coalesce("date", F.col("module_presentation_length") - F.lit(7.0))
        ),
        # repeated click rows are separate visits and stay
        vle_data=tables.vle_data.drop("week_from", "week_to"),
        resource_data=tables.resource_data.drop("week_from", "week_to"),
    )


def _truthy(false_when: Column) -> Column:
    """False on the given condition, true on anything else, missing values included."""
    return F.when(false_when, F.lit(False)).otherwise(F.lit(True))


def typecast_tables(tables: CourseTables) -> CourseTables:
    return replace(
        tables,
        student_data=tables.student_data.withColumn(
            "disability", _truthy(F.col("disability").isin("N", ""))
        ),
        assessment_data=tables.assessment_data.withColumn(
            "is_banked", _truthy(F.col("is_banked") == 0)
        ),
    )


def resource_text() -> Column:
    """Module, presentation and activity joined by blanks; a gap is spelt ``nan``."""
    return F.concat_ws(
        " ", *[F.coalesce(F.col(c), F.lit("nan")) for c in (*COURSE, "activity_type")]
    )


def process_tables(tables: CourseTables) -> CourseTables:
    of_learner_course = Window.partitionBy(*LEARNER_COURSE)
    known_course = F.col("code_module").isNotNull() & F.col("code_presentation").isNotNull()
    return replace(
        tables,
        student_data=tables.student_data.withColumn(
            "registration_duration", F.col("date_unregistration") - F.col("date_registration")
        ),
        assessment_data=tables.assessment_data.withColumn(
            "average_score", F.when(known_course, F.avg("score").over(of_learner_course))
        ),
        resource_data=tables.resource_data.withColumn("resource_text", resource_text()),
        interaction_data=aggregate_interactions(tables.vle_data),
    )


def prepare(raw: RawTables) -> CourseTables:
    return process_tables(typecast_tables(clean_tables(merge_tables(raw))))
