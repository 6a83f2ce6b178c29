"""Column lists, read schemas and table bundles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

COURSE = ["code_module", "code_presentation"]
LEARNER_COURSE = ["id_student", *COURSE]
ITEM = ["id_site", *COURSE, "activity_type"]
INTERACTION_KEYS = [*LEARNER_COURSE, "id_site", "activity_type"]


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in columns.items()])


ASSESSMENTS = _schema(
    code_module=StringType,
    code_presentation=StringType,
    id_assessment=LongType,
    assessment_type=StringType,
    date=DoubleType,
    weight=DoubleType,
)
COURSES = _schema(
    code_module=StringType,
    code_presentation=StringType,
    module_presentation_length=IntegerType,
)
STUDENT_ASSESSMENT = _schema(
    id_assessment=LongType,
    id_student=LongType,
    date_submitted=IntegerType,
    is_banked=IntegerType,
    score=DoubleType,
)
STUDENT_INFO = _schema(
    code_module=StringType,
    code_presentation=StringType,
    id_student=LongType,
    gender=StringType,
    region=StringType,
    highest_education=StringType,
    imd_band=StringType,
    age_band=StringType,
    num_of_prev_attempts=IntegerType,
    studied_credits=IntegerType,
    disability=StringType,
    final_result=StringType,
)
STUDENT_REGISTRATION = _schema(
    code_module=StringType,
    code_presentation=StringType,
    id_student=LongType,
    date_registration=DoubleType,
    date_unregistration=DoubleType,
)
STUDENT_VLE = _schema(
    code_module=StringType,
    code_presentation=StringType,
    id_student=LongType,
    id_site=LongType,
    date=IntegerType,
    sum_click=IntegerType,
)
VLE = _schema(
    id_site=LongType,
    code_module=StringType,
    code_presentation=StringType,
    activity_type=StringType,
    week_from=DoubleType,
    week_to=DoubleType,
)

INTERACTIONS = _schema(
    id_student=LongType,
    code_module=StringType,
    code_presentation=StringType,
    id_site=LongType,
    activity_type=StringType,
    total_resource_clicks=LongType,
    first_used=IntegerType,
    last_used=IntegerType,
    click_duration=IntegerType,
)

# The raw table names, their file names and read schemas.
RAW_TABLES = {
    "assessments": ("assessments.csv", ASSESSMENTS),
    "courses": ("courses.csv", COURSES),
    "student_assessment": ("studentAssessment.csv", STUDENT_ASSESSMENT),
    "student_info": ("studentInfo.csv", STUDENT_INFO),
    "student_registration": ("studentRegistration.csv", STUDENT_REGISTRATION),
    "student_vle": ("studentVle.csv", STUDENT_VLE),
    "vle": ("vle.csv", VLE),
}

# The learned ranker's input columns by treatment.
SCORE_COLUMNS = ["popularity_score", "collaborative_score", "content_score"]
CATEGORICAL_FEATURES = [
    "gender",
    "region",
    "highest_education",
    "imd_band",
    "age_band",
    "disability",
]
ASSESSMENT_FEATURES = [
    "average_score",
    "min_score",
    "max_score",
    "assessments_submitted",
    "average_submission_date",
    "average_assessment_weight",
    "assessment_type_diversity",
]
VLE_FEATURES = [
    "total_resource_clicks",
    "average_resource_clicks",
    "first_used",
    "last_used",
    "resources_used",
    "interaction_duration",
]
NUMERICAL_FEATURES = [
    *SCORE_COLUMNS,
    "num_of_prev_attempts",
    "studied_credits",
    *ASSESSMENT_FEATURES,
    *VLE_FEATURES,
    "days_registered",
]
TEXT_FEATURE = "resource_text"
MODEL_INPUT = [
    *SCORE_COLUMNS,
    TEXT_FEATURE,
    *CATEGORICAL_FEATURES[:5],
    "num_of_prev_attempts",
    "studied_credits",
    "disability",
    *ASSESSMENT_FEATURES,
    *VLE_FEATURES,
    "days_registered",
]
RECOMMENDATION_COLUMNS = [
    "id_student",
    "id_site",
    *COURSE,
    *SCORE_COLUMNS,
    "ML_score",
    "explanation",
]


@dataclass(frozen=True)
class RawTables:
    assessments: DataFrame
    courses: DataFrame
    student_assessment: DataFrame
    student_info: DataFrame
    student_registration: DataFrame
    student_vle: DataFrame
    vle: DataFrame


@dataclass(frozen=True)
class CourseTables:
    """Merged tables; ``interaction_data`` exists once they are processed."""

    student_data: DataFrame
    assessment_data: DataFrame
    vle_data: DataFrame
    resource_data: DataFrame
    interaction_data: DataFrame | None = None


@dataclass(frozen=True)
class ServingTables:
    history_interactions: DataFrame
    student_features: DataFrame
    resource_data: DataFrame
