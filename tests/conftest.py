import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from coursewise import schemas  # noqa: E402
from coursewise.operators.interactions import temporal_split  # noqa: E402
from coursewise.operators.learners import learner_profiles  # noqa: E402
from coursewise.plans.prepare import prepare  # noqa: E402
from coursewise.schemas import CourseTables, RawTables  # noqa: E402
from coursewise.sources.staging import staged  # noqa: E402

# A miniature of the seven raw tables with planted gaps.
ROWS = {
    "assessments": [
        ("AAA", "2013J", 1001, "CMA", 30.0, 10.0),
        ("BBB", "2013B", 2001, "TMA", None, 20.0),
        ("AAA", "2013J", 1002, "Exam", 54.0, 100.0),
    ],
    "courses": [("AAA", "2013J", 241), ("BBB", "2013B", 268)],
    "student_assessment": [
        (1001, 1, 18, 0, None),
        (2001, 2, 64, 1, 60.0),
        (1002, 1, 53, 0, 70.0),
        (1001, 3, 16, 0, 80.0),
    ],
    "student_info": [
        ("AAA", "2013J", 1, "M", "East Anglian Region", "HE Qualification", "90-100%", "55<=", 1, 60, "Y", "Pass"),
        ("BBB", "2013B", 2, "F", "Wales", "Lower Than A Level", "30-40%", "35-55", 0, 240, "N", "Withdrawn"),
        ("AAA", "2013J", 3, "M", "Scotland", "A Level or Equivalent", None, "0-35", 0, 60, "N", "Fail"),
    ],
    "student_registration": [
        ("AAA", "2013J", 1, -92.0, 3.0),
        ("BBB", "2013B", 2, None, -10.0),
        ("AAA", "2013J", 3, 20.0, None),
    ],
    "student_vle": [
        ("AAA", "2013J", 1, 101, -10, 5),
        ("BBB", "2013B", 2, 201, 5, 14),
        ("AAA", "2013J", 3, 101, 3, 12),
        ("AAA", "2013J", 1, 102, 2, 4),
        ("AAA", "2013J", 3, 103, 1, 3),
    ],
    "vle": [
        (101, "AAA", "2013J", "url", None, 5.0),
        (102, "AAA", "2013J", "oucontent", None, None),
        (103, "AAA", "2013J", "url", 2.0, 26.0),
        (201, "BBB", "2013B", "subpage", None, 23.0),
    ],
}


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    return RawTables(
        **{
            name: spark.createDataFrame(rows, schemas.RAW_TABLES[name][1]).coalesce(1)
            for name, rows in ROWS.items()
        }
    )


@pytest.fixture(scope="session")
def tables(raw):
    prepared = prepare(raw)
    return CourseTables(**{name: staged(df, name) for name, df in vars(prepared).items()})


@pytest.fixture(scope="session")
def profiles(tables):
    return staged(learner_profiles(tables.interaction_data), "profiles")


@pytest.fixture(scope="session")
def split_day_one(tables):
    return tuple(staged(df, "day_one") for df in temporal_split(tables.vle_data, 1))


@pytest.fixture(scope="session")
def interactions_of(spark):
    """Interaction rows from (learner, course, resource, clicks) tuples."""

    def build(rows):
        full = [(s, c, "P", i, f"type{i % 3}", n, 0, 1, 1) for s, c, i, n in rows]
        return staged(spark.createDataFrame(full, schemas.INTERACTIONS).coalesce(1), "synthetic")

    return build
