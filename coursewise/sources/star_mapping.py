"""Course tables derived from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coursewise.schemas import COURSE, RawTables
from coursewise.sources.staging import staged


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _number(column: str, names: list[str]) -> Column:
    """Position of a value in ``names`` from 1 on; anything else comes after the last."""
    out = F.when(F.col(column) == names[0], 1)
    for n, name in enumerate(names[1:], start=2):
        out = out.when(F.col(column) == name, n)
    return out.otherwise(len(names) + 1)


# The numbering of market segments and part types.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]
#: Clicks begin so many days before the start of a course, so the first days are negative.
DAYS_BEFORE_START = 25


def _half_no(day: str) -> Column:
    return F.year(day) % 2


def _half(day: str) -> Column:
    return F.when(_half_no(day) == 0, "EVEN").otherwise("ODD")


def click_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click log with the activity type of the resource still attached."""
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    # owners first: the lines, which are the most rows, shuffle by order and by part only
    owners = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return (
        lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("c_mktsegment").alias("code_module"),
            _half("l_shipdate").alias("code_presentation"),
            F.col("o_custkey").alias("id_student"),
            (
                _number("c_mktsegment", SEGMENTS) * 100000
                + _half_no("l_shipdate") * 10000
                + F.substring("p_brand", 7, 10).cast("int") * 100
                + _number("p_type", TYPES)
            )
            .cast("long")
            .alias("id_site"),
            (F.dayofyear("l_shipdate") - DAYS_BEFORE_START).alias("date"),
            F.col("l_quantity").cast("int").alias("sum_click"),
            F.lower("p_type").alias("activity_type"),
        )
    )


def catalogue(clicks: DataFrame) -> DataFrame:
    site = F.col("id_site")
    return (
        clicks.select("id_site", *COURSE, "activity_type")
        .distinct()
        .withColumn("week_from", F.when(site % 3 != 0, (site % 30).cast("double")))
        .withColumn("week_to", F.when(site % 4 != 0, (site % 30 + 5).cast("double")))
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """All seven raw tables in the shape of the course dataset.

    The click log joins four tables, and the catalogue needs all of them before anything else can
    start. So it is joined once and landed as files; scans of those are still pruned to what is
    asked for. The catalogue and the courses are small, read by many branches and landed too;
    Spark then knows their sizes when it chooses join strategies.
    """
    clicks = staged(click_rows(spark, sf_dir), "clicks")
    resources = staged(catalogue(clicks), "catalogue")
    courses = staged(
        resources.select(*COURSE)
        .distinct()
        .withColumn(
            "module_presentation_length", (240 + 5 * _number("code_module", SEGMENTS)).cast("int")
        ),
        "courses",
    )
    customers = (
        _table(spark, sf_dir, "customer")
        .join(_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    k = F.col("c_custkey")
    band = (F.floor(F.col("c_acctbal") / 1000) * 10).cast("int")

    def label(divisor: int, names: list[str], key: Column = k) -> Column:
        out = F.when(key % divisor == 0, names[0])
        for n, name in enumerate(names[1:-1], start=1):
            out = out.when(key % divisor == n, name)
        return out.otherwise(names[-1])

    people = customers.select(
        k.alias("id_student"),
        label(2, ["F", "M"]).alias("gender"),
        F.col("r_name").alias("region"),
        label(3, ["HE Qualification", "A Level or Equivalent", "Lower Than A Level"]).alias(
            "highest_education"
        ),
        F.when(
            F.col("c_acctbal") >= 0,
            F.concat(band.cast("string"), F.lit("-"), (band + 10).cast("string"), F.lit("%")),
        ).alias("imd_band"),
        label(3, ["0-35", "35-55", "55<="], F.col("n_nationkey")).alias("age_band"),
        (k % 3).cast("int").alias("num_of_prev_attempts"),
        (30 * (1 + k % 4)).cast("int").alias("studied_credits"),
        label(10, ["Y", "N"]).alias("disability"),
        label(4, ["Pass", "Fail", "Withdrawn", "Distinction"]).alias("final_result"),
    )
    student_info = clicks.select(*COURSE, "id_student").distinct().join(people, "id_student")
    student = F.col("id_student")
    student_registration = student_info.where(student % 41 != 0).select(
        *COURSE,
        "id_student",
        F.when(student % 50 != 0, (student % 200 - 60).cast("double")).alias("date_registration"),
        F.when(F.col("final_result") == "Withdrawn", (student % 150).cast("double")).alias(
            "date_unregistration"
        ),
    )
    course_no = _number("code_module", SEGMENTS) * 2 + F.when(
        F.col("code_presentation") == "EVEN", 0
    ).otherwise(1)
    digit = F.col("digit")
    assessments = courses.withColumn(
        "digit", F.explode(F.array(*[F.lit(d) for d in range(1, 6)]))
    ).select(
        *COURSE,
        (course_no * 10 + digit).cast("long").alias("id_assessment"),
        F.when(digit <= 2, "TMA").when(digit <= 4, "CMA").otherwise("Exam").alias("assessment_type"),
        F.when(digit < 5, (40 * digit).cast("double")).alias("date"),
        (10 * digit).cast("double").alias("weight"),
    )
    student_assessment = (
        _table(spark, sf_dir, "orders")
        .join(
            _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"),
            F.col("o_custkey") == F.col("c_custkey"),
        )
        .select(
            (
                (_number("c_mktsegment", SEGMENTS) * 2 + _half_no("o_orderdate")) * 10
                + F.substring("o_orderpriority", 1, 1).cast("int")
            )
            .cast("long")
            .alias("id_assessment"),
            F.col("o_custkey").alias("id_student"),
            F.dayofyear("o_orderdate").alias("date_submitted"),
            F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("is_banked"),
            F.when(F.col("o_orderkey") % 97 != 0, (F.col("o_orderkey") % 101).cast("double")).alias(
                "score"
            ),
        )
    )
    return RawTables(
        assessments=assessments,
        courses=courses,
        student_assessment=student_assessment,
        student_info=student_info,
        student_registration=student_registration,
        student_vle=clicks.drop("activity_type"),
        vle=resources,
    )
