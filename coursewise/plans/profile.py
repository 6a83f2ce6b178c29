"""Aggregates that describe the tables: shares, crosstabs, histograms, box plots, gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from coursewise.functions.scores import seeded_uniform
from coursewise.operators.ranks import exact_quantiles
from coursewise.schemas import COURSE
from coursewise.sources.staging import staged


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and share of every value of several columns in one pass; gaps are left out."""
    cells = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                    for c in columns
                ]
            )
        ).alias("cell")
    ).select("cell.*")
    counts = cells.where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return counts.join(totals, "column").select(
        "column", "value", "n", (F.col("n") / F.col("total")).alias("share")
    )


def crosstab_shares(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Row-wise shares in long form with a row for every pair of observed values.

    The pairs are the result, so the two lists of distinct values are crossed as rows; no value
    becomes a column and none goes to the driver.
    """
    known = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    counts = staged(known.groupBy(rows, columns).agg(F.count(F.lit(1)).alias("n")), "crosstab")
    totals = counts.groupBy(rows).agg(F.sum("n").alias("total"))
    pairs = totals.crossJoin(counts.select(columns).distinct())
    share = F.coalesce("n", F.lit(0)) / F.col("total")
    return pairs.join(counts, [rows, columns], "left").select(rows, columns, share.alias("share"))


def per_learner(df: DataFrame, measure, name: str) -> DataFrame:
    return df.groupBy("id_student").agg(measure.alias(name))


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Counts in equal-width bins, the last one closed; empty bins have a row."""
    value = F.col(column).cast("double")
    span = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).where(
        F.col("lo").isNotNull()
    ).select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    counts = (
        df.where(value.isNotNull())
        .select(
            F.least(F.floor((value - lo) / (hi - lo) * bins), F.lit(bins - 1)).alias("bin")
        )
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return (
        span.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin"))
        .join(counts, "bin", "left")
        .select(
            "bin",
            (F.col("lo") + width * F.col("bin")).alias("lower"),
            (F.col("lo") + width * (F.col("bin") + 1)).alias("upper"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def boxplot_stats(df: DataFrame, column: str) -> DataFrame:
    """Quartiles, whiskers at the outermost values within 1.5 IQR, and outlier count."""
    quartiles = exact_quantiles(df, [column], {"q1": 0.25, "median": 0.5, "q3": 0.75})
    pick = lambda name: quartiles.select(name).scalar()
    value = F.col(column).cast("double")
    fences = (
        df.where(value.isNotNull())
        .select(value.alias("v"), pick("q1").alias("q1"), pick("median").alias("median"), pick("q3").alias("q3"))
        .withColumn("low", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")))
        .withColumn("high", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    )
    inside = F.col("v").between(F.col("low"), F.col("high"))
    return fences.groupBy("q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("v"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("v"))).alias("upper_whisker"),
        F.count_if(~inside).alias("outliers"),
        F.count(F.lit(1)).alias("n"),
    )


def duplicate_profile(df: DataFrame, name: str) -> DataFrame:
    """Rows that repeat an earlier row, and their share."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.sum("copies").alias("n"), (F.sum("copies") - F.count(F.lit(1))).alias("duplicates"))
        .select(
            F.lit(name).alias("table_name"),
            "n",
            "duplicates",
            F.try_divide(F.col("duplicates"), F.col("n")).alias("share"),
        )
    )


def null_profile(df: DataFrame, name: str) -> DataFrame:
    """Missing values per column in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column_name", "n_null").select(
        F.lit(name).alias("table_name"), "column_name", "n_null"
    )


def day_profile(vle_data: DataFrame) -> DataFrame:
    """First, median and last day of activity, from which cutoffs are chosen."""
    median = exact_quantiles(vle_data, ["date"], {"median_day": 0.5}).select("median_day").scalar()
    return vle_data.agg(F.min("date").alias("min_day"), F.max("date").alias("max_day")).select(
        "min_day", median.alias("median_day"), "max_day"
    )


def site_uniqueness(resource_data: DataFrame) -> DataFrame:
    """Largest number of courses that share one resource id."""
    return (
        resource_data.select("id_site", *COURSE)
        .distinct()
        .groupBy("id_site")
        .count()
        .agg(F.max("count").alias("max_courses_per_site"))
    )


def top_interaction(interactions: DataFrame) -> DataFrame:
    """The interaction with most clicks; on a tie the first by learner and resource."""
    return interactions.orderBy(
        F.desc("total_resource_clicks"), "id_student", "id_site", *COURSE, "activity_type"
    ).limit(1)


def learner_count(interactions: DataFrame) -> DataFrame:
    return interactions.agg(F.count_distinct("id_student").alias("n_learners"))


def average_click_duration(interactions: DataFrame) -> DataFrame:
    return (
        interactions.groupBy("activity_type")
        .agg(F.avg("click_duration").alias("average_click_duration"))
        .orderBy("average_click_duration", "activity_type")
    )


def row_sample(df: DataFrame, keys: Sequence[str], n: int = 5, seed: int = 10) -> DataFrame:
    """``n`` rows drawn without replacement: a distributed top-n of draws seeded by the keys."""
    return df.withColumn("draw", seeded_uniform(seed, *keys)).orderBy("draw", *keys).limit(n).drop("draw")
