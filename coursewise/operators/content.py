"""Similarity of unused resources to the texts of used ones.

With unit term vectors ``v`` the sum of cosines of item i to the used items j is
``(sum_j v_j) . v_i``: one profile vector per learner instead of pairs of items. Term weights
depend on the catalogue of the learner's course set, and equal texts are weighed once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from coursewise.functions.text import term_weights
from coursewise.operators.blocked_product import blocked_product
from coursewise.operators.learners import course_sets
from coursewise.schemas import COURSE, ITEM
from coursewise.sources.staging import staged


def catalogue_by_course_set(
    resources: DataFrame, sets: DataFrame, scope: Sequence[str] = ()
) -> DataFrame:
    """Catalogue of every course set, one row per resource."""
    first = Window.partitionBy("course_set", "id_site").orderBy(*COURSE, "activity_type")
    return (
        resources.join(sets.select(*scope, *COURSE, "course_set"), COURSE)
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") == 1)
        .select("course_set", *scope, *ITEM, "resource_text")
    )


def text_vectors(catalogue: DataFrame) -> DataFrame:
    """course_set, resource_text, term, weight over the distinct texts of each catalogue."""
    texts = catalogue.groupBy("course_set", "resource_text").agg(F.count(F.lit(1)).alias("copies"))
    return term_weights(texts, ["resource_text"], "resource_text", ["course_set"], "copies")


def content_sides(
    resources: DataFrame, profiles: DataFrame, sets: DataFrame, scope: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Learners' summed term vectors, the items' term vectors, and the used resources."""
    catalogue = staged(catalogue_by_course_set(resources, sets, scope), "catalogue")
    vectors = staged(text_vectors(catalogue), "vectors")
    rows = vectors.groupBy("course_set", "resource_text").agg(
        F.collect_list(F.struct("term", "weight")).alias("entries")
    )
    items = catalogue.join(rows, ["course_set", "resource_text"]).select(
        "course_set",
        *scope,
        *ITEM,
        F.col("entries.term").alias("features"),
        F.col("entries.weight").alias("weights"),
    )
    used = profiles.select("course_set", "id_student", F.explode("used_sites").alias("id_site"))
    # learners shuffle as one row each; their exploded rows are grouped where they are
    spread = profiles.select("course_set", "id_student", "used_sites").repartition("course_set", "id_student")
    profile = (
        spread.select("course_set", "id_student", F.explode("used_sites").alias("id_site"))
        .join(
            catalogue.select("course_set", "id_site", "resource_text"), ["course_set", "id_site"]
        )
        .groupBy("course_set", "id_student", "resource_text")
        .agg(F.count(F.lit(1)).alias("times"))
        .join(vectors, ["course_set", "resource_text"])
        .groupBy("course_set", "id_student", "term")
        .agg(F.sum(F.col("times") * F.col("weight")).alias("weight"))
    )
    profile = profile.select("course_set", "id_student", F.col("term").alias("feature"), "weight")
    return profile, items, used


def raw_content(
    interactions: DataFrame,
    resources: DataFrame,
    profiles: DataFrame,
    scope: Sequence[str] = (),
    best: int | None = None,
    sets: DataFrame | None = None,
    normalised: bool = False,
) -> DataFrame:
    # several branches read the small tables: stage them
    if sets is None:
        sets = staged(course_sets(profiles, scope), "course_sets")
    profile, items, used = content_sides(resources, profiles, sets, scope)
    learner_rows = profile.withColumn("used_site", F.lit(None).cast("long")).unionByName(
        used.select(
            "course_set",
            "id_student",
            F.lit(None).cast("string").alias("feature"),
            F.lit(None).cast("double").alias("weight"),
            F.col("id_site").alias("used_site"),
        )
    )
    sizes = (
        items.groupBy("course_set")
        .agg(F.count(F.lit(1)).alias("n_items"), F.sum(F.size("features")).alias("n_entries"))
        .join(sets.select("course_set", "n_learners").distinct(), "course_set")
    )
    return blocked_product(learner_rows, items, sizes, [*scope, *ITEM], best, normalised)


def content_scores(
    interactions: DataFrame,
    resources: DataFrame,
    profiles: DataFrame,
    scope: Sequence[str] = (),
    best: int | None = None,
) -> DataFrame:
    found = raw_content(interactions, resources, profiles, scope, best, normalised=True)
    return found.select(*scope, "id_student", *ITEM, F.col("raw_score").alias("content_score"))
