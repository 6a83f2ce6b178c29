"""Total clicks of the resources a learner has not used yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from coursewise.functions.scores import RANKING_STEP, max_normalised
from coursewise.schemas import COURSE, ITEM
from coursewise.sources.staging import staged


def item_clicks(interactions: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return interactions.groupBy(*scope, *ITEM).agg(
        F.sum("total_resource_clicks").cast("double").alias("raw_score")
    )


def raw_popularity(
    interactions: DataFrame,
    profiles: DataFrame,
    scope: Sequence[str] = (),
    best: int | None = None,
) -> DataFrame:
    """Unnormalised scores of unused resources of the learners' courses.

    The learner's used resources travel as an array with the learner's row, so they are
    excluded inside the join and the long candidate list is never shuffled for it. The
    short learner rows are spread by learner before they fan out, which also is the
    partitioning that normalising and ranking ask for.

    With ``best``, a course's list is read only as deep as the learner's ``best`` unused
    resources can lie: past as many surely higher ones as are used, plus ``best``.
    """
    items = item_clicks(interactions, scope)
    keep = ~F.array_contains("used_sites", F.col("id_site"))
    if best is not None:
        keep = keep & (F.col("higher") < F.lit(best) + F.size("used_sites"))
        items = _with_higher_count(items, scope)
    items = staged(items, "items")
    learners = profiles.repartition(*scope, "id_student").select(
        *scope, "id_student", "used_sites", F.inline("courses")
    )
    return (
        learners.join(items, [*scope, *COURSE])
        .where(keep)
        .select(*scope, "id_student", *ITEM, "raw_score")
    )


def _with_higher_count(items: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Number of resources of the course that rank higher however scores are normalised.

    Clicks are cut to steps as wide as the final ranking's rounding at the largest item, and
    only items at least two steps up count. The rows of a resource listed under several
    activity types count 1 together, so that used resources account for at most their number.
    """
    items = staged(items, "item_clicks")
    top = items.agg(F.max("raw_score")).scalar()
    step = F.floor(F.try_divide(F.col("raw_score"), top * (2 * RANKING_STEP)))
    above = (
        Window.partitionBy(*scope, *COURSE)
        .orderBy("down")
        .rangeBetween(Window.unboundedPreceding, -2)
    )
    kinds = Window.partitionBy(*scope, *COURSE, "id_site")
    return (
        items.withColumn("down", -F.coalesce(step, F.lit(0)))
        .withColumn("share", 1.0 / F.count(F.lit(1)).over(kinds))
        .withColumn("higher", F.coalesce(F.sum("share").over(above), F.lit(0.0)))
    )


def popularity_scores(
    interactions: DataFrame,
    profiles: DataFrame,
    scope: Sequence[str] = (),
    best: int | None = None,
) -> DataFrame:
    raw = raw_popularity(interactions, profiles, scope, best)
    return max_normalised(raw, "popularity_score", scope)


def popularity_cold_start(interactions: DataFrame) -> DataFrame:
    """The list every learner without history gets: all courses, nothing used."""
    items = item_clicks(interactions)
    top = items.agg(F.max("raw_score")).scalar()
    return items.select(
        *ITEM,
        F.when(top > 0, F.col("raw_score") / top).otherwise(F.col("raw_score")).alias("popularity_score"),
    )
