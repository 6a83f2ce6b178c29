"""Which courses and resources each learner has touched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from coursewise.schemas import COURSE


def learner_profiles(
    interactions: DataFrame, scope: Sequence[str] = (), targets: DataFrame | None = None
) -> DataFrame:
    """Per learner: the courses taken, a text key of that course set, and the used resources.

    Both arrays hold distinct values, so a learner's row grows with the resources on offer
    and not with the learner's clicks. ``targets`` restricts the learners.
    """
    rows = interactions
    if targets is not None:
        rows = rows.join(targets.select(*scope, "id_student").distinct(), [*scope, "id_student"], "left_semi")
    return (
        rows.groupBy(*scope, "id_student")
        .agg(
            F.sort_array(F.collect_set(F.struct(*COURSE))).alias("courses"),
            F.collect_set("id_site").alias("used_sites"),
        )
        .withColumn("course_set", F.to_json(F.struct(*scope, "courses")))
    )


def course_sets(profiles: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Every distinct course set with its number of learners, one row per course in it.

    Neighbour norms, term weights and similarities depend on a learner only through the
    learner's course set, so they are computed once per set.
    """
    return (
        profiles.groupBy(*scope, "course_set")
        .agg(F.any_value("courses").alias("courses"), F.count(F.lit(1)).alias("n_learners"))
        .select(*scope, "course_set", "n_learners", F.inline("courses"))
    )
