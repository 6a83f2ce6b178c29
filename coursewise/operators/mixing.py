"""Scores of several sources side by side, and their fixed-weight mix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from coursewise.functions.scores import HYBRID_WEIGHTS, check_weights, hybrid_score
from coursewise.operators.baseline_random import random_score
from coursewise.operators.collaborative import raw_collaborative
from coursewise.operators.content import raw_content
from coursewise.operators.learners import course_sets
from coursewise.operators.popularity import raw_popularity
from coursewise.schemas import ITEM, SCORE_COLUMNS
from coursewise.sources.staging import staged

SOURCES = ["popularity", "collaborative", "content"]


def source_scores(
    interactions: DataFrame,
    resources: DataFrame,
    profiles: DataFrame,
    scope: Sequence[str] = (),
    best: int | None = None,
) -> DataFrame:
    """Max-normalised rows of all three sources in long form: source and score.

    With ``best``, rows that cannot be among a source's ``best`` of a learner-course may be
    missing; the rest and the order among them are the same.

    The raw rows shuffle once, by learner. Normalising, ranking per learner-course and
    mixing all group by keys that start from the learner and need no further shuffle.
    """
    sets = staged(course_sets(profiles, scope), "course_sets")
    raws = {
        "popularity": raw_popularity(interactions, profiles, scope, best),
        "collaborative": raw_collaborative(interactions, profiles, scope, best, sets),
        "content": raw_content(interactions, resources, profiles, scope, best, sets),
    }
    together = None
    for source in SOURCES:
        rows = raws[source].select(
            *scope, "id_student", *ITEM, F.lit(source).alias("source"), "raw_score"
        )
        together = rows if together is None else together.unionByName(rows)
    top = F.max("raw_score").over(Window.partitionBy(*scope, "id_student", "source"))
    return together.repartition(*scope, "id_student").select(
        *scope,
        "id_student",
        *ITEM,
        "source",
        F.when(top > 0, F.col("raw_score") / top).otherwise(F.col("raw_score")).alias("score"),
    )


def side_by_side(long_scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with a column per source; null where the source has no such row."""
    return long_scores.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("source") == source, F.col("score"))).alias(f"{source}_score")
            for source in SOURCES
        ]
    )


def score_table(
    interactions: DataFrame,
    resources: DataFrame,
    profiles: DataFrame,
    scope: Sequence[str] = (),
    weights: dict[str, float] = HYBRID_WEIGHTS,
) -> DataFrame:
    """All five recommenders' scores per learner and unused resource.

    A recommender that does not propose a resource has null there; the hybrid counts it as 0.
    """
    check_weights(**weights)
    wide = side_by_side(
        source_scores(interactions, resources, profiles, scope), [*scope, "id_student", *ITEM]
    )
    zero = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in SCORE_COLUMNS}
    mixed = (
        F.lit(float(weights["popularity"])) * zero["popularity_score"]
        + F.lit(float(weights["content"])) * zero["content_score"]
        + F.lit(float(weights["collaborative"])) * zero["collaborative_score"]
    )
    return wide.select(
        *scope,
        "id_student",
        *ITEM,
        *SCORE_COLUMNS,
        mixed.alias("hybrid_score"),
        F.when(F.col("popularity_score").isNotNull(), random_score()).alias("random_score"),
    )


def hybrid_scores(
    popularity: DataFrame,
    content: DataFrame,
    collaborative: DataFrame,
    popularity_weight: float = HYBRID_WEIGHTS["popularity"],
    content_weight: float = HYBRID_WEIGHTS["content"],
    collaborative_weight: float = HYBRID_WEIGHTS["collaborative"],
    keys: Sequence[str] = ("id_student",),
) -> DataFrame:
    """Weighted sum of three score frames; a resource missing from a source scores 0 there.

    Rows match on ``keys`` and all resource columns, missing activity types included.
    """
    mix = hybrid_score(popularity_weight, content_weight, collaborative_weight)
    frames = {"popularity": popularity, "content": content, "collaborative": collaborative}
    columns = [*keys, *ITEM]
    together = None
    for source in SOURCES:
        # popularity rows lie by learner; once the others do too, the union needs no shuffle of all three
        frame = frames[source] if source == "popularity" else frames[source].repartition(*keys)
        rows = frame.select(
            *columns, F.lit(source).alias("source"), F.col(f"{source}_score").alias("score")
        )
        together = rows if together is None else together.unionByName(rows)
    return (
        side_by_side(together, columns)
        .fillna(0.0, subset=SCORE_COLUMNS)
        .select(
            *columns,
            "popularity_score",
            "content_score",
            "collaborative_score",
            mix.alias("hybrid_score"),
        )
    )
