"""Candidate pools and labelled training rows for the learned ranker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from coursewise.functions.scores import best_first, check_k, seeded_uniform
from coursewise.operators.best_rows import SOURCES, best_scores
from coursewise.operators.learners import learner_profiles
from coursewise.operators.mixing import side_by_side
from coursewise.operators.ranks import largest_remainder
from coursewise.schemas import (
    CATEGORICAL_FEATURES,
    ITEM,
    LEARNER_COURSE,
    MODEL_INPUT,
    SCORE_COLUMNS,
    TEXT_FEATURE,
)
from coursewise.sources.staging import staged

SEED = 10
DRAW_SLICES = 4096


def evaluated_learner_courses(
    history: DataFrame, future: DataFrame, scope: Sequence[str] = ()
) -> DataFrame:
    """Learner-courses active both before and after the cutoff."""
    keys = [*scope, *LEARNER_COURSE]
    return history.select(*keys).distinct().join(future.select(*keys), keys, "left_semi")


def relevant_items(
    history: DataFrame,
    future: DataFrame,
    scope: Sequence[str] = (),
    grain: Sequence[str] = LEARNER_COURSE,
) -> DataFrame:
    """Resources first used after the cutoff."""
    keys = [*scope, *grain, "id_site"]
    return future.select(*keys).distinct().join(history.select(*keys), keys, "left_anti")


def site_sets(
    history: DataFrame, future: DataFrame, scope: Sequence[str] = (), grain: Sequence[str] = LEARNER_COURSE
) -> DataFrame:
    """One row per key: its ``relevant_sites``, and whether it has a ``past`` and a ``later``.

    ``relevant_sites`` are those of ``relevant_items``. Arrays of distinct resources grow with the
    catalogue, not with the clicks, and what is judged by them shuffles by key alone.
    """
    keys = [*scope, *grain]
    site, none = F.col("id_site"), F.lit(None).cast("long")
    both = history.select(*keys, site.alias("past"), none.alias("later")).unionByName(
        future.select(*keys, none.alias("past"), site.alias("later"))
    )
    return (
        both.groupBy(*keys)
        .agg(F.collect_set("past").alias("past"), F.collect_set("later").alias("later"))
        .select(
            *keys,
            F.array_except("later", "past").alias("relevant_sites"),
            (F.size("past") > 0).alias("past"),
            (F.size("later") > 0).alias("later"),
        )
    )


def generate_candidates(
    interactions: DataFrame,
    resources: DataFrame,
    k: int = 20,
    targets: DataFrame | None = None,
    scope: Sequence[str] = (),
    scores: DataFrame | None = None,
) -> DataFrame:
    """Union of every source's ``k`` best per learner-course, with resource details.

    A score outside its own source's best ``k`` counts as 0. ``targets`` restricts the
    learner-courses. ``scores`` are long source scores when they exist already.

    The best rows shuffle once, by learner-course; each source ranks them in a window there.
    """
    check_k(k)
    if scores is None:
        profiles = staged(learner_profiles(interactions, scope, targets), "profiles")
        wide = best_scores(interactions, resources, profiles, k, scope, ranked=SOURCES)
    else:
        wide = side_by_side(scores, [*scope, "id_student", *ITEM])
    keys = [*scope, *LEARNER_COURSE]
    wide = wide.select(*keys, "id_site", *SCORE_COLUMNS)
    if targets is not None:
        # scores are normalised over all of the learner's courses by now
        wide = wide.join(targets.select(*keys).distinct(), keys, "left_semi")
    place = {c: F.row_number().over(Window.partitionBy(*keys).orderBy(*best_first(c))) for c in SCORE_COLUMNS}
    placed = wide.select(*wide.columns, *[place[c].alias(f"{c}_place") for c in SCORE_COLUMNS])
    best = placed.select(*keys, "id_site", *[F.when(F.col(f"{c}_place") <= k, F.col(c)).alias(c) for c in SCORE_COLUMNS])
    pool = (
        best.where(F.coalesce(*SCORE_COLUMNS).isNotNull())
        .groupBy(*keys, "id_site")
        .agg(*[F.coalesce(F.max(c), F.lit(0.0)).alias(c) for c in SCORE_COLUMNS])
    )
    return pool.join(resources, ["id_site", "code_module", "code_presentation"], "left").select(
        *keys, "id_site", *SCORE_COLUMNS, "activity_type", "resource_text"
    )


def labelled_candidates(
    history: DataFrame,
    future: DataFrame,
    resources: DataFrame,
    k: int = 20,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Candidates of all evaluated learner-courses with ``target``.

    Learner-courses without relevant items stay, with targets of 0.
    """
    keys = [*scope, *LEARNER_COURSE]
    spine = staged(site_sets(history, future, scope).where("past and later").select(*keys, "relevant_sites"), "spine")
    candidates = generate_candidates(history, resources, k, spine, scope).where(
        F.col("resource_text").isNotNull()
    )
    target = F.when(F.array_contains("relevant_sites", F.col("id_site")), 1).otherwise(0)
    return candidates.join(spine, keys).withColumn("target", target).drop("relevant_sites")


def create_ml_dataset(
    history: DataFrame,
    future: DataFrame,
    resources: DataFrame,
    features: DataFrame,
    k: int = 20,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Labelled candidates with learner features.

    Learners without a feature row stay with missing features.
    """
    return labelled_candidates(history, future, resources, k, scope).join(features, [*scope, *LEARNER_COURSE], "left")


def create_ml_sample(
    history: DataFrame,
    future: DataFrame,
    resources: DataFrame,
    features: DataFrame,
    sample_size: int,
    k: int = 20,
    scope: Sequence[str] = (),
) -> DataFrame:
    """``sample_training_data`` of ``create_ml_dataset``, where only the sample meets the features."""
    keys = [*scope, *LEARNER_COURSE]
    labelled = staged(labelled_candidates(history, future, resources, k, scope), "labelled")
    features = staged(features, "features")
    if features.dropna(subset=keys).groupBy(*keys).count().where("count > 1").isEmpty():
        return sample_training_data(labelled, sample_size).join(features, keys, "left")
    # repeated feature rows repeat candidates, and the sample counts them
    return sample_training_data(staged(labelled.join(features, keys, "left"), "dataset"), sample_size)


def sample_training_data(dataset: DataFrame, sample_size: int = 5000) -> DataFrame:
    """An exact-size sample that keeps the share of every target value.

    Rows are taken in order of a draw seeded by their keys. Counts by class and slice of the draw
    give the slice in which a class's quota ends. One more scan keeps the rows up to it, and only
    that slice's are ordered, so no task sees a class and any size will do.
    """
    keys = [c for c in ("fold", *LEARNER_COURSE, "id_site") if c in dataset.columns]
    draw = seeded_uniform(SEED, *keys)
    drawn = dataset.withColumn("slice", F.floor(draw * DRAW_SLICES).cast("int"))
    slices = staged(drawn.groupBy("target", "slice").agg(F.count(F.lit(1)).alias("n")), "draw_slices")
    counts = {row["target"]: row["n"] for row in slices.groupBy("target").agg(F.sum("n").alias("n")).collect()}
    if not 0 < sample_size < sum(counts.values()):
        raise ValueError("The sample must be smaller than the dataset and not empty")
    quotas = largest_remainder(counts, sample_size)
    by_target = lambda values: F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("target"))
    before = Window.partitionBy("target").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    due = by_target(quotas) - F.coalesce(F.sum("n").over(before), F.lit(0))  # DRAW_SLICES rows a class
    ends = slices.withColumn("due", due).where("due > 0").groupBy("target").agg(F.max(F.struct("slice", "due")).alias("last"))
    last = {row["target"]: row["last"] for row in ends.collect()}
    end = by_target({target: row["slice"] for target, row in last.items()})
    held = staged(drawn.where(F.col("slice") <= end), "held")
    place = F.row_number().over(Window.partitionBy("target", "slice").orderBy(draw, *keys))
    cut = held.where(F.col("slice") == end).withColumn("place", place)
    cut = cut.where(F.col("place") <= by_target({target: row["due"] for target, row in last.items()}))
    return held.where(F.col("slice") < end).select(*dataset.columns).unionByName(cut.select(*dataset.columns))


def model_input(dataset: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The ranker's input columns, identifiers removed unless named in ``carry``.

    Categories become text with gaps left missing; a missing text becomes empty.
    """
    columns = []
    for name in MODEL_INPUT:
        if name == TEXT_FEATURE:
            columns.append(F.coalesce(F.col(name), F.lit("")).alias(name))
        elif name in CATEGORICAL_FEATURES:
            columns.append(F.col(name).cast("string").alias(name))
        else:
            columns.append(F.col(name).cast("double").alias(name))
    return dataset.select(*carry, *columns)


def prepare_model_input(training: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Input columns and ``target`` of both datasets."""
    return model_input(training, ["target"]), model_input(test, ["target"])
