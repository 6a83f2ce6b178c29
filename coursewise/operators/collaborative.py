"""Cosine-weighted clicks of learners with overlapping use.

For a learner with click row ``r`` and neighbours ``u`` the score of item i is
``sum_u cos(r, u) * u[i]``. With the item table ``M[j, i] = sum_u u[j] * u[i] / |u|`` this is
``sum_j r[j] * M[j, i] / |r|``; the factor ``1 / |r|`` falls out of the max-normalisation and
the learner itself adds nothing at unused items. So no pair of learners is ever formed.

A neighbour counts with the courses shared with the learner, so ``M`` depends on the learner's
course set. Neighbours of one course set have the same share of it: their part of ``M`` is one gram
per course set and intersection, added up by the course sets that have this intersection with it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from coursewise.operators.blocked_product import blocked_product
from coursewise.operators.learners import course_sets, learner_profiles
from coursewise.schemas import COURSE, ITEM
from coursewise.sources.staging import staged

ROWS_PER_BLOCK = 200_000
STEP = 2048
PAIRS = 2_000_000  # formed at a time
HELD = 8_000_000  # entries of a gram held before they leave the task


def shared_courses(interactions: DataFrame, sets: DataFrame, scope: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Who overlaps with whom: staged rows (neighbours, course_set, shared, courses), and learners.

    ``neighbours`` is a course set somebody has, ``course_set`` one that is asked for and
    ``courses`` their intersection, named ``shared``. Any number of course sets asked for may share
    the same courses with a set of neighbours. Learners are rows (id_student, neighbours).
    """
    learners = staged(
        learner_profiles(interactions, scope).select(
            *scope, "id_student", F.col("course_set").alias("neighbours"), "courses", F.size("used_sites").alias("n_sites")
        ),
        "neighbours",
    )
    held = learners.select(*scope, "neighbours", "courses").distinct().select(*scope, "neighbours", F.inline("courses"))
    overlaps = (
        held.join(sets.select(*scope, *COURSE, "course_set"), [*scope, *COURSE])
        .groupBy(*scope, "neighbours", "course_set")
        .agg(F.sort_array(F.collect_set(F.struct(*COURSE))).alias("courses"))
        .select(*scope, "neighbours", "course_set", F.to_json(F.struct(*scope, "courses")).alias("shared"), "courses")
    )
    return staged(overlaps, "overlaps"), learners.drop("courses")


def clicks_by_shared_courses(
    interactions: DataFrame, overlaps: DataFrame, learners: DataFrame, scope: Sequence[str] = ()
) -> DataFrame:
    """Mean clicks per neighbour set, shared courses, learner and resource.

    A learner's rows are copied to the distinct intersections of the learner's own courses with
    the sets asked for, not to those sets. Hashed learner blocks split an intersection that holds
    a large share of all rows; a block holds all of a learner's rows, so means and norms need no
    further shuffle. A set's blocks follow from the resources its learners used, an upper bound for
    each of its intersections.

    The small table of intersections is staged: Spark then knows its size beforehand. Otherwise the
    rows would shuffle by course set, of which there are few, and a task would sort a whole one.
    """
    parts = overlaps.select(*scope, "neighbours", "shared", "courses").distinct().select(*scope, "neighbours", "shared", F.inline("courses"))
    blocks = learners.groupBy("neighbours").agg(F.ceil(F.sum("n_sites") / ROWS_PER_BLOCK).alias("blocks"))
    parts = staged(parts.join(blocks, "neighbours"), "parts")
    rows = interactions.select(*scope, "id_student", "id_site", *COURSE, "total_resource_clicks").join(
        learners.drop("n_sites"), [*scope, "id_student"]
    )
    return (
        rows.join(parts, [*scope, "neighbours", *COURSE])
        .withColumn("block", F.pmod(F.xxhash64("id_student"), F.col("blocks")).cast("int"))
        .repartition("neighbours", "shared", "block")
        .groupBy("neighbours", "shared", "block", "id_student", "id_site")
        .agg(F.avg("total_resource_clicks").alias("clicks"))
        .where(F.col("clicks") != 0)
    )


def item_table(cells: DataFrame, overlaps: DataFrame) -> DataFrame:
    """``M`` in rows of course_set, id_site, features (resources) and weights.

    One gram per neighbour set and shared courses, summed inside the task and held as one row per
    resource; the course sets that share those courses add it up. Spark sums entries before they
    shuffle, by entry, so a resource that everybody uses is spread over many tasks.
    """
    grams = cells.groupBy("neighbours", "shared", "block").applyInArrow(
        partial_gram, "neighbours string, shared string, id_site long, others array<bigint>, weights array<double>"
    )
    entries = grams.join(overlaps.select("neighbours", "shared", "course_set"), ["neighbours", "shared"]).select(
        "course_set", "id_site", F.inline(F.arrays_zip("others", "weights")).alias("other", "weight")
    )
    summed = entries.groupBy("course_set", "id_site", "other").agg(F.sum("weight").alias("weight"))
    # a row has at most as many entries as the course set has resources
    return (
        summed.groupBy("course_set", "id_site")
        .agg(F.collect_list(F.struct("other", "weight")).alias("entries"))
        .select("course_set", "id_site", F.col("entries.other").alias("features"), F.col("entries.weight").alias("weights"))
    )


def summed_entries(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values summed by code, in order of the codes."""
    distinct, place = np.unique(codes, return_inverse=True)
    return distinct, np.bincount(place, weights=values, minlength=len(distinct))


def sparse_gram(row: np.ndarray, column: np.ndarray, clicks: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Entries (code, value) of sum_u u^T u / |u|, code = row * width + column, in bounded portions.

    Only the pairs of resources that one learner used are formed, PAIRS at a time (a learner's own
    pairs are cut too). What a portion sums up is kept until HELD entries are there.
    """
    order = np.argsort(row, kind="stable")
    row, column, clicks = row[order], column[order], clicks[order]
    scaled = clicks / np.sqrt(np.bincount(row, weights=clicks * clicks))[row]
    starts = np.searchsorted(row, np.arange(row[-1] + 2)) if len(row) else np.zeros(1, np.int64)
    partners = np.diff(starts)[row] if len(row) else np.zeros(0, np.int64)  # of each entry: its learner's entries
    before = np.r_[0, np.cumsum(partners)]
    codes, values, at, held = [], [], 0, 0
    while at < len(row):
        end = max(at + 1, int(np.searchsorted(before, before[at] + PAIRS, "right")) - 1)
        own = np.repeat(np.arange(at, end), partners[at:end])
        other = starts[row[own]] + np.arange(len(own)) - np.repeat(before[at:end] - before[at], partners[at:end])
        part = summed_entries(column[own].astype(np.int64) * width + column[other], clicks[own] * scaled[other])
        codes.append(part[0])
        values.append(part[1])
        held += len(part[0])
        at = end
        if held >= HELD:
            merged = summed_entries(np.concatenate(codes), np.concatenate(values))
            if 2 * len(merged[0]) >= HELD:
                yield merged
                codes, values, held = [], [], 0
            else:
                codes, values, held = [merged[0]], [merged[1]], len(merged[0])
    if codes:
        yield summed_entries(np.concatenate(codes), np.concatenate(values))


def dense_gram(row: np.ndarray, column: np.ndarray, clicks: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same for few resources, by products of blocks of STEP learners."""
    norm = np.sqrt(np.bincount(row, weights=clicks * clicks))
    gram = np.zeros((width, width))
    for start in range(0, len(norm), STEP):
        pick = (row >= start) & (row < start + STEP)
        block = np.zeros((min(STEP, len(norm) - start), width))
        block[row[pick] - start, column[pick]] = clicks[pick]
        gram += block.T @ (block / norm[start : start + STEP, None])
    j, i = np.nonzero(gram)
    yield j * width + i, gram[j, i]


def partial_gram(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The gram of one block as rows by resource; a resource may have several where it is large."""
    cells = pa.Table.from_batches([batch.select(["id_student", "id_site", "clicks"]) for batch in batches])
    students, row = np.unique(cells["id_student"].to_numpy(), return_inverse=True)
    sites, column = np.unique(cells["id_site"].to_numpy(), return_inverse=True)
    gram = dense_gram if len(sites) <= STEP and len(row) * 8 >= len(students) * len(sites) else sparse_gram
    for codes, values in gram(row, column, cells["clicks"].to_numpy(), len(sites)):
        site, other = codes // len(sites), codes % len(sites)
        starts = np.flatnonzero(np.r_[True, site[1:] != site[:-1]])
        borders = pa.array(np.r_[starts, len(site)].astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                pa.repeat(key[0], len(starts)),
                pa.repeat(key[1], len(starts)),
                pa.array(sites[site[starts]]),
                pa.ListArray.from_arrays(borders, pa.array(sites[other])),
                pa.ListArray.from_arrays(borders, pa.array(values)),
            ],
            ["neighbours", "shared", "id_site", "others", "weights"],
        )


def resource_details(
    interactions: DataFrame, sets: DataFrame, scope: Sequence[str] = ()
) -> DataFrame:
    return (
        interactions.select(*scope, *ITEM)
        .distinct()
        .join(sets.select(*scope, *COURSE, "course_set"), [*scope, *COURSE])
    )


def collaborative_sides(
    interactions: DataFrame, profiles: DataFrame, sets: DataFrame, scope: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Learners' clicks, the item table with details, and the (small) details by course set."""
    details = staged(resource_details(interactions, sets, scope), "details")
    overlaps, learners = shared_courses(interactions, sets, scope)
    cells = clicks_by_shared_courses(interactions, overlaps, learners, scope)
    items = item_table(cells, overlaps).join(details, ["course_set", "id_site"])
    learner_rows = (
        interactions.join(
            profiles.select(*scope, "id_student", "course_set"), [*scope, "id_student"]
        )
        .groupBy(*scope, "course_set", "id_student", "id_site")
        .agg(F.avg("total_resource_clicks").alias("weight"))
        .where(F.col("weight") != 0)
        .select(
            "course_set",
            "id_student",
            F.col("id_site").alias("feature"),
            "weight",
            F.col("id_site").alias("used_site"),
        )
    )
    return learner_rows, items, details


def raw_collaborative(
    interactions: DataFrame,
    profiles: DataFrame,
    scope: Sequence[str] = (),
    best: int | None = None,
    sets: DataFrame | None = None,
    normalised: bool = False,
) -> DataFrame:
    # several branches read the small tables: stage them
    if sets is None:
        sets = staged(course_sets(profiles, scope), "course_sets")
    learner_rows, items, details = collaborative_sides(interactions, profiles, sets, scope)
    n_items = F.count(F.lit(1))
    sizes = (
        details.groupBy("course_set")
        .agg(n_items.alias("n_items"), (n_items * n_items).alias("n_entries"))
        .join(sets.select("course_set", "n_learners").distinct(), "course_set")
    )
    return blocked_product(learner_rows, items, sizes, [*scope, *ITEM], best, normalised)


def collaborative_scores(
    interactions: DataFrame,
    profiles: DataFrame,
    scope: Sequence[str] = (),
    best: int | None = None,
) -> DataFrame:
    found = raw_collaborative(interactions, profiles, scope, best, normalised=True)
    return found.select(*scope, "id_student", *ITEM, F.col("raw_score").alias("collaborative_score"))
