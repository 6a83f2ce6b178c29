"""The rows that can be among the ``k`` best of any source or of their mix, from one block product.

Scoring all pairs, shuffling them by learner and ranking there moves every unused resource of
every learner once per source. Here the three sources meet in the block of learners and items in
which their scores arise: popularity is one more vector of the items, a block normalises, mixes and
ranks, and only rows that can be among the ``k`` best of a learner-course leave it. The final
ranking decides among them as it would on all rows.

Normalising needs the learner's best score over all items. Where the items of a course set make
several blocks, a first pass sends one maximum per learner, source and block; the second pass gets
them with the learner's rows. So every block prunes by exact scores, whatever their number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from coursewise.functions.scores import HYBRID_WEIGHTS, RANKING_STEP, check_k, check_weights
from coursewise.operators import blocked_product as blocks
from coursewise.operators.collaborative import collaborative_sides
from coursewise.operators.content import content_sides
from coursewise.operators.learners import course_sets
from coursewise.operators.popularity import item_clicks
from coursewise.schemas import COURSE, ITEM
from coursewise.sources.staging import staged

LEARNERS_PER_STEP = 1024  # scored at a time inside a task
LEARNERS_PER_BLOCK = 16_384  # that items are sent to at once
ROWS_PER_BLOCK = 2_000_000  # entries of learners
SOURCES = ["popularity", "collaborative", "content"]
BEST = "best "  # prefix of rows that carry a learner's best score of a source
RANKED = (*SOURCES, "hybrid")
KEYS = ["course_set", "learner_block", "item_block"]


def item_rows(interactions: DataFrame, sets: DataFrame, collaborative: DataFrame, content: DataFrame, scope: Sequence[str]) -> DataFrame:
    """course_set, source, resource, features, weights; popularity has one feature without a name."""
    popular = (
        item_clicks(interactions, scope)
        .where(F.col("raw_score").isNotNull())
        .join(sets.select(*scope, *COURSE, "course_set"), [*scope, *COURSE])
        .withColumn("features", F.array(F.lit("")))
        .withColumn("weights", F.array("raw_score"))
    )
    together = None
    for source, rows in zip(SOURCES, [popular, collaborative, content]):
        rows = rows.select(
            "course_set",
            F.lit(source).alias("source"),
            *scope,
            *ITEM,
            F.col("features").cast("array<string>").alias("features"),
            "weights",
        )
        together = rows if together is None else together.unionByName(rows)
    return together


def learner_rows(profiles: DataFrame, collaborative: DataFrame, content: DataFrame) -> DataFrame:
    """course_set, id_student, source, features, weights, used_sites, top: a row per learner and source.

    Vectors and used resources are arrays, so a learner's long course set is written once a source
    and not once an entry. Every learner has a popularity row. Used resources are masked for
    popularity and content, for the collaborative source only those with clicks.
    """
    keys = ["course_set", "id_student"]

    def rows(df: DataFrame, source: str) -> DataFrame:
        return df.select(
            *keys,
            F.lit(source).alias("source"),
            F.col("features").cast("array<string>").alias("features"),
            F.col("weights").cast("array<double>").alias("weights"),
            F.col("used_sites").cast("array<long>").alias("used_sites"),
            F.lit(None).cast("double").alias("top"),
        )

    everyone = profiles.select(*keys, "used_sites", F.array(F.lit("")).alias("features"), F.array(F.lit(1.0)).alias("weights"))
    entries = F.collect_list(F.struct("feature", "weight")).alias("entries")

    def vectors(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys).agg(entries).select(*keys, F.col("entries.feature").alias("features"), F.col("entries.weight").alias("weights"))

    return (
        rows(everyone, "popularity")
        .unionByName(rows(vectors(collaborative).withColumn("used_sites", F.col("features")), "collaborative"))
        .unionByName(rows(vectors(content).withColumn("used_sites", F.array()), "content"))
    )


def block_counts(learners: DataFrame, items: DataFrame) -> DataFrame:
    """learner_blocks and item_blocks of every course set, from counted entries."""
    of_learners = learners.groupBy("course_set").agg(
        F.sum(F.size("features") + F.size("used_sites")).alias("n_rows"), F.count_if(F.col("source") == "popularity").alias("n_learners")
    )
    of_items = items.groupBy("course_set").agg(
        F.count_distinct(F.struct(*ITEM)).alias("n_items"), F.sum(F.size("features")).alias("n_entries")
    )
    return of_learners.join(of_items, "course_set").select(
        "course_set",
        F.greatest(F.ceil(F.col("n_learners") / LEARNERS_PER_BLOCK), F.ceil(F.col("n_rows") / ROWS_PER_BLOCK)).alias("learner_blocks"),
        F.greatest(
            F.ceil(F.col("n_items") / blocks.ITEMS_PER_BLOCK), F.ceil(F.col("n_entries") / blocks.ENTRIES_PER_BLOCK)
        ).alias("item_blocks"),
    )


def _met(learners: DataFrame, items: DataFrame, counts: DataFrame):
    """Both sides grouped by their block pairs; each row goes to every block of the other side."""
    every = lambda column: F.explode(F.sequence(F.lit(0), (F.col(column) - 1).cast("int")))
    bucket = lambda column, n: F.pmod(F.xxhash64(column), F.col(n)).cast("int")
    left = learners.join(counts, "course_set").select(
        *learners.columns, bucket("id_student", "learner_blocks").alias("learner_block"), every("item_blocks").alias("item_block")
    )
    right = items.join(counts, "course_set").select(
        *items.columns, every("learner_blocks").alias("learner_block"), bucket("id_site", "item_blocks").alias("item_block")
    )
    return left.groupBy(*KEYS).cogroup(right.groupBy(*KEYS))


def best_scores(
    interactions: DataFrame,
    resources: DataFrame,
    profiles: DataFrame,
    k: int,
    scope: Sequence[str] = (),
    weights: dict[str, float] = HYBRID_WEIGHTS,
    ranked: Sequence[str] = RANKED,
) -> DataFrame:
    """Normalised scores of all rows that can be among the ``k`` best by a score of ``ranked``.

    Columns are those of ``score_table`` without the random draw; rows below the ``k`` best of
    their learner-course in every ranked column may be missing, the others and their order are the same.
    """
    check_k(k)
    check_weights(**weights)
    sets = staged(course_sets(profiles, scope), "course_sets")
    clicked, table, _ = collaborative_sides(interactions, profiles, sets, scope)
    profile, catalogue, _ = content_sides(resources, profiles, sets, scope)
    items = staged(item_rows(interactions, sets, table, catalogue, scope), "block_items")
    learners = staged(learner_rows(profiles, clicked, profile), "block_learners")
    counts = staged(block_counts(learners, items), "block_counts")
    detail = [*scope, *ITEM]
    several = counts.where("item_blocks > 1")
    if not several.isEmpty():
        maxima = _met(learners, items, several).applyInArrow(
            _block_maxima(detail), "course_set string, id_student long, source string, top double"
        )
        tops = maxima.groupBy("course_set", "id_student", "source").agg(F.max("top").alias("top"))
        learners = learners.unionByName(tops, allowMissingColumns=True)
    kinds = {f.name: f for f in items.schema}
    scores = [f"{source}_score" for source in SOURCES]
    schema = StructType(
        [
            StructField("id_student", LongType()),
            *[kinds[name] for name in detail],
            *[StructField(name, DoubleType()) for name in [*scores, "hybrid_score"]],
        ]
    )
    mix = {source: float(weights[source]) for source in ["popularity", "content", "collaborative"]}
    found = _met(learners, items, counts).applyInArrow(_block_best(detail, COURSE, mix, k, 2 * RANKING_STEP, ranked), schema)
    return found.select(*scope, "id_student", *ITEM, *scores, "hybrid_score")


def _numbered(rows: pa.Table, names: Sequence[str]) -> pa.Array:
    """Rows with the same values, gaps included, get the same number."""
    texts = [rows[name].cast(pa.string()) for name in names]
    joined = pc.binary_join_element_wise(*texts, "\x1f", null_handling="replace", null_replacement="\x1e")
    return joined.combine_chunks().dictionary_encode()


class _Items:
    """The different items of a block in order of their ids, and their vectors by source."""

    def __init__(self, rows: pa.Table, detail: Sequence[str]):
        codes = _numbered(rows, detail).indices.to_numpy()
        _, first = np.unique(codes, return_index=True)
        order = np.argsort(rows["id_site"].to_numpy()[first], kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.rows = rows.take(pa.array(first[order]))
        self.sites = self.rows["id_site"].to_numpy()
        self.entries = {}
        sources = rows["source"].to_numpy(zero_copy_only=False)
        for source in SOURCES:
            mine = np.flatnonzero(sources == source)
            lists = rows["features"].take(pa.array(mine)).combine_chunks()
            weights = rows["weights"].take(pa.array(mine)).combine_chunks()
            column = np.repeat(place[codes[mine]], pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            features = lists.flatten()
            vocabulary = features.unique()
            entry = pc.index_in(features, vocabulary).to_numpy(zero_copy_only=False)
            self.entries[source] = vocabulary, (column, entry, weights.flatten().to_numpy())

    def __len__(self) -> int:
        return len(self.sites)


def _listed(rows: pa.Table, column: str, at: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The values of a list column, and for each of them the entry of ``at`` of its row."""
    lists = rows[column].combine_chunks()
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(at, counts), lists.flatten()


def _scored(learners: pa.Table, items: _Items) -> Iterator[tuple[np.ndarray, dict, dict]]:
    """Per step of learners: ids, raw scores by source with gaps as -inf, and given maxima."""
    learners = learners.sort_by("id_student")
    students, row = np.unique(learners["id_student"].to_numpy(), return_inverse=True)
    borders = np.searchsorted(row, np.arange(0, len(students) + LEARNERS_PER_STEP, LEARNERS_PER_STEP))
    for step, (start, end) in enumerate(zip(borders[:-1], borders[1:])):
        ids = students[step * LEARNERS_PER_STEP : (step + 1) * LEARNERS_PER_STEP]
        part = learners.slice(start, end - start)
        at = row[start:end] - step * LEARNERS_PER_STEP
        sources = part["source"].to_numpy(zero_copy_only=False)
        top = pc.fill_null(part["top"], 0.0).to_numpy()
        raw, tops = {}, {}
        for source in SOURCES:
            vocabulary, entries = items.entries[source]
            mine = np.flatnonzero(sources == source)
            own = part.select(["features", "weights"]).take(pa.array(mine))
            owner, features = _listed(own, "features", at[mine])
            weight = pc.fill_null(_listed(own, "weights", at[mine])[1], 0.0).to_numpy(zero_copy_only=False)
            number = pc.fill_null(pc.index_in(features, vocabulary), -1).to_numpy(zero_copy_only=False)
            known = (number >= 0) & pc.is_valid(features).to_numpy(zero_copy_only=False)
            scores = blocks.multiplied((len(ids), len(items)), (owner[known], number[known], weight[known]), entries)
            listed = np.zeros(len(items), dtype=bool)
            listed[entries[0]] = True
            gone = ~listed[None, :] if source == "popularity" else scores <= 0
            hidden = np.flatnonzero(sources == ("collaborative" if source == "collaborative" else "popularity"))
            owner, used = _listed(part.select(["used_sites"]).take(pa.array(hidden)), "used_sites", at[hidden])
            used = used.to_numpy(zero_copy_only=False)
            first = np.searchsorted(items.sites, used)
            count = np.searchsorted(items.sites, used, "right") - first
            column = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            mask = np.zeros(scores.shape, dtype=bool)
            mask[np.repeat(owner, count), column] = True
            scores[mask | gone] = -np.inf
            raw[source] = scores
            given = sources == BEST + source
            if given.any():
                tops[source] = np.full(len(ids), -np.inf)
                tops[source][at[given]] = top[given]
        yield ids, raw, tops


def _block_maxima(detail: Sequence[str]) -> Callable:
    def run(key: tuple[pa.Scalar, ...], learners: pa.Table, items: pa.Table) -> pa.Table:
        kept = _Items(items, detail)
        parts = {"id_student": [], "source": [], "top": []}
        for ids, raw, _ in _scored(learners, kept) if len(kept) else ():
            for source in SOURCES:
                top = raw[source].max(axis=1)
                some = np.isfinite(top)
                parts["id_student"].append(ids[some])
                parts["source"].append(np.full(some.sum(), BEST + source, dtype=object))
                parts["top"].append(top[some])
        together = {
            name: np.concatenate(values) if values else np.zeros(0, dtype=kind)
            for (name, values), kind in zip(parts.items(), [np.int64, object, np.float64])
        }
        return pa.table(
            {
                "course_set": pa.repeat(key[0], len(together["id_student"])),
                "id_student": together["id_student"],
                "source": pa.array(together["source"], pa.string()),
                "top": together["top"],
            }
        )

    return run


def among_best(scores: np.ndarray, k: int, tolerance: float) -> np.ndarray:
    """Which columns can be among a row's ``k`` best; gaps are -inf, ties go to earlier columns.

    A column is left out if ``k`` others are higher by more than ``tolerance``, or equal to it and
    earlier.
    """
    there = np.isfinite(scores)
    if scores.shape[1] <= k:
        return there
    last = np.partition(scores, scores.shape[1] - k, axis=1)[:, [scores.shape[1] - k]]
    keep = there & (scores >= last - tolerance)
    equal = there & (scores == last)
    above = (scores > last + tolerance).sum(axis=1, keepdims=True)
    return keep & (~equal | (np.cumsum(equal, axis=1) <= k - above))


def _block_best(
    detail: Sequence[str], course: Sequence[str], mix: dict[str, float], k: int, tolerance: float, ranked: Sequence[str]
) -> Callable:
    names = [*SOURCES, "hybrid"]

    def run(learners: pa.Table, items: pa.Table) -> pa.Table:
        kept = _Items(items, detail)
        found = {name: [] for name in ["id_student", "item", *names]}
        codes = _numbered(kept.rows, course).indices.to_numpy() if len(kept) else np.zeros(0, np.int64)
        courses = [np.flatnonzero(codes == code) for code in np.unique(codes)]
        for ids, raw, tops in _scored(learners, kept) if len(kept) else ():
            scores = {}
            for source in SOURCES:
                top = tops.get(source, raw[source].max(axis=1))[:, None]
                scores[source] = np.where(top > 0, raw[source] / np.where(top > 0, top, 1.0), raw[source])
            there = np.logical_or.reduce([np.isfinite(scores[s]) for s in SOURCES])
            mixed = sum(mix[s] * np.where(np.isfinite(scores[s]), scores[s], 0.0) for s in mix)
            scores["hybrid"] = np.where(there, mixed, -np.inf)
            keep = np.zeros(there.shape, dtype=bool)
            for columns in courses:
                for name in ranked:
                    keep[:, columns] |= among_best(scores[name][:, columns], k, tolerance)
            who, what = np.nonzero(keep)
            found["id_student"].append(ids[who])
            found["item"].append(what)
            for name in names:
                found[name].append(scores[name][who, what])
        joined = {
            name: np.concatenate(values) if values else np.zeros(0, np.int64 if name in ("id_student", "item") else float)
            for name, values in found.items()
        }
        taken = kept.rows.select(detail).take(pa.array(joined["item"], pa.int64()))
        return pa.table(
            {
                "id_student": joined["id_student"],
                **{name: taken[name] for name in detail},
                **{
                    f"{name}_score": pa.array(joined[name], pa.float64(), mask=~np.isfinite(joined[name]))
                    for name in names
                },
            }
        )

    return run
