"""Sparse learner-by-feature times feature-by-item products in bounded blocks.

A learner's score for an item is the dot product of the learner's vector and the item's
vector. Joining the two on the feature would emit a row per learner, item and shared
feature. Here Spark brings a bounded block of learners and a bounded block of items of one
course set together and the block is multiplied in numpy, so only scores leave the task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from coursewise.functions.scores import RANKING_STEP, max_normalised
from coursewise.schemas import COURSE, ITEM
from coursewise.sources.staging import staged

LEARNERS_PER_BLOCK = 1024
ITEMS_PER_BLOCK = 2048
ENTRIES_PER_BLOCK = 4_000_000
COLUMNS_PER_STEP = 2048


def _bucket(column: str, blocks: str):
    return F.pmod(F.xxhash64(column), F.col(blocks)).cast("int")


def blocked_product(
    learner_rows: DataFrame,
    item_rows: DataFrame,
    sizes: DataFrame,
    detail: Sequence[str],
    best: int | None = None,
    normalised: bool = False,
) -> DataFrame:
    """Positive scores of unused items: id_student, ``detail`` columns, raw_score.

    With ``normalised``, scores are divided by the learner's best one, in the block: a learner has one
    course set and one learner block of it, so rows shuffle for it only where items make several blocks.

    With ``best``, a block leaves out items that cannot be among a learner's ``best`` of their
    course, as that many of the block surely rank higher. Scores within the rounding of the final
    ranking of the last place stay, so the ranking of what is left decides as it would on all
    rows. How wide that rounding is follows from the learner's best score over all blocks, for
    which a block takes an upper bound: the sum of the learner's weights times the largest weight
    of the course set's items. So every block prunes, whatever their number.

    learner_rows: course_set, id_student, feature, weight, used_site. A row with a feature
    is an entry of the learner's vector, a row with a used_site masks that item.
    item_rows: course_set, ``detail`` (with id_site), features, weights (arrays).
    sizes: course_set, n_learners, n_items, n_entries; upper bounds are enough.
    """
    blocks = sizes.select(
        "course_set",
        F.ceil(F.col("n_learners") / LEARNERS_PER_BLOCK).alias("learner_blocks"),
        F.greatest(
            F.ceil(F.col("n_items") / ITEMS_PER_BLOCK),
            F.ceil(F.col("n_entries") / ENTRIES_PER_BLOCK),
        ).alias("item_blocks"),
    )
    # the block counts are staged, so that Spark knows how small they are: joining them by course
    # set, of which there are few, must not shuffle the learners' rows
    if best is not None:
        item_rows = staged(item_rows, "item_rows")
        largest = item_rows.groupBy("course_set").agg(F.max(F.array_max("weights")).alias("largest"))
        blocks = blocks.join(largest, "course_set")
    else:
        blocks = blocks.withColumn("largest", F.lit(0.0))
    blocks = staged(blocks, "blocks")
    whole = normalised and blocks.where("item_blocks > 1").isEmpty()
    last = lambda column: F.sequence(F.lit(0), (F.col(column) - 1).cast("int"))
    keys = ["course_set", "learner_block", "item_block"]
    # the alias tells the two sides apart when both come from one course-set table
    learner_side = learner_rows.join(blocks, "course_set").select(
        F.col("course_set").alias("course_set"),
        _bucket("id_student", "learner_blocks").alias("learner_block"),
        F.explode(last("item_blocks")).alias("item_block"),
        "id_student",
        "feature",
        "weight",
        "used_site",
    )
    item_side = item_rows.join(blocks, "course_set").select(
        "course_set",
        F.explode(last("learner_blocks")).alias("learner_block"),
        _bucket("id_site", "item_blocks").alias("item_block"),
        *detail,
        "features",
        "weights",
        "largest",
    )
    kinds = {f.name: f for f in item_rows.schema}
    schema = StructType(
        [
            StructField("id_student", LongType()),
            *[kinds[name] for name in detail],
            StructField("raw_score", DoubleType()),
        ]
    )
    scored = (
        learner_side.groupBy(*keys)
        .cogroup(item_side.groupBy(*keys))
        .applyInArrow(_block_scores(list(detail), COLUMNS_PER_STEP, best, COURSE, 2 * RANKING_STEP, whole), schema)
    )
    if normalised and not whole:
        return max_normalised(scored, "raw_score", [c for c in detail if c not in ITEM])
    return scored


def multiplied(
    shape: tuple[int, int],
    left: tuple[np.ndarray, np.ndarray, np.ndarray],
    right: tuple[np.ndarray, np.ndarray, np.ndarray],
    step: int = COLUMNS_PER_STEP,
) -> np.ndarray:
    """Dense product of two sparse matrices in entries (row or column, feature, weight).

    Features are numbered from 0; ``step`` of them are made dense at a time.
    """
    scores = np.zeros(shape)
    row, feature, weight = left
    column, entry, entry_weight = right
    for start in range(0, int(entry.max()) + 1 if len(entry) else 0, step):
        pick = (feature >= start) & (feature < start + step)
        if not pick.any():
            continue
        dense_left = np.zeros((shape[0], step))
        dense_left[row[pick], feature[pick] - start] = weight[pick]
        pick = (entry >= start) & (entry < start + step)
        width = int(entry[pick].max()) - start + 1 if pick.any() else 0
        dense_right = np.zeros((width, shape[1]))
        dense_right[entry[pick] - start, column[pick]] = entry_weight[pick]
        scores += dense_left[:, :width] @ dense_right
    return scores


def _block_scores(
    detail: list[str], step: int, best: int | None, course: list[str], tolerance: float, normalised: bool = False
):
    def run(learners: pa.Table, items: pa.Table) -> pa.Table:
        students, row = np.unique(learners["id_student"].to_numpy(), return_inverse=True)
        features = items["features"].combine_chunks()
        entries = features.flatten()
        vocabulary = entries.unique()
        owner = np.repeat(
            np.arange(items.num_rows), pc.list_value_length(features).to_numpy(zero_copy_only=False)
        )
        entry = pc.index_in(entries, vocabulary).to_numpy(zero_copy_only=False)
        entry_weight = items["weights"].combine_chunks().flatten().to_numpy()
        feature = pc.fill_null(
            pc.index_in(learners["feature"].combine_chunks(), vocabulary), -1
        ).to_numpy()
        given = pc.is_valid(learners["feature"]).to_numpy() & (feature >= 0)
        weight = pc.fill_null(learners["weight"], 0.0).to_numpy()
        scores = multiplied(
            (len(students), items.num_rows), (row[given], feature[given], weight[given]), (owner, entry, entry_weight), step
        )
        sites, column = np.unique(items["id_site"].to_numpy(), return_inverse=True)
        masked = pc.is_valid(learners["used_site"]).to_numpy()
        used = pc.fill_null(learners["used_site"], 0).to_numpy()[masked]
        if len(sites) and len(used):
            place = np.minimum(np.searchsorted(sites, used), len(sites) - 1)
            hit = sites[place] == used
            mask = np.zeros((len(students), len(sites)), dtype=bool)
            mask[row[masked][hit], place[hit]] = True
            scores[mask[:, column]] = 0.0
        keep = scores > 0
        if best is not None and items.num_rows:
            total = np.bincount(row, weights=np.where(pc.is_valid(learners["feature"]).to_numpy(), np.abs(weight), 0.0))
            slack = tolerance * total[:, None] * items["largest"][0].as_py()
            names = pc.binary_join_element_wise(*[items[c] for c in course], "\x1f")
            codes = names.combine_chunks().dictionary_encode().indices.to_numpy()
            for code in np.unique(codes):
                of_course = np.flatnonzero(codes == code)
                if len(of_course) > best:
                    part = scores[:, of_course]
                    last = np.partition(part, len(of_course) - best, axis=1)
                    keep[:, of_course] &= part >= last[:, [len(of_course) - best]] - slack
        if normalised and items.num_rows:
            top = np.where(keep, scores, 0.0).max(axis=1, keepdims=True)
            scores = scores / np.where(top > 0, top, 1.0)
        who, what = np.nonzero(keep)
        taken = items.select(detail).take(pa.array(what))
        return pa.table(
            {
                "id_student": students[who],
                **{name: taken[name] for name in detail},
                "raw_score": scores[who, what],
            }
        )

    return run
