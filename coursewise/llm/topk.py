"""Exact top-k inner products by a three-phase uniform threshold.

Vectors become whole numbers, and their components are dealt out to ``GROUPS`` lists, stored as
columns: a list holds the partial scores of its own components.

1. Every list reports, block by block, the best partial scores of each query; the best of a list
   are scored exactly. The k-th best exact score of a query is a safe cutoff: k vectors reach it.
2. The cutoff is sent to all blocks. A vector whose score reaches it has a partial score of at
   least cutoff / GROUPS in some list, so each list returns all entries from there on.
3. What was returned is scored exactly and ranked.

Equal vectors are one entry that carries its k + 1 smallest ids, so very common vectors cost no
more than rare ones. Queries go through in sets of bounded size, each a pass over all blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from coursewise.sources.staging import staged

K = 10
SCALE = 1024
GROUPS = 2
QUERY_SET = 8192


def whole_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and vec, of the rows whose id and components are all there and finite."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return table.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))).select("vec_id", whole.alias("vec"))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of whole numbers: in doubles while they hold them, else in integers."""
    if fits(a, b, 53):
        return np.rint(a.astype(float) @ b.T.astype(float)).astype(np.int64)
    if not fits(a, b, 63):
        raise OverflowError("inner products of these vectors exceed a long")
    return a @ b.T


def fits(a: np.ndarray, b: np.ndarray, bits: int) -> bool:
    """Whether no inner product of rows can reach 2^bits."""
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1]) < 2.0**bits


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def entries(classes: DataFrame, group: int, ids: np.ndarray, queries: np.ndarray, pick, step: int = 2048) -> DataFrame:
    """(query, rep, partial) of what ``pick`` chooses from each block of partial scores."""
    width = queries.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                block = batch.slice(at, step)
                reps = block.column("rep").to_numpy()
                partial = product(queries, matrix(block.column("part"), width))
                q, v = pick(partial)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[q]), pa.array(reps[v]), pa.array(partial[q, v])], ["query", "rep", "partial"]
                )

    return classes.select("rep", F.col(f"part_{group}").alias("part")).mapInArrow(run, "query long, rep long, partial long")


def best_of_block(k: int):
    def pick(partial: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = min(k, partial.shape[1])
        v = np.argpartition(-partial, n - 1, axis=1)[:, :n] if n else np.zeros((len(partial), 0), np.int64)
        return np.repeat(np.arange(len(partial)), n), v.ravel()

    return pick


def from_cutoff(cutoffs: np.ndarray, groups: int):
    def pick(partial: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.nonzero(partial * groups >= cutoffs[:, None])

    return pick


def scorer(classes: DataFrame, ids: np.ndarray, queries: np.ndarray):
    """A function from (query, rep) to (query, score, vec_id): exact scores, without the own id."""
    order = np.argsort(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                place = order[np.searchsorted(ids[order], batch.column("query").to_numpy())]
                vec = matrix(batch.column("vec"), queries.shape[1])
                if not fits(vec, queries, 63):
                    raise OverflowError("inner products of these vectors exceed a long")
                score = (vec * queries[place]).sum(1)
                yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("ids"), pa.array(score)], ["query", "ids", "score"])

    def exact(pairs: DataFrame) -> DataFrame:
        vectors = pairs.join(classes, "rep").select("query", "ids", "vec")
        scored = vectors.mapInArrow(run, "query long, ids array<long>, score long")
        return scored.select("query", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query")

    return exact


def top_k(table: DataFrame, is_query: Column, k: int = K, groups: int = GROUPS) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query's k best other ids, ties to the smaller id.

    Left out: vectors that are null or hold null or non-finite components. A query is scored
    against the vectors of its own length, a pass for each length that a query has. A query with
    fewer than k others gets all of them. Repeated rows of an id count once if their vectors are
    equal; an id with several vectors queries with the smallest one, and can be found by each.
    Components whose inner products may exceed a long raise an error.
    """
    vectors = staged(whole_vectors(table), "vectors")
    asking = vectors.where(is_query).groupBy("vec_id").agg(F.min("vec").alias("qvec"))
    asking = staged(asking.select(F.col("vec_id").alias("query"), "qvec", F.size("qvec").alias("width")), "vector-queries")
    widths = sorted(r["width"] for r in asking.select("width").distinct().collect() if r["width"])
    results = [top_k_of_width(vectors, asking.where(F.col("width") == w).drop("width"), w, k, groups) for w in widths or [0]]
    out = results[0]
    for other in results[1:]:
        out = out.union(other)
    return out


def top_k_of_width(vectors: DataFrame, queries: DataFrame, width: int, k: int, groups: int) -> DataFrame:
    vectors = vectors.where(F.size("vec") == width)
    place = F.dense_rank().over(Window.partitionBy("vec").orderBy("vec_id"))
    few = vectors.withColumn("place", place).where(F.col("place") <= k + 1)
    bounds = [width * g // groups for g in range(groups + 1)]
    classes = few.groupBy("vec").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    parts = [F.slice("vec", bounds[g] + 1, bounds[g + 1] - bounds[g]).alias(f"part_{g}") for g in range(groups)]
    # an id with several vectors is in several classes, so a class has a number of its own
    classes = staged(classes.select(F.monotonically_increasing_id().alias("rep"), "ids", "vec", *parts), "vector-classes")
    sets = max(1, math.ceil(queries.count() / QUERY_SET))
    results = []
    for s in range(sets):
        own = queries.where(F.pmod(F.xxhash64("query"), F.lit(sets)) == s)
        rows = own.toArrow()  # about QUERY_SET rows
        ids = rows.column("query").to_numpy()
        held = matrix(rows.column("qvec").combine_chunks(), max(width, 1)) if len(ids) else np.zeros((0, width), np.int64)
        slices = [np.ascontiguousarray(held[:, bounds[g] : bounds[g + 1]]) for g in range(groups)]

        exact = scorer(classes.select("rep", "ids", "vec"), ids, held)
        best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        first = None
        for g in range(groups):
            local = entries(classes, g, ids, slices[g], best_of_block(k))
            at = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("partial"), "rep"))
            top = local.withColumn("at", at).where(F.col("at") <= k).select("query", "rep")
            first = top if first is None else first.union(top)
        reached = exact(first.distinct()).distinct().withColumn("at", F.row_number().over(best)).where(F.col("at") == k)
        known = {r["query"]: r["score"] for r in reached.select("query", "score").toLocalIterator()}
        lowest = -(2**62) // groups
        cutoffs = np.array([known.get(int(q), lowest) for q in ids], np.int64)
        found = None
        for g in range(groups):
            more = entries(classes, g, ids, slices[g], from_cutoff(cutoffs, groups)).select("query", "rep")
            found = more if found is None else found.union(more)
        ranked = exact(found.distinct()).distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        results.append(ranked.select(F.col("query").alias("query_id"), "rank", "vec_id", "score"))
    if sets == 1:
        return results[0]
    written = [staged(r, "topk") for r in results]
    out = written[0]
    for r in written[1:]:
        out = out.union(r)
    return out
