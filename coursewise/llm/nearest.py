"""Approximate nearest neighbours: a graph built by NN-descent, searched greedily.

Equal vectors are one node that carries its k + 1 smallest ids, so very common vectors cost no more
than rare ones and don't fill the lists of their neighbourhood. A node's code is its vector in
bytes with a scale of its own; codes travel while the graph is built and searched, the original
vectors only for the last, exact distances.

Start: every node goes to the cells of its nearest pivots, a bounded sample of nodes; cells above
``CELL`` nodes are cut into blocks, and each block returns a node's nearest ones in it.

Descent: a round joins, at every node, the nodes that became neighbours since the last round, in
both directions, with each other and with older neighbours: neighbours of neighbours. What is nearer
than a node's last neighbour goes to that node, best ones first inside the task. Rounds end when few
entries change. The reverse neighbours met in one round are the nearest ``JOINED``, so a hub is no
hot key.

Search: a query starts at its own node and looks, hop by hop, at the neighbours (in both directions)
of the best nodes it has not yet opened, until none of its ``BEAM`` best ones is left to open. A hop
is one join of the frontiers of all queries with the graph and one with the codes. The best nodes are
then measured exactly on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from coursewise.sources.staging import staged

K = 10
NEIGHBOURS = 20
CELL = 4096
CELLS = 6  # that a node belongs to, if there are as many pivots
PER_CELL = 12  # neighbours a block returns where a node has several
PIVOTS = 4096  # most rows of the sample
JOINED = 8  # new neighbours a node joins in a round, by direction
ROUNDS = 8
SETTLED = 0.03  # share of changed entries at which the rounds end
BEAM = 80
MEASURED = 40  # best nodes of a query that are measured exactly
BUCKET = 4096  # nodes merged at a time
EDGES = "node long, near array<bigint>, far array<float>"
GRAPH = EDGES + ", fresh array<boolean>, arrived int"


def usable_vectors(table: DataFrame) -> DataFrame:
    """vec_id and vec of the rows whose id and components are all there, finite and not all zero."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = finite & F.exists("embedding", lambda x: x != 0)
    return table.where(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False))).select("vec_id", F.col("embedding").alias("vec"))


# --- codes -----------------------------------------------------------------------------------


def code_of(vector: np.ndarray) -> bytes:
    scale = float(np.abs(vector).max()) / 127
    return np.float64(scale).tobytes() + np.rint(vector / scale if scale else vector * 0).astype(np.int8).tobytes()


def decoded(codes: pa.Array) -> np.ndarray:
    """The rows of a matrix from codes of one length."""
    size = len(codes[0].as_py())
    raw = np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(len(codes), size)
    return raw[:, 8:].view(np.int8).astype(np.float32) * raw[:, :8].copy().view(np.float64).astype(np.float32)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between the rows of a and b (over the last two axes), in single precision."""
    with np.errstate(all="ignore"):
        squares = (a * a).sum(-1)[..., :, None] + (b * b).sum(-1)[..., None, :] - 2 * (a @ np.swapaxes(b, -1, -2))
        return np.sqrt(np.maximum(np.nan_to_num(squares, nan=np.inf, posinf=np.inf), 0))


def nodes_of(vectors: DataFrame, k: int) -> DataFrame:
    """Staged nodes (node, ids, vec, code) of the distinct vectors."""
    place = F.dense_rank().over(Window.partitionBy("vec").orderBy("vec_id"))
    few = vectors.withColumn("place", place).where(F.col("place") <= k + 1)
    classes = few.groupBy("vec").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    numbered = classes.select(F.monotonically_increasing_id().alias("node"), "ids", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("vec")
            codes = [code_of(np.asarray(rows[i].values, float)) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary())], [*batch.schema.names, "code"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema)
    return staged(numbered.mapInArrow(run, f"{kinds}, code binary"), "nodes")


# --- lists of neighbours -----------------------------------------------------------------------

OLD, FRESH, ARRIVED = 0, 1, 2


def best_entries(node: np.ndarray, near: np.ndarray, far: np.ndarray, state: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k nearest different neighbours of each node; an entry already in the graph keeps its state."""
    order = np.lexsort((far, state, near, node))
    node, near, far, state = node[order], near[order], far[order], state[order]
    once = np.r_[True, (node[1:] != node[:-1]) | (near[1:] != near[:-1])][: len(node)]
    node, near, far, state = node[once], near[once], far[once], state[once]
    order = np.lexsort((near, far, node))
    node, near, far, state = node[order], near[order], far[order], state[order]
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]][: len(node)])
    place = np.arange(len(node)) - np.repeat(starts, np.diff(np.r_[starts, len(node)]))
    kept = place < k
    return node[kept], near[kept], far[kept], state[kept]


def listed(node: np.ndarray, near: np.ndarray, far: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array, np.ndarray]:
    """Arrays of the rows (node, near, far) of entries sorted by node, and the rows' borders."""
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]][: len(node)])
    borders = pa.array(np.r_[starts, len(node)].astype(np.int32))
    lists = [pa.ListArray.from_arrays(borders, pa.array(x)) for x in (near.astype(np.int64), far.astype(np.float32))]
    return pa.array(node[starts]), *lists, starts


def entries_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat node, near and far of rows with lists."""
    near, far = (table.column(c).combine_chunks() for c in ("near", "far"))
    sizes = near.value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(table.column("node").to_numpy(), sizes), near.flatten().to_numpy(), far.flatten().to_numpy()


def merged(edges: DataFrame, buckets: int, k: int) -> DataFrame:
    """The graph of the k nearest entries from rows of EDGES and, where they are of a graph, ``fresh``.

    Of a row of the graph the first JOINED fresh entries are old from now on: they have been joined.
    """

    def merge(table: pa.Table) -> pa.Table:
        node, near, far = entries_of(table)
        flags = table.column("fresh").combine_chunks()
        sizes = table.column("near").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        state = np.full(len(node), ARRIVED, np.int8)
        held = np.repeat(flags.is_valid().to_numpy(zero_copy_only=False), sizes)
        fresh = flags.flatten().to_numpy(zero_copy_only=False).astype(bool)
        inside = np.cumsum(fresh) - fresh  # fresh ones before, from the start of the table
        own = np.repeat(np.arange(table.num_rows), sizes)[held]
        first = np.r_[True, own[1:] != own[:-1]][: len(own)]
        before = np.maximum.accumulate(np.where(first, inside, 0)) if len(own) else inside
        state[held] = np.where(fresh & (inside - before >= JOINED), FRESH, OLD)
        node, near, far, state = best_entries(node, near, far, state, k)
        ids, nears, fars, starts = listed(node, near, far)
        news = pa.ListArray.from_arrays(nears.offsets, pa.array(state != OLD))
        arrived = np.add.reduceat((state == ARRIVED).astype(np.int32), starts) if len(starts) else np.zeros(0, np.int32)
        return pa.table([ids, nears, fars, news, pa.array(arrived.astype(np.int32))], ["node", "near", "far", "fresh", "arrived"])

    bucket = F.pmod(F.xxhash64("node"), F.lit(buckets)).alias("bucket")
    return edges.groupBy(bucket).applyInArrow(merge, GRAPH)


# --- start: cells around pivots ------------------------------------------------------------------


def cells_of(nodes: DataFrame, count: int) -> DataFrame:
    """Rows (dims, cell, node, code) of each node's nearest pivots; a length without pivots is one cell."""
    size = max(1, min(PIVOTS, math.ceil(count * CELLS / CELL))) if count > CELL else 1
    by_hash = nodes.select("code").orderBy(F.xxhash64("code"), "code").limit(size).toArrow()  # PIVOTS rows at most
    by_length: dict[int, list[bytes]] = {}
    for code in by_hash.column("code").to_pylist():
        by_length.setdefault(len(code), []).append(code)
    pivots = {length: decoded(pa.array(codes)) for length, codes in by_length.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.binary_length(batch.column("code")).to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                own = batch.take(pa.array(np.flatnonzero(lengths == length)))
                cells = np.zeros((own.num_rows, 1), np.int64)
                if len(around := pivots.get(int(length), ())) > 1:
                    far = distances(decoded(own.column("code")), around)
                    cells = np.argpartition(far, min(CELLS, len(around)) - 1, axis=1)[:, :CELLS]
                row = np.repeat(np.arange(own.num_rows), cells.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), length, np.int32)), pa.array(cells.ravel().astype(np.int32)), *(own.column(c).take(pa.array(row)) for c in ("node", "code"))],
                    ["dims", "cell", "node", "code"],
                )

    return staged(nodes.select("node", "code").mapInArrow(run, "dims int, cell int, node long, code binary"), "cells")


def started(nodes: DataFrame, count: int, k: int) -> DataFrame:
    """Rows of EDGES: each node's nearest ones in its blocks, all of them fresh."""
    cells = cells_of(nodes, count)
    sizes = cells.groupBy("dims", "cell").agg(F.ceil(F.count(F.lit(1)) / (2 * CELL)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")
    most = k if count <= CELL else PER_CELL

    def nearest(table: pa.Table) -> pa.Table:
        ids, vectors = table.column("node").to_numpy(), decoded(table.column("code").combine_chunks())
        n, parts = min(most, len(ids) - 1), []
        for at in range(0, len(ids) if n else 0, 1024):
            far = distances(vectors[at : at + 1024], vectors)
            far[np.arange(len(far)), np.arange(at, at + len(far))] = np.inf
            place = np.argpartition(far, n - 1, axis=1)[:, :n]
            rows = np.repeat(ids[at : at + 1024], n)
            parts.append((rows, ids[place].ravel(), np.take_along_axis(far, place, 1).ravel()))
        node, near, far = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((far, node))
        rows, nears, fars, _ = listed(node[order], near[order], far[order])
        return pa.table([rows, nears, fars], ["node", "near", "far"])

    return cells.join(sizes, ["dims", "cell"]).groupBy("dims", "cell", block).applyInArrow(nearest, EDGES)


# --- descent -------------------------------------------------------------------------------------


def met(graph: DataFrame) -> DataFrame:
    """Rows (at, node, fresh): who meets at a node in this round, wherever somebody fresh does."""
    entries = graph.select("node", F.posexplode(F.arrays_zip("near", "far", "fresh")).alias("place", "e"))
    order = lambda c: Window.partitionBy(c, "fresh").orderBy("far", "other")
    forward = entries.select(F.col("node").alias("at"), F.col("e.near").alias("other"), "e.far", "e.fresh")
    reverse = entries.where("e.fresh").select(F.col("e.near").alias("at"), F.col("node").alias("other"), "e.far", "e.fresh")
    ranked = [x.withColumn("place", F.row_number().over(order("at"))).where(F.col("place") <= JOINED) for x in (forward, reverse)]
    both = ranked[0].union(ranked[1]).groupBy("at", "other").agg(F.max("fresh").alias("fresh"))
    busy = F.max("fresh").over(Window.partitionBy("at"))
    return both.withColumn("busy", busy).where("busy").select("at", F.col("other").alias("node"), "fresh")


def improvements(graph: DataFrame, nodes: DataFrame, buckets: int, k: int) -> DataFrame:
    """Rows of EDGES: neighbours of neighbours that are nearer than the last one of a node's list."""
    last = graph.select("node", F.when(F.size("far") >= k, F.element_at("far", -1)).alias("last"))
    codes = nodes.select("node", "code").join(last, "node", "left")
    visits = met(graph).join(codes, "node")

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        at, ids = table.column("at").to_numpy(), table.column("node").to_numpy()
        fresh = table.column("fresh").to_numpy(zero_copy_only=False).astype(bool)
        last = np.nan_to_num(table.column("last").to_numpy(zero_copy_only=False).astype(np.float32), nan=np.inf)
        vectors = decoded(table.column("code").combine_chunks())
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        sizes = np.diff(np.r_[starts, len(at)])
        found: list[tuple[np.ndarray, ...]] = []
        for n in np.unique(sizes[sizes > 1]):  # groups of equal size are one stack of matrices
            group = starts[sizes == n][:, None] + np.arange(n)
            for s in range(0, len(group), 512):
                own = group[s : s + 512]
                far = distances(vectors[own], vectors[own])
                useful = (fresh[own][:, :, None] | fresh[own][:, None, :]) & (far < last[own][:, :, None]) & ~np.eye(n, dtype=bool)
                g, x, y = np.nonzero(useful)
                found.append((ids[own[g, x]], ids[own[g, y]], far[g, x, y]))
        node, near, far = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        node, near, far, _ = best_entries(node, near, far, np.zeros(len(node), np.int8), k)
        rows, nears, fars, _ = listed(node, near, far)
        return pa.table([rows, nears, fars], ["node", "near", "far"])

    dims = F.length("code").alias("dims")  # neighbours have vectors of one length
    bucket = F.pmod(F.xxhash64("at"), F.lit(buckets)).alias("bucket")
    return visits.groupBy(dims, bucket).applyInArrow(compare, EDGES)


def neighbour_graph(nodes: DataFrame, k: int = NEIGHBOURS, rounds: int = ROUNDS) -> DataFrame:
    """The staged graph: rows of GRAPH with the lists of every node that has a neighbour."""
    count = nodes.count()
    buckets = max(1, math.ceil(count / BUCKET))
    unknown = F.lit(None).cast("array<boolean>").alias("fresh")
    graph = staged(merged(started(nodes, count, k).select("*", unknown), buckets, k), "graph")
    for _ in range(rounds):
        edges = graph.drop("arrived").unionByName(improvements(graph, nodes, buckets, k).select("*", unknown))
        graph = staged(merged(edges, buckets, k), "graph")
        if (graph.agg(F.sum("arrived")).first()[0] or 0) <= SETTLED * k * count:
            break
    return graph


# --- search --------------------------------------------------------------------------------------


def both_ways(graph: DataFrame, k: int) -> DataFrame:
    """Staged rows (node, near): forward neighbours and the k nearest reverse ones."""
    entries = graph.select("node", F.inline(F.arrays_zip("near", "far")))
    reverse = entries.select(F.col("near").alias("node"), F.col("node").alias("near"), "far")
    place = F.row_number().over(Window.partitionBy("node").orderBy("far", "near"))
    few = reverse.withColumn("place", place).where(F.col("place") <= k)
    lists = entries.select("node", "near").union(few.select("node", "near")).groupBy("node")
    return staged(lists.agg(F.collect_set("near").alias("near")), "both-ways")


def measured(pairs: DataFrame, left: str, right: str, schema: str, measure) -> DataFrame:
    """Rows (query, node, far) of rows (query, node, left, right)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                far = pa.array(measure(batch.column(left), batch.column(right)))
                yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("node"), far], ["query", "node", "far"])

    return pairs.select("query", "node", left, right).mapInArrow(run, schema)


def by_length(measure):
    """``measure`` applied to the rows of each length; the two vectors of a row are of one length."""

    def run(a: pa.Array, b: pa.Array) -> np.ndarray:
        lengths = (pc.list_value_length(a) if pa.types.is_list(a.type) else pc.binary_length(a)).to_numpy(zero_copy_only=False)
        out = np.zeros(len(a))
        for n in np.unique(lengths):
            own = pa.array(np.flatnonzero(lengths == n))
            out[lengths == n] = measure(a.take(own), b.take(own))
        return out

    return run


def code_distance(a: pa.Array, b: pa.Array) -> np.ndarray:
    with np.errstate(all="ignore"):
        return np.sqrt(((decoded(a) - decoded(b)).astype(float) ** 2).sum(1))


def exact_distance(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Euclidean distances in double precision; scaled only where the squares leave its range."""
    x, y = (v.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(v), -1) for v in (a, b))
    with np.errstate(all="ignore"):
        gap = x - y
        far, most = np.sqrt((gap * gap).sum(1)), np.abs(gap).max(1)
        odd = (most > 0) & ~((far > 1e-150) & (far < 1e150))
        far[odd] = most[odd] * np.sqrt(((gap[odd] / most[odd, None]) ** 2).sum(1))
        return far


def searched(nodes: DataFrame, queries: DataFrame, graph: DataFrame, k: int, beam: int) -> DataFrame:
    """Staged rows (query, node, far): the best nodes each query node found, by their codes."""
    near = both_ways(graph, k)
    codes = nodes.select("node", "code")
    asked = staged(queries.join(codes, queries["query"] == codes["node"]).select("query", F.col("code").alias("query_code")), "asked")
    state = staged(asked.select("query", F.col("query").alias("node"), F.lit(0.0).alias("far"), F.lit(True).alias("open")), "beam")
    best = Window.partitionBy("query").orderBy("far", "node")
    while not state.where("open").isEmpty():
        reached = state.where("open").join(near, "node").select("query", F.explode("near").alias("node")).distinct()
        fresh = reached.join(state.select("query", "node"), ["query", "node"], "left_anti")
        pairs = fresh.join(asked, "query").join(codes, "node")
        seen = measured(pairs, "query_code", "code", "query long, node long, far double", by_length(code_distance))
        every = state.withColumn("open", F.lit(False)).unionByName(seen.withColumn("open", F.lit(True)))
        state = staged(every.withColumn("place", F.row_number().over(best)).where(F.col("place") <= beam).drop("place"), "beam")
    return state.select("query", "node", "far")


def nearest(table: DataFrame, is_query: Column, k: int = K, neighbours: int = NEIGHBOURS, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query's k nearest other ids found, ties to the smaller id.

    Left out: rows with a null id and vectors that are null, all zero or hold null or non-finite
    components. Vectors are only compared with those of their own length. A query with fewer than k
    others gets what there is. Repeated rows of an id count once if their vectors are equal; an id
    with several vectors queries with the smallest one and can be found by each. Tables of up to CELL
    different vectors are searched exactly, larger ones approximately. ``neighbours`` is to be k or more.
    """
    vectors = staged(usable_vectors(table), "usable")
    nodes = nodes_of(vectors, k)
    graph = neighbour_graph(nodes, neighbours)
    asking = vectors.where(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    asking = staged(asking.join(nodes.select("vec", F.col("node").alias("query")), "vec").select(F.col("vec_id").alias("query_id"), "query"), "asking")
    found = searched(nodes, asking.select("query").distinct(), graph, neighbours, beam)

    by_code = Window.partitionBy("query").orderBy("far", "node")
    few = found.withColumn("place", F.row_number().over(by_code)).where(F.col("place") <= MEASURED).select("query", "node")
    own = nodes.select(F.col("node").alias("query"), F.col("vec").alias("query_vec"))
    pairs = few.join(own, "query").join(nodes.select("node", "vec"), "node")
    exact = measured(pairs, "query_vec", "vec", "query long, node long, far double", by_length(exact_distance))
    ids = exact.join(nodes.select("node", "ids"), "node").select("query", "far", F.explode("ids").alias("vec_id"))
    # an id may be found by several of its vectors: the nearest counts
    ids = ids.groupBy("query", "vec_id").agg(F.min("far").alias("far"))
    best = Window.partitionBy("query").orderBy("far", "vec_id")
    lists = ids.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    lists = lists.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("far", "vec_id"))).alias("found"))
    others = asking.join(lists, "query").select(
        "query_id", F.posexplode(F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("place", "hit")
    )
    return others.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "hit.vec_id", F.col("hit.far").alias("score"))
