"""Centroid clustering of whole-number vectors through subvector dictionaries.

The dimensions are cut into blocks, and a chunk of vectors is stored once as its dictionaries of the
distinct subvectors of each block and the codes of its vectors, without loss. The chunks are rows of
a staged table, so a round shuffles no vector: for every dictionary entry the exact squared distances
to all centroids are computed once per round, a vector's distances are the sums of its codes'
entries, and the sums of a cluster are its counts per code times the dictionary. A task returns one
row per cluster, and Spark adds them up by cluster and dimension.

A dictionary belongs to a chunk. One for the whole table would have to meet every block of every
vector by a join, in each round.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from coursewise.sources.staging import stage_root, staged

DIMENSIONS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
CHUNK = 16_384  # vectors that share dictionaries
WIDTHS = (8, 4, 2, 1)  # of a block, the widest first
REPEATS = 4  # vectors per dictionary entry that a width is to reach
CHUNKS_PER_FILE = 8
LARGEST = 1 << 27  # of a component's whole number: 64 squared differences then fit a long


def whole_vectors(table: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and vec of the rows with ``dimensions`` components, all there and finite."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce((F.size("embedding") == dimensions) & finite, F.lit(False))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    fits = F.forall("vec", lambda x: F.abs(x.cast("double")) <= LARGEST)
    checked = F.when(fits, F.col("vec")).otherwise(F.raise_error(F.lit(f"a component beyond {LARGEST} / {scale}: its distances exceed a long")))
    return table.where(good).select("vec_id", whole.alias("vec")).select("vec_id", checked.cast("array<bigint>").alias("vec"))


def dictionary_of(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of a block and each row's code."""
    if block.shape[1] == 1:
        values, codes = np.unique(block[:, 0], return_inverse=True)
        return values[:, None], codes
    packed = np.ascontiguousarray(block).view(np.dtype((np.void, block.dtype.itemsize * block.shape[1]))).ravel()
    _, first, codes = np.unique(packed, return_index=True, return_inverse=True)
    return block[first], codes


def encode(vectors: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Dictionaries and codes by block, of the widest blocks whose entries repeat often enough."""
    for width in WIDTHS:
        blocks = [vectors[:, at : at + width] for at in range(0, vectors.shape[1], width)]
        first = dictionary_of(blocks[0])
        if width == WIDTHS[-1] or len(first[0]) * REPEATS <= len(vectors):
            entries, codes = zip(first, *map(dictionary_of, blocks[1:]), strict=True)
            if width == WIDTHS[-1] or sum(map(len, entries)) * REPEATS <= len(vectors) * len(blocks):
                return list(entries), list(codes)
    raise AssertionError("the last width always returns")


def dictionary_chunks(vectors: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The staged table (ids, entries, codes): a row per chunk, entries and codes by block."""
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def row_of(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        matrix = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        entries, codes = encode(matrix)
        ids = table.column("vec_id").combine_chunks()
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays([0, len(ids)], ids),
                pa.array([[e.ravel() for e in entries]], pa.list_(pa.list_(pa.int64()))),
                pa.array([[c.astype(np.int32) for c in codes]], pa.list_(pa.list_(pa.int32()))),
            ],
            ["ids", "entries", "codes"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = chunk - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == chunk:
                    yield row_of(held)
                    held = []
        if held:
            yield row_of(held)

    rows = vectors.mapInArrow(run, f"ids array<{kind}>, entries array<array<bigint>>, codes array<array<int>>")
    # few chunks a file, as Spark reads a file's rows of arrays some thousand at a time
    target = f"{stage_root(spark)}/dictionary-chunks-{uuid.uuid4().hex}"
    rows.write.option("maxRecordsPerFile", CHUNKS_PER_FILE).parquet(target)
    return spark.read.schema(rows.schema).parquet(target)


class Chunk:
    """One row of the table of chunks, and its distances to centroids."""

    def __init__(self, entries: list[np.ndarray], codes: list[np.ndarray]) -> None:
        self.codes = codes
        self.entries = [e.reshape(-1, DIMENSIONS // len(codes)) for e in entries]  # a width divides the dimensions

    def assigned(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid (ties: the smaller number) and squared distance of every vector."""
        total = np.zeros((len(self.codes[0]), len(centroids)), np.int64)
        at = 0
        for entries, codes in zip(self.entries, self.codes, strict=True):
            part = centroids[:, at : at + entries.shape[1]]
            total += ((entries[:, None, :] - part[None]) ** 2).sum(2)[codes]
            at += entries.shape[1]
        nearest = total.argmin(1)
        return nearest, total[np.arange(len(total)), nearest]

    def sums(self, nearest: np.ndarray, clusters: int) -> np.ndarray:
        """Componentwise sums by cluster: the counts of its codes times the dictionary."""
        parts = []
        for entries, codes in zip(self.entries, self.codes, strict=True):
            counts = np.bincount(nearest * len(entries) + codes, minlength=clusters * len(entries))
            parts.append(counts.reshape(clusters, -1) @ entries)
        return np.concatenate(parts, 1)


def chunks_of(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, Chunk]]:
    """The ids and the chunk of every row of a batch, one at a time."""
    for i in range(batch.num_rows):
        codes, entries = batch.column("codes")[i].values, batch.column("entries")[i].values
        arrays = lambda a: [a[j].values.to_numpy(zero_copy_only=False) for j in range(len(a))]
        yield batch.column("ids")[i].values, Chunk(arrays(entries), arrays(codes))


def moved(chunks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floors of the means, empty ones as they were."""
    k, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, members = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, chunk in chunks_of(batch):
                nearest, _ = chunk.assigned(centroids)
                total += chunk.sums(nearest, k)
                members += np.bincount(nearest, minlength=k)
        own = np.flatnonzero(members)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own), pa.array(members[own]), pa.array(list(total[own]), pa.list_(pa.int64()))], ["cluster", "members", "total"]
        )

    rows = chunks.select("entries", "codes", F.slice("ids", 1, 0).alias("ids")).mapInArrow(run, "cluster long, members long, total array<long>")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    cells = rows.select("cluster", "members", F.posexplode("total").alias("dimension", "part"))
    sums = cells.groupBy("cluster", "dimension").agg(exact("part").alias("part"), exact("members").alias("members"))
    after = centroids.copy()
    for r in sums.collect():  # clusters times dimensions at most
        after[r["cluster"], r["dimension"]] = int(r["part"]) // int(r["members"])
    return after


def assigned(chunks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Rows (vec_id, cluster, distance)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, chunk in chunks_of(batch):
                nearest, distance = chunk.assigned(centroids)
                yield pa.RecordBatch.from_arrays([ids, pa.array(nearest.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    kind = chunks.schema["ids"].dataType.elementType.simpleString()
    return chunks.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def seed_hash(vec_id: Column, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(vec_id.cast("string"), F.lit(""))), 256)


def cluster(table: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, chunk: int = CHUNK) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Left out: vectors that are null, hold null or non-finite components or don't have exactly
    DIMENSIONS of them. A null id hashes as empty text; rows that repeat an id are vectors of their
    own, and of those with equal hashes the smaller vector seeds first. With fewer vectors than
    clusters each one seeds a cluster; without any there is no row. A finite component of more than
    LARGEST / SCALE raises an error, since its squared distances would not fit a long.
    """
    vectors = whole_vectors(table)
    seeds = vectors.select("vec", seed_hash(F.col("vec_id"), seed).alias("hash")).orderBy("hash", "vec").limit(clusters)
    centroids = np.array([r["vec"] for r in seeds.collect()], np.int64).reshape(-1, DIMENSIONS)
    chunks = dictionary_chunks(vectors, chunk)
    for _ in range(rounds if len(centroids) else 0):
        after = moved(chunks, centroids)
        if (after == centroids).all():
            break  # every further round would end here too
        centroids = after
    out = staged(assigned(chunks, centroids), "clustered")
    sums = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = {c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest() for c in sums}
    facts = out.sparkSession.createDataFrame(
        [(c, s, sum(sums.values()), digests[c]) for c, s in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return out.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
