"""SimHash near-duplicates through vantage-point trees.

Fingerprints within ``RADIUS`` = 4 differing bits are linked. A single vantage-point tree over 64
bits hardly prunes: distances of unrelated texts crowd around 32, so a ball of radius 4 meets
both sides of most splits. The 64 bits are therefore cut into four 16-bit parts with a tree each.
If two fingerprints differ in at most four bits, then either one part is equal, or all four parts
differ in exactly one bit. So the trees are searched with radius 0, and the first with radius 1:
small radii, for which the triangle bounds prune nearly everything.

A tree partitions the part's values by Hamming distance from vantage points; its leaves are the
shards. A fingerprint lives in one shard of each tree and is also sent to the shards of the first
tree that hold a value one bit away. A shard compares whole fingerprints exactly and returns a
spanning forest of the links instead of all pairs, so a group of thousands of near copies costs as
many rows as it has members.

The trees grow with the data: below a shard of more than DEEP blocks of BLOCK rows, the other three
parts have trees of their own. Two fingerprints that share the shard's part differ by four bits at
most in the other three, so one of these is equal or the first two of them differ by one bit in
one; the same bounds hold one level down, and a row is copied a bounded number of times however
large the shard is. What is still larger than a block, as in a dense group of near copies, is cut
into blocks, compared block against block.

Equal fingerprints are one node. Components come from rounds of star contraction, each written
to the shared folder. Joins on a key that may hold a large share of all rows, a component's root or
the fingerprint of a much copied text, meet that key apart from the others (``spread_join``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from coursewise.llm.common import map_texts, spread_join, texts_as_bytes
from coursewise.sources.staging import staged

RADIUS = 4
SHINGLE = 4
PART_RADIUS = (1, 0, 0, 0)  # see above: enough for RADIUS = 4 over four parts
DEEP_RADIUS = (1, 1, 0)  # for the three other parts of two fingerprints that share one
LEAF_VALUES = 16
BLOCK = 4096
DEEP = 16  # blocks of a shard beyond which it has trees below it
SEED = 42
#: What a row is to its group: of its first resident block, of its second, or a guest.
FIRST, SECOND, GUEST = 0, 1, 2


def fingerprint(text: bytes) -> int:
    """Bit i is 1 if it is set in over half of the shingle hashes; no words: 0."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    k = min(SHINGLE, len(words))
    first = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[: len(words) - k + 1]
    digest, view = xxhash.xxh64_intdigest, memoryview(line)
    hashes = [digest(view[s:e], SEED) for s, e in zip(first.tolist(), (ends[k - 1 :] - 1).tolist(), strict=True)]
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        rows = np.array(hashes[at : at + (1 << 16)], ">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(rows, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, numbered: bool = False) -> DataFrame:
    """doc_id and the fingerprint as a signed long; with row_id if the rows are ``numbered``."""
    extra = ["row_id"] if numbered else []

    def build(batch: pa.RecordBatch) -> dict:
        prints = np.array([fingerprint(t) for t in texts_as_bytes(batch)], np.uint64)
        return {"doc_id": batch.column("doc_id"), "bits": pa.array(prints.view(np.int64))} | {c: batch.column(c) for c in extra}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs.select("doc_id", "text", *extra), f"doc_id {kind}, bits long" + ", row_id long" * len(extra), build)


class PartTree:
    """A vantage-point tree over all values of a 16-bit part, the same in every process."""

    def __init__(self, seed: int) -> None:
        self.nodes: list[tuple | None] = []
        self.home = np.zeros(1 << 16, np.int32)
        rng = np.random.default_rng(seed)

        def grow(values: np.ndarray) -> int:
            me = len(self.nodes)
            self.nodes.append(None)
            if len(values) <= LEAF_VALUES:
                self.home[values] = me
                return me
            vantage = int(values[rng.integers(len(values))])
            far = np.bitwise_count(values ^ np.uint16(vantage))
            border = int(np.median(far))
            if (far <= border).all():
                border -= 1
            inner = grow(values[far <= border])
            self.nodes[me] = (vantage, border, inner, grow(values[far > border]))
            return me

        grow(np.arange(1 << 16, dtype=np.uint16))

    def overlapped(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for every leaf that the ball of radius 1 around a row's value may overlap."""
        rows, leaves, todo = [], [], [(0, np.arange(len(values)))]
        while todo:
            at, own = todo.pop()
            if not len(own):
                continue
            node = self.nodes[at]
            if node is None:
                rows.append(own)
                leaves.append(np.full(len(own), at, np.int32))
                continue
            vantage, border, inner, outer = node
            far = np.bitwise_count(values[own] ^ np.uint16(vantage)).astype(np.int64)
            todo.append((inner, own[far - 1 <= border]))  # triangle bounds
            todo.append((outer, own[far + 1 > border]))
        return np.concatenate(rows), np.concatenate(leaves)

    @cached_property
    def borders(self) -> dict[bool, tuple[np.ndarray, np.ndarray]]:
        """For all values, (starts, leaves) of the leaves but its own that hold a value one bit away.

        Bounds alone leave some 60 leaves a value; those without such a value are dropped by looking into
        them. Under True are the leaves that hold one with one bit more. A search for all values takes
        about a second, once a process, whatever the data.
        """
        order = np.argsort(self.home, kind="stable").astype(np.uint16)  # values by leaf
        sizes = np.bincount(self.home, minlength=len(self.nodes))
        first = np.cumsum(sizes) - sizes
        found: dict[bool, list] = {False: [], True: []}
        for low in range(0, 1 << 16, 1 << 12):
            values = np.arange(low, low + (1 << 12), dtype=np.uint16)
            rows, leaves = self.overlapped(values)
            away = self.home[values[rows]] != leaves
            rows, leaves = rows[away], leaves[away]
            at = np.minimum(np.arange(LEAF_VALUES), sizes[leaves, None] - 1)  # the last one again in smaller leaves
            held, own = order[first[leaves, None] + at], values[rows][:, None]
            near = np.bitwise_count(held ^ own) == 1
            for more, hit in ((False, near.any(1)), (True, (near & (held > own)).any(1))):
                found[more].append(np.stack([rows[hit] + low, leaves[hit]]))
        out = {}
        for more, parts in found.items():
            rows, leaves = np.concatenate(parts, axis=1)
            starts = np.r_[0, np.cumsum(np.bincount(rows, minlength=1 << 16))]
            out[more] = starts, leaves[np.argsort(rows, kind="stable")].astype(np.int32)
        return out

    def reached(self, values: np.ndarray, only_more_bits: bool) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of ``borders`` for the rows' values."""
        starts, leaves = self.borders[only_more_bits]
        counts = starts[values.astype(np.int64) + 1] - starts[values]
        ends = np.cumsum(counts)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[values] - (ends - counts), counts)
        return np.repeat(np.arange(len(values)), counts), leaves[places]


@cache
def trees() -> tuple[PartTree, ...]:
    return tuple(PartTree(SEED + p) for p in range(len(PART_RADIUS)))


def parts_of(bits: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(bits).view(np.uint16).reshape(-1, 4)


def routed(prints: DataFrame) -> DataFrame:
    """Rows (tree, shard, bits, guest): a home row in each tree, guest rows in the shards of neighbours.

    A guest only meets residents, never other guests. In the first tree a fingerprint is a guest
    for partners with one bit more in that part; those with one bit less are its guests.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("bits").to_numpy(zero_copy_only=False)
            parts = parts_of(bits)
            for p, (tree, radius) in enumerate(zip(trees(), PART_RADIUS, strict=True)):
                values = np.ascontiguousarray(parts[:, p])
                found = [(np.arange(len(bits)), tree.home[values], False)]
                if radius:
                    found.append((*tree.reached(values, True), True))
                for rows, leaves, guest in found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), p, np.int32)), pa.array(leaves), pa.array(bits[rows]), pa.array(np.full(len(rows), guest))],
                        ["tree", "shard", "bits", "guest"],
                    )

    return prints.select("bits").mapInArrow(run, "tree int, shard int, bits long, guest boolean")


def routed_below(rows: DataFrame) -> DataFrame:
    """Rows (tree, shard, below, bits, guest) of large shards, dealt out by the other three parts.

    ``below`` names a part's tree and its leaf. A resident lives in a leaf of each of the three and is
    a guest as in ``routed``. A guest of the shard differs from those it is to meet by one bit in each
    part, so it visits the neighbours of either side in one tree, and its own leaf there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, trees_of, shards = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("bits", "tree", "shard"))
            guests = batch.column("guest").to_numpy(zero_copy_only=False).astype(bool)
            parts = parts_of(bits)
            for p in range(len(PART_RADIUS)):
                others = [q for q in range(len(PART_RADIUS)) if q != p]
                for i, (q, radius) in enumerate(zip(others, DEEP_RADIUS, strict=True)):
                    tree = trees()[q]
                    residents, visitors = np.flatnonzero((trees_of == p) & ~guests), np.flatnonzero((trees_of == p) & guests)
                    values = np.ascontiguousarray(parts[:, q])
                    found = [(residents, tree.home[values[residents]], False)]
                    if radius:
                        at, leaves = tree.reached(values[residents], True)
                        found.append((residents[at], leaves, True))
                    if i == 0:
                        at, leaves = tree.reached(values[visitors], False)
                        found += [(visitors[at], leaves, True), (visitors, tree.home[values[visitors]], True)]
                    for own, leaves, guest in found:
                        below = (q << 24 | leaves).astype(np.int32)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(trees_of[own]), pa.array(shards[own]), pa.array(below), pa.array(bits[own]), pa.array(np.full(len(own), guest))],
                            ["tree", "shard", "below", "bits", "guest"],
                        )

    return rows.select("tree", "shard", "bits", "guest").mapInArrow(run, "tree int, shard int, below int, bits long, guest boolean")


def blocks_of(rows: DataFrame, key: list[str]) -> DataFrame:
    """By group, the numbers of blocks r of residents and g of guests, where there is something to compare."""
    sizes = rows.groupBy(*key).agg(
        F.sum((~F.col("guest")).cast("long")).alias("residents"), F.sum(F.col("guest").cast("long")).alias("guests")
    )
    some = sizes.where("residents > 0 and residents + guests > 1")
    return some.select(*key, F.ceil(F.col("residents") / BLOCK).cast("int").alias("r"), F.ceil(F.col("guests") / BLOCK).cast("int").alias("g"))


def dealt_groups(prints: DataFrame) -> DataFrame:
    """Rows (tree, shard, below, x, y, bits, side): the groups to compare.

    Below large shards, only leaves of more than a block need their numbers of blocks. They hold
    BLOCK rows each and Spark measures their table before it broadcasts it.
    """
    spark = prints.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = staged(routed(prints.repartition(parts, "bits")), "shards")
    cut = staged(blocks_of(rows, ["tree", "shard"]), "shard-blocks")
    # as many rows as the four trees have leaves at most, which doesn't grow with the data
    both = rows.join(F.broadcast(cut), ["tree", "shard"])
    large = (F.col("r") > DEEP) | (F.col("g") > DEEP)
    both = both.withColumn("below", F.lit(-1))
    if cut.where(large).limit(1).count():
        lower = staged(routed_below(both.where(large)), "lower-shards")
        key = ["tree", "shard", "below"]
        cut_below = staged(blocks_of(lower, key).where("r > 1 or g > 1"), "lower-blocks")
        lower = lower.join(cut_below, key, "left").withColumns({n: F.coalesce(n, F.lit(1)) for n in ("r", "g")})
        both = both.where(~large).unionByName(lower)
    # Groups: (x, y) with x <= y holds resident blocks x and y, and (x, -1 - z) resident block x
    # and guest block z. The guests of a shard with one block of them visit the groups (x, x).
    own = lambda n: F.pmod(F.xxhash64("bits"), F.col(n)).cast("int")
    up_to = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    group = lambda x, y, side: F.struct(x.alias("x"), y.alias("y"), side.alias("side"))
    home, first, second, guest = F.col("own"), F.lit(FIRST), F.lit(SECOND), F.lit(GUEST)
    among = F.transform(up_to("r"), lambda c: group(F.least(home, c), F.greatest(home, c), F.when(home <= c, first).otherwise(second)))
    with_guests = F.when(F.col("g") > 1, F.transform(up_to("g"), lambda z: group(home, -1 - z, first)))
    visits = F.transform(up_to("r"), lambda x: group(x, F.when(F.col("g") > 1, -1 - home).otherwise(x), guest))
    return (
        both.withColumn("own", F.when(F.col("guest"), own("g")).otherwise(own("r")))
        .withColumn("at", F.when(F.col("guest"), visits).when(F.col("g") > 1, F.concat(among, with_guests)).otherwise(among))
        .select("tree", "shard", "below", "bits", F.explode("at").alias("at"))
        .select("tree", "shard", "below", "at.x", "at.y", "bits", "at.side")
    )


def spanning_links(residents: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between residents and others, found by exact distances."""
    residents, others = residents.view(np.uint64), others.view(np.uint64)
    nodes, place = np.unique(np.concatenate([residents, others]), return_inverse=True)
    root = list(range(len(nodes)))
    flat = np.arange(len(nodes))  # the same with every path at its end, for whole arrays of pairs
    mine, theirs = place[: len(residents)], place[len(residents) :]
    a, b = [], []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    step = max(1, (1 << 22) // max(1, len(others)))
    for at in range(0, len(residents), step):
        rows, columns = np.nonzero(np.bitwise_count(residents[at : at + step, None] ^ others[None, :]) <= RADIUS)
        rows, columns = mine[at + rows], theirs[columns]
        for s in range(0, len(rows), BLOCK):
            x, y = rows[s : s + BLOCK], columns[s : s + BLOCK]
            apart = flat[x] != flat[y]  # a pair already connected needs no link, nor does a row with itself
            if not apart.any():
                continue
            for p, q in zip(x[apart].tolist(), y[apart].tolist(), strict=True):
                u, v = find(p), find(q)
                if u != v:
                    root[max(u, v)] = min(u, v)
                    a.append(nodes[p])
                    b.append(nodes[q])
            flat = np.array([find(n) for n in range(len(nodes))])
    return np.array(a, np.uint64).view(np.int64), np.array(b, np.uint64).view(np.int64)


def links(prints: DataFrame) -> DataFrame:
    """Rows (a, b) of distinct fingerprints within RADIUS that connect all such fingerprints.

    ``prints`` holds distinct ``bits``.
    """
    key = ["tree", "shard", "below", "x", "y"]
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = dealt_groups(prints).repartition(parts, *key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of the group that may go on in the next batch

        def flushed(table: pa.Table, whole: bool) -> tuple[list[pa.RecordBatch], pa.Table]:
            keys = np.stack([table.column(k).to_numpy() for k in key])
            starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(0)])
            ends = np.r_[starts[1:], table.num_rows]
            last = len(starts) if whole else len(starts) - 1
            bits, side = (np.ascontiguousarray(table.column(c).to_numpy()) for c in ("bits", "side"))
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for s, e in zip(starts[:last], ends[:last], strict=True):
                first = side[s:e] == FIRST
                others = slice(None) if keys[3, s] == keys[4, s] else ~first
                if e - s > 1 and first.any():
                    x, y = spanning_links(bits[s:e][first], bits[s:e][others])
                    a.append(x)
                    b.append(y)
            out = pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
            return [out], table.slice(0 if whole else starts[-1])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            start, final = ([x.column(k)[i].as_py() for k in key] for x, i in ((held[0], 0), (batch, batch.num_rows - 1)))
            if start != final:
                out, rest = flushed(pa.Table.from_batches(held), False)
                yield from out
                held = rest.to_batches()
        if held:
            yield from flushed(pa.Table.from_batches(held), True)[0]

    return grouped.mapInArrow(run, "a long, b long").where("a <> b").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Rows (node, root) for every node of an edge, by large-star and small-star rounds.

    Each round links a node's larger neighbours, then the rest, to the smallest one it knows; the
    rounds end when the edges stay as they are, which takes about log n of them.
    """
    def least(pairs: DataFrame) -> DataFrame:
        return staged(pairs.groupBy("a").agg(F.min("b").alias("low"), F.count(F.lit(1)).alias("n")), "least")

    def digest(pairs: DataFrame) -> tuple:  # distinct edges, whatever their order
        return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())

    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = digest(edges)
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        low = least(both).select("a", F.least("a", "low").alias("low"), "n")
        large = spread_join(both, low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = staged(large, "large-star")
        low = least(large)
        small = spread_join(large, low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", "low"))
        edges = staged(small.where("a <> b").distinct(), "edges")
        after = digest(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = after
    raise RuntimeError("components did not settle")


def component_of(prints: DataFrame) -> DataFrame:
    """Distinct fingerprints with the smallest fingerprint of their component: (bits, root)."""
    distinct = staged(prints.select("bits").distinct(), "prints")
    found = staged(components(links(distinct)), "components")
    joined = distinct.join(found, distinct["bits"] == found["node"], "left")
    return joined.select("bits", F.coalesce("root", "bits").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Null and empty texts have fingerprint zero and are linked like any other. Repeated rows come
    out repeated. Null ids belong to a component but don't name it unless all its ids are null.
    """
    prints = staged(fingerprints(docs), "fingerprints")
    roots = staged(component_of(prints), "roots")
    copies = staged(prints.groupBy("bits").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")).join(roots, "bits"), "copies")
    names = staged(copies.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("n")), "names")
    named = staged(spread_join(copies.select("bits", "root", F.col("n").alias("copies")), names, "root"), "named")
    out = spread_join(prints, named.select("bits", "component_id", F.col("copies").alias("n")), "bits")
    return out.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one row of each component, the one with the smallest id (null last).

    Rows are numbered in a staged copy, so that of rows with equal ids one stays as well.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    numbered = staged(rows.withColumn("row_id", F.monotonically_increasing_id()), "numbered")
    prints = staged(fingerprints(numbered.select("doc.doc_id", "doc.text", "row_id"), numbered=True), "fingerprints")
    roots = staged(component_of(prints), "roots")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")
    first = prints.groupBy("bits").agg(F.min(rank).alias("first")).join(roots, "bits")
    kept = staged(first.groupBy("root").agg(F.min("first").alias("first")).select("first.row_id"), "kept")
    # merged at every size: the list of rows that stay grows with the documents
    return numbered.join(kept.hint("merge"), "row_id", "left_semi").select("doc.*")
