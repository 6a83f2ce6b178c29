"""Mixing sources to target weights by capped water-filling, with native expressions only.

Targets: every source has a weight and a cap of ``max_epochs`` times its size. The word budget is
dealt out by weight; a source whose share exceeds its cap is clamped and the excess is dealt out
again by weight among the rest, until no share exceeds its cap. Each round is one aggregate over
the staged table of sources, and weights come from distributed ranks, so no task and no driver
loop holds the sources.

Sampling: a source of ratio r = target / size gives every document floor(r) times. One more
repetition goes to documents in a seeded md5 order: each one that still fits into the words due is
taken, the others are passed over. The pass runs in rounds for all sources at once. A round takes
what comes before the first document that doesn't fit; the next one goes on behind it with the
documents that fit into the rest, until none does. At the end the smallest document left is added
if that brings the source nearer to its target. A round's end is found through hash buckets: sums
by (source, bucket) give the bucket it lies in, and only that bucket is sorted, so a source with a
third of all rows stays spread out. Rows that repeat id and size are one group with a count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from coursewise.llm.common import WORD
from coursewise.operators.ranks import running_totals
from coursewise.sources.staging import staged

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MAX_EPOCHS = 2
SEED = 7
END = "~"  # behind every draw


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """Rows (source, source_size, target) from rows (source, size).

    Sources take the weights in turn, by code point, null last. A source without words has
    target 0. Where the caps cannot hold the budget, every target is its cap.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    keyed = totals.withColumn("last", F.col("source").isNull().cast("int")).withColumn("one", F.lit(1))
    ordered = keyed.withColumn("place", F.concat(F.col("last").cast("string"), F.coalesce("source", F.lit(""))))
    ranked = running_totals(ordered, "place", ["one"])
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("one_running") - 1, F.lit(len(weights))) + 1).cast("int")
    )
    table = staged(
        ranked.select(
            "source",
            "source_size",
            weight.cast("long").alias("weight"),
            (F.col("source_size") * max_epochs).alias("cap"),
            F.lit(False).alias("clamped"),
        ),
        "sources",
    )
    free = F.when(~F.col("clamped"), F.col("weight"))
    while True:
        # at most one row: what is left to deal out, in hundredths of a word, and among which weights
        left = table.agg(
            (F.sum("source_size") * share_percent - 100 * F.coalesce(F.sum(F.when(F.col("clamped"), F.col("cap"))), F.lit(0))).alias("left"),
            F.sum(free).alias("free"),
        )
        marked = table.crossJoin(left).withColumn(
            "over",
            ~F.col("clamped")
            & (F.col("left").cast("decimal(38,0)") * F.col("weight") > F.col("cap").cast("decimal(38,0)") * 100 * F.col("free")),
        )
        if marked.where("over").limit(1).count() == 0:
            break
        table = staged(marked.select("source", "source_size", "weight", "cap", (F.col("clamped") | F.col("over")).alias("clamped")), "sources")
    share = F.col("left").cast("double") * F.col("weight") / F.col("free") / 100
    return marked.select(
        "source",
        "source_size",
        F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def draw_of(seed: int) -> Column:
    """The seeded draw of a document, the same for rows that repeat its id and size."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("size").cast("string")))


def same_source(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def next_round(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan after one more round of its open sources.

    ``rounds`` gets the interval of draws in which every document of at most ``room`` words is
    taken, and ``few`` the group at its end if only some of its rows fit.
    """
    going = plan.where("open").select("source", "room", "after")
    fits = rows.alias("r").join(going.alias("p"), same_source("r", "p") & (F.col("draw") > F.col("after")) & F.col("size").between(1, F.col("room")))
    fits = fits.select("r.*", "room")
    buckets = fits.groupBy("source", "room", "bucket").agg(F.sum("size").alias("words"))
    up_to = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = buckets.withColumn("sum", F.sum("words").over(up_to))
    ended = F.min(F.when(F.col("sum") > F.col("room"), F.struct("bucket", (F.col("sum") - F.col("words")).alias("before"))))
    cuts = staged(summed.groupBy("source").agg(ended.alias("cut"), F.max("sum").alias("all")), "mix-cuts")
    edge = fits.alias("r").join(cuts.alias("c"), same_source("r", "c") & (F.col("r.bucket") == F.col("c.cut.bucket")))
    groups = edge.groupBy("r.source", "room", "cut.before", "draw", "size").agg(F.count(F.lit(1)).alias("n"))
    by_draw = Window.partitionBy("source").orderBy("draw").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = groups.withColumn("sum", F.col("before") + F.sum(F.col("size") * F.col("n")).over(by_draw)).where("sum > room")
    last = last.groupBy("source").agg(F.min(F.struct("draw", "size", "n", (F.col("sum") - F.col("size") * F.col("n")).alias("before"))).alias("last"))
    k = F.floor((F.col("room") - F.col("last.before")) / F.col("last.size"))
    until = F.coalesce("last.draw", F.lit(END))
    left = F.col("room") - F.coalesce(F.col("last.before") + k * F.col("last.size"), "all", F.lit(0))
    some = F.when(k > 0, F.array(F.struct(F.col("last.draw").alias("draw"), k.alias("k"), F.col("last.n").alias("n")))).otherwise(F.array())
    both = plan.alias("p").join(cuts.alias("c"), same_source("p", "c"), "left").join(last.alias("e"), same_source("p", "e"), "left")
    added = F.array(F.struct("after", until.alias("until"), "room"))
    new = {
        "room": F.when(F.col("open"), left).otherwise(F.col("room")),
        "after": F.when(F.col("open"), until).otherwise(F.col("after")),
        "rounds": F.when(F.col("open"), F.concat("rounds", added)).otherwise(F.col("rounds")),
        "few": F.concat("few", some),
        "open": F.col("open") & F.col("last").isNotNull() & (left > 0),
    }
    return staged(both.select(*[new.get(c, F.col(f"p.{c}")).cast(plan.schema[c].dataType).alias(c) for c in plan.columns]), "mix-plan")


def in_rounds(draw: Column, size: Column) -> Column:
    return F.exists("rounds", lambda x: (draw > x["after"]) & (draw < x["until"]) & (size <= x["room"]))


def mix_plan(sizes: DataFrame, seed: int = SEED, max_epochs: int = MAX_EPOCHS, **settings) -> DataFrame:
    """One staged row per source: what decides how often each of its documents is taken.

    source, source_size, target; ``whole`` repetitions of each document; ``rounds`` of one more
    repetition; ``few``, groups (draw, k, n) of which k of n rows get it. Null sources form one
    source. An empty table gives an empty plan.
    """
    draw = draw_of(seed)
    rows = sizes.where("size > 0").select("source", "size", draw.alias("draw"), F.substring(draw, 1, 4).alias("bucket"))
    targets = source_targets(sizes, max_epochs=max_epochs, **settings)
    ratio = F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))
    whole = F.coalesce(F.least(F.floor(ratio), F.lit(max_epochs)), F.lit(0))
    due = F.col("target") - whole * F.col("source_size")
    plan = targets.select("source", "source_size", "target", whole.alias("whole"), due.alias("due")).select(
        "*",
        F.floor("due").cast("long").alias("room"),
        F.lit("").alias("after"),
        F.array().cast("array<struct<after:string,until:string,room:long>>").alias("rounds"),
        F.array().cast("array<struct<draw:string,k:long,n:long>>").alias("few"),
        (F.floor("due") > 0).alias("open"),
    )
    plan = staged(plan, "mix-plan")
    while plan.where("open").limit(1).count():
        plan = next_round(rows, plan)
    # what is left is larger than the room; the smallest may still bring the source nearer
    missing = F.col("room") + F.col("due") - F.floor("due")
    spare = rows.alias("r").join(plan.withColumn("missing", missing).alias("p"), same_source("r", "p") & (F.col("size") < 2 * F.col("missing")))
    taken = in_rounds(F.col("draw"), F.col("size")) | F.exists("few", lambda x: (x["draw"] == F.col("draw")) & (x["k"] == x["n"]))
    groups = spare.where(~taken).groupBy("r.source", "size", "draw").agg(F.count(F.lit(1)).alias("n"))
    fill = groups.groupBy("source").agg(F.min(F.struct("size", "draw", "n")).alias("fill"))
    of_fill = lambda x: x["draw"] == F.col("fill.draw")
    k = F.coalesce(F.get(F.filter("few", of_fill), F.lit(0))["k"], F.lit(0)) + 1
    filled = F.concat(F.filter("few", lambda x: ~of_fill(x)), F.array(F.struct(F.col("fill.draw").alias("draw"), k.alias("k"), F.col("fill.n").alias("n"))))
    few = F.when(F.col("fill").isNotNull(), filled).otherwise(F.col("few"))
    joined = plan.alias("p").join(fill.alias("f"), same_source("p", "f"), "left")
    return staged(joined.select("p.source", "source_size", "target", "whole", "rounds", few.alias("few")), "mix-plan")


def with_copies(rows: DataFrame, plan: DataFrame, seed: int = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Rows with doc_id, source and size, with source_size, target and copies of ``mix_plan``.

    The plan has a row per source. Spark broadcasts it where it measures below the session's
    threshold, so no row is shuffled; beyond, it merges by source and splits the hot ones.
    Documents without words get no repetition. Only where some of several rows with the same id
    and size are taken are those rows staged and numbered, in ranges.
    """
    keyed = rows.withColumn("draw", draw_of(seed))
    few = F.get(F.filter("few", lambda x: x["draw"] == F.col("draw")), F.lit(0))
    joined = keyed.alias("r").join(plan.alias("p"), same_source("r", "p")).select(
        *[f"r.{c}" for c in keyed.columns], "source_size", "target", "whole", in_rounds(F.col("draw"), F.col("size")).alias("extra"), few.alias("few")
    )

    def copied(extra: Column) -> Column:
        return F.when(F.col("size") > 0, F.least(F.col("whole") + extra.cast("int"), F.lit(max_epochs))).otherwise(F.lit(0)).cast("int").alias("copies")

    columns = [*rows.columns, "source_size", "target"]
    divided = F.coalesce(F.col("few.k") < F.col("few.n"), F.lit(False))
    out = joined.where(~divided).select(*columns, copied(F.col("extra") | F.col("few").isNotNull()))
    if plan.where(F.exists("few", lambda x: x["k"] < x["n"])).limit(1).count():
        tied = staged(joined.where(divided).select("*", F.monotonically_increasing_id().alias("place"), F.lit(1).alias("one")), "mix-tied")
        ranked = running_totals(tied, "place", ["one"], ["source", "draw"])
        out = out.union(ranked.select(*columns, copied(F.col("one_running") <= F.col("few.k"))))
    return out


def mix_sizes(sizes: DataFrame, seed: int = SEED, max_epochs: int = MAX_EPOCHS, **settings) -> DataFrame:
    """Rows (doc_id, source, size) with source_size, target and copies."""
    return with_copies(sizes, mix_plan(sizes, seed, max_epochs, **settings), seed, max_epochs)


def mix_table(docs: DataFrame, **settings) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    sizes = staged(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    mixed = mix_sizes(sizes, **settings)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix_documents(docs: DataFrame, seed: int = SEED, max_epochs: int = MAX_EPOCHS, **settings) -> DataFrame:
    """The documents repeated as the mix takes them, in the columns they came with.

    A document's copies follow from its id, its source and its size, so texts meet the plan of
    the sources alone and are not shuffled by document.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row).select(
        "row", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), word_count(F.col("row.text")).alias("size")
    )
    plan = mix_plan(staged(keyed.select("doc_id", "source", "size"), "mix-sizes"), seed, max_epochs, **settings)
    taken = with_copies(keyed, plan, seed, max_epochs).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
