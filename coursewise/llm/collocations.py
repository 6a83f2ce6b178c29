"""Collocations of two to four words by top-order marginalisation.

Every word occurrence is looked at once, as the start of its longest window: the word and the three
words that lead it in its piece, padded with null past the piece's end. Only these windows are
counted, each distinct one once. A phrase of m words occurs as often as windows start with it, so
Spark's ROLLUP over the window's columns sums the counts of all shorter phrases from the counted
windows, and no n-gram is ever exploded. Rows of the rollup whose phrase would end in padding are the
same phrase again and are left out.

Most windows of four words occur once, so a window ends before a pair or triple of words that is
surely rare, as no frequent phrase holds it: the counts of frequent phrases stay exact. Pairs, then
the triples of frequent pairs, are counted by hash and the frequent ones set bits in a blocked Bloom
filter of at most MAX_BLOCKS longs, which can be broadcast whatever the corpus; collisions, or a
filter that is too small for its phrases, only leave windows longer than they need be.

Only frequent phrases go on: the parts of a candidate occur at least as often as the candidate, so
their counts are in the same table. What follows are joins of that table with itself, keyed by
phrase; ranks are cut inside each task before a language meets in one.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from coursewise.sources.staging import staged

LONGEST = 4
MIN_COUNT = 30
CONTAINED_PERCENT = 80
SCALE = 2_000_000
TOP = 2000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What ends a piece, and white space between words.
PIECE_ENDS, SPACES = ".,;:!?\n\x0b\x0c\r", " \t"
UNKNOWN = "und"
PHRASES_PER_BLOCK = 4  # of 64 bits, four of which a phrase sets
MAX_BLOCKS = 1 << 20


def columns(longest: int) -> list[str]:
    return [f"w{i}" for i in range(longest)]


def pieces(docs: DataFrame) -> DataFrame:
    """Rows (lang, words) of all pieces, A-Z in lower case."""
    plain = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER + PIECE_ENDS + SPACES, LOWER + "\n" * len(PIECE_ENDS) + " " * len(SPACES))
    lang = F.coalesce(F.col("lang"), F.lit(UNKNOWN)).alias("lang")
    rows = docs.select(lang, F.explode(F.split(plain, "\n")).alias("piece"))
    return rows.select("lang", F.array_remove(F.split("piece", " "), "").alias("words"))


def windows(rows: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Rows (lang, w0, w1, ..): each word with those that lead it in its piece, null past the end."""
    leads = [F.slice("words", i + 1, F.greatest(F.size("words") - i, F.lit(0))).alias(w) for i, w in enumerate(columns(longest))]
    return rows.select("lang", F.inline(F.arrays_zip(*leads)))


def hash_of(words: list[str]) -> Column:
    return F.xxhash64("lang", *words)


def block_of(phrase: Column, blocks: int) -> Column:
    return F.pmod(phrase, F.lit(blocks)).cast("int")


def mask_of(phrase: Column) -> Column:
    """Four bits from the upper part of the hash; the block comes from the lower one."""
    places = [F.shiftright(phrase, 40 + 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(4)]
    return reduce(lambda a, b: a.bitwiseOR(b), [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places])


Filters = dict[int, tuple[DataFrame, int]]


def cut_windows(rows: DataFrame, longest: int, filters: Filters) -> DataFrame:
    """The windows, each ending before its first word that ends a surely rare phrase.

    ``filters`` has, by number of words, rows (block, bits) and the number of blocks.
    """
    cols = columns(longest)
    out = windows(rows, longest)
    for at in range(1, longest):
        linked = F.col(cols[at]).isNotNull() & F.col(cols[at - 1]).isNotNull()
        held = linked
        for size, (bits, blocks) in filters.items():
            if size <= at + 1:
                phrase, lane = hash_of(cols[at - size + 1 : at + 1]), f"lane_{size}"
                out = out.withColumn("block", F.when(linked, block_of(phrase, blocks)))
                out = out.join(F.broadcast(bits.withColumnRenamed("bits", lane)), "block", "left").drop("block")  # MAX_BLOCKS rows at most
                held = held & F.coalesce(F.col(lane).bitwiseAND(mask_of(phrase)) == mask_of(phrase), F.lit(False))
        out = out.withColumn(cols[at], F.when(held, F.col(cols[at]))).select("lang", *cols)
    return out


def phrase_filter(rows: DataFrame, size: int, min_count: int, filters: Filters) -> tuple[DataFrame, int]:
    """Rows (block, bits) of the phrases of ``size`` words found ``min_count`` times or more."""
    cols = columns(size)
    whole = cut_windows(rows, size, filters).where(F.col(cols[-1]).isNotNull())
    counted = whole.groupBy(hash_of(cols).alias("phrase")).agg(F.count(F.lit(1)).alias("n"))
    frequent = staged(counted.where(F.col("n") >= min_count).select("phrase"), "frequent-phrases")
    blocks = min(MAX_BLOCKS, 1 << math.ceil(math.log2(max(1, frequent.count() / PHRASES_PER_BLOCK))))
    bits = frequent.groupBy(block_of(F.col("phrase"), blocks).alias("block")).agg(F.bit_or(mask_of(F.col("phrase"))).alias("bits"))
    return staged(bits, "phrase-filter"), blocks


def phrase_counts(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """Staged tables (lang, m, phrase, f) of phrases of 1 to ``longest`` words found ``min_count``
    times or more, and (lang, n) of all word occurrences."""
    cols = columns(longest)
    rows, filters = pieces(docs), {}
    for size in range(2, longest):
        filters[size] = phrase_filter(rows, size, min_count, filters)
    counted = cut_windows(rows, longest, filters).groupBy("lang", *cols).agg(F.count(F.lit(1)).alias("n"))
    level = F.grouping_id()
    rolled = counted.rollup("lang", *cols).agg(F.sum("n").alias("f"), level.alias("level"))
    # of the grouping columns the first 1 + m are set where the last (longest - m) bits are ones
    length = F.element_at(
        F.create_map(*[x for m in range(-1, longest + 1) for x in (F.lit((1 << (longest - m)) - 1), F.lit(m))]), F.col("level").cast("int")
    )
    padded = reduce(lambda a, b: a | b, [F.col(w).isNull() & (F.col("m") > i) for i, w in enumerate(cols)])
    kept = rolled.withColumn("m", length).where((F.col("m") == 0) | ((F.col("m") > 0) & (F.col("f") >= min_count) & ~padded))
    table = staged(kept.select("lang", "m", F.concat_ws(" ", *cols).alias("phrase"), "f"), "phrases")
    return table.where("m > 0"), table.where("m = 0").select("lang", F.col("f").alias("n"))


def part(first: Column | int, size: Column | int) -> Column:
    """``size`` words of the phrase from word ``first`` on, counted from 1."""
    return F.array_join(F.slice("words", first, size), " ")


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    min_count: int = MIN_COUNT,
    contained_percent: int = CONTAINED_PERCENT,
    top: int = TOP,
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score), each language's ``top`` best collocations.

    Null texts count as empty, a null language as ``und``; repeated rows count each time, other
    columns are not read. An empty table, or one without a phrase that is frequent enough, gives
    no row. A piece of any length is whole. Counts are exact as long as a language has fewer than
    2^63 words; products are taken as decimals of 38 digits.
    """
    phrases, totals = phrase_counts(docs, longest, min_count)
    counts = phrases.select("lang", "phrase", "f")
    found = phrases.where("m > 1").withColumn("words", F.split("phrase", " "))
    cut = found.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", part(1, F.col("k")).alias("first"), part(F.col("k") + 1, F.size("words")).alias("rest"))
    left, right = (counts.select("lang", F.col("phrase").alias(p), F.col("f").alias(f)) for p, f in (("first", "l"), ("rest", "r")))
    scored = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    wide = lambda x: x.cast("decimal(20,0)")
    # div of decimals is exact and cuts towards zero, which is the floor of what is positive
    scored = scored.withColumn("product", (wide(F.col("a")) * F.lit(SCALE).cast("decimal(10,0)")).cast("decimal(38,0)"))
    scored = scored.withColumn("parts", (wide(F.col("l")) + wide(F.col("r"))).cast("decimal(38,0)"))
    scored = scored.withColumn("score", F.expr("product div parts"))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.max("a").alias("a"))

    at = F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("m") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.col("m") - size + 1), lambda first: F.struct(first.alias("first"), size.alias("size"))),
    )))
    inner = found.where("m > 2").select("lang", F.col("f").alias("longer"), "words", at.alias("at"))
    inner = inner.select("lang", part(F.col("at.first"), F.col("at.size")).alias("phrase"), "longer")
    around = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    percent = lambda x, p: wide(x) * F.lit(p).cast("decimal(10,0)")
    inside = percent(F.col("longer"), 100) >= percent(F.col("a"), contained_percent)
    kept = lowest.join(around, ["lang", "phrase"], "left").where(~F.coalesce(inside, F.lit(False)))

    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
