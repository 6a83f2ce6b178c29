"""Cosine similarity to everybody else at once, without forming pairs.

With unit rows the sum of a row's cosines to all rows of its group is its dot product with
the group's sum of unit rows. A row's cosine to itself is 1 and is taken off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from coursewise.functions.text import terms
from coursewise.sources.staging import staged

# a term in over one of this many documents is common; a document's mean number of terms times this bounds how many are
COMMON_SHARE = 1000


def unit_rows(
    entries: DataFrame, group: Sequence[str], row: str, feature: str, value: str
) -> DataFrame:
    """Entries scaled to rows of length 1; rows of length 0 fall away."""
    norm = F.sqrt(F.sum(F.col(value) * F.col(value)).over(Window.partitionBy(*group, row)))
    return (
        entries.withColumn("norm", norm)
        .where(F.col("norm") > 0)
        .select(*group, row, feature, (F.col(value) / F.col("norm")).alias("unit"))
    )


def total_similarity(
    entries: DataFrame, group: Sequence[str], row: str, feature: str, value: str
) -> DataFrame:
    """Sum of cosines of each row to all other rows of its group."""
    units = unit_rows(entries, group, row, feature, value)
    centre = units.groupBy(*group, feature).agg(F.sum("unit").alias("centre"))
    return (
        units.join(centre, [*group, feature])
        .groupBy(*group, row)
        .agg((F.sum(F.col("unit") * F.col("centre")) - 1.0).alias("total_similarity"))
    )


def text_similarity(documents: DataFrame, group: str, doc: str, text: str) -> DataFrame:
    """``total_similarity`` of the term weights of texts, for tables where few terms fill most entries.

    Rows of one ``doc`` are one document of the corpus; where they repeat within a group they count
    as often there. Terms are counted where a document's rows are and kept as one row per document.
    Common terms meet their weights and centres there too, as a broadcast table. Only entries of
    rare terms shuffle by term.
    """
    counts = (
        documents.select(doc, text)
        .repartition(doc)
        .select(doc, F.explode(terms(text)).alias("term"))
        .groupBy(doc, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    packed = staged(counts.groupBy(doc).agg(F.collect_list(F.struct("term", "tf")).alias("entries")), "term_counts")
    entries = packed.select(doc, F.inline("entries"))
    n, n_docs = documents.count(), packed.count()
    idf = F.log((1.0 + F.lit(n)) / (1.0 + F.col("df"))) + 1.0
    frequency = entries.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select("term", "df", idf.alias("idf"))
    frequency = staged(frequency, "term_frequency")
    is_common = F.col("df") * COMMON_SHARE > n_docs
    common = F.broadcast(frequency.where(is_common).select("term", "idf"))
    rare = staged(
        entries.join(common, "term", "left_anti")
        .join(frequency.where(~is_common), "term")
        .select(doc, "term", (F.col("tf") * F.col("idf")).alias("value")),
        "rare_entries",
    )

    def weighed(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.select(doc, *keys, F.inline("entries")).join(common, "term").select(
            doc, *keys, "term", (F.col("tf") * F.col("idf")).alias("value")
        )

    square = F.sum(F.col("value") * F.col("value")).alias("square")
    norms = (
        weighed(packed).groupBy(doc).agg(square).unionByName(rare.groupBy(doc).agg(square))
        .groupBy(doc).agg(F.sqrt(F.sum("square")).alias("norm"))
    )
    times = documents.where(F.col(group).isNotNull()).groupBy(group, doc).agg(F.count(F.lit(1)).alias("times"))
    # a document that is there m times has m rows of length 1, which add up to sqrt(m) times sqrt(m)
    scales = staged(norms.join(times, doc).select(group, doc, (F.sqrt("times") / F.col("norm")).alias("scale")), "scales")
    unit = (F.col("value") * F.col("scale")).alias("unit")
    often = weighed(packed.join(scales, doc), group, "scale").select(group, doc, "term", unit)
    seldom = rare.join(scales, doc).select(group, doc, "term", unit)
    centre = lambda units: units.groupBy(group, "term").agg(F.sum("unit").alias("centre"))
    product = F.sum(F.col("unit") * F.col("centre")).alias("product")
    of_common = F.broadcast(staged(centre(often), "common_centres"))
    parts = [often.join(of_common, [group, "term"]), seldom.join(centre(seldom), [group, "term"])]
    return (
        parts[0].groupBy(group, doc).agg(product).unionByName(parts[1].groupBy(group, doc).agg(product))
        .groupBy(group, doc).agg((F.sum("product") - 1.0).alias("total_similarity"))
    )


def shared_similarity(cells: DataFrame, overlaps: DataFrame, row: str, feature: str, value: str) -> DataFrame:
    """Sum of cosines of each row to all others within the row's own course set.

    ``cells`` are keyed by neighbours and shared courses. Unit rows are summed once per neighbour
    set and intersection, and a course set adds up the sums it has an intersection with; the rows
    themselves are those whose set is shared as a whole.
    """
    units = unit_rows(cells, ["neighbours", "shared"], row, feature, value)
    centre = (
        units.groupBy("neighbours", "shared", feature)
        .agg(F.sum("unit").alias("centre"))
        .join(overlaps.select("neighbours", "shared", "course_set"), ["neighbours", "shared"])
        .groupBy("course_set", feature)
        .agg(F.sum("centre").alias("centre"))
    )
    own = units.where(F.col("neighbours") == F.col("shared")).withColumnRenamed("neighbours", "course_set")
    return (
        own.join(centre, ["course_set", feature])
        .groupBy("course_set", row)
        .agg((F.sum(F.col("unit") * F.col("centre")) - 1.0).alias("total_similarity"))
    )


def pair_similarity(
    pairs: DataFrame,
    entries: DataFrame,
    group: Sequence[str],
    row: str,
    feature: str,
    value: str,
    left: str,
    right: str,
) -> DataFrame:
    """Cosine of the given pairs of rows; pairs without a shared feature get 0.

    Only rows that a pair names are read. Of a pair the left row's entries meet the right row's on
    (pair, feature); dot products are divided by the norms of both rows at the end. Pairs are to be
    distinct.
    """
    names = lambda c: pairs.select(*group, F.col(c).alias(row))
    named = entries.join(names(left).union(names(right)).distinct(), [*group, row], "left_semi")
    norms = named.groupBy(*group, row).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("norm"))
    side = lambda c, v: named.select(*group, F.col(row).alias(c), feature, F.col(value).alias(v))
    dots = (
        pairs.select(*group, left, right)
        .join(side(left, "left_value"), [*group, left])
        .join(side(right, "right_value"), [*group, right, feature])
        .groupBy(*group, left, right)
        .agg(F.sum(F.col("left_value") * F.col("right_value")).alias("dot"))
    )
    length = lambda c, n: norms.select(*group, F.col(row).alias(c), F.col("norm").alias(n))
    cosine = dots.join(length(left, "left_norm"), [*group, left]).join(length(right, "right_norm"), [*group, right]).select(
        *group, left, right, F.try_divide(F.col("dot"), F.col("left_norm") * F.col("right_norm")).alias("similarity")
    )
    return pairs.join(cosine, [*group, left, right], "left").fillna(0.0, subset=["similarity"])
