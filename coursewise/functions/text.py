"""Term weights and cosines of texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Fixed value: a term is a run of two or more letters, digits or underscores.
TERM = r"[\p{L}\p{N}_]{2,}"


def terms(text: str | Column) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(column), F.lit(TERM), F.lit(0))


def term_weights(
    texts: DataFrame,
    doc: Sequence[str],
    text: str,
    corpus: Sequence[str] = (),
    copies: str | None = None,
) -> DataFrame:
    """TF-IDF with unit rows: the ``corpus`` and ``doc`` columns, term, weight.

    idf is ``ln((1 + n) / (1 + df)) + 1`` within a corpus. ``copies`` names a column with the
    number of equal documents a row stands for, so that equal texts are weighed once.
    """
    keys = [*corpus, *doc]
    n = F.col(copies) if copies else F.lit(1)
    counts = (
        texts.select(*keys, n.alias("copies"), F.explode(terms(text)).alias("term"))
        .groupBy(*keys, "term")
        .agg(F.count(F.lit(1)).alias("tf"), F.any_value("copies").alias("copies"))
    )
    frequency = counts.groupBy(*corpus, "term").agg(F.sum("copies").alias("df"))
    total = texts.groupBy(*corpus).agg(F.sum(n).alias("n"))
    if corpus:
        frequency = frequency.join(total, list(corpus))
    else:
        frequency = frequency.withColumn("n", total.select("n").scalar())
    weighted = counts.join(frequency, [*corpus, "term"]).withColumn(
        "weight", F.col("tf") * (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0)
    )
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(*keys)))
    return weighted.select(*keys, "term", (F.col("weight") / norm).alias("weight"))
