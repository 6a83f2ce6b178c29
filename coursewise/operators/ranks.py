"""Exact order statistics without bringing a column into one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from coursewise.sources.staging import staged


def running_totals(
    counts: DataFrame, order: str, values: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Inclusive running sums ``<value>_running`` in ``order`` within ``keys``.

    The rows are range-partitioned by key and order; each partition sums its own rows and
    starts from the total of the partitions before it. The partitioned rows are staged, as
    range borders are sampled and a recomputation could move them. Rows are to be distinct
    in (keys, order): group equal values into one row with a count first.
    """
    ranged = staged(
        counts.repartitionByRange(*keys, order).withColumn("part", F.spark_partition_id()),
        "running",
    )
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*keys, "part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    starts = (
        ranged.groupBy(*keys, "part")
        .agg(*[F.sum(v).alias(f"{v}_part") for v in values])
        .select(
            *keys,
            "part",
            *[F.coalesce(F.sum(f"{v}_part").over(before), F.lit(0)).alias(f"{v}_before") for v in values],
        )
    )
    return (
        ranged.join(starts, [*keys, "part"])
        .select(
            *counts.columns,
            *[(F.col(f"{v}_before") + F.sum(v).over(within)).alias(f"{v}_running") for v in values],
        )
    )


def exact_quantiles(df: DataFrame, columns: Sequence[str], fractions: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles of several columns in one job.

    One row per column that has values: column, n, and a column per name in ``fractions``.
    """
    melted = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                    for c in columns
                ]
            )
        ).alias("cell")
    ).select("cell.*")
    counts = melted.where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    ranked = running_totals(counts, "value", ["n"], ["column"])
    totals = ranked.groupBy("column").agg(F.max("n_running").alias("total"))
    picks = []
    for name, q in fractions.items():
        place = (F.col("total") - 1) * F.lit(float(q))
        for side, rank in (("lower", F.floor(place)), ("upper", F.ceil(place))):
            picks.append(
                F.min(F.when(F.col("n_running") > rank, F.col("value"))).alias(f"{name}_{side}")
            )
    picked = ranked.join(totals, "column").groupBy("column", F.col("total").alias("n")).agg(*picks)
    return picked.select(
        "column",
        "n",
        *[
            (
                F.col(f"{name}_lower")
                + (F.col(f"{name}_upper") - F.col(f"{name}_lower"))
                * ((F.col("n") - 1) * F.lit(float(q)) - F.floor((F.col("n") - 1) * F.lit(float(q))))
            ).alias(name)
            for name, q in fractions.items()
        ],
    )


def largest_remainder(counts: dict, size: int) -> dict:
    """Whole quotas proportional to ``counts`` that add up to ``size``."""
    total = sum(counts.values())
    exact = {key: size * n / total for key, n in counts.items()}
    quotas = {key: math.floor(x) for key, x in exact.items()}
    by_remainder = sorted(exact, key=lambda key: (quotas[key] - exact[key], key))
    for key in by_remainder[: size - sum(quotas.values())]:
        quotas[key] += 1
    return quotas
