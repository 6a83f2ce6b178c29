"""Column expressions on scores: normalisation, ranking, mixing, explanation, metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from coursewise.schemas import ITEM

# The weights of the fixed hybrid and the wording of explanations.
HYBRID_WEIGHTS = {"popularity": 0.4, "content": 0.2, "collaborative": 0.4}
EXPLANATIONS = {
    "popularity": "This resource was recommended because it is frequently used by other students",
    "content": "This resource was recommended because it is similar to other interacted-with resources",
    "collaborative": "This resource was recommended because it is used by similar students",
}


# The final ranking compares normalised scores to this step.
RANKING_DIGITS = 9
RANKING_STEP = 10.0**-RANKING_DIGITS


def max_normalised(raw: DataFrame, name: str, scope: Sequence[str] = ()) -> DataFrame:
    """Scores divided by the learner's best over all the learner's courses."""
    top = F.max("raw_score").over(Window.partitionBy(*scope, "id_student"))
    return raw.select(
        *scope,
        "id_student",
        *ITEM,
        F.when(top > 0, F.col("raw_score") / top).otherwise(F.col("raw_score")).alias(name),
    )


def best_first(score: str) -> list[Column]:
    """Ranking order: rounded score, then resource id, so that ties are settled."""
    return [F.desc(F.round(score, RANKING_DIGITS)), F.asc("id_site")]


def top_k(scores: DataFrame, score: str, k: int, keys: Sequence[str]) -> DataFrame:
    """The ``k`` best rows of every key with their ``position``."""
    check_k(k)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*best_first(score)))
    return scores.withColumn("position", place).where(F.col("position") <= k)


def check_k(k: int) -> None:
    if k <= 0:
        raise ValueError("Value of k must be greater than zero")


def check_weights(popularity: float, content: float, collaborative: float) -> None:
    if round(popularity + content + collaborative) != 1:
        raise ValueError("Weights must add up to 1")
    if min(popularity, content, collaborative) < 0:
        raise ValueError("Weights cannot be negative")


def hybrid_score(popularity: float, content: float, collaborative: float) -> Column:
    check_weights(popularity, content, collaborative)
    return (
        F.lit(float(popularity)) * F.col("popularity_score")
        + F.lit(float(content)) * F.col("content_score")
        + F.lit(float(collaborative)) * F.col("collaborative_score")
    )


def explanation(
    popularity: float = HYBRID_WEIGHTS["popularity"],
    content: float = HYBRID_WEIGHTS["content"],
    collaborative: float = HYBRID_WEIGHTS["collaborative"],
) -> Column:
    """Wording for the source with the largest weighted score, in the order of the ties."""
    p = F.col("popularity_score") * popularity
    c = F.col("content_score") * content
    n = F.col("collaborative_score") * collaborative
    return (
        F.when((p >= c) & (p >= n), EXPLANATIONS["popularity"])
        .when(c >= n, EXPLANATIONS["content"])
        .otherwise(EXPLANATIONS["collaborative"])
    )


def precision_at(k: int) -> Column:
    check_k(k)
    return F.col("hits") / F.lit(float(k))


def recall() -> Column:
    return F.when(F.col("n_relevant") > 0, F.col("hits") / F.col("n_relevant")).otherwise(0.0)


def f1(precision: str = "precision", recall_: str = "recall") -> Column:
    p, r = F.col(precision), F.col(recall_)
    return F.when(p + r == 0, 0.0).otherwise(2 * p * r / (p + r))


def seeded_uniform(seed: int, *columns: str | Column) -> Column:
    """A repeatable draw in [0, 1) from the row's own keys, whatever the partitioning."""
    keys = [F.col(c) if isinstance(c, str) else c for c in columns]
    text = F.concat_ws(":", F.lit(str(seed)), *[key.cast("string") for key in keys])
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double")
    return head / F.lit(4294967296.0)

