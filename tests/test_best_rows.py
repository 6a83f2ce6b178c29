import numpy as np
import pytest
from pyspark.sql import functions as F

from coursewise.functions.scores import HYBRID_WEIGHTS, top_k
from coursewise.operators import baseline_random, best_rows, blocked_product as blocks
from coursewise.operators.best_rows import among_best, best_scores
from coursewise.operators.learners import learner_profiles
from coursewise.operators.mixing import score_table
from coursewise.plans.evaluate import long_recommendations
from coursewise.schemas import ITEM, LEARNER_COURSE
from coursewise.sources.staging import staged

RANKED = ["popularity", "collaborative", "content", "hybrid"]


@pytest.fixture(scope="module")
def clicked():
    """Twelve learners of two courses, with ties, zero clicks and resources of two types."""
    draw = np.random.default_rng(7)
    rows = {
        (s, c, int("AB".index(c) * 100 + i)): int(draw.integers(0, 4))
        for s in range(12)
        for c in ("A", "B")
        if s != 11 or c == "A"
        for i in draw.choice(14, size=4, replace=False)
    }
    return sorted((s, c, i, n) for (s, c, i), n in rows.items())


def lists(scores, k, keys):
    picked = long_recommendations(scores, k, keys, RANKED).collect()
    return sorted((*(r[c] for c in keys), r.recommender, r.position, r.id_site, round(r.score, 9)) for r in picked)


@pytest.mark.parametrize(
    "k, items, learners, step", [(1, 2048, 16_384, 1024), (3, 2048, 3, 2), (1, 6, 16_384, 5), (3, 5, 4, 3), (50, 7, 5, 2)]
)
def test_best_rows_give_the_same_lists(interactions_of, clicked, monkeypatch, k, items, learners, step):
    monkeypatch.setattr(blocks, "ITEMS_PER_BLOCK", items)
    monkeypatch.setattr(best_rows, "LEARNERS_PER_BLOCK", learners)
    monkeypatch.setattr(best_rows, "LEARNERS_PER_STEP", step)
    history = interactions_of(clicked)
    resources = history.select(*ITEM).distinct().withColumn(
        "resource_text", F.concat_ws(" ", "code_module", F.when(F.col("id_site") % 3 == 0, "quiz").otherwise("page"), F.col("id_site") % 4)
    )
    profiles = staged(learner_profiles(history), "profiles")
    full = score_table(history, resources, profiles)
    pruned = staged(best_scores(history, resources, profiles, k), "best")
    for keys in (LEARNER_COURSE, ["id_student"]):
        assert lists(pruned, k, keys) == lists(full, k, keys)
    if k == 1:
        assert pruned.count() < full.count()
    values = {(r.id_student, r.id_site): r for r in full.collect()}
    for r in pruned.collect():
        other = values[r.id_student, r.id_site]
        for name in RANKED:
            want = other[f"{name}_score"]
            assert r[f"{name}_score"] == (want if want is None else pytest.approx(want))


def test_best_rows_of_scopes_do_not_mix(interactions_of, clicked):
    history = interactions_of(clicked)
    both = history.withColumn("fold", F.lit(1)).unionByName(history.where("id_student < 6").withColumn("fold", F.lit(2)))
    both = staged(both, "both")
    resources = history.select(*ITEM).distinct().withColumn("resource_text", F.concat_ws(" ", "code_module", F.col("id_site") % 4))
    found = best_scores(both, resources, staged(learner_profiles(both, ["fold"]), "profiles"), 2, ["fold"])
    second = history.where("id_student < 6")
    alone = best_scores(second, resources, staged(learner_profiles(second), "profiles"), 2)
    keys = LEARNER_COURSE
    assert lists(found.where("fold = 2").drop("fold"), 2, keys) == lists(alone, 2, keys)


def test_best_rows_of_nothing_and_wrong_input(interactions_of, clicked):
    history = interactions_of(clicked).where("id_student < 0")
    resources = history.select(*ITEM).withColumn("resource_text", F.lit("text"))
    assert best_scores(history, resources, learner_profiles(history), 3).isEmpty()
    with pytest.raises(ValueError):
        best_scores(history, resources, learner_profiles(history), 0)
    with pytest.raises(ValueError):
        best_scores(history, resources, learner_profiles(history), 3, weights=HYBRID_WEIGHTS | {"content": 1.2})


def test_among_best_against_ranking():
    draw = np.random.default_rng(5)
    for k in (1, 2, 5, 9):
        scores = draw.integers(0, 4, (60, 9)) / 4.0
        scores[draw.random(scores.shape) < 0.3] = -np.inf
        found = among_best(scores, k, 2e-9)
        for row, kept in zip(scores, found):
            order = [i for i in np.argsort(-row, kind="stable") if np.isfinite(row[i])]
            assert sorted(order[:k]) == list(np.flatnonzero(kept))


def test_rows_leaving_a_block_stay_near_k(interactions_of):
    """All resources alike: ties must not carry the whole list out of a block."""
    history = interactions_of([(s, "A", s * 10 + i, 1) for s in range(20) for i in range(10)])
    resources = history.select(*ITEM).distinct().withColumn("resource_text", F.lit("the same text"))
    profiles = staged(learner_profiles(history), "profiles")
    rows = best_scores(history, resources, profiles, 3).groupBy("id_student").count().collect()
    assert len(rows) == 20 and max(r["count"] for r in rows) <= 4 * 3


def test_a_learner_is_one_row_a_source(interactions_of, clicked, monkeypatch):
    """A row per entry carried the course set with each of them."""
    kept = {}
    staging = best_rows.staged
    monkeypatch.setattr(best_rows, "staged", lambda df, name: kept.setdefault(name, staging(df, name)))
    history = interactions_of(clicked)
    resources = history.select(*ITEM).distinct().withColumn("resource_text", F.lit("the same text"))
    full = best_scores(history, resources, staging(learner_profiles(history), "profiles"), 3).count()
    learners = kept["block_learners"]
    assert learners.count() == learners.select("course_set", "id_student", "source").distinct().count()
    mixed = best_scores(history, resources, staging(learner_profiles(history), "profiles"), 3, ranked=["hybrid"])
    assert 0 < mixed.count() < full


def test_random_best_is_the_start_of_the_whole_list(interactions_of, clicked, monkeypatch):
    history = interactions_of(clicked)
    profiles = staged(learner_profiles(history), "profiles")
    for per_list in (2048, 5):
        monkeypatch.setattr(baseline_random, "ITEMS_PER_LIST", per_list)
        for k in (1, 3, 50):
            few = baseline_random.random_scores(history, profiles, best=k)
            whole = baseline_random.random_scores(history, profiles)
            columns = [*LEARNER_COURSE, "id_site", "activity_type", "position", "random_score"]
            got, want = (sorted(top_k(df, "random_score", k, LEARNER_COURSE).select(*columns).collect()) for df in (few, whole))
            assert got == want
        assert baseline_random.random_scores(history, profiles, best=1).count() < whole.count()
