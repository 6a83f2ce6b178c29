import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from coursewise.functions.scores import explanation, hybrid_score, top_k
from coursewise.operators import blocked_product as blocks
from coursewise.operators import collaborative as collab_module
from coursewise.operators.baseline_random import random_scores
from coursewise.operators.collaborative import collaborative_scores
from coursewise.operators.content import content_scores
from coursewise.operators.learners import course_sets, learner_profiles
from coursewise.operators.mixing import hybrid_scores, score_table, source_scores
from coursewise.functions.text import term_weights
from coursewise.operators import similarity
from coursewise.operators.similarity import pair_similarity, text_similarity, total_similarity
from coursewise.operators.popularity import popularity_cold_start, popularity_scores
from coursewise.schemas import ITEM, LEARNER_COURSE
from coursewise.sources.staging import staged


def by_item(df, score):
    return {(r.id_student, r.id_site): r[score] for r in df.collect()}


def test_popularity_cold_start(tables):
    scores = {r.id_site: r.popularity_score for r in popularity_cold_start(tables.interaction_data).collect()}
    assert scores == pytest.approx({101: 1.0, 201: 14 / 17, 102: 4 / 17, 103: 3 / 17})


def test_popularity_only_in_taken_courses(tables, profiles):
    rows = popularity_scores(tables.interaction_data, profiles).collect()
    assert {(r.id_student, r.id_site, r.popularity_score) for r in rows} == {(1, 103, 1.0), (3, 102, 1.0)}
    assert rows[0].asDict().keys() == {"id_student", *ITEM, "popularity_score"}


def test_collaborative(tables, profiles):
    scores = by_item(collaborative_scores(tables.interaction_data, profiles), "collaborative_score")
    assert scores == {(1, 103): 1.0, (3, 102): 1.0}


def test_collaborative_of_unrelated_learners_is_empty(split_day_one):
    history, _ = split_day_one
    assert collaborative_scores(history, learner_profiles(history)).isEmpty()


def test_content_values(tables, split_day_one):
    history, _ = split_day_one
    scores = by_item(
        content_scores(history, tables.resource_data, learner_profiles(history)), "content_score"
    )
    u, o = math.log(4 / 3) + 1, math.log(4 / 2) + 1
    other = 2 / (math.sqrt(2 + u * u) * math.sqrt(2 + o * o))
    assert scores[1, 103] == pytest.approx(1.0)
    assert scores[1, 102] == pytest.approx(other)
    assert scores[3, 101] == pytest.approx(1.0)


def test_content_empty_when_all_is_used(tables, profiles):
    rows = content_scores(tables.interaction_data, tables.resource_data, profiles)
    assert rows.where("id_student = 2").isEmpty()


def test_random_is_repeatable_and_in_range(tables, profiles):
    first = by_item(random_scores(tables.interaction_data, profiles), "random_score")
    again = by_item(random_scores(tables.interaction_data.repartition(3), profiles), "random_score")
    assert first == again and all(0 <= x < 1 for x in first.values())


def _frame(spark, column, rows):
    return spark.createDataFrame(
        [(1, site, "AAA", "2013J", kind, score) for site, kind, score in rows],
        f"id_student long, id_site long, code_module string, code_presentation string, activity_type string, {column} double",
    )


def test_hybrid(spark):
    popularity = _frame(spark, "popularity_score", [(101, "url", 0.4), (103, None, 1.0)])
    content = _frame(spark, "content_score", [(101, "url", 0.5), (102, "url", 0.5)])
    collaborative = _frame(spark, "collaborative_score", [(101, "url", 0.3), (103, None, 0.5)])
    rows = {r.id_site: r for r in hybrid_scores(popularity, content, collaborative).collect()}
    assert rows[101].hybrid_score == pytest.approx(0.38)
    assert rows[102].popularity_score == 0 and rows[102].collaborative_score == 0
    # missing activity types match each other
    assert rows[103].hybrid_score == pytest.approx(0.6)


@pytest.mark.parametrize("weights", [(1, 2, 3), (-0.3, 0.5, 0.8)])
def test_hybrid_weights(weights):
    with pytest.raises(ValueError):
        hybrid_score(*weights)


def test_explanation_ties(spark):
    rows = spark.createDataFrame(
        [(1, 0.5, 0.5, 0.5), (2, 0.1, 0.5, 0.5), (3, 0.1, 0.2, 0.5)],
        "n int, popularity_score double, content_score double, collaborative_score double",
    )
    said = {r.n: r.e for r in rows.select("n", explanation(1, 1, 1).alias("e")).collect()}
    assert "frequently used" in said[1] and "similar to other" in said[2]
    assert "similar students" in said[3]


def brute_force(rows):
    """Direct statement of the collaborative scorer over (learner, course, resource, clicks)."""
    courses = {}
    for s, c, _, _ in rows:
        courses.setdefault(s, set()).add(c)
    out = {}
    for s in courses:
        mine = [r for r in rows if r[1] in courses[s]]
        learners, sites = sorted({r[0] for r in mine}), sorted({r[2] for r in mine})
        sums, counts = np.zeros((len(learners), len(sites))), np.zeros((len(learners), len(sites)))
        for u, _, i, n in mine:
            sums[learners.index(u), sites.index(i)] += n
            counts[learners.index(u), sites.index(i)] += 1
        m = np.divide(sums, counts, out=np.zeros_like(sums), where=counts > 0)
        norm = np.linalg.norm(m, axis=1)
        unit = np.divide(m, norm[:, None], out=np.zeros_like(m), where=norm[:, None] > 0)
        me = learners.index(s)
        similarity = unit @ unit[me]
        similarity[me] = 0
        score = similarity @ m
        kept = {sites[i]: score[i] for i in range(len(sites)) if m[me, i] == 0 and score[i] > 0}
        top = max(kept.values(), default=1)
        out.update({(s, i): x / top for i, x in kept.items()})
    return out


@pytest.mark.parametrize("small_blocks", [False, True])
def test_collaborative_against_brute_force(interactions_of, monkeypatch, small_blocks):
    if small_blocks:
        monkeypatch.setattr(blocks, "LEARNERS_PER_BLOCK", 3)
        monkeypatch.setattr(blocks, "ITEMS_PER_BLOCK", 4)
        monkeypatch.setattr(blocks, "ENTRIES_PER_BLOCK", 20)
        monkeypatch.setattr(blocks, "COLUMNS_PER_STEP", 3)
        monkeypatch.setattr(collab_module, "ROWS_PER_BLOCK", 10)
        monkeypatch.setattr(collab_module, "STEP", 3)
    draw = np.random.default_rng(5)
    rows = set()
    for s in range(14):
        for c in draw.choice(["A", "B", "C"], size=draw.integers(1, 4), replace=False):
            for i in draw.choice(8, size=4, replace=False):
                rows.add((s, str(c), int("ABC".index(c) * 10 + i), int(draw.integers(0, 6))))
    rows = sorted(rows)
    rows = [(s, c, i, n) for s, c, i, n in rows if (s, i) not in {(0, 1)}] + [(0, "A", 1, 0)]
    history = interactions_of(rows)
    found = by_item(collaborative_scores(history, learner_profiles(history)), "collaborative_score")
    expected = brute_force(rows)
    assert found.keys() == expected.keys()
    assert found == pytest.approx(expected)


def test_zero_click_resource_is_collaborative_but_not_popularity_candidate(interactions_of):
    history = interactions_of([(1, "A", 1, 3), (1, "A", 2, 0), (2, "A", 1, 2), (2, "A", 2, 5)])
    profiles = learner_profiles(history)
    assert (1, 2) in by_item(collaborative_scores(history, profiles), "collaborative_score")
    assert (1, 2) not in by_item(popularity_scores(history, profiles), "popularity_score")


def test_score_table_matches_single_scorers(tables, profiles):
    table = {
        (r.id_student, r.id_site): r
        for r in score_table(tables.interaction_data, tables.resource_data, profiles).collect()
    }
    content = by_item(
        content_scores(tables.interaction_data, tables.resource_data, profiles), "content_score"
    )
    assert {k: r.content_score for k, r in table.items() if r.content_score is not None} == pytest.approx(content)
    assert all(r.hybrid_score <= 1 + 1e-12 for r in table.values())


def test_normalisation_spans_all_courses(interactions_of):
    history = interactions_of(
        [(1, "A", 1, 1), (1, "B", 11, 1), (2, "A", 2, 10), (2, "B", 12, 40)]
    )
    scores = by_item(popularity_scores(history, learner_profiles(history)).where(F.col("id_student") == 1), "popularity_score")
    assert scores == {(1, 2): 0.25, (1, 12): 1.0}


@pytest.mark.parametrize("k, items_per_block", [(1, 2048), (3, 2048), (1, 6), (3, 10)])
def test_pruned_lists_give_the_same_best(interactions_of, monkeypatch, k, items_per_block):
    monkeypatch.setattr(blocks, "ITEMS_PER_BLOCK", items_per_block)
    draw = np.random.default_rng(7)
    rows = sorted(
        {
            (s, c, int("AB".index(c) * 100 + i), int(draw.integers(1, 4)))
            for s in range(12)
            for c in ("A", "B")
            for i in draw.choice(12, size=3, replace=False)
        }
    )
    history = interactions_of(rows)
    resources = history.select(*ITEM).distinct().withColumn(
        "resource_text", F.concat_ws(" ", "code_module", "activity_type")
    )
    profiles = staged(learner_profiles(history), "profiles")
    full = source_scores(history, resources, profiles)
    pruned = source_scores(history, resources, profiles, best=k)
    keys = [*LEARNER_COURSE, "source"]

    def best(scores):
        return sorted(
            (*(r[c] for c in keys), r.position, r.id_site, round(r.score, 9))
            for r in top_k(scores, "score", k, keys).collect()
        )

    expected = best(full)
    assert best(pruned) == expected and len(expected) == 12 * 2 * 3 * k
    assert pruned.count() < full.count()


def many_course_sets():
    """Learners with hundreds of different course sets."""
    draw = np.random.default_rng(11)
    rows = set()
    for s in range(260):
        for c in draw.choice(10, size=draw.integers(1, 6), replace=False):
            for i in draw.choice(5, size=2, replace=False):
                rows.add((s, chr(65 + int(c)), int(c * 10 + i), int(draw.integers(0, 5))))
    return sorted(rows)


def test_collaborative_with_hundreds_of_course_sets(interactions_of):
    rows = many_course_sets()
    history = interactions_of(rows)
    profiles = staged(learner_profiles(history), "profiles")
    assert profiles.select("course_set").distinct().count() > 150
    found = by_item(collaborative_scores(history, profiles), "collaborative_score")
    assert found == pytest.approx(brute_force(rows))


def test_neighbours_are_copied_by_intersection(interactions_of):
    rows = many_course_sets()
    history = interactions_of(rows)
    sets = course_sets(learner_profiles(history))
    overlaps, learners = collab_module.shared_courses(history, sets)
    cells = collab_module.clicks_by_shared_courses(history, overlaps, learners)
    courses = {}
    for s, c, _, _ in rows:
        courses.setdefault(s, set()).add(c)
    asked = {frozenset(c) for c in courses.values()}
    by_intersection = by_set = 0
    for s, c, _, n in rows:
        if n:
            by_intersection += len({frozenset(courses[s] & t) for t in asked if c in t})
            by_set += sum(c in t for t in asked)
    assert cells.count() == by_intersection < by_set / 3


@pytest.mark.parametrize("pairs, held", [(2_000_000, 8_000_000), (7, 40), (50, 10)])
def test_sparse_gram_is_the_dense_one(monkeypatch, pairs, held):
    monkeypatch.setattr(collab_module, "PAIRS", pairs)
    monkeypatch.setattr(collab_module, "HELD", held)
    draw = np.random.default_rng(3)
    m = draw.integers(0, 4, (30, 12)) * (draw.random((30, 12)) < 0.4)
    m = m[m.any(1)]
    row, column = np.nonzero(m)
    want = m.T @ (m / np.linalg.norm(m, axis=1, keepdims=True))
    for gram in (collab_module.sparse_gram, collab_module.dense_gram):
        got = np.zeros(12 * 12)
        for codes, values in gram(row, column, m[row, column].astype(float), 12):
            got[codes] += values
        assert got.reshape(12, 12) == pytest.approx(want)


def test_gram_of_100000_resources_stays_small(monkeypatch):
    monkeypatch.setattr(collab_module, "PAIRS", 200_000)
    monkeypatch.setattr(collab_module, "HELD", 400_000)
    draw = np.random.default_rng(4)
    row = np.repeat(np.arange(4000), 25)
    column = draw.integers(0, 100_000, len(row))
    portions = [len(codes) for codes, _ in collab_module.sparse_gram(row, column, np.ones(len(row)), 100_000)]
    assert max(portions) <= 400_000 + 200_000 + 25 and sum(portions) >= 2_000_000


def test_pair_similarity_against_brute_force(spark):
    draw = np.random.default_rng(12)
    m = draw.integers(0, 3, (9, 6))
    m[4] = 0
    entries = [("g", i, j, float(m[i, j])) for i in range(9) for j in range(6) if m[i, j]]
    pairs = [("g", a, b) for a in range(0, 9, 2) for b in range(9)] + [("g", 0, 77)]
    found = pair_similarity(
        spark.createDataFrame(pairs, "g string, a int, b int"), spark.createDataFrame(entries, "g string, r int, f int, v double"), ["g"], "r", "f", "v", "a", "b"
    )
    norm = lambda i: np.linalg.norm(m[i])
    cosine = lambda a, b: m[a] @ m[b] / (norm(a) * norm(b)) if b < 9 and norm(a) and norm(b) else 0.0
    assert {(r.a, r.b): r.similarity for r in found.collect()} == pytest.approx({(a, b): cosine(a, b) for _, a, b in pairs})


@pytest.mark.parametrize("share", [1, 3, 1000])
def test_text_similarity_ships_only_rare_terms(spark, monkeypatch, share):
    texts = ["every one has this", "every two has that this", "every two two words", None, "", "every lone term"]
    rows = [(i, "en" if i % 2 else "de", x) for i, x in enumerate(texts)]
    rows += [rows[1], rows[1], (1, "de", "more of every one"), (None, "en", "every null id"), (7, None, "every null lang"), (8, "xx", "alone")]
    documents = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    kept = {}

    def keep(df, name):
        kept[name] = staged(df, name)
        return kept[name]

    monkeypatch.setattr(similarity, "COMMON_SHARE", share)
    monkeypatch.setattr(similarity, "staged", keep)
    entries = term_weights(documents.select("doc_id", "text"), ["doc_id"], "text").join(documents.select("doc_id", "lang"), "doc_id")
    values = lambda df: {(r.lang, r.doc_id): r.total_similarity for r in df.collect()}
    wanted = values(total_similarity(entries, ["lang"], "doc_id", "term", "weight"))
    assert values(text_similarity(documents, "lang", "doc_id", "text")) == pytest.approx(wanted, abs=1e-9)
    assert (1, 7) not in wanted and ("de", 1) in wanted and ("en", 1) in wanted
    rare = {r.term for r in kept["rare_entries"].collect()}
    assert {1: {"every", "lone"}, 3: {"lone"}, 1000: set()}[share] <= rare
    assert share == 1 or "every" not in rare
    assert share < 1000 or not rare


def test_intersections_of_course_sets_are_staged(interactions_of, monkeypatch):
    """Unless Spark knows how small they are, all rows shuffle by course set."""
    names = []
    staging = collab_module.staged
    monkeypatch.setattr(collab_module, "staged", lambda df, name: (names.append(name), staging(df, name))[1])
    history = interactions_of([(s, "A", i, 1) for s in range(3) for i in range(3)])
    overlaps, learners = collab_module.shared_courses(history, staging(course_sets(learner_profiles(history)), "sets"))
    cells = collab_module.clicks_by_shared_courses(history, overlaps, learners)
    assert "parts" in names and cells.count() == 9


@pytest.mark.parametrize("items_per_block", [2048, 2])
def test_scores_are_normalised_in_their_block(interactions_of, monkeypatch, items_per_block):
    """All scores shuffled by learner for the learner's best one."""
    from coursewise.functions.scores import max_normalised
    from coursewise.operators import blocked_product, collaborative

    monkeypatch.setattr(blocked_product, "ITEMS_PER_BLOCK", items_per_block)
    rows = [(s, "AB"[s % 2], i, 1 + (s * i) % 7) for s in range(1, 9) for i in range(1, 9) if (s + i) % 3]
    history = interactions_of(rows)
    profiles = staged(learner_profiles(history), "profiles")
    want = max_normalised(collaborative.raw_collaborative(history, profiles), "collaborative_score")
    got = collaborative.collaborative_scores(history, profiles)
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("Window" in plan) == (items_per_block == 2)
