import pytest
from pyspark.sql import functions as F

from coursewise.functions.scores import f1, precision_at, recall, seeded_uniform
from coursewise.operators.ranks import exact_quantiles, largest_remainder, running_totals
from coursewise.plans import candidates
from coursewise.plans.candidates import (
    create_ml_dataset,
    evaluated_learner_courses,
    generate_candidates,
    model_input,
    sample_training_data,
)
from coursewise.plans.evaluate import (
    classifier_metrics,
    evaluate_learner,
    evaluate_recommenders,
    summarise,
    summarise_folds,
)
from coursewise.plans.features import student_features
from coursewise.plans.profile import boxplot_stats, crosstab_shares, histogram, value_counts
from coursewise.schemas import LEARNER_COURSE, MODEL_INPUT
from coursewise.sources.staging import staged


@pytest.fixture(scope="module")
def ml(tables, split_day_one):
    from coursewise.sources.staging import staged

    history, future = split_day_one
    features = student_features(tables, 1)
    return staged(create_ml_dataset(history, future, tables.resource_data, features, 20), "ml")


def test_metric_formulas(spark):
    row = spark.range(1).select(F.lit(2).alias("hits"), F.lit(3).alias("n_relevant"))
    row = row.withColumn("precision", precision_at(4)).withColumn("recall", recall())
    got = row.first()
    assert got.precision == 0.5 and got.recall == pytest.approx(2 / 3)
    pairs = spark.createDataFrame([(0.3, 0.5), (0.0, 0.0)], "precision double, recall double")
    assert [r.f for r in pairs.select(f1().alias("f")).collect()] == pytest.approx([0.375, 0])
    for k in (0, -1):
        with pytest.raises(ValueError):
            precision_at(k)


def test_evaluated_learner_courses(split_day_one):
    assert {r.id_student for r in evaluated_learner_courses(*split_day_one).collect()} == {1, 3}


def test_ml_dataset(ml):
    rows = {(r.id_student, r.id_site): r for r in ml.collect()}
    assert {k: r.target for k, r in rows.items()} == {(1, 102): 1, (1, 103): 0, (3, 101): 1, (3, 102): 0}
    # learner 3 registers on day 20
    assert rows[3, 101].days_registered is None and rows[1, 102].days_registered == 93
    assert rows[1, 102].popularity_score == 0 and rows[1, 103].popularity_score == 1
    assert all(r.collaborative_score == 0 for r in rows.values())


def test_candidates_have_no_gaps(tables):
    rows = generate_candidates(tables.interaction_data, tables.resource_data, 20).collect()
    assert rows and all(
        None not in (r.popularity_score, r.collaborative_score, r.content_score) for r in rows
    )
    with pytest.raises(ValueError):
        generate_candidates(tables.interaction_data, tables.resource_data, 0)


def test_candidates_zero_outside_the_source_best(interactions_of, tables):
    history = interactions_of(
        [(1, "A", 1, 1), (2, "A", 1, 2), (2, "A", 2, 9), (2, "A", 3, 1), (3, "A", 3, 1), (3, "A", 1, 5)]
    )
    resources = history.select("id_site", "code_module", "code_presentation", "activity_type").distinct()
    resources = resources.withColumn("resource_text", F.concat_ws(" ", "code_module", "activity_type"))
    rows = {r.id_site: r for r in generate_candidates(history, resources, 1).where("id_student = 1").collect()}
    assert rows[2].popularity_score == 1
    assert all(r.popularity_score == 0 for site, r in rows.items() if site != 2)


def test_sampling(ml):
    sample = sample_training_data(ml, 2).collect()
    assert sorted(r.target for r in sample) == [0, 1]
    assert largest_remainder({0: 7, 1: 3}, 5) == {0: 4, 1: 1}
    with pytest.raises(ValueError):
        sample_training_data(ml, 100)


def test_model_input(ml):
    holed = model_input(ml.withColumn("resource_text", F.lit(None).cast("string")))
    assert holed.columns == MODEL_INPUT and len(MODEL_INPUT) == 26
    assert dict(holed.dtypes)["disability"] == "string"
    assert {r.resource_text for r in holed.collect()} == {""}


def test_evaluation(tables, split_day_one):
    history, future = split_day_one
    metrics = evaluate_recommenders(history, future, tables.resource_data, 2)
    rows = {(r.id_student, r.recommender): r for r in metrics.collect()}
    assert len(rows) == 10
    # learner 1: relevant 102, content lists 103 and 102
    assert rows[1, "content"].precision == 0.5 and rows[1, "content"].recall == 1
    assert rows[1, "collaborative"].f1 == 0
    assert rows[3, "popularity"].precision == 0.5
    mean = {r.recommender: r for r in summarise(metrics).collect()}
    assert mean["popularity"].precision == 0.25


def test_single_learner(tables, split_day_one):
    metrics, listed = evaluate_learner(*split_day_one, tables.resource_data, 1, 2)
    rows = {r.recommender: r for r in metrics.collect()}
    assert rows["hybrid"].recall == 1 and rows["popularity"].hits == 0
    assert [r.id_site for r in listed.orderBy("position").collect()] == [103, 102]
    assert all(r.hybrid_explanation for r in listed.collect())


def test_fold_summary_reproduces_published_numbers(spark):
    # Published per-fold metrics and their summary.
    folds = [
        (1, "hybrid", 0.18270723935191416, 0.3084437691956763, 0.19343047871792887),
        (2, "hybrid", 0.15600623240852432, 0.2565754093845993, 0.16843809034211837),
        (3, "hybrid", 0.19125614355926393, 0.32867492506220153, 0.2100950313866836),
    ]
    rows = spark.createDataFrame(folds, "fold int, recommender string, precision double, recall double, f1 double")
    got = summarise_folds(rows).first()
    assert got.precision_mean == pytest.approx(0.1766565384399008)
    assert got.recall_mean == pytest.approx(0.29789803454749236)
    assert got.f1_mean == pytest.approx(0.1906545334822436)
    assert got.precision_std == pytest.approx(0.018387, abs=1e-6)
    assert got.recall_std == pytest.approx(0.037189, abs=1e-6)
    assert got.f1_std == pytest.approx(0.020967, abs=1e-6)


def test_running_totals_and_quantiles(spark):
    rows = spark.createDataFrame([(x % 10,) for x in range(95)] + [(None,)], "x int")
    counts = rows.where("x is not null").groupBy("x").count()
    got = {r.x: r.count_running for r in running_totals(counts, "x", ["count"]).collect()}
    assert got[0] == 10 and got[4] == 50 and got[9] == 95
    q = exact_quantiles(rows, ["x"], {"q1": 0.25, "median": 0.5}).first()
    assert (q.n, q.q1, q.median) == (95, 2.0, 4.0)
    even = spark.createDataFrame([(1.0,), (3.0,), (4.0,), (9.0,)], "x double")
    assert exact_quantiles(even, ["x"], {"median": 0.5}).first().median == 3.5


def test_classifier_metrics_with_ties(spark):
    rows = spark.createDataFrame(
        [(1, 0.9), (0, 0.9), (1, 0.8), (0, 0.3), (0, 0.3), (1, 0.1)], "target int, ML_score double"
    )
    got = classifier_metrics(rows, "m", 0.5).first()
    pairs = [(a, b) for t, a in [(1, 0.9), (1, 0.8), (1, 0.1)] for b in (0.9, 0.3, 0.3)]
    auc = sum(1 if a > b else 0.5 if a == b else 0 for a, b in pairs) / 9
    assert got.classifier_roc_auc == pytest.approx(auc)
    assert got.classifier_precision == pytest.approx(2 / 3)


def test_profiles(spark, tables):
    counted = value_counts(tables.student_data, ["gender", "disability"]).collect()
    assert {(r.column, r.value, r.n) for r in counted} == {
        ("gender", "M", 2),
        ("disability", "true", 1),
        ("disability", "false", 1),
    }
    shares = crosstab_shares(tables.resource_data, "code_module", "activity_type").collect()
    assert len(shares) == 6 and sum(r.share for r in shares) == pytest.approx(2)
    rows = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 10, 100]], "v double")
    bins = {r.bin: r.n for r in histogram(rows, "v").collect()}
    assert bins[0] == 3 and bins[1] == 1 and bins[9] == 1 and len(bins) == 10
    box = boxplot_stats(rows, "v").first()
    assert (box.q1, box.median, box.q3, box.upper_whisker, box.outliers) == (1, 2, 10, 10, 1)


@pytest.mark.parametrize("slices", (1, 5, 4096))
def test_quotas_are_exact_whatever_the_slices(spark, monkeypatch, slices):
    monkeypatch.setattr(candidates, "DRAW_SLICES", slices)
    rows = [(s, "A", "P", i, int(i % 7 == 0)) for s in range(20) for i in range(50)]
    dataset = spark.createDataFrame(rows, "id_student long, code_module string, code_presentation string, id_site long, target int")
    drawn = dataset.withColumn("draw", seeded_uniform(candidates.SEED, "id_student", "code_module", "code_presentation", "id_site")).collect()
    for size in (1, 333, 999):
        got = candidates.sample_training_data(dataset, size).collect()
        quotas = largest_remainder({t: sum(r.target == t for r in drawn) for t in (0, 1)}, size)
        want = {(r.id_student, r.id_site) for t in (0, 1) for r in sorted((r for r in drawn if r.target == t), key=lambda r: r.draw)[: quotas[t]]}
        assert {(r.id_student, r.id_site) for r in got} == want and len(got) == size


def test_sampling_keeps_one_scan(spark):
    rows = [(s, "A", "P", i, int(i % 7 == 0)) for s in range(20) for i in range(50)]
    schema = "id_student long, code_module string, code_presentation string, id_site long, target int"
    dataset = staged(spark.createDataFrame(rows, schema), "dataset")
    sample = candidates.sample_training_data(dataset, 100)
    assert set(sample.inputFiles()).isdisjoint(dataset.inputFiles())


@pytest.mark.parametrize("copies", (1, 3))
def test_sample_is_that_of_the_whole_dataset(interactions_of, copies):
    history = interactions_of([(s, "A", i, 1 + (s + i) % 3) for s in range(4) for i in range(s, s + 4)])
    future = interactions_of([(s, "A", i, 1) for s in range(4) for i in range(0, 8, 2)])
    resources = history.select("id_site", "code_module", "code_presentation", "activity_type").distinct()
    resources = resources.withColumn("resource_text", F.lit("a page"))
    # no features of learner 0, ``copies`` rows of learner 1
    learners = history.select(*LEARNER_COURSE).distinct().where("id_student > 0")
    times = F.when(F.col("id_student") == 1, copies).otherwise(1)
    features = learners.withColumn("x", F.explode(F.array_repeat(F.col("id_student") * 10, times)))
    sides = (history, future, resources, features)
    whole = staged(create_ml_dataset(*sides, 2), "whole")
    size = whole.count() - 3
    got = candidates.create_ml_sample(*sides, size, 2)
    want = sample_training_data(whole, size)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # only the sample meets the features, unless those repeat
    assert ("Join" in got._jdf.queryExecution().optimizedPlan().toString()) == (copies == 1)


def test_site_sets_are_the_relevant_items(interactions_of):
    history = interactions_of([(1, "A", 1, 1), (1, "A", 2, 1), (2, "A", 1, 1), (3, "A", 1, 1)])
    future = interactions_of([(1, "A", 2, 1), (1, "A", 3, 1), (1, "A", 4, 2), (2, "A", 1, 1), (4, "A", 1, 1)])
    rows = {r.id_student: (sorted(r.relevant_sites), r.past, r.later) for r in candidates.site_sets(history, future).collect()}
    assert rows == {1: ([3, 4], True, True), 2: ([], True, True), 3: ([], True, False), 4: ([1], False, True)}
    wanted = {(r.id_student, r.id_site) for r in candidates.relevant_items(history, future).collect()}
    assert wanted == {(s, i) for s, (sites, _, _) in rows.items() for i in sites}


def test_recommenders_become_rows_after_the_joins(interactions_of):
    """A spine with a row per recommender was broadcast five times as large as Spark took it for."""
    history = interactions_of([(s, "A", i, 1 + (s + i) % 3) for s in range(4) for i in range(s, s + 4)])
    future = interactions_of([(s, "A", i, 1) for s in range(4) for i in range(8)])
    resources = history.select("id_site", "code_module", "code_presentation", "activity_type").distinct()
    resources = resources.withColumn("resource_text", F.lit("a page"))
    found = evaluate_recommenders(history, future, resources, 2)
    plan = found.where("hits > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan[plan.index("Join") :].split("Relation")[0]
    rows = found.collect()
    assert len(rows) == 20 and {r.n_relevant for r in rows} == {4}
    assert all(0 <= r.hits <= 2 for r in rows) and sum(r.hits for r in rows if r.recommender == "popularity") > 0
