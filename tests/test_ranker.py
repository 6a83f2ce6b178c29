import json
import math

import pytest
from pyspark.sql import functions as F

from coursewise.plans import ranker
from coursewise.plans.candidates import model_input
from coursewise.plans.ranker import (
    category_modes,
    create_ml_model,
    load_model,
    numeric_parameters,
    predict_ml_scores,
    save_model,
)
from coursewise.plans.recommend import recommend, recommend_for, serving_tables
from coursewise.schemas import CATEGORICAL_FEATURES, MODEL_INPUT, RECOMMENDATION_COLUMNS, ServingTables
from coursewise.sources.staging import staged
from coursewise.sources.tables import recommendation_records


@pytest.fixture(scope="module")
def training(spark):
    """Rows whose target follows one score; one number and one category have gaps."""
    df = spark.range(60).withColumn("target", (F.col("id") % 3 == 0).cast("int"))
    for name in MODEL_INPUT:
        if name == "resource_text":
            column = F.when(F.col("target") == 1, "AAA 2013J url").otherwise("AAA 2013J quiz")
        elif name in CATEGORICAL_FEATURES:
            column = F.when(F.col("id") % 5 != 0, F.concat(F.lit("v"), (F.col("id") % 2).cast("string")))
        elif name == "popularity_score":
            column = F.col("target") * 0.5 + (F.col("id") % 7) / 20.0
        else:
            column = F.when(F.col("id") % 4 != 0, (F.col("id") % 11).cast("double"))
        df = df.withColumn(name, column)
    return staged(df.drop("id"), "training_rows")


@pytest.fixture(scope="module")
def forest(training):
    return create_ml_model(training, "random_forest", forest={"numTrees": 5, "maxDepth": 3})


def test_parameters(training):
    got = {r.column: r for r in numeric_parameters(training).collect()}
    values = [r.min_score for r in training.select("min_score").collect()]
    known = sorted(v for v in values if v is not None)
    middle = (known[len(known) // 2] + known[(len(known) - 1) // 2]) / 2
    filled = [middle if v is None else v for v in values]
    mean = sum(filled) / len(filled)
    assert got["min_score"].median == middle
    assert got["min_score"].mean == pytest.approx(mean)
    assert got["min_score"].std == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in filled) / len(filled)))
    modes = {r.column: r["mode"] for r in category_modes(training).collect()}
    assert modes["gender"] == "v0"


def test_forest_learns_saves_and_loads(training, forest, tmp_path):
    path = str(tmp_path / "forest")
    save_model(forest, path)
    first = [r.ML_score for r in predict_ml_scores(forest, training).collect()]
    again = [r.ML_score for r in predict_ml_scores(load_model(path), training).collect()]
    assert first == again and all(0 <= x <= 1 for x in first)
    scored = predict_ml_scores(forest, training).groupBy("target").agg(F.avg("ML_score").alias("s"))
    means = {r.target: r.s for r in scored.collect()}
    assert means[1] > means[0]


def test_forest_caches_nodes_and_comes_in_parts(training, tmp_path, monkeypatch):
    settings = {"numTrees": 5, "maxDepth": 3}
    whole = create_ml_model(training, forest=settings).stages[-1]
    assert whole.getCacheNodeIds() and whole.getNumTrees == 5
    monkeypatch.setattr(ranker, "TREE_ROWS", 130)  # 60 rows: two trees at once
    model = create_ml_model(training, forest=settings)
    assert [s.getNumTrees for s in model.stages[-3:]] == [1, 2, 2]
    path = str(tmp_path / "parts")
    save_model(model, path)
    rows = predict_ml_scores(load_model(path), training).select("target", "ML_score").collect()
    keyed = model_input(training.withColumn(ranker.ROW, F.struct("target")), [ranker.ROW])
    each = model.transform(keyed).select("probability", "probability_1", "probability_2").collect()
    mean = [(r[0][1] + 2 * r[1][1] + 2 * r[2][1]) / 5 for r in each]
    assert sorted(r.ML_score for r in rows) == pytest.approx(sorted(mean))
    means = {x: [r.ML_score for r in rows if r.target == x] for x in (0, 1)}
    assert sum(means[1]) / len(means[1]) > sum(means[0]) / len(means[0])


def test_unseen_values_are_scored(training, forest):
    strange = training.withColumn("gender", F.lit("never seen")).withColumn("resource_text", F.lit("new words"))
    assert predict_ml_scores(forest, strange).where("ML_score is null").isEmpty()


def test_svc_learns_saves_and_loads(training, tmp_path):
    model = create_ml_model(training, "SVC", fourier_features=32)
    path = str(tmp_path / "svc")
    save_model(model, path)
    scored = predict_ml_scores(load_model(path), training, "SVC")
    means = {r.target: r.s for r in scored.groupBy("target").agg(F.avg("ML_score").alias("s")).collect()}
    assert means[1] > means[0]


def test_svc_margins_need_no_cosine_rows(training, monkeypatch):
    """Each row's 256 cosines went through Spark only to be summed there."""
    model = create_ml_model(training, "SVC", fourier_features=32)
    keyed = model_input(training.withColumn(ranker.ROW, F.struct("target")), [ranker.ROW])
    want = [r.rawPrediction[1] for r in model.transform(keyed).select("rawPrediction").collect()]
    monkeypatch.setattr(ranker.RandomFourierFeatures, "_transform", None)
    scored = predict_ml_scores(model, training, "SVC", carry=["target"])
    assert scored.columns == ["target", "ML_score"]
    assert [r.ML_score for r in scored.collect()] == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_errors(training):
    with pytest.raises(ValueError):
        create_ml_model(training, "error")
    with pytest.raises(ValueError):
        predict_ml_scores(None, training, "error")
    with pytest.raises(ValueError):
        create_ml_model(training.where("target = 1"))


def test_recommendations(tables, forest):
    serving = serving_tables(tables, 300)
    serving = ServingTables(
        staged(serving.history_interactions, "h"), serving.student_features, serving.resource_data
    )
    got = recommend(serving, forest, 1)
    assert got.columns == RECOMMENDATION_COLUMNS
    rows = {r.id_student: r for r in got.collect()}
    assert {s: r.id_site for s, r in rows.items()} == {1: 103, 3: 102}
    assert rows[1].explanation.startswith("This resource was recommended because")
    record = recommendation_records(got).where("id_student = 1").first()
    assert [r["id_site"] for r in json.loads(record.records)] == [103]
    mine = recommend_for(serving, forest, 1, "AAA", "2013J", 5).collect()
    assert [r.id_site for r in mine] == [103]
    for who, course in ((10, ("AAA", "2013J")), (1, ("BBB", "2013B"))):
        with pytest.raises(ValueError):
            recommend_for(serving, forest, who, *course)


def test_category_modes_count_rows_not_combinations(spark):
    rows = [("a", "x"), ("a", "x"), ("a", "x"), ("b", "y"), ("b", "z"), (None, "y"), ("b", None)]
    found = category_modes(spark.createDataFrame(rows, "one string, two string"), ["one", "two"])
    assert {r["column"]: r["mode"] for r in found.collect()} == {"one": "a", "two": "x"}


def test_svc_is_fitted_on_every_row(training, monkeypatch):
    """The query drew 10,000 rows and fitted the SVC on those."""
    from coursewise.registry import queries

    fitted = []
    monkeypatch.setattr(queries, "_TRAINED", {})
    monkeypatch.setattr(queries, "tables_of", lambda spark, sf_dir: None)
    monkeypatch.setattr(queries, "ml_datasets", lambda tables, a, b, k, sample_size=None: (training.limit(sample_size or 60), training))
    monkeypatch.setattr(queries, "run_train", lambda rows, path, model_type: fitted.append(rows.count()))
    monkeypatch.setattr(queries, "load_model", lambda path: path)
    monkeypatch.setattr(queries, "SAMPLE", 12)
    queries._trained(training.sparkSession, "", "SVC")
    assert fitted == [60]


def test_svc_reaches_the_hinge_optimum(training):
    """Its loss is no higher than that of Spark's own fit of the same cosine rows."""
    from pyspark.ml.classification import LinearSVC

    *stages, fourier, svc = create_ml_model(training, "SVC", fourier_features=16).stages
    keyed = model_input(training.withColumn(ranker.ROW, F.struct("target")), [ranker.ROW])
    for stage in [*stages, fourier]:
        keyed = stage.transform(keyed)
    rows = keyed.select(
        F.col("row_keys.target").cast("double").alias("target"),
        F.when(F.col("row_keys.target") == 1, 1.5).otherwise(0.75).alias("class_weight"),
        "kernel_features",
    ).collect()

    def loss(model):
        w, b = model.coefficients.toArray(), model.intercept
        hinge = [r.class_weight * max(0, 1 - (2 * r.target - 1) * (r.kernel_features.toArray() @ w + b)) for r in rows]
        return sum(hinge) / 60 + (w @ w) / 120

    theirs = LinearSVC(
        labelCol="target", weightCol="class_weight", featuresCol="kernel_features", regParam=1 / 60, standardization=False, maxIter=100
    ).fit(training.sparkSession.createDataFrame(rows))
    assert loss(svc) <= loss(theirs) + 0.01


def test_forest_scores_are_its_own_without_its_transformer(training, forest, monkeypatch):
    """Each row walked each tree on its own, with a search in the sparse features at every node."""
    keyed = model_input(training.withColumn(ranker.ROW, F.struct("target")), [ranker.ROW])
    want = [r.probability[1] for r in forest.transform(keyed).select("probability").collect()]
    monkeypatch.setattr(ranker.RandomForestClassificationModel, "_transform", None)
    assert [r.ML_score for r in predict_ml_scores(forest, training).collect()] == want


def test_both_datasets_are_built_side_by_side(tables, monkeypatch):
    """The test candidates waited for the training ones."""
    import threading

    from coursewise.plans import recommend as jobs

    both = threading.Barrier(2)
    monkeypatch.setattr(jobs, "create_ml_dataset", lambda history, future, *rest: (both.wait(60), history.count(), future.count())[1:])
    assert jobs.ml_datasets(tables, 1, 2) == ((2, 1), (3, 2))
