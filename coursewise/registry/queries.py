"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from coursewise.functions.scores import explanation, hybrid_score, top_k
from coursewise.functions.text import term_weights
from coursewise.operators.baseline_random import random_scores
from coursewise.operators.best_rows import best_scores
from coursewise.operators.collaborative import clicks_by_shared_courses, collaborative_scores, shared_courses
from coursewise.operators.content import (
    catalogue_by_course_set,
    content_scores,
    text_vectors,
)
from coursewise.operators.interactions import (
    expanding_folds,
    fold_split,
    ml_temporal_split,
    temporal_split,
)
from coursewise.operators.learners import course_sets, learner_profiles
from coursewise.operators.mixing import hybrid_scores
from coursewise.operators.popularity import popularity_cold_start, popularity_scores
from coursewise.operators.similarity import pair_similarity, shared_similarity, text_similarity, total_similarity
from coursewise.plans import features, profile
from coursewise.plans.candidates import (
    create_ml_dataset,
    evaluated_learner_courses,
    generate_candidates,
    model_input,
    relevant_items,
    sample_training_data,
)
from coursewise.plans.evaluate import (
    METRICS,
    classifier_metrics,
    count_hits,
    cross_validate,
    evaluate_recommenders,
    evaluate_scored,
    long_recommendations,
    metric_rows,
    summarise,
    summarise_folds,
)
from coursewise.plans.prepare import (
    clean_tables,
    merge_tables,
    most_frequent,
    prepare,
)
from coursewise.plans.ranker import (
    category_modes,
    load_model,
    numeric_parameters,
    predict_ml_scores,
)
from coursewise.plans.recommend import (
    ml_datasets,
    recommend,
    run_ml_cross_validation,
    run_train,
    serving_tables,
)
from coursewise.schemas import (
    ASSESSMENT_FEATURES,
    LEARNER_COURSE,
    NUMERICAL_FEATURES,
    SCORE_COLUMNS,
    VLE_FEATURES,
    CourseTables,
    ServingTables,
)
from coursewise.sources.staging import stage_root, staged
from coursewise.sources.star_mapping import raw_tables
from coursewise.sources.tables import compare_models, recommendation_records, upsert_summary

Query = Callable[[SparkSession, str], DataFrame]
CUTOFF = 150
FEATURE_CUTOFF = 86
K = 20
SAMPLE = 10_000
PERSON = [
    "gender",
    "region",
    "highest_education",
    "imd_band",
    "age_band",
    "num_of_prev_attempts",
    "studied_credits",
    "disability",
    "date_registration",
    "module_presentation_length",
]


def rounded(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Doubles at six digits, which both engines agree on."""
    picked = [f.name for f in df.schema if f.dataType.typeName() == "double"] if names is None else names
    return df.withColumns({name: F.round(name, 6) for name in picked})


def tables_of(spark: SparkSession, sf_dir: str) -> CourseTables:
    return prepare(raw_tables(spark, sf_dir))


def split_of(tables: CourseTables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged history, future and catalogue at the test cutoff."""
    history, future = temporal_split(tables.vle_data, CUTOFF)
    return (
        staged(history, "history"),
        staged(future, "future"),
        staged(tables.resource_data, "resources"),
    )


def history_of(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged history, catalogue and learner profiles at the test cutoff."""
    tables = tables_of(spark, sf_dir)
    history = staged(temporal_split(tables.vle_data, CUTOFF)[0], "history")
    return history, tables.resource_data, staged(learner_profiles(history), "profiles")


def course_set_names(profiles: DataFrame) -> DataFrame:
    name = F.array_join(
        F.transform("courses", lambda c: F.concat_ws("|", c["code_module"], c["code_presentation"])), ";"
    )
    return profiles.select("course_set", name.alias("name")).distinct()


def named_course_sets(df: DataFrame, profiles: DataFrame) -> DataFrame:
    return (
        df.join(course_set_names(profiles), "course_set")
        .drop("course_set")
        .withColumnRenamed("name", "course_set")
    )


# preparation


def merge_student(spark, sf_dir):
    return merge_tables(raw_tables(spark, sf_dir)).student_data


def merge_assessment(spark, sf_dir):
    return merge_tables(raw_tables(spark, sf_dir)).assessment_data


def merge_vle(spark, sf_dir):
    return merge_tables(raw_tables(spark, sf_dir)).vle_data


def clean_student(spark, sf_dir):
    return clean_tables(merge_tables(raw_tables(spark, sf_dir))).student_data


def clean_assessment(spark, sf_dir):
    return clean_tables(merge_tables(raw_tables(spark, sf_dir))).assessment_data


def impute_mode_imd_band(spark, sf_dir):
    students = merge_student(spark, sf_dir).distinct()
    return students.select(
        *LEARNER_COURSE,
        F.coalesce("imd_band", most_frequent(students, "imd_band")).alias("imd_band"),
    )


def typecast_student(spark, sf_dir):
    return tables_of(spark, sf_dir).student_data.select(*LEARNER_COURSE, "disability", "withdrew")


def typecast_assessment(spark, sf_dir):
    return tables_of(spark, sf_dir).assessment_data.select(
        *LEARNER_COURSE, "id_assessment", "date_submitted", "score", "is_banked"
    )


def registration_duration(spark, sf_dir):
    return tables_of(spark, sf_dir).student_data.select(*LEARNER_COURSE, "registration_duration")


def average_score_window(spark, sf_dir):
    return rounded(
        tables_of(spark, sf_dir).assessment_data.select(
            *LEARNER_COURSE, "id_assessment", "date_submitted", "score", "average_score"
        )
    )


def resource_text(spark, sf_dir):
    return tables_of(spark, sf_dir).resource_data


def interaction_data(spark, sf_dir):
    return tables_of(spark, sf_dir).interaction_data


# splits and features


def history_at_cutoff(spark, sf_dir):
    return tables_of(spark, sf_dir).vle_data.where(F.col("date") <= FEATURE_CUTOFF)


def drop_leaking_columns(spark, sf_dir):
    return tables_of(spark, sf_dir).student_data.drop(*features.LEAKING_STUDENT_COLUMNS)


def leakage_safe_student(spark, sf_dir):
    return features.filter_by_cutoff(tables_of(spark, sf_dir), FEATURE_CUTOFF).student_data


def leakage_safe_assessment(spark, sf_dir):
    return features.filter_by_cutoff(tables_of(spark, sf_dir), FEATURE_CUTOFF).assessment_data


def _day_counts(df: DataFrame, *by) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("sum_click").alias("clicks"),
        F.min("date").alias("min_day"),
        F.max("date").alias("max_day"),
    )


def ml_temporal_split_counts(spark, sf_dir):
    parts = ml_temporal_split(tables_of(spark, sf_dir).vle_data, FEATURE_CUTOFF, CUTOFF)
    names = ("training_history", "training_future", "test_history", "test_future")
    out = None
    for name, part in zip(names, parts):
        counted = _day_counts(part, F.lit(name).alias("part"))
        out = counted if out is None else out.unionByName(counted)
    return out


def temporal_split_history(spark, sf_dir):
    return temporal_split(tables_of(spark, sf_dir).vle_data, CUTOFF)[0]


def temporal_split_future(spark, sf_dir):
    return temporal_split(tables_of(spark, sf_dir).vle_data, CUTOFF)[1]


def cv_fold_split(spark, sf_dir):
    folds = expanding_folds((60, 120, 180), 60)
    return _day_counts(fold_split(tables_of(spark, sf_dir).vle_data, folds), "fold", "part")


def assessment_features(spark, sf_dir):
    past = features.filter_by_cutoff(tables_of(spark, sf_dir), FEATURE_CUTOFF)
    return rounded(features.assessment_features(past.assessment_data))


def vle_features(spark, sf_dir):
    past = features.filter_by_cutoff(tables_of(spark, sf_dir), FEATURE_CUTOFF)
    return rounded(features.vle_features(past.vle_data))


def student_features(spark, sf_dir):
    found = features.student_features(tables_of(spark, sf_dir), FEATURE_CUTOFF)
    return rounded(
        found.select(
            *LEARNER_COURSE, *PERSON, *ASSESSMENT_FEATURES, *VLE_FEATURES, "days_registered"
        )
    )


# scorers


def popularity(spark, sf_dir):
    history, _, profiles = history_of(spark, sf_dir)
    return rounded(popularity_scores(history, profiles))


def popularity_unseen(spark, sf_dir):
    history, _ = temporal_split(tables_of(spark, sf_dir).vle_data, CUTOFF)
    return rounded(popularity_cold_start(staged(history, "history")))


def collaborative(spark, sf_dir):
    history, _, profiles = history_of(spark, sf_dir)
    return rounded(collaborative_scores(history, profiles))


def content(spark, sf_dir):
    history, resources, profiles = history_of(spark, sf_dir)
    return rounded(content_scores(history, staged(resources, "resources"), profiles))


def random_list(spark, sf_dir):
    history, _, profiles = history_of(spark, sf_dir)
    return rounded(random_scores(history, profiles))


def hybrid(spark, sf_dir):
    history, resources, profiles = history_of(spark, sf_dir)
    return rounded(
        hybrid_scores(
            popularity_scores(history, profiles),
            content_scores(history, staged(resources, "resources"), profiles),
            collaborative_scores(history, profiles),
        )
    )


def _best(scores: DataFrame, name: str) -> DataFrame:
    score = f"{name}_score"
    return rounded(
        top_k(scores, score, K, LEARNER_COURSE).select(*LEARNER_COURSE, "id_site", "position", score)
    )


def topk_popularity(spark, sf_dir):
    history, _, profiles = history_of(spark, sf_dir)
    return _best(popularity_scores(history, profiles, best=K), "popularity")


def topk_collaborative(spark, sf_dir):
    history, _, profiles = history_of(spark, sf_dir)
    return _best(collaborative_scores(history, profiles, best=K), "collaborative")


def topk_content(spark, sf_dir):
    history, resources, profiles = history_of(spark, sf_dir)
    return _best(content_scores(history, staged(resources, "resources"), profiles, best=K), "content")


def topk_hybrid(spark, sf_dir):
    history, resources, profiles = history_of(spark, sf_dir)
    return _best(best_scores(history, staged(resources, "resources"), profiles, K, ranked=["hybrid"]), "hybrid")


def topk_random(spark, sf_dir):
    history, _, profiles = history_of(spark, sf_dir)
    return _best(random_scores(history, profiles, best=K), "random")


def explanations(spark, sf_dir):
    history, resources, profiles = history_of(spark, sf_dir)
    best = best_scores(history, staged(resources, "resources"), profiles, K, ranked=["hybrid"])
    scores = best.fillna(0.0, subset=SCORE_COLUMNS)
    return top_k(scores, "hybrid_score", K, LEARNER_COURSE).select(
        *LEARNER_COURSE, "id_site", "position", explanation().alias("explanation")
    )


def tfidf_weights(spark, sf_dir):
    _, resources, profiles = history_of(spark, sf_dir)
    catalogue = catalogue_by_course_set(staged(resources, "resources"), course_sets(profiles))
    return rounded(named_course_sets(text_vectors(catalogue), profiles))


def _documents(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def document_term_weights(spark, sf_dir):
    return rounded(term_weights(_documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"], "text"))


def document_similarity(spark, sf_dir):
    return rounded(text_similarity(_documents(spark, sf_dir), "lang", "doc_id", "text"))


def learner_similarity(spark, sf_dir):
    history, _, profiles = history_of(spark, sf_dir)
    overlaps, learners = shared_courses(history, course_sets(profiles))
    cells = clicks_by_shared_courses(history, overlaps, learners)
    total = shared_similarity(cells, overlaps, "id_student", "id_site", "clicks")
    return rounded(named_course_sets(total, profiles))


def resource_similarity(spark, sf_dir):
    _, resources, profiles = history_of(spark, sf_dir)
    catalogue = staged(
        catalogue_by_course_set(staged(resources, "resources"), course_sets(profiles)), "catalogue"
    )
    entries = catalogue.select("course_set", "id_site", "resource_text").join(
        text_vectors(catalogue), ["course_set", "resource_text"]
    )
    total = total_similarity(entries, ["course_set"], "id_site", "term", "weight")
    return rounded(named_course_sets(total, profiles))


def pair_similarity_to_favourite(spark, sf_dir):
    """Cosine of every resource's text to the most clicked one of each course set."""
    history, resources, profiles = history_of(spark, sf_dir)
    catalogue = staged(catalogue_by_course_set(staged(resources, "resources"), course_sets(profiles)), "catalogue")
    entries = catalogue.select("course_set", "id_site", "resource_text").join(
        text_vectors(catalogue), ["course_set", "resource_text"]
    )
    clicks = (
        history.join(profiles.select("id_student", "course_set"), "id_student")
        .join(catalogue.select("course_set", "id_site"), ["course_set", "id_site"], "left_semi")
        .groupBy("course_set", "id_site")
        .agg(F.sum("total_resource_clicks").alias("clicks"))
    )
    favourite = clicks.groupBy("course_set").agg(F.min(F.struct((-F.col("clicks")).alias("minus"), "id_site"))["id_site"].alias("id_site"))
    pairs = favourite.join(catalogue.select("course_set", F.col("id_site").alias("other")), "course_set")
    similar = pair_similarity(staged(pairs, "pairs"), entries, ["course_set"], "id_site", "term", "weight", "id_site", "other")
    return rounded(named_course_sets(similar, profiles))


# evaluation


def evaluated(spark, sf_dir):
    history, future, _ = split_of(tables_of(spark, sf_dir))
    return evaluated_learner_courses(history, future)


def relevant(spark, sf_dir):
    history, future, _ = split_of(tables_of(spark, sf_dir))
    return relevant_items(history, future)


def hits_at_k(spark, sf_dir):
    return (
        evaluate_recommenders(*split_of(tables_of(spark, sf_dir)), K)
        .where(F.col("hits") > 0)
        .select(*LEARNER_COURSE, "recommender", "hits")
    )


def metrics_at_k(spark, sf_dir):
    history, future, _ = split_of(tables_of(spark, sf_dir))
    items = relevant_items(history, future)
    spine = (
        items.groupBy(*LEARNER_COURSE)
        .agg(F.count(F.lit(1)).alias("n_relevant"))
        .join(history.select(*LEARNER_COURSE), LEARNER_COURSE, "left_semi")
        .withColumn("recommender", F.lit("popularity"))
    )
    scores = popularity_scores(history, learner_profiles(history, targets=spine), best=K)
    best = long_recommendations(scores, K, LEARNER_COURSE, ["popularity"])
    return rounded(metric_rows(spine, count_hits(best, items, LEARNER_COURSE), K, LEARNER_COURSE))


def evaluate_baselines(spark, sf_dir):
    return rounded(evaluate_recommenders(*split_of(tables_of(spark, sf_dir)), K))


def evaluation_summary(spark, sf_dir):
    return rounded(summarise(evaluate_recommenders(*split_of(tables_of(spark, sf_dir)), K)))


def evaluate_single_learner(spark, sf_dir):
    return rounded(evaluate_recommenders(*split_of(tables_of(spark, sf_dir)), K, grain=["id_student"]))


def _cross_validation(spark, sf_dir) -> DataFrame:
    tables = tables_of(spark, sf_dir)
    return cross_validate(tables.vle_data, staged(tables.resource_data, "resources"))


def cv_baselines(spark, sf_dir):
    return rounded(_cross_validation(spark, sf_dir))


def cv_summary(spark, sf_dir):
    return rounded(summarise_folds(_cross_validation(spark, sf_dir)))


def summary_upsert(spark, sf_dir):
    """The summary with the random recommender's row replaced."""
    summary = staged(summarise(evaluate_recommenders(*split_of(tables_of(spark, sf_dir)), K)), "summary")
    reset = summary.where(F.col("recommender") == "random").select(
        "recommender", *[(F.col(m) * 0).alias(m) for m in METRICS]
    )
    return rounded(upsert_summary(summary, reset))


def model_comparison(spark, sf_dir):
    summary = staged(summarise(evaluate_recommenders(*split_of(tables_of(spark, sf_dir)), K)), "summary")
    named = {name: summary.where(F.col("recommender") == name) for name in ("popularity", "random")}
    return rounded(compare_models(named))


# candidates and learned ranker


def candidates(spark, sf_dir):
    history, _, resources = split_of(tables_of(spark, sf_dir))
    return rounded(generate_candidates(history, resources, K))


def _test_dataset(spark, sf_dir) -> DataFrame:
    tables = tables_of(spark, sf_dir)
    history, future, resources = split_of(tables)
    return create_ml_dataset(
        history, future, resources, features.student_features(tables, CUTOFF), K
    )


ML_COLUMNS = [
    *LEARNER_COURSE,
    "id_site",
    "activity_type",
    "resource_text",
    "target",
    *PERSON,
    *SCORE_COLUMNS,
    *ASSESSMENT_FEATURES,
    *VLE_FEATURES,
    "days_registered",
]


def ml_dataset(spark, sf_dir):
    return rounded(_test_dataset(spark, sf_dir).select(*ML_COLUMNS))


def ranker_input(spark, sf_dir):
    return rounded(model_input(_test_dataset(spark, sf_dir), ["target"]))


def stratified_sample(spark, sf_dir):
    sample = sample_training_data(staged(_test_dataset(spark, sf_dir), "dataset"), SAMPLE)
    return rounded(sample.select(*ML_COLUMNS))


def stratified_sample_counts(spark, sf_dir):
    return stratified_sample(spark, sf_dir).groupBy("target").agg(F.count(F.lit(1)).alias("n"))


def numeric_scaling(spark, sf_dir):
    return rounded(numeric_parameters(staged(_test_dataset(spark, sf_dir), "dataset"), NUMERICAL_FEATURES))


def categories(spark, sf_dir):
    return category_modes(_test_dataset(spark, sf_dir))


def _stand_in(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidates scored by the fixed hybrid in the ranker's place."""
    tables = tables_of(spark, sf_dir)
    history, future, resources = split_of(tables)
    dataset = create_ml_dataset(
        history, future, resources, features.student_features(tables, CUTOFF), K
    )
    return dataset.withColumn("ML_score", hybrid_score(0.4, 0.2, 0.4)), history, future


def classifier(spark, sf_dir):
    scored, _, _ = _stand_in(spark, sf_dir)
    settled = scored.withColumn("ML_score", F.round("ML_score", 9))
    return rounded(classifier_metrics(settled, "hybrid", 0.5))


def evaluate_scored_candidates(spark, sf_dir):
    scored, history, future = _stand_in(spark, sf_dir)
    scored = scored.select(*LEARNER_COURSE, "id_site", "ML_score")
    return rounded(evaluate_scored(staged(scored, "scored"), history, future, "hybrid", K))


_TRAINED: dict[tuple, tuple] = {}


def _trained(spark, sf_dir, model_type: str):
    """The saved model and the staged test candidates; trained once per session and tables."""
    key = (spark.sparkContext.applicationId, sf_dir, model_type)
    if key not in _TRAINED:
        training, test = ml_datasets(tables_of(spark, sf_dir), FEATURE_CUTOFF, CUTOFF, K)
        path = f"{stage_root(spark)}/model-{uuid.uuid4().hex}"
        run_train(staged(training, "training_dataset"), path, model_type)
        _TRAINED[key] = path, staged(test, "test_dataset")
    path, test = _TRAINED[key]
    return load_model(path), test


def _ranker_scores(spark, sf_dir, model_type: str) -> DataFrame:
    model, test = _trained(spark, sf_dir, model_type)
    return predict_ml_scores(model, test, model_type, [*LEARNER_COURSE, "id_site", "target"])


def rf_scores(spark, sf_dir):
    return _ranker_scores(spark, sf_dir, "random_forest")


def svc_scores(spark, sf_dir):
    return _ranker_scores(spark, sf_dir, "SVC")


def ranker_metrics(spark, sf_dir):
    history, future, _ = split_of(tables_of(spark, sf_dir))
    scored = staged(rf_scores(spark, sf_dir), "scored")
    return evaluate_scored(scored, history, future, "random_forest", K)


def ranker_cv(spark, sf_dir):
    return run_ml_cross_validation(tables_of(spark, sf_dir), (60, 120, 180), 60, K)[0]


def _recommendations(spark, sf_dir) -> DataFrame:
    tables = tables_of(spark, sf_dir)
    model, _ = _trained(spark, sf_dir, "random_forest")
    serving = serving_tables(tables, CUTOFF)
    return recommend(
        ServingTables(
            staged(serving.history_interactions, "serving_history"),
            serving.student_features,
            staged(serving.resource_data, "resources"),
        ),
        model,
        K,
    )


def recommendations(spark, sf_dir):
    return _recommendations(spark, sf_dir)


def recommendation_json(spark, sf_dir):
    return recommendation_records(_recommendations(spark, sf_dir))


# profiles


def value_counts(spark, sf_dir):
    tables = tables_of(spark, sf_dir)
    wanted = {
        "student_data": ["gender", "code_module", "region", "final_result", "disability"],
        "assessment_data": ["assessment_type", "is_banked"],
        "vle_data": ["activity_type"],
        "resource_data": ["code_module"],
    }
    out = None
    for name, columns in wanted.items():
        part = profile.value_counts(getattr(tables, name), columns).withColumn("table_name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return rounded(out)


def crosstab_normalized(spark, sf_dir):
    resources = staged(tables_of(spark, sf_dir).resource_data, "resources")
    return rounded(profile.crosstab_shares(resources, "code_module", "activity_type"))


def _assessments_per_learner(tables: CourseTables) -> DataFrame:
    return profile.per_learner(tables.assessment_data, F.count("id_assessment"), "n_assessments")


def _clicks_per_learner(tables: CourseTables) -> DataFrame:
    return profile.per_learner(tables.interaction_data, F.sum("total_resource_clicks"), "clicks")


def assessments_per_learner(spark, sf_dir):
    return _assessments_per_learner(tables_of(spark, sf_dir))


def clicks_per_learner(spark, sf_dir):
    return _clicks_per_learner(tables_of(spark, sf_dir))


def histogram(spark, sf_dir):
    tables = tables_of(spark, sf_dir)
    sources = {
        "average_score": (tables.assessment_data, "average_score"),
        "assessments_per_learner": (_assessments_per_learner(tables), "n_assessments"),
        "module_presentation_length": (tables.vle_data, "module_presentation_length"),
        "clicks_per_learner": (_clicks_per_learner(tables), "clicks"),
    }
    out = None
    for name, (df, column) in sources.items():
        part = profile.histogram(staged(df.select(column), "measure"), column).withColumn(
            "histogram", F.lit(name)
        )
        out = part if out is None else out.unionByName(part)
    return rounded(out)


def avg_click_duration(spark, sf_dir):
    return rounded(profile.average_click_duration(tables_of(spark, sf_dir).interaction_data))


def boxplot_stats(spark, sf_dir):
    durations = tables_of(spark, sf_dir).student_data.select("registration_duration")
    return profile.boxplot_stats(staged(durations, "durations"), "registration_duration")


def duplicate_profile(spark, sf_dir):
    merged = merge_tables(raw_tables(spark, sf_dir))
    named = {
        "student_merged": merged.student_data,
        "assessment_merged": merged.assessment_data,
        "vle_merged": merged.vle_data,
        "vle": merged.resource_data,
    }
    out = None
    for name, df in named.items():
        part = profile.duplicate_profile(df, name)
        out = part if out is None else out.unionByName(part)
    return rounded(out)


def null_profile(spark, sf_dir):
    merged = merge_tables(raw_tables(spark, sf_dir))
    named = {
        "student_merged": merged.student_data,
        "assessment_merged": merged.assessment_data,
        "vle_merged": merged.vle_data,
    }
    out = None
    for name, df in named.items():
        part = profile.null_profile(df, name)
        out = part if out is None else out.unionByName(part)
    return out


def day_profile(spark, sf_dir):
    return profile.day_profile(tables_of(spark, sf_dir).vle_data)


def site_uniqueness(spark, sf_dir):
    return profile.site_uniqueness(tables_of(spark, sf_dir).resource_data)


def top_interaction(spark, sf_dir):
    return profile.top_interaction(tables_of(spark, sf_dir).interaction_data)


def learner_count(spark, sf_dir):
    return profile.learner_count(tables_of(spark, sf_dir).interaction_data)


def row_sample(spark, sf_dir):
    return profile.row_sample(tables_of(spark, sf_dir).student_data, LEARNER_COURSE)


def registered() -> dict[str, Query]:
    return {
        "merge_student": merge_student,
        "merge_assessment": merge_assessment,
        "merge_vle": merge_vle,
        "clean_student": clean_student,
        "clean_assessment": clean_assessment,
        "impute_mode_imd_band": impute_mode_imd_band,
        "typecast_student": typecast_student,
        "typecast_assessment": typecast_assessment,
        "registration_duration": registration_duration,
        "average_score_window": average_score_window,
        "resource_text": resource_text,
        "interaction_data": interaction_data,
        "history_at_cutoff": history_at_cutoff,
        "drop_leaking_columns": drop_leaking_columns,
        "leakage_safe_student": leakage_safe_student,
        "leakage_safe_assessment": leakage_safe_assessment,
        "ml_temporal_split_counts": ml_temporal_split_counts,
        "temporal_split_history": temporal_split_history,
        "temporal_split_future": temporal_split_future,
        "cv_fold_split": cv_fold_split,
        "assessment_features": assessment_features,
        "vle_features": vle_features,
        "student_features": student_features,
        "popularity_scores": popularity,
        "popularity_cold_start": popularity_unseen,
        "collaborative_scores": collaborative,
        "content_scores": content,
        "hybrid_scores": hybrid,
        "random_scores": random_list,
        "topk_popularity": topk_popularity,
        "topk_collaborative": topk_collaborative,
        "topk_content": topk_content,
        "topk_hybrid": topk_hybrid,
        "topk_random": topk_random,
        "explanations": explanations,
        "tfidf_weights": tfidf_weights,
        "document_term_weights": document_term_weights,
        "document_similarity": document_similarity,
        "learner_similarity": learner_similarity,
        "resource_similarity": resource_similarity,
        "pair_similarity": pair_similarity_to_favourite,
        "evaluated_learner_courses": evaluated,
        "relevant_items": relevant,
        "hits_at_k": hits_at_k,
        "metrics_at_k": metrics_at_k,
        "evaluate_baselines": evaluate_baselines,
        "evaluation_summary": evaluation_summary,
        "evaluate_single_learner": evaluate_single_learner,
        "cv_baselines": cv_baselines,
        "cv_summary": cv_summary,
        "summary_upsert": summary_upsert,
        "model_comparison": model_comparison,
        "generate_candidates": candidates,
        "ml_dataset": ml_dataset,
        "model_input": ranker_input,
        "stratified_sample": stratified_sample,
        "stratified_sample_counts": stratified_sample_counts,
        "numeric_scaling": numeric_scaling,
        "category_modes": categories,
        "classifier_metrics": classifier,
        "evaluate_scored_candidates": evaluate_scored_candidates,
        "rf_scores": rf_scores,
        "svc_scores": svc_scores,
        "ranker_metrics": ranker_metrics,
        "ranker_cv": ranker_cv,
        "recommendations": recommendations,
        "recommendation_json": recommendation_json,
        "value_counts": value_counts,
        "crosstab_normalized": crosstab_normalized,
        "assessments_per_learner": assessments_per_learner,
        "clicks_per_learner": clicks_per_learner,
        "histogram": histogram,
        "avg_click_duration": avg_click_duration,
        "boxplot_stats": boxplot_stats,
        "duplicate_profile": duplicate_profile,
        "null_profile": null_profile,
        "day_profile": day_profile,
        "site_uniqueness": site_uniqueness,
        "top_interaction": top_interaction,
        "learner_count": learner_count,
        "row_sample": row_sample,
    }

