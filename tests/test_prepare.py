import dataclasses

from pyspark.sql import functions as F

from coursewise.operators.interactions import aggregate_interactions, fold_split, temporal_split
from coursewise.plans import features
from coursewise.plans.prepare import merge_tables
from coursewise.schemas import INTERACTIONS


def test_merge_keeps_rows_and_adds_columns(raw):
    merged = merge_tables(raw)
    assert {f.name for f in dataclasses.fields(merged)} >= {"student_data", "vle_data"}
    assert merged.student_data.count() == 3
    assert {"date_registration", "module_presentation_length"} <= set(merged.student_data.columns)


def test_student_cleaning(tables):
    rows = {r.id_student: r for r in tables.student_data.collect()}
    assert set(rows) == {1, 3}
    assert rows[3].imd_band == "30-40%"
    assert rows[3].date_unregistration == 241
    assert rows[3].registration_duration == 221
    assert rows[1].registration_duration == 95
    assert rows[1].withdrew is False
    assert rows[1].disability is True and rows[3].disability is False


def test_assessment_cleaning(tables):
    rows = {(r.id_assessment, r.id_student): r for r in tables.assessment_data.collect()}
    assert set(rows) == {(2001, 2), (1002, 1), (1001, 3)}
    assert rows[2001, 2].date == 261
    assert rows[2001, 2].is_banked is True and rows[1002, 1].is_banked is False
    assert rows[1002, 1].average_score == 70


def test_week_columns_removed_and_text_built(tables):
    assert "week_from" not in tables.vle_data.columns
    assert "week_to" not in tables.resource_data.columns
    texts = {r.id_site: r.resource_text for r in tables.resource_data.collect()}
    assert texts[102] == "AAA 2013J oucontent"


def test_interactions(tables):
    assert tables.interaction_data.columns == INTERACTIONS.names
    row = tables.interaction_data.where("id_student = 2").first()
    assert (row.total_resource_clicks, row.first_used, row.last_used, row.click_duration) == (14, 5, 5, 0)


def test_rows_with_missing_key_belong_to_no_group(tables):
    holed = tables.vle_data.withColumn(
        "activity_type", F.when(F.col("id_site") != 201, F.col("activity_type"))
    )
    assert aggregate_interactions(holed).where("id_site = 201").isEmpty()


def test_repeated_clicks_are_summed(tables):
    twice = tables.vle_data.union(tables.vle_data)
    row = aggregate_interactions(twice).where("id_student = 1 AND id_site = 101").first()
    assert row.total_resource_clicks == 10


def test_split_respects_cutoff(tables):
    history, future = temporal_split(tables.vle_data, 1)
    assert {(r.id_student, r.id_site) for r in history.collect()} == {(1, 101), (3, 103)}
    assert {(r.id_student, r.id_site) for r in future.collect()} == {(1, 102), (2, 201), (3, 101)}


def test_fold_split_labels_rows_of_every_fold(tables):
    folds = [
        {"fold": 1, "cutoff_day": 0, "test_end": 2},
        {"fold": 2, "cutoff_day": 2, "test_end": 4},
    ]
    rows = {(r.fold, r.part, r.date) for r in fold_split(tables.vle_data, folds).collect()}
    assert rows == {
        (1, "history", -10),
        (1, "future", 1),
        (1, "future", 2),
        (2, "history", -10),
        (2, "history", 1),
        (2, "history", 2),
        (2, "future", 3),
    }


def test_leakage_guard(tables):
    past = features.filter_by_cutoff(tables, 10)
    assert past.interaction_data is None
    assert not set(features.LEAKING_STUDENT_COLUMNS) & set(past.student_data.columns)
    assert "average_score" not in past.assessment_data.columns
    assert past.vle_data.where("date > 10").isEmpty()


def test_assessment_and_vle_features(tables):
    row = features.assessment_features(tables.assessment_data).where("id_student = 2").first()
    assert (row.average_score, row.min_score, row.max_score) == (60, 60, 60)
    assert row.assessments_submitted == 1 and row.assessment_type_diversity == 1
    row = features.vle_features(tables.vle_data).where("id_student = 2").first()
    assert (row.total_resource_clicks, row.resources_used) == (14, 1)
    assert (row.first_used, row.last_used, row.interaction_duration) == (5, 5, 0)


def test_student_features_fill_zero_and_drop_late_learners(tables):
    rows = features.student_features(tables, 10).collect()
    assert [r.id_student for r in rows] == [1]
    assert rows[0].days_registered == 102
    assert rows[0].assessments_submitted == 0 and rows[0].average_score == 0
    assert rows[0].total_resource_clicks == 9
