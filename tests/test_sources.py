import json

import pytest
from pyspark.sql import functions as F

from coursewise.plans.recommend import ml_datasets, run_baseline_holdout, serving_tables
from coursewise.schemas import INTERACTIONS, ITEM, RAW_TABLES, STUDENT_REGISTRATION, ServingTables
from coursewise.sources.staging import memoised, parameter_path
from coursewise.sources.tables import (
    compare_models,
    read_csv_table,
    read_ml_datasets,
    read_processed,
    read_raw_tables,
    read_serving_tables,
    read_summary,
    recommendation_records,
    save_summary,
    summary_versions,
    upsert_summary,
    write_ml_datasets,
    write_processed,
    write_recommendations,
    write_results,
    write_serving_tables,
)


def rows(df):
    return sorted(map(str, df.collect()))


def test_missing_tokens_and_bad_numbers_become_null(spark, tmp_path):
    path = tmp_path / "registration.csv"
    path.write_text(
        "id_student,code_module,code_presentation,date_registration,date_unregistration\n"
        "1,AAA,2013J,-5,NA\n2,null,2013J,,nan\n3,BBB,2013B,x,12.0\n"
    )
    got = {r.id_student: r for r in read_csv_table(spark, str(path), STUDENT_REGISTRATION).collect()}
    assert got[1].date_registration == -5 and got[1].date_unregistration is None
    assert got[2].code_module is None and got[2].date_registration is None
    assert got[3].date_registration is None and got[3].date_unregistration == 12


def test_absent_column_is_an_error(spark, tmp_path):
    path = tmp_path / "registration.csv"
    path.write_text("id_student\n1\n")
    with pytest.raises(ValueError):
        read_csv_table(spark, str(path), STUDENT_REGISTRATION)


def test_raw_round_trip(spark, raw, tmp_path):
    for name, (file, _) in RAW_TABLES.items():
        getattr(raw, name).write.option("header", True).csv(str(tmp_path / file))
    again = read_raw_tables(spark, str(tmp_path))
    for name in ("student_info", "student_vle", "assessments"):
        table = getattr(again, name)
        assert table.schema == RAW_TABLES[name][1]
        assert rows(table) == rows(getattr(raw, name))


def test_processed_round_trip(spark, tables, tmp_path):
    write_processed(tables, str(tmp_path))
    again = read_processed(spark, str(tmp_path))
    assert rows(again.student_data) == rows(tables.student_data)
    assert dict(again.student_data.dtypes)["disability"] == "boolean"


def test_serving_round_trip(spark, tables, tmp_path):
    serving = serving_tables(tables, 10)
    write_serving_tables(serving, str(tmp_path))
    again = read_serving_tables(spark, str(tmp_path))
    assert again.history_interactions.columns == serving.history_interactions.columns
    assert rows(again.history_interactions) == rows(serving.history_interactions)
    assert (tmp_path / "history_interactions" / "code_module=AAA").is_dir()


def test_memoised_dataset_is_keyed_by_all_parameters(spark, tmp_path):
    calls = []

    def build(n):
        calls.append(n)
        return spark.range(n)

    root = str(tmp_path)
    assert memoised(spark, root, "d", {"fold": 1, "cutoff": 60}, lambda: build(3)).count() == 3
    assert memoised(spark, root, "d", {"cutoff": 60, "fold": 1}, lambda: build(4)).count() == 3
    assert memoised(spark, root, "d", {"fold": 1, "cutoff": 90}, lambda: build(5)).count() == 5
    assert calls == [3, 5]
    assert parameter_path(root, "d", {"a": 1}) != parameter_path(root, "d", {"a": 2})


def test_summary_upsert(spark, tmp_path):
    schema = "recommender string, precision double, recall double, f1 double"
    first = spark.createDataFrame([("a", 0.1, 0.2, 0.3), ("b", 0.4, 0.5, 0.6)], schema)
    second = spark.createDataFrame([("b", 1.0, 1.0, 1.0), ("c", 0.0, 0.0, 0.0)], schema)
    assert rows(upsert_summary(None, first)) == rows(first)
    folder = str(tmp_path / "summary")
    save_summary(spark, first, folder)
    save_summary(spark, second, folder)
    got = {r.recommender: r.precision for r in read_summary(spark, folder).collect()}
    assert got == {"a": 0.1, "b": 1.0, "c": 0.0}
    assert summary_versions(spark, folder) == [1, 2]
    both = compare_models({"x": first.where("recommender = 'a'"), "y": second.where("recommender = 'b'")})
    assert {(r.recommender, r.f1) for r in both.collect()} == {("x", 0.3), ("y", 1.0)}


def test_serving_files_follow_the_rows_of_a_course(spark, tables, tmp_path):
    history = spark.range(10_000).select(
        F.pmod("id", F.lit(700)).alias("id_student"),
        F.when(F.col("id") < 9000, "A").when(F.col("id") < 9900, "B").otherwise("C").alias("code_module"),
        F.lit("0123").alias("code_presentation"),
        F.col("id").alias("id_site"),
        F.lit("url").alias("activity_type"),
        *[F.lit(1).cast(f.dataType).alias(f.name) for f in INTERACTIONS.fields if f.name not in (*ITEM, "id_student")],
    ).select(INTERACTIONS.names)
    serving = ServingTables(history, tables.student_data, tables.resource_data)
    write_serving_tables(serving, str(tmp_path), rows_per_file=500)
    files = {}
    for path in (tmp_path / "history_interactions").rglob("*.parquet"):
        files.setdefault(path.parent.parent.name, []).append(spark.read.parquet(str(path)).count())
    assert {k: len(v) for k, v in files.items()} == {"code_module=A": 18, "code_module=B": 2, "code_module=C": 1}
    large = files["code_module=A"] + files["code_module=B"]
    assert max(large) < 4 * min(large) and sum(map(sum, files.values())) == 10_000
    again = read_serving_tables(spark, str(tmp_path)).history_interactions
    assert again.where("code_presentation = '0123'").count() == 10_000


def test_ml_datasets_round_trip(spark, tables, tmp_path):
    training, test = ml_datasets(tables, 1, 3, 5)
    write_ml_datasets(training, test, str(tmp_path))
    for written, read in zip((training, test), read_ml_datasets(spark, str(tmp_path)), strict=True):
        assert read.schema["disability"].dataType == written.schema["disability"].dataType
        assert rows(read.select(written.columns)) == rows(written)


def test_results_are_written_by_recommender(spark, tables, tmp_path):
    results, summary = run_baseline_holdout(tables, 1, 2, str(tmp_path / "summary"))
    write_results(results, str(tmp_path / "results"))
    again = spark.read.parquet(str(tmp_path / "results"))
    assert rows(again.select(results.columns)) == rows(results)
    assert (tmp_path / "results" / "recommender=hybrid").is_dir()
    assert rows(read_summary(spark, str(tmp_path / "summary"))) == rows(summary)


@pytest.mark.parametrize("form", ("parquet", "csv"))
def test_recommendations_are_written(spark, tmp_path, form):
    schema = "id_student long, code_module string, code_presentation string, id_site long, ML_score double, explanation string"
    best = spark.createDataFrame([(1, "A", "P", 7, 0.5, "often, used"), (1, "A", "P", 9, 0.25, 'so "similar"')], schema)
    write_recommendations(best, str(tmp_path / "out"), form)
    reader = spark.read.schema(schema)
    again = reader.parquet(str(tmp_path / "out")) if form == "parquet" else reader.option("header", True).option("escape", '"').csv(str(tmp_path / "out"))
    assert {(r.id_site, r.ML_score) for r in again.collect()} == {(7, 0.5), (9, 0.25)}
    [record] = recommendation_records(best).collect()
    assert [r["id_site"] for r in json.loads(record.records)] == [7, 9]


def test_click_log_is_joined_once(spark, tmp_path):
    from datetime import date

    from coursewise.sources.star_mapping import raw_tables

    tables = {
        "lineitem": ([(1, 1, 2.0, date(1996, 2, 1)), (9, 1, 2.0, date(1996, 2, 1))], "l_orderkey long, l_partkey long, l_quantity double, l_shipdate date"),
        "orders": ([(1, 7, date(1996, 1, 1), "1-URGENT", "O")], "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string, o_orderstatus string"),
        "customer": ([(7, 0, 10.0, "BUILDING")], "c_custkey long, c_nationkey long, c_acctbal double, c_mktsegment string"),
        "part": ([(1, "Brand#12", "PROMO")], "p_partkey long, p_brand string, p_type string"),
        "nation": ([(0, 0)], "n_nationkey long, n_regionkey long"),
        "region": ([(0, "ASIA")], "r_regionkey long, r_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    raw = raw_tables(spark, str(tmp_path))
    assert [tuple(r) for r in raw.student_vle.select("id_student", "code_module", "date", "sum_click").collect()] == [(7, "BUILDING", 7, 2)]
    assert not any("lineitem" in file for file in raw.student_vle.inputFiles())
