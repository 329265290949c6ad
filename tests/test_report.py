from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from basketlens.operators import clean, explain, models, profile
from basketlens.plans import report
from basketlens.schema import PurchaseValues
from basketlens.sources.landing import write_tables

from .conftest import SCHEMA


def test_report_agrees_with_the_single_operators(planted):
    lines = {r.metric: (r["item"], r.value) for r in report.insight_report(planted).collect()}
    assert lines["purchases"] == ("", 4000.0)
    table = profile.basic_stats(planted, ["age", "unit_price"])
    stats = {r["column"]: r["mean"] for r in table.collect()}
    assert lines["average age"][1] == pytest.approx(stats["age"], abs=0.005)
    assert lines["average unit price"][1] == pytest.approx(stats["unit_price"], abs=0.005)
    female = profile.value_share(planted, "gender", "female").first()
    members = profile.value_share(planted, "is_member", "yes").first()
    assert lines["female share"] == ("female", female.share)
    assert lines["member share"] == ("yes", members.share)
    ranks = {r["rank"]: r for r in profile.best_and_worst(planted, "category").collect()}
    assert lines["best seller"] == (ranks["best"].category, ranks["best"].n)
    assert lines["worst seller share"] == (ranks["worst"].category, ranks["worst"].share)
    band = profile.top_age_band(planted).first()
    assert lines["promote to age band"] == (f"{band.age_band}: {ranks['best'].category}", band.n)


def test_report_values_are_parameters(planted):
    rows = report.insight_report(planted, PurchaseValues(female="nobody", member="no")).collect()
    lines = {r.metric: r for r in rows}
    assert lines["female share"].value == 0.0
    assert lines["member share"]["item"] == "no" and lines["member share"].value > 50


def test_report_of_nothing(spark):
    rows = report.insight_report(spark.createDataFrame([], SCHEMA)).collect()
    lines = {r.metric: r.value for r in rows}
    assert lines["purchases"] == 0.0 and lines["female share"] == 0.0


def test_report_reads_the_purchases_once(planted, tmp_path):
    planted.write.parquet(str(tmp_path / "p"))
    df = planted.sparkSession.read.parquet(str(tmp_path / "p"))
    plan = report.insight_report(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_chart_tables_can_be_saved(spark, planted, tmp_path):
    tables = report.chart_tables(planted)
    assert set(tables) == {
        "category_distribution", "age_histogram", "age_density", "gender_category",
        "age_category", "member_stats", "province_distribution",
    }
    write_tables(tables, str(tmp_path))
    for name, table in tables.items():
        assert spark.read.parquet(str(tmp_path / name)).count() == table.count() > 0
    write_tables({"c": tables["category_distribution"]}, str(tmp_path / "csv"), "csv")
    back = spark.read.option("header", True).csv(str(tmp_path / "csv" / "c"))
    assert back.columns == ["category", "n"]


def test_lines_about_cleaning_and_models(spark, planted):
    lines = report.cleaning_lines(clean.clean_counts(planted)).collect()
    assert [(r.metric, r.value) for r in lines] == [("rows read", 4000.0), ("rows kept", 4000.0)]
    rows = planted.withColumn("held_out", F.pmod(F.xxhash64("row_id"), F.lit(4)) == 0)
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("row_id"), F.lit(3)).cast("int"))
    candidates = {"forest": models.forest_grid(trees=(3,), depths=(2,))}
    board, fitted = models.leaderboard(rows, candidates)
    importance = explain.feature_importance(fitted["forest"], rows)
    found = report.model_lines(board, importance, fitted["forest"]).collect()
    chosen = [r["item"] for r in found if r.metric == "chosen parameters"]
    assert chosen == ["forest: maxDepth=2, numTrees=3"]
    assert "feature_importance" in report.chart_tables(planted, importance=importance)
