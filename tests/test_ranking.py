from __future__ import annotations

import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from basketlens.operators import explain, features, models, ranking, selection


def by_hand(rows, k):
    out = []
    for c in range(k):
        pos = [(p[c], n) for label, n, p in rows if label == c]
        neg = [(p[c], n) for label, n, p in rows if label != c]
        pairs = sum(n for _, n in pos) * sum(n for _, n in neg)
        won = sum(a * b * (1.0 if x > y else 0.5 if x == y else 0.0) for x, a in pos for y, b in neg)
        out.append((sum(n for _, n in pos), won / pairs if pairs else None))
    return out


@pytest.fixture(scope="module")
def fits(planted):
    marked = planted.withColumn("held_out", F.pmod(F.xxhash64("row_id"), F.lit(4)) == 0)
    parts = models.prepare(marked, "held_out")
    return parts, {
        name: models.fit_classifier(classifier, parts.train, parts.features, parts.slicer)
        for name, classifier in (("forest", models.random_forest(10, 4)), ("regression", models.logistic_regression(20)))
    }


def test_auc_equals_all_pairs(spark):
    rows = [(float(i % 3), i % 5 + 1, [round((i * 7 % 11) / 11, 1), round((i % 4) / 4, 2), 0.5]) for i in range(60)]
    df = spark.createDataFrame(rows, "label double, n long, probability array<double>").repartition(5)
    got = {r.category: (r.n, r.auc) for r in ranking.class_auc(df, ["a", "b", "c", "none"]).collect()}
    for name, (n, auc) in zip("abc", by_hand(rows, 3)):
        assert got[name][0] == n and got[name][1] == pytest.approx(auc, abs=1e-12)
    assert got["c"][1] == 0.5 and got["none"] == (0, None)


def test_auc_over_many_ranges(spark):
    df = spark.range(20_000).select(
        (F.col("id") % 2).cast("double").alias("label"), F.lit(1).cast("long").alias("n"),
        F.array(F.rand(3), F.col("id") / 20_000).alias("probability"),
    )
    (first, second) = ranking.class_auc(df, ["even", "odd"]).orderBy("category").collect()
    assert abs(first.auc - 0.5) < 0.02 and second.auc == pytest.approx(0.50005, abs=1e-9)


@pytest.mark.parametrize("name", ["forest", "regression"])
def test_log_loss_equals_the_stock_evaluator_on_single_rows(fits, name):
    parts, fitted = fits
    rated = ranking.probabilities(fitted[name], parts.test)
    rows = rated.withColumn("one", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).withColumn(
        "probability", array_to_vector("probability")
    ).withColumn("prediction", F.lit(0.0))
    stock = MulticlassClassificationEvaluator(metricName="logLoss", labelCol="label", probabilityCol="probability")
    line = ranking.log_loss(rated).first()
    assert line.log_loss == pytest.approx(stock.evaluate(rows), abs=1e-9) and line.n == rows.count()
    auc = [r.auc for r in ranking.class_auc(rated, parts.features.labels).collect()]
    assert min(auc) > 0.85
    flat = ranking.base_rates(parts, ["is_member_index"])
    assert ranking.log_loss(flat).first().log_loss > line.log_loss
    assert all(abs(r.auc - 0.5) < 0.1 for r in ranking.class_auc(flat, parts.features.labels).collect())


def test_scores_of_nothing(spark):
    empty = spark.createDataFrame([], "label double, n long, probability array<double>")
    assert [tuple(r) for r in ranking.class_auc(empty, ["a"]).collect()] == [("a", 0, None)]
    assert tuple(ranking.log_loss(empty).first()) == (0, None)


def test_expected_importance_equals_shuffling_by_every_row(spark):
    rows = [("xy"[i % 2], i % 3, "pq"[(i * 5 % 7) % 2], i % 4 + 1) for i in range(30)]
    df = spark.createDataFrame(rows, "a string, b int, label string, n long")

    def rule(t):
        return t.withColumn("prediction", F.when((F.col("a") == "x") & (F.col("b") > 0), "p").otherwise("q"))

    def guess(a, b):
        return "p" if a == "x" and b > 0 else "q"

    total = sum(r[3] for r in rows)
    base = sum(n for a, b, label, n in rows if guess(a, b) == label) / total
    lost = {
        "a": sum(n * m for _, b, label, n in rows for a, _, _, m in rows if guess(a, b) == label) / total**2,
        "b": sum(n * m for a, _, label, n in rows for _, b, _, m in rows if guess(a, b) == label) / total**2,
    }
    got = explain.expected_importance(df, {"a": "a", "b": "b"}, rule).collect()
    assert {r.source_column for r in got} == {"a", "b"}
    for r in got:
        assert r.accuracy == pytest.approx(base) and r.permuted_accuracy == pytest.approx(lost[r.source_column])


@pytest.mark.parametrize("name", ["forest", "regression"])
def test_the_planted_signal_is_found_in_both_models(fits, name):
    parts, fitted = fits
    lines = {r.source_column: r for r in explain.permutation_importance(fitted[name], parts.test).collect()}
    base = models.accuracy(fitted[name], parts.test).first().accuracy
    assert lines["gender"].accuracy == pytest.approx(base)
    assert lines["gender"].importance > 0.2 and lines["age"].importance > 0.2
    assert all(abs(lines[c].importance) < 0.03 for c in ("is_member", "province", "unit_price"))


def test_every_column_is_tested_once(planted):
    model = features.fit_features(planted)
    table = features.cells(planted, model)
    rows = {r.source_column: r for r in selection.column_tests(table, model).collect()}
    assert set(rows) == {"gender", "is_member", "province", "age", "unit_price"}
    assert rows["gender"].dof == 3 and rows["gender"].selected and rows["age"].selected
    slots = {r.feature: r for r in selection.chi_square(table, model).collect()}
    assert rows["gender"].statistic == pytest.approx(slots["gender=male"].statistic)
    assert rows["age"].statistic == pytest.approx(slots["age"].statistic)


def test_step_up_rule_over_slots(planted):
    model = features.fit_features(planted)
    table = features.cells(planted, model)
    rows = selection.discovered_slots(table, model).collect()
    assert len(rows) == len(model.slots)
    tests = {}
    for r in rows:
        twin = r.source_column if r.source_column in ("gender", "is_member") else r.feature
        tests.setdefault(twin, set()).add((r.rank, r.log_p, r.selected))
    assert all(len(x) == 1 for x in tests.values())
    lines = sorted(x for (x,) in map(tuple, tests.values()))
    bounds = [math.log(rank * 0.05 / len(lines)) for rank, _, _ in lines]
    last = max((i for i, ((_, p, _), b) in enumerate(zip(lines, bounds)) if p <= b), default=-1)
    assert [s for _, _, s in lines] == [i <= last for i in range(len(lines))]
    kept = selection.select_discovered(table, model).getIndices()
    assert kept == sorted(r.slot for r in rows if r.selected)
    assert {r.source_column for r in rows if r.selected} >= {"gender", "age"}
