from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_oracles import connect, differences

FOLDER = "/root/testdata/sf0.001"
# The last one is run, stage by stage, by its own tests.
MODELS = {"pipeline", "rf_accuracy", "cv_scores", "model_leaderboard", "model_report", "confusion_matrix"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert differences(queries()[name](spark, FOLDER), con, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - MODELS))
def test_query_without_sql_gives_rows(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


def test_leaderboard_query(spark):
    rows = queries()["model_leaderboard"](spark, FOLDER).collect()
    assert {r.model for r in rows} == {"random forest", "logistic regression"}
    assert all(0 <= r.cv_accuracy <= 1 and 0 <= r.test_accuracy <= 1 for r in rows)
    assert sum(r.is_best for r in rows) == 1


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["category", "n"]
    assert df.count() == 6


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
