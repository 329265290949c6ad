from __future__ import annotations

import duckdb
import pytest

from basketlens.operators import models, profile
from basketlens.operators.clean import clean_counts
from basketlens.plans import purchases as plan
from basketlens.plans import queries
from basketlens.plans.oracles import ORACLES
from basketlens.plans.queries import QUERIES
from tools.check_oracles import differences

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture(scope="module")
def hot_folder(spark, tmp_path_factory):
    """Test tables in which one part and one order hold a third of the lines each."""
    folder = str(tmp_path_factory.mktemp("hot"))
    spark.range(5).selectExpr("int(id) AS n_nationkey", "concat('N', id) AS n_name").write.parquet(
        f"{folder}/nation.parquet"
    )
    spark.range(40).selectExpr(
        "id AS c_custkey", "int(id % 5) AS c_nationkey", "id * 250.0D AS c_acctbal"
    ).write.parquet(f"{folder}/customer.parquet")
    spark.range(400).selectExpr("id AS o_orderkey", "id % 40 AS o_custkey").write.parquet(
        f"{folder}/orders.parquet"
    )
    spark.range(60).selectExpr(
        "id AS p_partkey",
        "element_at(array('ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'), int(id % 6) + 1)"
        " AS p_type",
    ).write.parquet(f"{folder}/part.parquet")
    spark.range(0, 30_000, 1, 6).selectExpr(
        "IF(id % 3 = 1, 7, id % 400) AS l_orderkey",
        "IF(id % 3 = 0, 11, id % 60) AS l_partkey",
        "id AS l_suppkey",
        "int(id % 7) AS l_linenumber",
        "double(id % 50 + 1) AS l_quantity",
        "double(id % 977 + 1) AS l_extendedprice",
        "0.0D AS l_discount",
        "0.0D AS l_tax",
        "IF(id % 2 = 0, 'F', 'O') AS l_linestatus",
    ).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_hot_keys_are_split_between_tasks(spark, hot_folder):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    try:
        lines = plan.order_lines(spark, hot_folder)
        assert len(lines.collect()) == 30_000
        executed = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    final = executed.split("Initial Plan")[0]
    assert final.count("SortMergeJoin(skew=true)") == 2


@pytest.mark.parametrize(
    "name", ["category_counts", "best_worst_category", "price_quantile_bins", "feature_matrix"]
)
def test_hot_keys_give_whole_results(spark, hot_folder, name):
    con = duckdb.connect()
    for table in ("nation", "customer", "orders", "part", "lineitem"):
        con.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{hot_folder}/{table}.parquet/*.parquet'"
        )
    assert differences(QUERIES[name](spark, hot_folder), con, ORACLES[name]) == []


def test_landed_once_and_read_by_column(spark, hot_folder):
    rows = plan.purchases(spark, hot_folder)
    assert plan.purchases(spark, hot_folder) is rows
    text = profile.group_counts(rows, "gender")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<gender:string>" in text
    assert "Join" not in text


def test_lines_without_a_match_are_kept_for_cleaning_to_count(spark, hot_folder, tmp_path):
    folder = str(tmp_path)
    for table in ("nation", "customer", "orders", "part", "lineitem"):
        spark.read.parquet(f"{hot_folder}/{table}.parquet").limit(40).write.parquet(
            f"{folder}/{table}.parquet"
        )
    odd = [(-1, 0, 1, 0, 5.0, 5.0, 0.0, 0.0, "F"), (0, -1, 2, 0, 5.0, 5.0, 0.0, 0.0, "F"), (0, 0, 3, 0, 5.0, 5.0, 0.0, 0.0, None)]
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(odd, lines.schema).write.mode("append").parquet(f"{folder}/lineitem.parquet")
    rows = plan.order_lines(spark, folder)
    assert rows.count() == 43
    orphan = rows.where("l_discount = 0 AND province IS NULL AND is_member IS NULL")
    assert orphan.count() >= 1
    counts = clean_counts(rows).first()
    assert counts.rows_in == 43
    assert counts.missing_province >= 1 and counts.missing_category >= 1
    assert counts.missing_gender == 1
    con = duckdb.connect()
    for table in ("nation", "customer", "orders", "part", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    for name in ("category_counts", "clean_counts"):
        assert differences(QUERIES[name](spark, folder), con, ORACLES[name]) == []


def test_refresh_reads_the_source_again(spark, hot_folder, tmp_path):
    folder = str(tmp_path / "copy")
    for table in ("nation", "customer", "orders", "part", "lineitem"):
        spark.read.parquet(f"{hot_folder}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
    n = plan.purchases(spark, folder).count()
    spark.read.parquet(f"{hot_folder}/lineitem.parquet").write.mode("append").parquet(
        f"{folder}/lineitem.parquet"
    )
    assert plan.purchases(spark, folder).count() == n
    assert plan.purchases(spark, folder, refresh=True).count() == 2 * n


@pytest.mark.parametrize("room, by_part", [(60 * 50, 0), (60 * 40, 1)])
def test_lines_are_shuffled_by_part_only_if_products_take_too_much_room(spark, hot_folder, room, by_part):
    # Spark itself would broadcast the nations only.
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in settings}
    for k in settings:
        spark.conf.set(k, "1")
    try:
        lines = plan.order_lines(spark, hot_folder, room)
        assert lines.count() == 30_000
        lines = plan.order_lines(spark, hot_folder, room).where("category IS NOT NULL")
        text = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert text.count("Exchange hashpartitioning(l_orderkey") == 1
    assert text.count("Exchange hashpartitioning(l_partkey") == by_part


def test_purchases_are_landed_in_a_dense_codec(spark, hot_folder):
    files = plan.purchases(spark, hot_folder).inputFiles()
    assert files and all(".zstd." in f for f in files)


def _copy(spark, hot_folder, folder):
    for table in ("nation", "customer", "orders", "part", "lineitem"):
        spark.read.parquet(f"{hot_folder}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
    return folder


def test_copy_without_the_key_has_the_same_rows(spark, hot_folder, tmp_path):
    folder = _copy(spark, hot_folder, str(tmp_path / "copy"))
    odd = [(0, 0, None, 0, 5.0, 7.0, 0.0, 0.0, "F"), (0, 0, None, None, 5.0, 7.0, 0.0, 0.0, "O"),
           (0, 0, 3, 0, 5.0, 5.0, 0.0, 0.0, None), (None, None, 3, 0, 5.0, 5.0, 0.0, 0.0, "F")]
    lines = spark.read.parquet(f"{hot_folder}/lineitem.parquet")
    spark.createDataFrame(odd, lines.schema).write.mode("append").parquet(f"{folder}/lineitem.parquet")
    without = plan.purchases(spark, folder, keyed=False)
    assert plan.KEY not in without.columns
    whole = plan.purchases(spark, folder)
    assert plan.KEY in whole.columns
    named = whole.drop(plan.KEY)
    assert without.columns == named.columns and without.count() == 30_002
    assert without.exceptAll(named).count() == 0 and named.exceptAll(without).count() == 0


def test_models_learn_from_the_copy_without_the_key(spark, hot_folder, tmp_path):
    folder = _copy(spark, hot_folder, str(tmp_path / "copy"))
    matrix = queries._fit(spark, folder, models.random_forest(2, 2))[1]
    assert matrix.agg({"n": "sum"}).first()[0] == plan.purchases(spark, folder, keyed=False).where("split = 'test'").count()
    assert set(plan._LANDED[spark.sparkContext.applicationId, folder]) == {False}
    # With a keyed copy there is no need for another.
    keyed = plan.purchases(spark, folder, refresh=True)
    assert queries._marked(spark, folder).columns == [*keyed.columns, "held_out"]
    assert set(plan._LANDED[spark.sparkContext.applicationId, folder]) == {True}


def test_pivot_lands_the_copy_without_the_key(spark, hot_folder, tmp_path):
    folder = _copy(spark, hot_folder, str(tmp_path / "copy"))
    slot = spark.sparkContext.applicationId, folder
    # The tables have no lines of the other two categories.
    wide = QUERIES["gender_category_pivot"](spark, folder).collect()
    assert set(plan._LANDED[slot]) == {False}
    counts = {(r["gender"], c): r[c] for r in wide for c in ("LARGE", "MEDIUM", "SMALL", "STANDARD") if r[c]}
    con = duckdb.connect()
    for table in ("nation", "customer", "orders", "part", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    assert counts == {(g, c): n for g, c, n in con.execute(ORACLES["gender_category_long"]).fetchall()}
    assert differences(QUERIES["cv_folds"](spark, folder), con, ORACLES["cv_folds"]) == []
    assert set(plan._LANDED[slot]) == {False, True}
