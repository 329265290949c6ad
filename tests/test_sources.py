from __future__ import annotations

import pytest

from basketlens.operators import clean, features
from basketlens.schema import CHINESE_COLUMNS
from basketlens.sources import csv, landing
from basketlens.sources.csv import LEGACY_CHARSETS, read_purchases

HEADER = "编号,单价,年龄,性别,是否会员,商品大类,收货省份"
LINES = ["1,9.5,30,女,是,书,浙江", "2,abc,41,男,否,食品,广东", "3,7,,女,否,书,浙江"]


@pytest.fixture
def chinese_file(tmp_path):
    def write(encoding):
        path = tmp_path / f"{encoding}.csv"
        path.write_bytes("\n".join([HEADER, *LINES]).encode(encoding))
        return str(path)

    return write


def test_columns_are_matched_by_header_name(spark, chinese_file):
    df = read_purchases(spark, chinese_file("utf-8"), CHINESE_COLUMNS, keep=("编号",))
    assert {t for _, t in df.dtypes} == {"string"}
    rows = clean.clean(df, keep=("编号",)).collect()
    assert [(r["编号"], r.gender, r.age, r.unit_price) for r in rows] == [("1", "女", 30, 9.5)]
    counts = clean.clean_counts(df).first()
    assert (counts.rows_in, counts.missing_age, counts.invalid_unit_price) == (3, 1, 1)


def test_other_charsets_need_the_legacy_flag(spark, chinese_file):
    path = chinese_file("gb18030")
    with pytest.raises(ValueError, match="UTF-8.*javaCharsets"):
        read_purchases(spark, path, CHINESE_COLUMNS, encoding="gb18030")
    spark.conf.set(LEGACY_CHARSETS, "true")
    try:
        df = read_purchases(spark, path, CHINESE_COLUMNS, encoding="gb18030")
        assert clean.clean(df).first().province == "浙江"
    finally:
        spark.conf.unset(LEGACY_CHARSETS)


def test_only_needed_columns_are_read(spark, chinese_file):
    df = read_purchases(spark, chinese_file("utf-8"), CHINESE_COLUMNS).groupBy("gender").count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<性别:string>" in plan


def test_files_with_other_column_order_are_not_misread(spark, tmp_path):
    head = "性别,年龄,是否会员,商品大类,收货省份,单价"
    (tmp_path / "a.csv").write_text(f"{head}\n女,30,是,food,浙江,1.5\n", "utf-8")
    other = "性别,年龄,是否会员,收货省份,商品大类,单价"
    (tmp_path / "b.csv").write_text(f"{other}\n男,31,否,广东,toys,2.5\n", "utf-8")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_purchases(spark, str(tmp_path), CHINESE_COLUMNS).select("category").collect()
    one = [read_purchases(spark, str(tmp_path / f), CHINESE_COLUMNS) for f in ("a.csv", "b.csv")]
    rows = one[0].unionByName(one[1]).collect()
    assert {(r.category, r.province) for r in rows} == {("food", "浙江"), ("toys", "广东")}


def test_landed_tables_go_to_the_configured_folder(spark, planted):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert landing.shared_folder(spark) == folder
    back = landing.land(planted, "copy")
    assert back.count() == planted.count()
    assert all(folder in f for f in back.inputFiles())
    first, second = landing.new_path(spark, "a"), landing.new_path(spark, "a")
    assert first != second


def test_clear_deletes_only_what_this_application_landed(spark, monkeypatch, tmp_path):
    (tmp_path / "other").mkdir()
    monkeypatch.setattr(landing, "shared_folder", lambda spark: str(tmp_path))
    landing.land(spark.range(3), "t")
    assert landing.clear(spark)
    assert [p.name for p in (tmp_path / "basketlens").iterdir()] == []
    assert (tmp_path / "other").exists() and not landing.clear(spark)


def test_landed_tables_keep_column_metadata(planted):
    model = features.fit_features(planted)
    indexed = model.indexers[0].transform(planted)
    back = landing.land(indexed, "indexed")
    assert back.schema["gender_index"].metadata == indexed.schema["gender_index"].metadata


class Session:
    """Stands in for a session on a cluster without a shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"
        applicationId = "app"

        @staticmethod
        def getCheckpointDir():
            return None


@pytest.mark.parametrize("warehouse", [None, "file:/home/me/spark-warehouse"])
def test_no_machine_local_folder_on_a_cluster(monkeypatch, warehouse):
    def get(key, default=None):
        return warehouse if key == "spark.sql.warehouse.dir" and warehouse else default

    monkeypatch.setattr(Session.conf, "get", staticmethod(get))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        landing.shared_folder(Session)


def test_shared_warehouse_is_used_when_no_checkpoint_folder_is_set(monkeypatch):
    def get(key, default=None):
        return "hdfs://names/warehouse/" if key == "spark.sql.warehouse.dir" else default

    monkeypatch.setattr(Session.conf, "get", staticmethod(get))
    assert landing.shared_folder(Session) == "hdfs://names/warehouse"


def test_files_of_other_orders_and_broken_lines(spark, tmp_path):
    files = {
        "a.csv": "gender,age,is_member,category,province,unit_price,id\nf,20,yes,food,P1,1.5,1\nm,30,no,toys,P2,2.5,2\n",
        "b.csv": 'id,note,unit_price,province,category,is_member,age,gender\n3,"x, y",3.5,P3,books,no,40,f\n',
        "c.csv": "gender,age,is_member,category,province,unit_price,id\nf,20\nf,20,yes,food,P1,1.5,4,more\nm,9,no,toys,P2,4.5,5\n",
        "empty.csv": "",
        "header.csv": "age,gender,is_member,category,province,unit_price,id\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    rows = csv.read_mixed_purchases(spark, str(tmp_path), keep=("id",))
    good = {(r.id, r.gender, r.age, r.unit_price) for r in rows.collect() if r.corrupt_line is None}
    assert good == {("1", "f", "20", "1.5"), ("2", "m", "30", "2.5"), ("3", "f", "40", "3.5"), ("5", "m", "9", "4.5")}
    bad = [r for r in rows.collect() if r.corrupt_line is not None]
    assert sorted(r.corrupt_line for r in bad) == ["f,20", "f,20,yes,food,P1,1.5,4,more"]
    assert all(r.id is None and r.gender is None for r in bad)
    counts = {r.file.rsplit("/", 1)[1]: (r.n_lines, r.n_corrupt) for r in csv.corrupt_counts(rows).collect()}
    assert counts == {"a.csv": (2, 0), "b.csv": (1, 0), "c.csv": (3, 2)}
    assert clean.clean(rows, keep=("id",)).count() == 4
    assert clean.clean_counts(rows).first().rows_in == 6


def test_a_file_without_a_column_is_an_error_and_no_files_are_no_rows(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert csv.read_mixed_purchases(spark, str(tmp_path)).count() == 0
    (tmp_path / "a.csv").write_text("gender,age\nf,1\n")
    with pytest.raises(ValueError, match="a.csv has no column is_member"):
        csv.read_mixed_purchases(spark, str(tmp_path))
