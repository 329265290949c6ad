from __future__ import annotations

import duckdb
import pytest


@pytest.fixture
def given(spark, tmp_path):
    """Write rows as a named table; gives the frame and a DuckDB connection which sees it."""
    con = duckdb.connect()

    def write(name, rows, schema, partitions=3):
        path = str(tmp_path / f"{name}.parquet")
        spark.createDataFrame(rows, schema).repartition(partitions).write.parquet(path)
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/*.parquet'")
        return spark.read.parquet(path), con

    return write
