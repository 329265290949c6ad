"""Tables written to shared storage so that later stages start from files.

A landed table cuts lineage: an executor lost during model training costs a
re-read of a small table, not a rerun of the joins and scans behind it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or else of ``spark.sql.warehouse.dir``.

    Both are taken as shared by all machines where they were set to be: a ``file:``
    folder may be a network mount. Only Spark's own default warehouse, a folder of
    the driver's machine, is refused on a cluster.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    local = context.master.startswith("local[") or context.master == "local"
    if not warehouse or (not local and warehouse.startswith(("file:", "/"))):
        raise ValueError("set spark.checkpoint.dir to a folder which every executor can reach")
    return warehouse.rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/basketlens/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder which nothing has used before."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> bool:
    """Delete everything that this application has landed; whether there was anything.

    Tables which come from landed ones cannot be read afterwards.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def land(
    df: DataFrame, name: str, partition_by: tuple[str, ...] = (), compression: str | None = None
) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Column metadata (ML attributes) survives the round trip. Rows of each value of
    the ``partition_by`` columns lie in a folder of their own; these columns come last.
    ``compression`` is a codec of Parquet; without it the session's is used.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def write_tables(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """Save named result tables, one sub-folder each, in any Spark file format."""
    for name, table in tables.items():
        writer = table.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.save(f"{folder.rstrip('/')}/{name}")
