"""CSV purchases: read by header name, every cell as text, coerced later."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.schema import PurchaseColumns

# Charsets which Spark's CSV reader takes without the legacy flag.
CSV_CHARSETS = (
    "ISO-8859-1",
    "US-ASCII",
    "UTF-8",
    "UTF-16",
    "UTF-16BE",
    "UTF-16LE",
    "UTF-32",
)
LEGACY_CHARSETS = "spark.sql.legacy.javaCharsets"


def read_purchases(
    spark: SparkSession,
    path: str | list[str],
    columns: PurchaseColumns = PurchaseColumns(),
    keep: tuple[str, ...] = (),
    encoding: str = "UTF-8",
    **options: str,
) -> DataFrame:
    """The six purchase columns, and those in ``keep``, as text.

    Types are not inferred: that would read the file twice, and a single bad
    cell would turn a numeric column into text. Only the header line is looked
    at here; ``clean.parse`` does the typing. Spark takes the names from one file
    and the others by position, so reading a file whose header differs where
    columns are used fails with a message which names it: ``read_mixed_purchases``
    takes such folders.
    """
    _check_charset(spark, encoding)
    table = (
        spark.read.options(**options)
        .option("header", True)
        .option("encoding", encoding)
        .option("enforceSchema", False)
        .csv(path)
    )
    named = [F.col(f"`{source}`").alias(ours) for ours, source in columns.items()]
    return table.select(*keep, *named)


CORRUPT = "corrupt_line"


def read_mixed_purchases(
    spark: SparkSession,
    path: str,
    columns: PurchaseColumns = PurchaseColumns(),
    keep: tuple[str, ...] = (),
    encoding: str = "UTF-8",
    parallelism: int = 16,
    **options: str,
) -> DataFrame:
    """The purchase columns, as text, of a folder whose files differ in their columns.

    Every file has a header of its own, which is read by a small job; files with the
    same header are read together, and the groups are put together by name. Columns
    that are not asked for may be there or not. A line with more or fewer cells than
    its header keeps no cell but is kept itself in ``corrupt_line``, so that cleaning
    counts it as a row without values; ``corrupt_counts`` counts them by file. A file
    without any line has no rows; one without a column that is asked for is an error.
    """
    _check_charset(spark, encoding)
    reader = {**options, "header": "true", "encoding": encoding}
    listed = spark.read.format("binaryFile").load(path).select("path").collect()

    @inheritable_thread_target(spark)
    def header(file: str) -> tuple[str, ...]:
        return tuple(spark.read.options(**reader).csv(file).columns)

    files = sorted(r["path"] for r in listed)
    with ThreadPool(parallelism) as pool:
        headers = pool.map(header, files)
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, names in zip(files, headers):
        if names:
            groups.setdefault(names, []).append(file)
    wanted = [*keep, *[source for _, source in columns.items()]]
    tables = []
    for names, same in groups.items():
        lacking = [c for c in wanted if c not in names]
        if lacking:
            raise ValueError(f"{same[0]} has no column {', '.join(lacking)}")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT)])
        # Where cells that no one asks for are not read, lines with more cells pass for whole ones.
        rows = (
            spark.read.options(**reader).schema(schema).option("columnPruning", "false")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(same)
        )
        whole = F.col(CORRUPT).isNull()
        tables.append(rows.select(
            *[F.when(whole, F.col(f"`{k}`")).alias(k) for k in keep],
            *[F.when(whole, F.col(f"`{source}`")).alias(ours) for ours, source in columns.items()],
            CORRUPT, F.col("_metadata.file_path").alias("file"),
        ))
    if not tables:
        names = [*keep, *[ours for ours, _ in columns.items()], CORRUPT, "file"]
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return reduce(DataFrame.unionByName, tables)


def corrupt_counts(rows: DataFrame) -> DataFrame:
    """(file, n_lines, n_corrupt) of the files that ``read_mixed_purchases`` found lines in."""
    # Spark's reader wants a column besides the corrupt line to be read.
    filled = F.coalesce(*[c for c in rows.columns if c not in (CORRUPT, "file")]).isNotNull()
    return rows.groupBy("file").agg(
        (F.count_if(filled) + F.count_if(~filled)).alias("n_lines"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("n_corrupt"),
    )


def _check_charset(spark: SparkSession, encoding: str) -> None:
    if encoding.upper() not in CSV_CHARSETS and not _legacy_charsets(spark):
        raise ValueError(
            f"Spark's CSV reader does not take {encoding!r}: convert the file to UTF-8, or set "
            f"{LEGACY_CHARSETS}=true and leave it on until the data has been read"
        )


def _legacy_charsets(spark: SparkSession) -> bool:
    return str(spark.conf.get(LEGACY_CHARSETS, "false")).lower() == "true"
