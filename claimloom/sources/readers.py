"""Scans. Every reader returns a lazy DataFrame; schemas are explicit where files carry none."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from claimloom.config.schemas import FORECAST_FILE
from claimloom.config.tables import TableSpec
from claimloom.sources.storage import list_files

CSV_TEXT = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}


def jdbc_options(
    spec: TableSpec,
    url: str,
    predicate: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    **options: str,
) -> dict[str, str]:
    """Options of a JDBC read: a pushed-down sub-select, split by column ranges if asked.

    A partition count alone would still read through one connection, so it needs column and bounds.
    """
    table = f"{spec.database}.{spec.name}" if spec.database else spec.name
    where = f" where {predicate}" if predicate else ""
    result = {"url": url, "dbtable": f"(select * from {table}{where}) source_rows", **options}
    if partitions > 1:
        if partition_column is None or bounds is None:
            raise ValueError(f"{spec.name}: a partitioned read needs a column and its bounds")
        result |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return result


def delta_predicate(spec: TableSpec, low: str, high: str | None = None) -> str:
    closed = f" and {spec.changed_at} <= '{high}'" if high else ""
    return f"{spec.changed_at} > '{low}'{closed}"


def read_table(spark: SparkSession, spec: TableSpec, url: str, predicate: str | None = None, **split) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(spec, url, predicate, **split)).load()


def read_csv_strings(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Quoted CSV with header and line breaks inside fields; every column is text.

    Folder names below the paths are not read as columns.

    Such a file cannot be split, so one file is one task: keep files small when writing them
    (``export_csv_by(rows_per_file=...)``).
    """
    options = {**CSV_TEXT, "recursiveFileLookup": True}
    return spark.read.options(**options).csv(paths, inferSchema=False)


def read_training(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Union of all CSV files of a folder, columns matched by name; no file is an error.

    The files are grouped by their first line, and each group is read in its own column order. Columns
    that a group lacks are null, further ones are left out.
    """
    if not list_files(spark, folder, ".csv"):
        raise ValueError(f"there are no csv files in {folder}")
    wanted = {f.name: f.dataType for f in StructType.fromDDL(schema)}
    groups = []
    for header, paths in headers(spark, folder).items():
        names = next(csv.reader([header]))
        own = StructType([StructField(n, wanted.get(n, StringType())) for n in names])
        rows = spark.read.schema(own).options(**CSV_TEXT).csv(paths)
        groups.append(rows.select(*[F.col(f"`{n}`") if n in names else F.lit(None).cast(t).alias(n) for n, t in wanted.items()]))
    return reduce(DataFrame.unionByName, groups)


def headers(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """First line of the CSV files of a folder -> the files that start with it.

    Lines keep their order within a task, and a file's first block is read by one.
    """
    lines = spark.read.option("pathGlobFilter", "*.csv").text(folder)
    lines = lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    lines = lines.where("block = 0").withColumn("place", F.monotonically_increasing_id())
    found: dict[str, list[str]] = {}
    for row in lines.groupBy("path").agg(F.min_by("value", "place").alias("header")).orderBy("path").collect():
        found.setdefault(row.header.lstrip("\ufeff"), []).append(row.path)
    return found


def read_forecasts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.schema(FORECAST_FILE).options(header=True, recursiveFileLookup=True).csv(paths)


def view_frame(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def warehouse_query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Run SQL over registered tables; frames may be passed by name (``{name}`` in the text)."""
    return spark.sql(sql, **tables)


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Nested documents, one JSON object per line; fields that are missing become null."""
    return spark.read.schema(schema).json(path)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def parse_runs(files: DataFrame, path: str = "path", text: str = "value") -> DataFrame:
    """Long table of tracked runs from ``(path, text)`` rows.

    Paths end in ``<experiment>/<run>/<kind>/<name>`` with kind ``metrics``, ``params`` or ``tags``.
    A metric line is ``<epoch ms> <value> <step>``, one per line; other files hold their value.
    """
    parts = F.split(F.col(path), "/")
    size = F.size(parts)
    named = files.select(
        *[F.try_element_at(parts, size - i).alias(n) for n, i in (("experiment", 3), ("run", 2), ("kind", 1))],
        F.element_at(parts, -1).alias("name"),
        F.col(text).alias("text"),
    ).filter(F.col("kind").isin("metrics", "params", "tags"))
    is_metric = F.col("kind") == "metrics"
    lines = F.when(is_metric, F.filter(F.split(F.trim("text"), r"\n"), lambda line: line != "")).otherwise(
        F.array("text")
    )
    fields = F.split("line", " ")
    return named.withColumn("line", F.explode(lines)).select(
        "experiment",
        "run",
        "kind",
        "name",
        F.when(is_metric, F.get(fields, F.lit(1))).otherwise(F.col("line")).alias("value"),
        F.when(is_metric, F.timestamp_millis(F.get(fields, F.lit(0)).try_cast("bigint"))).alias("ts"),
        F.when(is_metric, F.get(fields, F.lit(2)).try_cast("bigint")).alias("step"),
    )


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """Tracked-run folder as a long table; each small file is one row of text.

    Names may hold any character: file paths come URL-encoded and are decoded part by part.
    Spark leaves out files without any byte.
    """
    files = spark.read.options(recursiveFileLookup=True, wholetext=True).text(root)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return parse_runs(files.select(path.alias("path"), "value"))
