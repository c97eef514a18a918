"""Catalog tables, partition replacement and exports."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from featuremart.sources.storage import shuffles_released

# the folder name of a null partition
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def load(spark: SparkSession, name: str, rename: Mapping[str, str] | None = None) -> DataFrame:
    """A catalog table, optionally with columns renamed ``{theirs: ours}``."""
    df = spark.table(name)
    return df.withColumnsRenamed(dict(rename)) if rename else df


def load_path(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """Files of a columnar format; give the schema to skip the footer lookup."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def small_table(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str] | str) -> DataFrame:
    """A dictionary or calendar table from literals; ``columns`` may be a DDL string."""
    return spark.createDataFrame(rows, columns)


def row_numbers(spark: SparkSession, n: int, name: str = "id") -> DataFrame:
    """The numbers ``0 … n-1`` as rows."""
    return spark.range(n).withColumnRenamed("id", name)


def ensure_db(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the namespace unless it exists; ``location`` is where its tables go."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def _sized(df: DataFrame, files: int | None) -> DataFrame:
    # without a fixed count, adaptive execution sizes the output files
    return df.hint("rebalance") if files is None else df.repartition(files)


def write_table(
    df: DataFrame,
    name: str,
    *,
    files: int | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "orc",
    path: str | None = None,
) -> None:
    """Overwrite a catalog table.

    Partitioned output is rebalanced by the partition columns first, so that a
    task writes few partitions and a large partition is still split.
    """
    if files is None and partition_by:
        sized = df.hint("rebalance", *[F.col(c) for c in partition_by])
    else:
        sized = _sized(df, files)
    writer = sized.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def partition_values(spark: SparkSession, name: str, col: str) -> list:
    """The partitions that the catalog lists for ``col``, in order; reads no file."""
    listed = spark.sql(f"SHOW PARTITIONS {name}").collect()
    pairs = [dict(part.split("=", 1) for part in row[0].split("/")) for row in listed]
    return sorted({unquote(pair[col]) for pair in pairs})


def _sql_literal(value) -> str:
    if value is None:
        return "null"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _repeated(df: DataFrame, keys: Sequence[str], known: Sequence[str]) -> int:
    """How many rows repeat the keys of an earlier one; those with a null in ``known`` don't count. Reads the keys alone."""
    rows = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in known])).groupBy(*keys).count()
    return rows.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0))).first()[0]


def replace_partition(
    df: DataFrame, name: str, col: str, *, fmt: str = "orc", path: str | None = None, unique: Sequence[str] = (), sized: bool = False
) -> list[str]:
    """Replace only the partitions present in ``df``; a rerun leaves the same table.

    The rows are written to a fresh folder first. Only then are the partitions
    switched to it in the catalog, one statement each, so a write that fails
    leaves every old partition as it was, no session setting that bears on results is
    touched, and a reader sees a partition's old files or its new ones. Shuffle files go
    as soon as the rows are written. A null and the empty text are one partition. With
    ``sized`` each task writes its rows as they come, which suits rows of one partition; else
    they are dealt by partition first. With ``unique``, rows that repeat a key are refused; they are
    looked for in the key columns of the staged files, so that no wide row moves for it.
    Returns the folders that are no longer in use; they may be deleted once no
    reader that started before is left. The partitions are to be read by the
    table's name, not by its folder.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        write_table(df.where("false"), name, partition_by=[col], fmt=fmt, path=path)
    table = spark.table(name)
    # the files hold the table's other columns, in its order and types
    ordered = df.select(*[F.col(f.name).cast(f.dataType) for f in table.schema.fields])
    staged = f"{table_location(spark, name).rstrip('/')}/_run-{uuid.uuid4().hex}"
    with shuffles_released(spark):
        dealt = ordered if sized else ordered.hint("rebalance", F.col(col))
        dealt.write.format(fmt).partitionBy(col).save(staged)
        repeated = _repeated(spark.read.format(fmt).schema(table.schema).load(staged), [col, *unique], unique) if unique else 0
    if repeated:
        raise ValueError(f"{repeated} rows of {name} repeat their {list(unique)}; the table was not changed")
    known, unused = set(partition_values(spark, name, col)), []
    # folders of the run, from its file names: no job, and bounded by the files written
    folders = {f.rsplit("/", 1)[0] for f in spark.read.format(fmt).load(staged).inputFiles()}
    for folder in sorted(folders):
        value = unquote(unquote(folder.rsplit(f"/{col}=", 1)[1]))
        literal = _sql_literal(None if value == _NO_VALUE else value)
        part = f"PARTITION (`{col}` = {literal})"
        if value in known:
            facts = spark.sql(f"DESCRIBE FORMATTED {name} {part}").where("col_name = 'Location'").first()
            unused.append(facts["data_type"])
            spark.sql(f"ALTER TABLE {name} {part} SET LOCATION {_sql_literal(unquote(folder))}")
        else:
            spark.sql(f"ALTER TABLE {name} ADD {part} LOCATION {_sql_literal(unquote(folder))}")
    spark.catalog.refreshTable(name)
    return unused


def replace_partition_path(df: DataFrame, path: str, col: str, *, fmt: str = "parquet") -> None:
    """The same on a folder instead of a catalog table."""
    (
        df.hint("rebalance", F.col(col))
        .write.mode("overwrite")
        .format(fmt)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(col)
        .save(path)
    )


def export_parquet(df: DataFrame, path: str, *, files: int | None = None) -> None:
    """Parquet with zstd compression, one file per full-sized partition."""
    sized = _sized(df, files)
    sized.write.mode("overwrite").option("compression", "zstd").parquet(path)


def table_location(spark: SparkSession, name: str) -> str:
    """Where a catalog table keeps its files."""
    facts = spark.sql(f"DESCRIBE FORMATTED {name}")
    return facts.where(F.col("col_name") == "Location").first()["data_type"]


def refresh(spark: SparkSession, name: str) -> DataFrame:
    """The table after dropping cached file listings."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def fetch_small(df: DataFrame, max_rows: int = 10_000):
    """A report-sized result as pandas; a larger one raises instead of filling the driver."""
    rows = df.limit(max_rows + 1).toPandas()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows: write the result to a table instead")
    return rows
