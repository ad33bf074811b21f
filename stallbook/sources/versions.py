"""Table loads that replace at once: write aside, check, then point the table at the new files.

Every load writes a folder of its own below the database's location. The table's definition only names the folder, so a
load that fails leaves the former rows in place, and whoever reads sees the former or the new rows, never none or a
mixture. Queries that were planned before the switch go on reading the former version, which is kept until the next load.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.functions.scalars import text_literal

ROWS_PER_FILE = 4_000_000
KEPT_VERSIONS = 1  # besides the current one


def _split_name(spark: SparkSession, table: str) -> tuple[str, str]:
    database, _, name = table.rpartition(".")
    return database or spark.catalog.currentDatabase(), name


def versions_root(spark: SparkSession, table: str) -> str:
    database, name = _split_name(spark, table)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}.versions"


def current_location(spark: SparkSession, table: str) -> str | None:
    """Folder that the table's definition names; None without a table."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0].data_type if rows else None


def _file_system(spark: SparkSession, path: str) -> tuple:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def stored_versions(spark: SparkSession, table: str) -> list[str]:
    """Folders of all versions of a table, newest first."""
    fs, root = _file_system(spark, versions_root(spark, table))
    found = [(s.getModificationTime(), s.getPath().toString()) for s in fs.listStatus(root)] if fs.exists(root) else []
    return [path for _, path in sorted(found, reverse=True)]


def drop_old_versions(spark: SparkSession, table: str, kept: int = KEPT_VERSIONS) -> int:
    """Delete all but the current version and the ``kept`` newest others; returns how many went."""
    current = current_location(spark, table)
    others = [v for v in stored_versions(spark, table) if current is None or v.rsplit("/", 1)[-1] != current.rstrip("/").rsplit("/", 1)[-1]]
    for path in others[kept:]:
        fs, folder = _file_system(spark, path)
        fs.delete(folder, True)
    return len(others[kept:])


def dealt_by_bucket(df: DataFrame, key: str, buckets: int, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``df`` with every bucket in tasks of its own: one, or as many as its rows need.

    The number of a bucket is the table format's own (the hash of the key modulo ``buckets``), so each task writes one
    file. A bucket that a hot key fills is spread by a hash of the whole row.
    """
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    rows = {r.bucket: r.n for r in df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()}
    pieces = [max(1, math.ceil(rows.get(b, 0) / rows_per_file)) for b in range(buckets)]
    first = [sum(pieces[:b]) for b in range(buckets)]

    def looked_up(numbers: list[int]) -> F.Column:
        return F.expr(f"from_json({text_literal(json.dumps(numbers))}, 'array<int>')")[bucket]

    spread = F.pmod(F.xxhash64(*df.columns), looked_up(pieces)) if max(pieces) > 1 else F.lit(0)
    return df.repartitionById(sum(pieces), (looked_up(first) + spread).cast("int"))


def same_definition(spark: SparkSession, one: str, other: str) -> bool:
    """Equal columns and buckets."""

    def told(table: str) -> list[tuple]:
        rows = spark.sql(f"DESCRIBE FORMATTED {table}").collect()
        names = ("Num Buckets", "Bucket Columns", "Sort Columns", "Provider")
        return [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema] + [(r.col_name, r.data_type) for r in rows if r.col_name in names]

    return told(one) == told(other)


def replace_table(
    df: DataFrame, table: str, buckets: int | None = None, key: str | None = None, check: Callable[[DataFrame], None] | None = None, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Replace a table's rows at once; a second run leaves the same result.

    ``check`` gets the rows as stored and may raise, which leaves the table as it was. A table with the same columns and buckets keeps its
    definition (comments, properties); another definition replaces it.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    database, name = _split_name(spark, table)
    location, aside = f"{versions_root(spark, table)}/{version}", f"{database}.{name}__{version}"
    bucketed = bool(buckets and key)
    writer = (dealt_by_bucket(df, key, buckets, rows_per_file) if bucketed else df).write.format("parquet").option("path", location).option("compression", "zstd")
    if bucketed:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    try:
        writer.saveAsTable(aside)
        if check is not None:
            check(spark.table(aside))
        _switch(spark, table, aside, location)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
        fs, folder = _file_system(spark, location)
        if current_location(spark, table) is None or not current_location(spark, table).rstrip("/").endswith(version):
            fs.delete(folder, True)
        raise
    drop_old_versions(spark, table)


def _switch(spark: SparkSession, table: str, aside: str, location: str) -> None:
    if spark.catalog.tableExists(table) and same_definition(spark, table, aside):
        spark.sql(f"ALTER TABLE {table} SET LOCATION {text_literal(location)}")
        spark.sql(f"DROP TABLE {aside}")  # the files stay, as the table names its own folder
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
    spark.catalog.refreshTable(table)
