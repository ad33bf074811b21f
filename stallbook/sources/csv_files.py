"""Raw CSV files: locate, read, clean to staging types, and export."""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.functions.scalars import pad_zip, text_literal, to_int, to_ts
from stallbook.operators.materialize import materialize, observed
from stallbook.schemas import STAGING
from stallbook.sources.csv_records import records

# Source file names (after any publisher prefix) in load order.
FILES: dict[str, str] = {
    "orders": "orders_dataset.csv",
    "customers": "customers_dataset.csv",
    "order_items": "order_items_dataset.csv",
    "payments": "order_payments_dataset.csv",
    "reviews": "order_reviews_dataset.csv",
    "products": "products_dataset.csv",
    "sellers": "sellers_dataset.csv",
    "geolocation": "geolocation_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
}

# Header names in the files that differ from the staging names.
RENAMES: dict[str, str] = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
    "geolocation_zip_code_prefix": "zip_code_prefix",
    "geolocation_lat": "lat",
    "geolocation_lng": "lng",
    "geolocation_city": "city",
    "geolocation_state": "state",
}

# Only these hold quoted text with line breaks, which Spark's reader cannot split between tasks.
FREE_TEXT = {"reviews"}

# Columns in which a value that is no whole number becomes NULL; dates do so as well.
COERCED = ("product_name_length", "product_description_length", "product_photos_qty")

# Text that stands for a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
    "None", "n/a", "nan", "null",
)

BROKEN_ROW = "_broken_row"


class LoadError(RuntimeError):
    """Raised once, after every table was tried, with all the problems found; ``frames`` has the tables without any."""

    def __init__(self, message: str, frames: dict[str, DataFrame] | None = None):
        super().__init__(message)
        self.frames = frames or {}


def locate(spark: SparkSession, folder: str, table: str) -> list[str]:
    """Paths of all of a table's files (or folders of part files), with or without a publisher prefix."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = set()
    for pattern in (FILES[table], f"*_{FILES[table]}"):
        path = hadoop.Path(f"{folder.rstrip('/')}/{pattern}")
        hits = path.getFileSystem(conf).globStatus(path)
        names = [str(h.getPath()) for h in (hits or [])]
        # "*_orders_dataset.csv" style patterns can only clash through longer table names.
        found |= {n for n in names if _table_of(n.rsplit("/", 1)[-1]) == table}
    return sorted(found)


def _table_of(file_name: str) -> str | None:
    fits = [(len(suffix), t) for t, suffix in FILES.items() if file_name == suffix or file_name.endswith("_" + suffix)]
    return max(fits)[1] if fits else None


def header_index(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(file, size, header)``: the first line of every file below the paths, by one job.

    A session of its own makes every file one partition, and every partition stops after one row, so that a
    file costs one short task. Files without any line are left out, and those that share a partition with
    another one where a platform fixes the size of partitions.
    """
    session = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        session.conf.set(key, str(1 << 40))
    lines = session.read.options(lineSep="\n").text(paths)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("value").alias("header"), F.col("_metadata.file_block_start").alias("start"))
    return first_of_each_partition(lines).where("start = 0").drop("start")


def first_of_each_partition(df: DataFrame) -> DataFrame:
    """One row of every partition, read no further: the partition's half of LIMIT, for which DataFrames have no method."""
    # LIMIT is a limit of every partition below one of the whole; the plan below it is taken.
    session = df.sparkSession
    per_partition = df.limit(1)._jdf.logicalPlan().child()
    return DataFrame(session._jvm.org.apache.spark.sql.classic.Dataset.ofRows(session._jsparkSession, per_partition), session)


def header_names(line: str) -> list[str]:
    """Column names in a header line; nameless columns are counted."""
    names = next(csv.reader([line.lstrip("\ufeff").rstrip("\r")]), [])
    return [name or f"_c{i}" for i, name in enumerate(names)]


def files_by_header(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[tuple[str, int]]]:
    """Paths and sizes of the files below ``paths``, grouped by the column names of their own headers."""
    groups: dict[tuple[str, ...], list[tuple[str, int]]] = {}
    pending = {plain_path(file) for file in spark.read.text(paths).inputFiles()}
    while pending:
        found = {plain_path(row.file): row for row in header_index(spark, paths).collect()}
        for file, row in found.items():
            groups.setdefault(tuple(header_names(row.header)), []).append((file, row.size))
        if not pending & set(found):
            break  # what is left has no line
        pending -= set(found)
        paths = sorted(pending)
    return {names: sorted(files) for names, files in sorted(groups.items())}


def plain_path(file: str) -> str:
    """A file's name as Spark gives it out: without escapes, and with one slash after a scheme that has no host."""
    return re.sub(r"^([\w+.-]+):///", r"\1:/", unquote(file))


def read_raw(spark: SparkSession, paths: list[str], table: str) -> DataFrame:
    """All columns of all files as text under their staging names, and ``_broken_row`` where a row does not fit its header.

    Every file, also every part file of a folder, is read by its own header, so files may order their columns differently. Files
    with the same header are one scan. Of tables with free text, files larger than a partition are
    read record by record (``csv_records``), so that many tasks share them.
    """
    options = {"header": True, "escape": '"', "quote": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN_ROW}
    split_bytes = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    frames = []
    for names, files in files_by_header(spark, paths).items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, BROKEN_ROW]])
        large = [file for file, size in files if table in FREE_TEXT and size > split_bytes]
        small = [file for file, size in files if file not in set(large)]
        if small:
            # The header of each file is compared with the schema once more as it is read.
            reader = spark.read.options(**options, multiLine=table in FREE_TEXT, enforceSchema=False)
            frames.append(reader.schema(schema).csv(small))
        if large:
            frames.append(parsed_records(records(spark, large), schema, options))
    if not frames:
        raise LoadError(f"{table}: no header in {', '.join(paths)}")
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [f.withColumnsRenamed(RENAMES) for f in frames])


def parsed_records(found: DataFrame, schema: T.StructType, options: dict) -> DataFrame:
    """Columns of the records but the header; blank records are none."""
    text = F.regexp_replace("_text", "\r$", "")
    rows = found.where("_record > 1").select(text.alias("_text")).where("trim(_text) <> ''")
    return rows.select(F.from_csv("_text", schema.simpleString(), {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}).alias("row")).select("row.*")


def _text(name: str) -> str:
    missing = ", ".join(text_literal(m) for m in MISSING)
    return f"CASE WHEN `{name}` NOT IN ({missing}) THEN `{name}` END"


def _convert(name: str, dtype: T.DataType) -> str:
    text = _text(name)
    if name.endswith("zip_code_prefix"):
        return pad_zip(text)
    if isinstance(dtype, T.IntegerType):
        return to_int(text)
    if isinstance(dtype, T.TimestampNTZType):
        return to_ts(text)
    return f"try_cast({text} AS {dtype.simpleString()})"


def require_columns(raw: DataFrame, table: str) -> T.StructType:
    """The staging schema; an error if a column is in no file."""
    schema = T.StructType.fromDDL(STAGING[table])
    missing = [f.name for f in schema if f.name not in raw.columns]
    if missing:
        raise LoadError(f"{table}: columns not found: {', '.join(missing)}")
    return schema


def to_staging(raw: DataFrame, table: str) -> DataFrame:
    """Typed staging columns; what ``lost_values`` counts as lost is NULL here."""
    schema = require_columns(raw, table)
    return raw.selectExpr(*[f"{_convert(f.name, f.dataType)} AS {f.name}" for f in schema])


def loss_counts(table: str, broken: bool) -> dict[str, str]:
    """Aggregates by column: values that do not fit their type, and under ``_broken_row`` rows that do not fit their file's header."""
    fields = T.StructType.fromDDL(STAGING[table]).fields
    counts = {f.name: f"count_if(({_text(f.name)}) IS NOT NULL AND ({_convert(f.name, f.dataType)}) IS NULL)" for f in fields}
    return {**counts, BROKEN_ROW: broken_count(broken)}


def broken_count(broken: bool) -> str:
    return f"count_if({BROKEN_ROW} IS NOT NULL)" if broken else "0L"


def accepted_losses(table: str) -> list[str]:
    """Columns in which a value that does not fit becomes NULL: the coerced ones and dates."""
    return [f.name for f in T.StructType.fromDDL(STAGING[table]) if f.name in COERCED or isinstance(f.dataType, T.TimestampNTZType)]


def lost_values(raw: DataFrame, table: str) -> DataFrame:
    """``(table_name, column_name, lost, accepted)`` of ``loss_counts``, by a pass of its own."""
    counts = loss_counts(table, BROKEN_ROW in raw.columns)
    # Every column is named, so that the reader parses whole rows and sees the broken ones.
    counted = raw.selectExpr(*[f"{text} AS {name}" for name, text in counts.items()])
    lenient = accepted_losses(table)
    accepted = f"column_name IN ({', '.join(text_literal(n) for n in lenient)})" if lenient else "false"
    long = counted.unpivot([], list(counts), "column_name", "lost")
    return long.selectExpr(f"'{table}' AS table_name", "column_name", "lost", f"{accepted} AS accepted")


class StagingLoad(NamedTuple):
    """Stored tables without a problem, the problems of the others, and per table what the pass that stored it counted."""

    frames: dict[str, DataFrame]
    problems: list[str]
    counts: dict[str, dict[str, int]]


def store_staging(raw: DataFrame, table: str, rules: Mapping[str, str] | None = None) -> tuple[DataFrame, dict[str, int], dict[str, int]]:
    """The typed table written once, with its losses per column and the aggregates ``rules`` as counted by that very pass.

    The counts belong to the stage that writes, where a task that runs again counts once.
    """
    fields = require_columns(raw, table).fields
    broken = BROKEN_ROW in raw.columns
    # Every value is converted once, beside its text: where nothing came out, the text tells whether something was lost.
    texts = [*(f"`{f.name}`" for f in fields), *([BROKEN_ROW] if broken else [])]
    both = raw.selectExpr(*texts, *[f"{_convert(f.name, f.dataType)} AS _typed_{f.name}" for f in fields])
    losses = {f.name: f"count_if(_typed_{f.name} IS NULL AND ({_text(f.name)}) IS NOT NULL)" for f in fields}
    watched, lost = observed(both, {**losses, BROKEN_ROW: broken_count(broken)}, f"losses of {table}")
    typed, counted = observed(watched.selectExpr(*[f"_typed_{f.name} AS {f.name}" for f in fields]), rules or {}, f"rules of {table}")
    stored = materialize(typed, f"staging-{table}")
    return stored, lost(), counted()


def load_staging(spark: SparkSession, folder: str, tables: list[str] | None = None, rules: Mapping[str, Mapping[str, str]] | None = None) -> StagingLoad:
    """Store the staging tables, each in one pass over its files that also counts.

    A missing file or column, a row that does not fit its header or a value that does not fit its
    type keeps a table out; the others are loaded all the same.
    """
    load = StagingLoad({}, [], {})
    for table in tables or list(FILES):
        paths = locate(spark, folder, table)
        if not paths:
            load.problems.append(f"{table}: no file matching {FILES[table]} in {folder}")
            continue
        try:
            frame, lost, counted = store_staging(read_raw(spark, paths, table), table, (rules or {}).get(table))
        except LoadError as problem:
            load.problems.append(str(problem))
            continue
        load.counts[table] = {**counted, **{f"lost {name}": n for name, n in lost.items() if n}}
        bad = {name: n for name, n in lost.items() if n and name not in accepted_losses(table)}
        if bad:
            load.problems.append(f"{table}: " + ", ".join(f"{n} bad rows" if name == BROKEN_ROW else f"{n} bad values of {name}" for name, n in bad.items()))
        else:
            load.frames[table] = frame
    return load


def scan_staging(spark: SparkSession, folder: str, tables: list[str] | None = None, check: bool = True) -> tuple[dict[str, DataFrame], list[str]]:
    """Staging tables without a problem, and the problems of the others.

    With ``check`` the tables are those of ``load_staging``; without it they read the files, whose values are not looked at before.
    """
    if check:
        load = load_staging(spark, folder, tables)
        return load.frames, load.problems
    frames: dict[str, DataFrame] = {}
    problems: list[str] = []
    for table in tables or list(FILES):
        paths = locate(spark, folder, table)
        try:
            if not paths:
                raise LoadError(f"{table}: no file matching {FILES[table]} in {folder}")
            frames[table] = to_staging(read_raw(spark, paths, table), table)
        except LoadError as problem:
            problems.append(str(problem))
    return frames, problems


def read_staging(spark: SparkSession, folder: str, tables: list[str] | None = None, check: bool = True) -> dict[str, DataFrame]:
    """Every staging table; problems are reported together, with the tables that have none."""
    frames, problems = scan_staging(spark, folder, tables, check)
    if problems:
        raise LoadError("; ".join(problems), frames)
    return frames


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, one part file per task; fractions of seconds and outer blanks are kept."""
    options = {"header": True, "escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(**options).csv(path)
