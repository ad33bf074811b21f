"""Records of CSV files with line breaks inside quotes, read by many tasks.

A quoted field writes a quote inside it twice, so a line starts a record exactly if the number of quotes before it in its file is
even. Lines are read in blocks as plain text, which Spark can split. Inside a block quotes are counted from the block's
start on, which is right or wrong for all its lines alike; the parity of the blocks before it tells which. The same sums
number the records of a file. Only lines that are part of a longer record are grouped; a record that runs on into the next
block has one number there as well, so it is put together whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.operators.materialize import materialize

BLOCK = ["_file", "_start"]


def numbered_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(_file, _start, _line, value, _odd, _row, _even_before)``: every line with its place in its block.

    ``_even_before`` counts the lines of the block up to this one with an even number of quotes of the block before them.
    """
    # Only line feeds end a line, so that a carriage return inside quotes is kept.
    lines = spark.read.options(lineSep="\n").text(paths).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_line"), "value"
    )
    counted = lines.withColumn("_odd", F.expr("CAST((length(value) - length(replace(value, '\"'))) % 2 AS INT)"))
    order = f"PARTITION BY {', '.join(BLOCK)} ORDER BY _line"
    placed = counted.selectExpr("*", f"row_number() OVER ({order}) AS _row", f"coalesce(sum(_odd) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 AS _inside")
    return placed.selectExpr("*", f"count_if(_inside = 0) OVER ({order} ROWS UNBOUNDED PRECEDING) AS _even_before")


def block_starts(lines: DataFrame) -> DataFrame:
    """Per block: whether it starts inside quotes, and how many records start before it in its file."""
    blocks = lines.groupBy(*BLOCK).agg(F.expr("sum(_odd) % 2 AS odd"), F.expr("count(1) AS n"), F.expr("count_if(_inside = 0) AS even"))
    before = "OVER (PARTITION BY _file ORDER BY _start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    blocks = blocks.selectExpr("*", f"coalesce(sum(odd) {before}, 0) % 2 AS _turned")
    blocks = blocks.selectExpr("*", "CASE WHEN _turned = 0 THEN even ELSE n - even END AS starts")
    return blocks.selectExpr(*BLOCK, "_turned", f"coalesce(sum(starts) {before}, 0) AS _records")


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(_file, _record, _text)``: every record of the files, numbered from 1 within its file (the header)."""
    lines = materialize(numbered_lines(spark, paths), "lines")
    known = lines.join(block_starts(lines), BLOCK)
    known = known.selectExpr(
        "_file", "_start", "_line", "value", "_odd", "_inside <> _turned AS _runs_on",
        "_records + CASE WHEN _turned = 0 THEN _even_before ELSE _row - _even_before END AS _record",
    )
    single = known.where("NOT _runs_on AND _odd = 0").selectExpr("_file", "_record", "value AS _text")
    parts = known.where("_runs_on OR _odd = 1").groupBy("_file", "_record")
    whole = parts.agg(F.expr("array_join(transform(sort_array(collect_list(struct(_start, _line, value))), l -> l.value), '\n') AS _text"))
    return single.unionByName(whole)
