"""Reuse stored results for as long as their sources stand.

A result is known by a name, its parameters and the version of its sources: paths, sizes and times of all files
that its input frames read. A changed, added or removed file changes the version, and the result is made
again on next use.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_KNOWN: dict[tuple[str, str], tuple[tuple, Any]] = {}


def source_version(spark: SparkSession, frames: Iterable[DataFrame]) -> tuple[int, ...]:
    """Number of files below the frames and a hash of their paths, sizes and times; listed by Spark, not read."""
    files = sorted({unquote(file) for frame in frames for file in frame.inputFiles()})
    if not files:
        return (0,)
    listed = spark.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
    row = listed.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")), F.bit_xor(F.xxhash64(F.lit(1), "path", "length", "modificationTime"))).first()
    return tuple(row)


def remembered(spark: SparkSession, name: str, sources: Iterable[DataFrame], params: object, build: Callable[[], Any]) -> Any:
    """What ``build`` returned when it last ran on these sources with these parameters in this application, or else what it returns now."""
    key = (spark.sparkContext.applicationId, name)
    version = (source_version(spark, sources), repr(params))
    if key not in _KNOWN or _KNOWN[key][0] != version:
        _KNOWN[key] = (version, build())
    return _KNOWN[key][1]


def forget(spark: SparkSession) -> None:
    """Drop all of this application's results, as after ``clear_scratch``, which deletes their files."""
    for key in [k for k in _KNOWN if k[0] == spark.sparkContext.applicationId]:
        del _KNOWN[key]
