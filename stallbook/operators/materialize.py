"""Write an intermediate table once, to storage every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stallbook.operators.remembered import forget

_LOCAL_ROOTS: dict[str, str] = {}
_WRITTEN: dict[str, list[str]] = {}


def _application(spark: SparkSession) -> str:
    return spark.sparkContext.applicationId


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only in local mode, where one process does everything, a temp folder stands in for it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = _application(spark)
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="stallbook-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark).rstrip('/')}/stallbook/{label}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(_application(spark), []).append(path)
    return path


def materialize(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Store ``df`` as Parquet and read it back.

    Used where several passes need one result to stay the same: the table survives lost
    executors, is read column by column and carries exact sizes for the planner.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, metrics: Mapping[str, str], label: str) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` that computes the aggregates ``metrics`` while it is written, and a way to get them after that.

    Put it right below the write: a task of the last stage counts once, also if it runs again, while a
    stage before a shuffle could be counted again when its output is lost.
    """
    if not metrics:
        return df, dict
    seen = Observation(f"{label} {uuid.uuid4().hex}")
    return df.observe(seen, *[F.expr(text).alias(name) for name, text in metrics.items()]), lambda: dict(seen.get)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables that this application has written; results read from them end with it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    forget(spark)
    paths = _WRITTEN.pop(_application(spark), [])
    for name in paths:
        path = hadoop.Path(name)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)
