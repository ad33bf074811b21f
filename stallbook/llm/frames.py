"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.llm.shipping import ship

SLICE_ROWS = 1_000
WORD = r"[^\x20\x09-\x0D]+"


def words(text: bytes | None) -> list[bytes]:
    """Lower-case A-Z and split at ASCII white space (0x20, 0x09-0x0D); null has no words."""
    return text.lower().split() if text else []


def utf8(column: str) -> Column:
    """The bytes of a text column, which cost Python no decoding."""
    return F.col(column).cast("binary")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sampled(df: DataFrame, wanted: int, rows: int, *columns: str, salt: int = 0) -> DataFrame:
    """About ``wanted`` of the ``rows`` of ``df``, picked by a hash of ``columns``, so that reruns pick the same; all if fewer."""
    limit = 1 << 50
    below = limit if rows <= wanted else -(-limit * wanted // rows)
    return df.where(F.pmod(F.xxhash64(*columns, F.lit(salt)), F.lit(limit)) < F.lit(below))


def map_rows(df: DataFrame, function: Callable[[dict[str, list]], dict[str, list]], schema: str | T.StructType) -> DataFrame:
    """Apply ``function`` to lists of column values, some rows of an Arrow batch at a time."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
            out = function(batch.to_pydict())
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def redealt(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` dealt out by a hash of ``columns``.

    An aggregate that is joined on its own keys would bring its partitioning into the join, and
    Spark splits an oversized partition only where both sides were shuffled for the join itself.
    """
    return df.withColumn("_deal", F.xxhash64(*columns)).repartition("_deal").drop("_deal")


class Forest:
    """Union-find over 0..n-1 that takes links as arrays; memory stays O(n) however many come."""

    def __init__(self, n: int):
        self.root = np.arange(n, dtype=np.int64)

    def _compress(self) -> None:
        while True:
            up = self.root[self.root]
            if np.array_equal(up, self.root):
                return
            self.root = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            self._compress()

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Every element that is not its own root, with its root."""
        inner = np.flatnonzero(self.root != np.arange(len(self.root)))
        return inner, self.root[inner]
