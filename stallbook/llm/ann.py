"""Approximate nearest neighbours with a forest of hash prefixes.

Rows are dealt evenly into parts, queries into blocks. Each part holds a forest: per tree every row
has a long hash string (sides of random planes through the data's centre) and the strings lie
sorted in an array. A query descends in all trees to its longest matching prefixes; then all trees
ascend together, a bit at a time, and rows under the prefixes become candidates until ``SHARE`` of
the part is reached. Candidates are ranked by Euclidean distance in double precision on the
original vectors, each part returns its ``k`` nearest and these are merged per query.

``SHARE`` is what recall costs: vectors without structure (random directions in 64 dimensions) need
about half of all rows for 0.9 at 10 neighbours; clustered ones need far fewer. Work and messages
are (query blocks) x (parts), both of bounded size, so no task grows with the input.

Cases: rows without an id and vectors that are null, empty, zero or hold null or non-finite
components take no part; vectors of different length are no neighbours; rows with the query's id
are not its neighbours; ties go to the smaller id; fewer rows than ``k`` give fewer neighbours.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.llm.embedding_dedup import matrix, usable
from stallbook.llm.frames import sampled
from stallbook.llm.shipping import ship
from stallbook.operators.materialize import materialize

TREES = 16
BITS = 40
SHARE = 0.6
PART_ROWS = 8_192
QUERY_BLOCK = 4_096
CENTRE_ROWS = 2_000
SEED = 29


def hash_strings(x: np.ndarray, centre: np.ndarray, trees: int = TREES) -> np.ndarray:
    """``trees x rows`` strings of ``BITS`` bits."""
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    out = np.zeros((trees, len(x)), np.int64)
    for t in range(trees):
        planes = np.random.default_rng((SEED, t, x.shape[1])).standard_normal((x.shape[1], BITS))
        out[t] = (((x - centre) @ planes) > 0) @ weights
    return out


class PrefixForest:
    """Sorted arrays of hash strings of one part."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, centre: np.ndarray):
        self.x, self.ids, self.centre = x, ids, centre
        strings = hash_strings(x, centre)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)
        self.squares = (x * x).sum(axis=1)

    def ranges(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``bits + 1 x trees x queries`` ends of the rows that share a prefix of each length."""
        low = np.zeros((BITS + 1, *strings.shape), np.int64)
        high = np.zeros_like(low)
        for depth in range(BITS + 1):
            rest = BITS - depth
            first = (strings >> rest) << rest
            for t in range(len(strings)):
                low[depth, t] = np.searchsorted(self.sorted[t], first[t], side="left")
                high[depth, t] = np.searchsorted(self.sorted[t], first[t] + (1 << rest), side="left")
        return low, high

    def search(self, queries: np.ndarray, query_ids: np.ndarray, k: int, share: float) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the ids and distances of its ``k`` nearest candidates."""
        low, high = self.ranges(hash_strings(queries, self.centre))
        widths = (high - low).sum(axis=1)  # bits + 1 x queries, growing as prefixes get shorter
        wanted = min(len(self.x), max(2 * k, int(np.ceil(share * len(self.x)))))
        out = []
        for i, q in enumerate(queries):
            depth = int(np.flatnonzero(widths[:, i] >= wanted).max(initial=0))
            seen = np.zeros(len(self.x), bool)
            while True:
                for t in range(len(self.order)):
                    seen[self.order[t, low[depth, t, i] : high[depth, t, i]]] = True
                if depth == 0 or np.count_nonzero(seen) >= wanted:
                    break
                depth -= 1
            found = np.flatnonzero(seen & (self.ids != query_ids[i]))
            if len(found) > 4 * k:
                # A fast estimate leaves out what is surely farther than the k nearest.
                rough = self.squares[found] - 2 * (self.x[found] @ q)
                slack = 1e-9 * (float(np.abs(rough).max()) + float(q @ q))
                found = found[rough <= np.partition(rough, k - 1)[k - 1] + slack]
            gap = self.x[found] - q
            distance = np.sqrt((gap * gap).sum(axis=1))
            nearest = np.lexsort((self.ids[found], distance))[:k]
            out.append((self.ids[found[nearest]], distance[nearest]))
        return out


def nearest(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 10, share: float = SHARE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for each row where ``is_query``."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.where(F.col(vec_id).isNotNull() & usable(embedding)).select(F.col(vec_id).cast("bigint").alias("_id"), F.col(embedding).cast("array<double>").alias("_v"), is_query.alias("_query"))
    rows = materialize(rows, "ann-rows")
    total, asked = rows.agg(F.count(F.lit(1)), F.count_if("_query")).first()
    parts, blocks = max(1, -(-total // PART_ROWS)), max(1, -(-asked // QUERY_BLOCK))
    # The centre of a bounded sample; any point gives right results, this one balances the trees.
    chosen = sampled(rows, CENTRE_ROWS, total, "_id", salt=SEED)
    at = chosen.select(F.posexplode("_v").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("x")).collect()
    centre = spark.sparkContext.broadcast({r["i"]: r["x"] for r in at})

    def spread(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    part = F.pmod(F.xxhash64("_id", "_v", F.lit(SEED + 1)), F.lit(parts)).cast("int")
    block = F.pmod(F.xxhash64("_id", "_v", F.lit(SEED + 2)), F.lit(blocks)).cast("int")
    # A query is a distinct id and vector: equal rows ask once, and other vectors under the same id are ranked on their own.
    asker = F.xxhash64("_id", "_v", F.lit(SEED + 3))
    held = rows.select(part.alias("part"), spread(blocks).alias("block"), "_id", "_v", F.lit(False).alias("_query"), F.lit(0).cast("bigint").alias("_asker"))
    asking = rows.where("_query").dropDuplicates(["_id", "_v"]).select(spread(parts).alias("part"), block.alias("block"), "_id", "_v", "_query", asker.alias("_asker"))

    def search(key, frame: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "asker": [], "vec_id": [], "score": []}, dtype="int64")]
        for length, group in frame.groupby(frame["_v"].map(len)):
            rows_here, queries = group[~group["_query"]], group[group["_query"]]
            if not len(rows_here) or not len(queries):
                continue
            middle = np.array([centre.value.get(i, 0.0) for i in range(length)])
            rows_here = rows_here.sort_values("_id", kind="stable")
            forest = PrefixForest(matrix(rows_here["_v"]), rows_here["_id"].to_numpy(np.int64), middle)
            ids = queries["_id"].to_numpy(np.int64)
            found = forest.search(matrix(queries["_v"]), ids, k, share)
            counts = [len(f[0]) for f in found]
            out.append(pd.DataFrame({"query_id": np.repeat(ids, counts), "asker": np.repeat(queries["_asker"].to_numpy(np.int64), counts), "vec_id": np.concatenate([f[0] for f in found]), "score": np.concatenate([f[1] for f in found])}))
        return pd.concat(out).astype({"query_id": "int64", "asker": "int64", "vec_id": "int64", "score": "float64"})

    near = held.unionByName(asking).groupBy("part", "block").applyInPandas(search, "query_id bigint, asker bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id", "asker").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
