"""Embedding near-dedup by sorted projection passes.

Each pass gives every vector a key of concatenated random hashes (signs of random projections),
orders the vectors by it and cuts the order into runs of about ``RUN_ROWS`` vectors; vectors of the
same run and of neighbouring runs are compared by cosine in double precision. Run borders come from
a sample of keys, so they are known before the shuffle and each vector can name its run of every
pass. A pair is counted in the first pass that brings it together, which any task can tell from the
run numbers of all passes; so link counts need no list of pairs. Runs hand on a spanning forest of
their links, and the passes' forests are joined into components.

The number of passes follows from the key bits that tell runs apart: a pair at the threshold shares
``bits`` leading bits with probability ``(1 - angle / pi) ** bits`` per pass, and meets at once if
it does. Evenly spread directions need log2(runs) bits, dense parts more, so each vector takes the
most bits that its keys have needed so far to stay inside their run and the two beside it (a pass
with few bits may have cut it off from its partners), and goes through passes until it meets a
partner at the threshold with probability ``RECALL``, or through ``MAX_PASSES``. Links are those found this way; none is below the threshold.

Equal vectors are one node with a count, so groups of copies never meet as rows; runs that sampling
left too long are compared in blocks.

Cases: vectors that are null, empty, zero or hold null or non-finite components, and rows without
an id, have no links and no part in others' counts; vectors of different length are never linked;
a repeated row counts as another vector; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.llm.components import connected_components
from stallbook.llm.frames import Forest, redealt, sampled
from stallbook.llm.shipping import ship
from stallbook.operators.materialize import materialize

THRESHOLD = 0.95
RUN_ROWS = 512
MAX_RUNS = 65_536
RUNS_PER_TASK = 8
SAMPLE_PER_RUN = 16
RECALL = 0.999
MAX_PASSES = 512
SAMPLE_KEYS = 1 << 24
KEY_BITS = 62
BLOCK = 2_048
SEED = 23


def usable(embedding: str) -> Column:
    """Whether a vector has a direction: numbers only, not all zero."""
    v = F.col(embedding)
    return F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaling by the largest component first keeps squares in range."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def keys_of(x: np.ndarray, passes: int, first: int = 0) -> np.ndarray:
    """Sort keys of the passes from ``first`` on; bit b of pass p is the side of a random plane, the same for every call."""
    out = np.zeros((len(x), passes - first), np.int64)
    weights = 1 << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64)
    for p in range(first, passes):
        planes = np.random.default_rng((SEED, p, x.shape[1])).standard_normal((x.shape[1], KEY_BITS))
        out[:, p - first] = ((x @ planes) > 0) @ weights
    return out


def own_bits(keys: np.ndarray, run: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Leading bits of a key that no key outside its run and the two beside it shares."""

    def shared(other: np.ndarray) -> np.ndarray:
        apart = keys ^ other
        for shift in (1, 2, 4, 8, 16, 32):
            apart |= apart >> shift
        return KEY_BITS - np.bitwise_count(apart).astype(np.int64)

    if not len(borders):
        return np.zeros(len(keys), np.int64)
    below = borders[np.maximum(run - 2, 0)] - 1  # the last key before the run before
    above = borders[np.minimum(run + 1, len(borders) - 1)]  # the first key after the run after
    return np.maximum(np.where((run >= 2) & (below >= 0), shared(np.maximum(below, 0)) + 1, 0), np.where(run + 1 < len(borders), shared(above) + 1, 0))


def passes_of(bits: np.ndarray, threshold: float, recall: float = RECALL) -> np.ndarray:
    """Passes until a pair at the threshold has once shared so many leading bits."""
    meet = (1 - math.acos(threshold) / math.pi) ** bits.astype(float)
    return np.ceil(math.log(1 - recall) / np.log1p(-np.minimum(meet, 0.999)))


def passes_for(runs: int, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    agree = 1 - math.acos(threshold) / math.pi
    meet = agree ** math.log2(max(2, runs))
    return max(2, math.ceil(math.log(1 - recall) / math.log(1 - min(meet, 0.999))))


def _by_length(frame: pd.DataFrame):
    return frame.groupby(frame["_v"].map(len), sort=True)


def _compare(run_of: np.ndarray, vectors: np.ndarray, node: np.ndarray, copies: np.ndarray, p: int, first: int, last: int, threshold: float):
    """Links of pass ``p`` with the lower run in ``first..last``: counts per row and a spanning forest."""
    links = np.zeros(len(node), np.int64)
    forest = Forest(len(node))
    order = np.argsort(run_of[:, p], kind="stable")
    sorted_runs = run_of[order, p]
    for run in np.unique(sorted_runs[(sorted_runs >= first) & (sorted_runs <= last)]):
        a0, a1, b1 = np.searchsorted(sorted_runs, [run, run + 1, run + 2])
        own, both = order[a0:a1], order[a0:b1]
        for i in range(0, len(own), BLOCK):
            left = own[i : i + BLOCK]
            for j in range(0, len(both), BLOCK):
                right = both[j : j + BLOCK]
                near = (vectors[left] @ vectors[right].T) >= threshold
                # Each pair once: within the run the later row is the right one.
                if j < len(own):
                    near &= (np.arange(i, i + len(left))[:, None] < np.arange(j, j + len(right))[None, :])
                li, ri = np.nonzero(near)
                li, ri = left[li], right[ri]
                forest.link(li, ri)
                new = np.ones(len(li), bool)
                for q in range(p):
                    new &= np.abs(run_of[li, q] - run_of[ri, q]) > 1
                np.add.at(links, li[new], copies[ri[new]])
                np.add.at(links, ri[new], copies[li[new]])
    return links, forest


def linked(nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(a, b, n)`` over distinct vectors ``(_node, _v, _copies)``: a link of the forest, or with b null a count of links."""
    spark = nodes.sparkSession
    ship(spark)
    total = nodes.count()
    runs = min(MAX_RUNS, max(1, -(-total // RUN_ROWS)))
    least = passes_for(runs, threshold)
    chosen = materialize(sampled(nodes, runs * SAMPLE_PER_RUN, total, "_node", salt=SEED).select("_v"), "vector-sample")

    def sample_keys(first: int, last: int) -> np.ndarray:
        def run(frames):
            for frame in frames:
                for _, part in _by_length(frame):
                    yield pd.DataFrame({"keys": list(keys_of(unit(matrix(part["_v"])), last, first))})

        keys = chosen.mapInPandas(run, "keys array<bigint>").toPandas()["keys"]
        return np.stack(list(keys)) if len(keys) else np.zeros((0, last - first), np.int64)

    def borders_of(keys: np.ndarray) -> list[np.ndarray]:
        step = max(1, len(keys) // runs)
        return [np.sort(column)[step::step] for column in keys.T]

    # About SAMPLE_PER_RUN vectors a run give the borders; from the first passes follows how many the densest of them need.
    keys = sample_keys(0, least)
    found_borders = borders_of(keys)
    bits = [own_bits(k, np.searchsorted(b, k, side="right"), b) for k, b in zip(keys.T, found_borders)]
    passes = max(least, int(min(MAX_PASSES, passes_of(np.max(bits), threshold)))) if len(keys) else least
    at_once = max(1, SAMPLE_KEYS // max(1, len(keys)))  # so that the driver holds a bounded number of keys
    for first in range(least, passes, at_once):
        found_borders += borders_of(sample_keys(first, min(passes, first + at_once)))
    borders = spark.sparkContext.broadcast(found_borders)

    def deal(frames):
        for frame in frames:
            for _, part in _by_length(frame):
                x = unit(matrix(part["_v"]))
                history, bits = np.zeros((len(part), 0), np.int32), np.zeros(len(part), np.int64)
                for p in range(passes):
                    found = keys_of(x, p + 1, p)[:, 0]
                    run = np.searchsorted(borders.value[p], found, side="right")
                    history, bits = np.column_stack([history, run.astype(np.int32)]), np.maximum(bits, own_bits(found, run, borders.value[p]))
                    part = part.assign(run=list(history))
                    own = run // RUNS_PER_TASK
                    yield part.assign(p=np.int32(p), part=own)
                    # The first run of a task is also the neighbour of the task before.
                    border = (run % RUNS_PER_TASK == 0) & (own > 0)
                    if border.any():
                        yield part[border].assign(p=np.int32(p), part=own[border] - 1)
                    go_on = (passes_of(bits, threshold) > p + 1) | (p + 1 < least)
                    part, x, history, bits = part[go_on], x[go_on], history[go_on], bits[go_on]
                    if not len(part):
                        break

    def search(key, frame: pd.DataFrame) -> pd.DataFrame:
        p, part = int(key[0]), int(key[1])
        out = [pd.DataFrame({"a": [], "b": [], "n": []})]
        for _, group in _by_length(frame.sort_values("_node")):
            node, copies = group["_node"].to_numpy(np.int64), group["_copies"].to_numpy(np.int64)
            run_of = np.stack(list(group["run"])).astype(np.int64)
            links, forest = _compare(run_of, unit(matrix(group["_v"])), node, copies, p, part * RUNS_PER_TASK, (part + 1) * RUNS_PER_TASK - 1, threshold)
            a, b = forest.edges()
            out.append(pd.DataFrame({"a": node[a], "b": node[b], "n": 0}))
            some = np.flatnonzero(links)
            out.append(pd.DataFrame({"a": node[some], "b": None, "n": links[some]}))
        return pd.concat(out).astype({"a": "Int64", "b": "Int64", "n": "Int64"})

    dealt = nodes.mapInPandas(deal, "_node bigint, _v array<float>, _copies bigint, run array<int>, p int, part bigint".replace("array<float>", dict(nodes.dtypes)["_v"]))
    return dealt.groupBy("p", "part").applyInPandas(search, "a bigint, b bigint, n bigint")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links``, ``component_id``, ``kept``.

    A vector outside every comparison is its own component, with its own id.
    """
    rows = vectors.select(F.col(vec_id).alias("_id"), F.col(embedding).alias("_v"), (usable(embedding) & F.col(vec_id).isNotNull()).alias("_use"))
    nodes = rows.where("_use").groupBy("_v").agg(F.min("_id").cast("bigint").alias("_node"), F.count(F.lit(1)).alias("_copies"))
    nodes = materialize(nodes.select("_node", "_v", "_copies"), "vectors")
    found = materialize(linked(nodes, threshold), "vector-links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("_node")).agg(F.sum("n").alias("_n"))
    parts = connected_components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "_node")
    described = nodes.join(counts, "_node", "left").join(parts, "_node", "left")
    described = described.select("_v", F.expr("coalesce(_n, 0) + _copies - 1 AS _links"), F.coalesce("component", "_node").alias("_component"))
    described = redealt(described, "_v")
    out = rows.join(described.withColumnRenamed("_v", "_w"), F.col("_use") & (F.col("_v") == F.col("_w")), "left")
    return out.select(
        F.col("_id").alias(vec_id),
        F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("_component", F.col("_id").cast("bigint")).alias("component_id"),
        F.coalesce(F.col("_id") == F.coalesce("_component", "_id"), F.lit(False)).alias("kept"),
    )
