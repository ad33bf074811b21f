"""Near-duplicate texts: SimHash fingerprints linked through vantage-point trees.

Fingerprints within ``DISTANCE`` bits are linked and components found. Trees are built on Hamming
distance; two of them are used, each on the distance within one half of the bits: of at most 3
differing bits at most 1 falls into one of the halves, so that half's tree needs balls of radius 1
only, and the full distance is compared at the leaves. Where vantage points cannot separate
members by their half, a node uses the full distance and radius 3.

The upper part of each tree is fitted on a sample (about ``SAMPLE_PER_SHARD`` fingerprints per
shard, at most ``MAX_SHARDS`` shards; beyond 500 million distinct fingerprints shards grow) and divides all fingerprints into shards. A fingerprint is a member of one shard per tree
and visits as a query each other shard that the triangle bound does not rule out. Inside a shard
the tree goes on down to small leaves.

``one_of_each`` keeps one row of each component.

Cases: null or empty text has fingerprint 0 and is linked like any other; equal fingerprints are
one node, so groups of copies never meet as rows; rows with a null id take part, but an id that is
null never names a component unless all are null; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallbook.llm.components import connected_components
from stallbook.llm.frames import Forest, fresh, map_rows, redealt, sampled, utf8, words
from stallbook.llm.shipping import ship
from stallbook.operators.materialize import materialize

SHINGLE_WORDS = 3
DISTANCE = 3
SHARD_ROWS = 16_384
MAX_SHARDS = 32_768
SAMPLE_PER_SHARD = 32
LEAF_ROWS = 96
BLOCK_PAIRS = 1_000_000
FULL = 0xFFFFFFFFFFFFFFFF
HALVES = (0xFFFFFFFF00000000, 0x00000000FFFFFFFF)


def fingerprint(text: bytes | None, size: int = SHINGLE_WORDS) -> int:
    """64 bits, each set if it is set in over half of the hashes of the word shingles; 0 without words."""
    tokens = words(text)
    if not tokens:
        return 0
    line = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(size, len(tokens))
    digest, view = xxhash.xxh64_intdigest, memoryview(line)
    hashes = np.array([digest(view[a:b], 42) for a, b in zip(starts[: len(tokens) - k + 1].tolist(), ends[k - 1 :].tolist())], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str, *keys: str) -> DataFrame:
    """``keys`` of every row and its fingerprint as a signed bigint ``_fp``."""
    types = dict(docs.select(*keys).dtypes)

    def run(rows: dict[str, list]) -> dict[str, list]:
        prints = np.array([fingerprint(t) for t in rows["_utf8"]], np.uint64).view(np.int64)
        return {**{k: rows[k] for k in keys}, "_fp": prints}

    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "_fp bigint"])
    return map_rows(docs.select(*keys, utf8(text).alias("_utf8")), run, schema)


def _distance(points: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((points ^ vantage) & mask)


def _cut(members: np.ndarray, mask: int) -> tuple[np.uint64, np.uint64, int, int] | None:
    """Vantage point, mask, radius and cut of a node; None if all members are equal."""
    for bits, radius in ((mask, 1), (FULL, DISTANCE)):
        best = None
        for i in (0, len(members) // 3, (2 * len(members)) // 3):
            d = _distance(members, members[i], np.uint64(bits))
            cut = min(int(np.median(d)), int(d.max()) - 1)
            if cut < int(d.min()):
                continue
            both = int(((d > cut - radius) & (d <= cut + radius)).sum())  # members near the boundary are copied
            if best is None or both < best[0]:
                best = (both, members[i], np.uint64(bits), radius, cut)
        if best is not None and (bits == FULL or best[0] < 0.7 * len(members)):
            return best[1:]
    return None if best is None else best[1:]


def build_tree(sample: np.ndarray, mask: int, leaf_rows: int) -> list[tuple]:
    """Nodes ``(vantage, mask, radius, cut, inner, outer)``; a child below 0 is leaf ``-child - 1``."""
    nodes: list[tuple] = []
    leaves = 0

    def grow(members: np.ndarray) -> int:
        nonlocal leaves
        found = _cut(members, mask) if len(members) > leaf_rows else None
        if found is None:
            leaves += 1
            return -leaves
        at = len(nodes)
        nodes.append(())
        d = _distance(members, found[0], found[1])
        inner = grow(members[d <= found[3]])
        nodes[at] = (*found, inner, grow(members[d > found[3]]))
        return at

    grow(np.unique(sample))
    return nodes


def route(nodes: list[tuple], points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(point index, leaf, is member)``: each point's own leaf and the lower-numbered leaves its ball may reach.

    Two points within the radius each reach the other's leaf, so visiting lower numbers finds both.
    """
    own = np.zeros(len(points), np.int64)
    seen: list[tuple[np.ndarray, int]] = []
    stack = [(0, np.arange(len(points)), np.ones(len(points), bool))] if nodes else []
    while stack:
        at, index, home = stack.pop()
        vantage, mask, radius, cut, inner, outer = nodes[at]
        d = _distance(points[index], vantage, mask).astype(np.int64)
        for child, reach, inside in ((inner, d <= cut + radius, d <= cut), (outer, d > cut - radius, d > cut)):
            sub, sub_home = index[reach], (home & inside)[reach]
            if not len(sub):
                continue
            if child >= 0:
                stack.append((child, sub, sub_home))
            else:
                own[sub[sub_home]] = -child - 1
                seen.append((sub[~sub_home], -child - 1))
    index, leaf, member = [np.arange(len(points))], [own], [np.ones(len(points), bool)]
    for sub, number in seen:
        sub = sub[own[sub] > number]
        index.append(sub)
        leaf.append(np.full(len(sub), number))
        member.append(np.zeros(len(sub), bool))
    return np.concatenate(index), np.concatenate(leaf), np.concatenate(member)


def shard_links(points: np.ndarray, n_members: int, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as index pairs, of all links between members (the first points) and any point."""
    forest = Forest(len(points))
    stack = [(np.arange(n_members), np.arange(len(points)))]
    while stack:
        members, asking = stack.pop()
        found = _cut(points[members], mask) if len(members) > LEAF_ROWS else None
        if found is None:
            step = max(1, BLOCK_PAIRS // max(1, len(members)))
            for at in range(0, len(asking), step):
                block = asking[at : at + step]
                near = np.bitwise_count(points[members][:, None] ^ points[block][None, :]) <= DISTANCE
                i, j = np.nonzero(near)
                forest.link(members[i], block[j])
            continue
        vantage, bits, radius, cut = found
        dm = _distance(points[members], vantage, bits)
        dq = _distance(points[asking], vantage, bits).astype(np.int64)
        stack.append((members[dm <= cut], asking[dq <= cut + radius]))
        stack.append((members[dm > cut], asking[dq > cut - radius]))
    return forest.edges()


def tree_links(nodes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between the distinct ``_fp`` of ``nodes`` that connect exactly what all pairs within the distance connect."""
    spark = nodes.sparkSession
    ship(spark)
    total = nodes.count()
    shards = min(MAX_SHARDS, max(1, -(-total // SHARD_ROWS)))
    # A hash picks the sample, so a rerun builds the same trees; a shard's share of it has a fixed size.
    chosen = sampled(nodes, shards * SAMPLE_PER_SHARD, total, "_fp", salt=7)
    sample = chosen.select("_fp").toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64)
    trees = spark.sparkContext.broadcast([build_tree(sample, mask, SAMPLE_PER_SHARD) if shards > 1 else [] for mask in HALVES])

    def deal(frames):
        for frame in frames:
            at = frame["_fp"].to_numpy(np.int64)
            for half, tree in enumerate(trees.value):
                index, leaf, member = route(tree, at.view(np.uint64))
                yield pd.DataFrame({"tree": np.int32(half), "leaf": leaf, "member": member, "_fp": at[index]})

    def search(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["member", "_fp"], ascending=[False, True])
        at = frame["_fp"].to_numpy(np.int64)
        a, b = shard_links(at.view(np.uint64), int(frame["member"].sum()), HALVES[key[0]])
        return pd.DataFrame({"a": at[a], "b": at[b]})

    dealt = nodes.select("_fp").mapInPandas(deal, "tree int, leaf bigint, member boolean, _fp bigint")
    return dealt.groupBy("tree", "leaf").applyInPandas(search, "a bigint, b bigint")


def classes(prints: DataFrame, doc_id: str) -> DataFrame:
    """``(_fp, _root, component_id)`` for every ``_fp``: its component and the smallest id in it.

    ``prints`` should be a stored table; it is read once here and again by the callers.
    """
    nodes = materialize(prints.groupBy("_fp").agg(F.min(doc_id).alias("_least")), "fingerprints")
    linked = connected_components(tree_links(nodes))
    joined = nodes.join(linked.withColumnRenamed("node", "_fp"), "_fp", "left")
    joined = joined.select("_fp", "_least", F.coalesce("component", "_fp").alias("_root"))
    joined = materialize(joined, "fingerprint-classes")
    least = joined.groupBy("_root").agg(F.min("_least").alias("component_id"))
    return joined.select("_fp", "_root").join(redealt(least, "_root", "component_id"), "_root")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits), ``component_id``."""
    prints = materialize(fingerprints(docs, text, doc_id), "simhash")
    found = redealt(classes(prints, doc_id), "_fp", "component_id").drop("_root")
    out = prints.join(found, "_fp")
    return out.select(doc_id, F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates (``near_duplicates``): of each component the row with the smallest id stays.

    Rows of one id are told apart by their text, equal ones by a hash of the row. A row without an
    id stays only where its component has no id at all. Rows meet in the kept list through a 64-bit
    hash of id and text, so the texts are shuffled once.
    """
    key = fresh(docs, "_key")
    keyed = docs.withColumn(key, F.xxhash64(doc_id, text))
    prints = materialize(fingerprints(keyed, text, doc_id, key).withColumnRenamed(key, "_key"), "simhash")
    found = classes(prints, doc_id)
    member = prints.select(doc_id, "_key", "_fp").join(redealt(found, "_fp", "component_id"), "_fp")
    first = member.where(F.col(doc_id).eqNullSafe(F.col("component_id")))
    kept = first.groupBy("_root").agg(F.min("_key").alias(key)).select(key)
    rows = keyed.join(kept, key, "left_semi")
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind]
    number = fresh(keyed, "_n")
    order = Window.partitionBy(key).orderBy(F.xxhash64(*hashed))
    return rows.withColumn(number, F.row_number().over(order)).where(F.col(number) == 1).select(*docs.columns)
