"""Mix sources to target weights with a multivariate-hypergeometric splitting tree.

Every source gets a target in words: the total is shared by weight, no source beyond
``MAX_EPOCHS`` times its own size, the excess shared again by weight. A source's documents fall
into blocks by a hash; a target of e.g. 2.3 sizes draws every block twice and the first blocks of a
permutation a third time, up to the target, inside the last block document by document in hash
order, and there the one document more that brings it nearest. The drawn blocks of each source are its quota. A binary tree over the output shards splits
the quota vector of all sources: at each node the left half's share is one draw from the
multivariate hypergeometric distribution, so the leaves' quotas are whole blocks that add up
exactly. Each source's permuted draws are then dealt to the shards in turn, and rows get a random
position inside their shard.

Only the totals of the sources (one row each, as the weights are) reach the driver. Blocks grow
with the data (``BLOCK_WORDS``, at most ``MAX_BLOCKS`` a source), so joins are on (source, block).

Cases: a null text has size 0 and draws follow its block; a null source is a source of its own,
last in order; repeated rows are drawn or not together; without words every target is 0 and
nothing is taken; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.llm.frames import WORD, fresh, redealt
from stallbook.operators.materialize import materialize

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BLOCK_WORDS = 20_000
MAX_BLOCKS = 4_096
SHARD_WORDS = 4_000_000
SEED = 17


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: list[int], weights: list[float], limit: float = MAX_EPOCHS) -> list[float]:
    """Share ``sum(sizes)`` by weight; whoever passes ``limit`` times its size stops there, the rest is shared again."""
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(sum(sizes))
    while open_:
        weight = sum(weights[i] for i in open_)
        full = {i for i in open_ if left * weights[i] / weight > limit * sizes[i]}
        if not full:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = float(limit * sizes[i])
        left -= sum(out[i] for i in full)
        open_ -= full
    return out


def split_quotas(quotas: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """``shards x sources`` whole blocks: each tree node gives its left half one hypergeometric draw of its vector."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def node(first: int, n: int, vector: np.ndarray) -> None:
        if n == 1:
            out[first] = vector
            return
        left = n // 2
        take = int(vector.sum()) * left // n
        rng = np.random.default_rng((seed, first, n))
        part = rng.multivariate_hypergeometric(vector, take, method="marginals") if len(vector) and take else vector * 0
        node(first, left, part)
        node(first + left, n - left, vector - part)

    node(0, shards, np.array(quotas, np.int64))
    return out


def mix(docs: DataFrame, source: str = "source", text: str = "text", identity: tuple[str, ...] = ("doc_id", "text"), keep: tuple[str, ...] = ("doc_id",), seed: int = SEED) -> DataFrame:
    """``keep`` and the mix of every row: ``_size``, ``_source_size``, ``_target``, ``_draws``.

    ``_draws`` is an array of (epoch, shard, position), one entry per copy that the mix takes.
    ``identity`` are the columns whose hash places a row, so reruns and other partitionings agree.
    """
    return _mix(docs, source, text, identity, keep, seed)[0]


def _mix(docs: DataFrame, source: str, text: str, identity: tuple[str, ...], keep: tuple[str, ...], seed: int = SEED) -> tuple[DataFrame, int]:
    """The rows of ``mix`` and the number of shards."""
    spark = docs.sparkSession
    rows = docs.select(*[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)], F.col(source).cast("string").alias("_source"), word_count(text).alias("_size"), F.xxhash64(*identity, F.lit(seed)).alias("_hash"))
    rows = materialize(rows, "mix-rows")
    found = rows.groupBy("_source").agg(F.sum("_size").alias("size")).collect()
    # Strings compare by code point in Python as in UTF-8 order; null comes last.
    found.sort(key=lambda r: (r["_source"] is None, r["_source"] or ""))
    sizes = [r["size"] for r in found]
    goal = targets(sizes, [float(WEIGHTS[i % len(WEIGHTS)]) for i in range(len(found))])
    blocks = [min(MAX_BLOCKS, s // BLOCK_WORDS + 1) for s in sizes]
    epochs = [int(g // s) if s else 0 for g, s in zip(goal, sizes)]
    rest = [g - e * s for g, e, s in zip(goal, epochs, sizes)]
    schema = "_source string, _source_size bigint, _target double, _blocks int, _epochs int, _rest double, _number int"
    plan = spark.createDataFrame([(r["_source"], s, g, b, e, x, i) for i, (r, s, g, b, e, x) in enumerate(zip(found, sizes, goal, blocks, epochs, rest))], T._parse_datatype_string(schema))
    plan = F.broadcast(plan)  # one row per source, like the weights
    placed = rows.join(plan, rows["_source"].eqNullSafe(plan["_source"])).drop("_source")
    placed = placed.withColumn("_block", F.pmod("_hash", F.col("_blocks").cast("bigint")).cast("int"))

    # Blocks in a permuted order per source: what the partial epoch takes whole, and where it ends.
    per_block = placed.groupBy("_number", "_block").agg(F.sum("_size").alias("_words"), F.first("_rest").alias("_rest"), F.first("_epochs").alias("_epochs"))
    permuted = Window.partitionBy("_number").orderBy(F.xxhash64("_block", F.lit(seed + 1)), "_block")
    per_block = materialize(per_block.withColumn("_before", F.sum("_words").over(permuted) - F.col("_words")), "mix-blocks")
    edge = per_block.where("_before < _rest AND _before + _words > _rest").select("_number", "_block", (F.col("_rest") - F.col("_before")).alias("_room"))
    inside = placed.select("_number", "_block", "_hash", "_size").join(F.broadcast(edge), ["_number", "_block"])  # one block per source
    # Of each edge block the rows in hash order as long as they fit the room, and the one row that fills it best.
    so_far = inside.groupBy("_number", "_hash").agg(F.sum("_size").alias("_words"), F.first("_room").alias("_room"))
    running = F.sum("_words").over(Window.partitionBy("_number").orderBy("_hash"))
    so_far = materialize(so_far.withColumn("_run", running), "mix-edges")
    fits = so_far.where("_run <= _room").groupBy("_number").agg(F.max("_hash").alias("_last"), F.max("_run").alias("_got"))
    rest_of = so_far.join(F.broadcast(fits), "_number", "left").where("_last IS NULL OR _hash > _last")
    rest_of = rest_of.withColumn("_gap", F.col("_room") - F.coalesce("_got", F.lit(0))).where("abs(_words - _gap) < _gap")
    fill = rest_of.groupBy("_number").agg(F.min(F.struct(F.abs(F.col("_words") - F.col("_gap")).alias("off"), "_hash")).alias("_best"))
    edge_numbers = so_far.select("_number").distinct()
    last = edge_numbers.join(fits, "_number", "left").join(fill.select("_number", F.col("_best._hash").alias("_fill")), "_number", "left")

    # Each drawn block of each epoch, in the permuted order in which a source's quota is dealt out.
    whole = per_block.select("_number", "_block", F.explode(F.expr("sequence(0, _epochs)")).alias("_epoch"), (F.col("_epoch") < F.col("_epochs")).alias("_full"), (F.expr("_before + _words <= _rest")).alias("_in_rest"), F.expr("_before < _rest AND _before + _words > _rest").alias("_edge"))
    drawn = whole.where("_full OR _in_rest OR _edge").withColumn("_partial", ~F.col("_full") & F.col("_edge"))
    turn = Window.partitionBy("_number").orderBy(F.xxhash64("_block", "_epoch", F.lit(seed + 2)), "_block", "_epoch")
    drawn = materialize(drawn.select("_number", "_block", "_epoch", "_partial", (F.row_number().over(turn) - 1).alias("_turn")), "mix-draws")
    quotas = [0] * len(found)
    for r in drawn.groupBy("_number").count().collect():
        quotas[r["_number"]] = r["count"]
    shards = max(1, -(-sum(sizes) // SHARD_WORDS))
    ends = split_quotas(quotas, shards, seed).cumsum(axis=0)
    cuts = spark.createDataFrame([(i, [int(v) for v in ends[:, i]]) for i in range(len(found))], T._parse_datatype_string("_number int, _ends array<bigint>"))
    shard = F.size(F.filter("_ends", lambda e: e <= F.col("_turn")))
    dealt = drawn.join(F.broadcast(cuts), "_number").select("_number", "_block", "_epoch", "_partial", shard.cast("int").alias("_shard"))
    per_block = dealt.groupBy("_number", "_block").agg(F.sort_array(F.collect_list(F.struct("_epoch", "_shard", "_partial"))).alias("_list"))  # at most MAX_EPOCHS + 1
    placed = placed.join(redealt(per_block, "_number", "_block"), ["_number", "_block"], "left").join(F.broadcast(last), "_number", "left")
    taken = F.filter(F.coalesce("_list", F.array().cast("array<struct<_epoch:int,_shard:int,_partial:boolean>>")), lambda d: ~d["_partial"] | F.coalesce(F.col("_hash") <= F.col("_last"), F.lit(False)) | F.coalesce(F.col("_hash") == F.col("_fill"), F.lit(False)))
    draws = F.transform(taken, lambda d: F.struct(d["_epoch"].alias("epoch"), d["_shard"].alias("shard"), F.xxhash64("_hash", d["_epoch"]).alias("position")))
    return placed.select(*[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)], "_size", "_source_size", "_target", draws.alias("_draws")), shards


def mixture(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Per document: id, size, source_size, target, taken (words, repeats counted)."""
    return mix(docs, source, text, (doc_id, text), (doc_id,)).select(
        doc_id, F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_size") * F.size("_draws")).alias("taken")
    )


def mixed(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mixed rows themselves: each row of ``docs`` as often as it is drawn, a partition per shard, in the shard's order.

    The mix is worked out on sizes alone and joined to the rows by a hash of id, text and source.
    """
    key = fresh(docs, "_mix_key")
    keyed = docs.withColumn(key, F.xxhash64(doc_id, text, F.coalesce(F.col(source).cast("string"), F.lit("\0"))))
    rows, shards = _mix(keyed, source, text, (doc_id, text), (key,))
    drawn = rows.where(F.size("_draws") > 0)
    draws = drawn.groupBy(key).agg(F.first("_draws").alias(name := fresh(docs, "_draw")))  # repeated rows are drawn alike
    copies = keyed.join(redealt(draws, key), key).select(*docs.columns, F.explode(name).alias(name))
    return copies.repartitionById(shards, F.col(f"{name}.shard")).sortWithinPartitions(f"{name}.shard", f"{name}.position").select(*docs.columns)
