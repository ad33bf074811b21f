"""Operator 11: the prefix tree of conversations, with what sharing its prefixes saves.

Conversations become paths: the key of depth d is a 128-bit hash of the first d turns (the XOR of a hash of each
(depth, turn)), so equal prefixes have equal keys and nothing but keys, ids and word counts is shuffled after the first pass.

1. Turns are put in order by ranges of (conversation, turn), so a huge conversation is spread over many tasks.
2. Conversations are rebuilt (see ``rebuilt``) and cut into segments of at most ``SEGMENT`` turns; what came before a segment enters
   it through the XOR and the words of the segments before.
3. Each task puts its segments, batch by batch, into z-fast tries (``zfast.py``) and writes their nodes out with every edge expanded to
   one row per depth. Rows of equal prefixes are summed over the tasks; a hot prefix is one row per task by then.
4. A node's smallest member and its number of members name its edge in the compacted tree. Sums over subtrees
   are made on edges, by doubling: after k rounds an edge knows all edges less than 2**k below it.

Nulls: a null role or text is empty, a null turn comes first, rows without a conversation id are left out. Rows of the same
turn are ordered by a hash of role and text; repeated rows are turns of their own. An empty table has no node. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stallbook.llm.frames import WORD, redealt
from stallbook.llm.shipping import ship
from stallbook.llm.zfast import ZFastTrie
from stallbook.operators.materialize import materialize
from stallbook.operators.ranking import with_global_order

FAMILY = 20  # conversations c with the same c - c % FAMILY share turns of that one
MOST_SHARED = 3
SEGMENT = 2_048
BATCH_TURNS = 500_000  # turns in one trie; beyond that a task starts the next one
ID_BITS = 12  # ids per row of the lists of ends: 2**ID_BITS

KEYS = ("pa", "pb")
NODE = "depth bigint, pa bigint, pb bigint, qa bigint, qb bigint, n bigint, conv_id bigint, words bigint, total bigint"


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, row, a, b, words)`` with a running row number, and ``(conv_id, first, n)`` of every conversation."""
    text = [F.coalesce(c, F.lit("")) for c in ("role", "text")]
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.xxhash64(*text).alias("a"), F.xxhash64(F.lit(7), *text).alias("b"),
        F.regexp_count(text[1], F.lit(WORD)).cast("bigint").alias("words"),
    )
    rows = with_global_order(rows, ["conv_id", "turn", "a", "b"], row_number="row")
    return rows, rows.groupBy("conv_id").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, and ``(conv_id, length)`` of each, those without turns included.

    Conversation c starts with the first h turns of c - c % FAMILY, h = crc32 of its decimal id mod 4, and goes on with its own turns after
    its first h.
    """
    rows, spans = ordered_turns(conversations)
    spans = materialize(spans, "spans")
    own = spans.selectExpr("*", f"conv_id - conv_id % {FAMILY} AS base", f"crc32(CAST(conv_id AS STRING)) % {MOST_SHARED + 1} AS h")
    bases = spans.where(f"conv_id % {FAMILY} = 0").selectExpr("conv_id AS base", "n AS base_n")
    convs = own.join(bases, "base", "left").withColumn("lead", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = materialize(convs.selectExpr("*", "lead + greatest(n - h, 0) AS length"), "conversations")
    kept = rows.join(convs.select("conv_id", "first", "h", "lead"), "conv_id")
    kept = kept.where("row - first >= h").selectExpr("conv_id", "lead + row - first - h + 1 AS depth", "a", "b", "words")
    heads = rows.join(spans.where(f"conv_id % {FAMILY} = 0").select("conv_id", "first"), "conv_id")
    heads = heads.where(f"row - first < {MOST_SHARED}").selectExpr("conv_id AS base", "row - first + 1 AS depth", "a", "b", "words")
    shared = convs.where("lead > 0").select("conv_id", "base", "lead").join(heads, "base").where("depth <= lead").select("conv_id", "depth", "a", "b", "words")
    return kept.unionByName(shared), convs.select("conv_id", "length")


def segments(turns: DataFrame, convs: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``(conv_id, seg, turns, xa, xb, w, oa, ob, ow)``: up to ``segment`` turns in order, their XOR and words, and those of what comes before."""
    hashed = turns.selectExpr("conv_id", "depth", f"(depth - 1) div {segment} AS seg", "xxhash64(a, b, depth) AS ta", "xxhash64(11, a, b, depth) AS tb", "words")
    cut = hashed.groupBy("conv_id", "seg").agg(
        F.sort_array(F.collect_list(F.struct("depth", "ta", "tb", "words"))).alias("turns"), F.bit_xor("ta").alias("xa"), F.bit_xor("tb").alias("xb"), F.sum("words").alias("w")
    )
    cut = materialize(cut, "segments")
    # Only conversations of several segments have anything before one.
    long = cut.select("conv_id", "seg", "xa", "xb", "w").join(convs.where(F.col("length") > segment).select("conv_id"), "conv_id", "left_semi")
    before = "OVER (PARTITION BY conv_id ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    before = long.selectExpr("conv_id", "seg", f"bit_xor(xa) {before} AS oa", f"bit_xor(xb) {before} AS ob", f"sum(w) {before} AS ow").where("seg > 0")
    return cut.join(before, ["conv_id", "seg"], "left").na.fill(0, ["oa", "ob", "ow"])


def _paths(batch: pa.RecordBatch, segment: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per segment: id, depth before it, keys of depths start .. end as (n + 1, 2), words and running words of its turns."""
    turns = batch.column("turns")
    offsets, flat = turns.offsets.to_numpy(), turns.values
    terms = np.stack([flat.field("ta").to_numpy(), flat.field("tb").to_numpy()], axis=1)
    words = flat.field("words").to_numpy()
    columns = [batch.column(c).to_numpy() for c in ("conv_id", "seg", "oa", "ob", "ow")]
    for i, (conv, seg, oa, ob, ow) in enumerate(zip(*columns)):
        at = slice(offsets[i], offsets[i + 1])
        keys = np.bitwise_xor.accumulate(np.concatenate([np.array([[oa, ob]], np.int64), terms[at]]), axis=0)
        yield int(conv), int(seg) * segment, keys, words[at], ow + np.cumsum(words[at])


def expanded(trie: ZFastTrie, held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> dict[str, np.ndarray]:
    """One row per node and depth of its stretch; ``held`` has keys, words and running words of the trie's paths."""
    count, least = trie.totals()
    out: dict[str, list] = {name.split()[0]: [] for name in NODE.split(", ")}
    for node, (low, high, path) in enumerate(zip(trie.low, trie.high, trie.path)):
        if low == high:
            continue
        keys, words, total = held[path]
        start = trie.paths[path][0]
        a, b, n = low - start, high - start, high - low
        for name, value in zip(out, (np.arange(low + 1, high + 1), keys[a + 1 : b + 1, 0], keys[a + 1 : b + 1, 1], keys[a:b, 0], keys[a:b, 1], np.full(n, count[node]), np.full(n, least[node]), words[a:b], total[a:b])):
            out[name].append(value)
    return {name: np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64) for name, parts in out.items()}


def prefix_rows(cut: DataFrame, segment: int, batch_turns: int) -> DataFrame:
    """Distinct prefixes of each trie of each task, with the number of segments through them and the smallest conversation."""
    schema = to_arrow_schema(T._parse_datatype_string(NODE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held, turns = ZFastTrie(), [], 0
        for batch in batches:
            for conv, start, keys, words, total in _paths(batch, segment):
                if turns and turns + len(words) > batch_turns:
                    yield pa.RecordBatch.from_pydict(expanded(trie, held), schema)
                    trie, held, turns = ZFastTrie(), [], 0
                trie.insert(start, keys[0].tobytes(), keys[1:].tobytes(), conv)
                held.append((keys, words, total))
                turns += len(words)
        yield pa.RecordBatch.from_pydict(expanded(trie, held), schema)

    ship(cut.sparkSession)
    return cut.select("conv_id", "seg", "turns", "oa", "ob", "ow").mapInArrow(run, NODE)


def tree_nodes(cut: DataFrame, convs: DataFrame, segment: int = SEGMENT, batch_turns: int = BATCH_TURNS) -> DataFrame:
    """Every node once: depth, own and parent's key, members, smallest member, words of the last turn and of all turns."""
    nodes = prefix_rows(cut, segment, batch_turns).groupBy("depth", *KEYS).agg(
        F.min("qa").alias("qa"), F.min("qb").alias("qb"), F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.min("words").alias("words"), F.min("total").alias("total")
    )
    root = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id")).where("n > 0")
    root = root.selectExpr("0L AS depth", "0L AS pa", "0L AS pb", "CAST(NULL AS BIGINT) AS qa", "CAST(NULL AS BIGINT) AS qb", "n", "conv_id", "0L AS words", "0L AS total")
    return materialize(nodes.unionByName(root), "nodes")


def compacted_edges(nodes: DataFrame) -> DataFrame:
    """One row per edge, named by (conv_id, n): its depths, saved tokens, the edge above and the number of edges below.

    On the path of a node's smallest member fewer members are left wherever the tree branches or a conversation ends, so the nodes with the
    same smallest member and the same number of members are the stretch between two such places.
    """
    edges = nodes.groupBy("conv_id", "n").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.max("total").alias("total"), F.min(F.col("total") - F.col("words")).alias("before"),
        F.min(F.struct("depth", "qa", "qb")).alias("above"),
    )
    edges = edges.selectExpr("* EXCEPT (before, above)", "(n - 1) * (total - before) AS saved", "top - 1 AS depth", "above.qa AS pa", "above.qb AS pb")
    places = nodes.selectExpr("depth", *KEYS, "conv_id AS up_conv", "n AS up_n")
    edges = edges.join(places, ["depth", *KEYS], "left").drop("depth", *KEYS)
    edges = materialize(edges, "edges")
    below = edges.where("up_conv IS NOT NULL").groupBy("up_conv", "up_n").agg(F.count(F.lit(1)).alias("children"))
    below = below.withColumnsRenamed({"up_conv": "conv_id", "up_n": "n"})
    return materialize(edges.join(below, ["conv_id", "n"], "left").na.fill(0, ["children"]), "edges-below")


def subtree_sums(edges: DataFrame) -> DataFrame:
    """``edges`` with ``leaves`` and ``saved_below`` of everything under them, in as many rounds as the height has bits."""
    up = ["up_conv", "up_n"]
    leaf = edges.where("children = 0")
    given = leaf.where("up_conv IS NOT NULL").groupBy(*up).agg(F.count(F.lit(1)).alias("leaves"), F.sum("saved").alias("under"))
    inner = edges.where("children > 0").select("conv_id", "n", *up, "saved")
    inner = inner.join(given.withColumnsRenamed({"up_conv": "conv_id", "up_n": "n"}), ["conv_id", "n"], "left").na.fill(0, ["leaves", "under"])
    state = materialize(inner.selectExpr("conv_id", "n", *up, "leaves", "saved + under AS sum"), "sums")
    while not state.where("up_conv IS NOT NULL").isEmpty():
        sent = state.where("up_conv IS NOT NULL").groupBy(*up).agg(F.sum("leaves").alias("more_leaves"), F.sum("sum").alias("more"))
        sent = sent.withColumnsRenamed({"up_conv": "conv_id", "up_n": "n"})
        jumps = state.selectExpr("conv_id AS up_conv", "n AS up_n", "up_conv AS far_conv", "up_n AS far_n")
        state = state.join(jumps, up, "left").drop(*up).join(sent, ["conv_id", "n"], "left").na.fill(0, ["more_leaves", "more"])
        state = materialize(state.selectExpr("conv_id", "n", "far_conv AS up_conv", "far_n AS up_n", "leaves + more_leaves AS leaves", "sum + more AS sum"), "sums")
    summed = edges.join(state.select("conv_id", "n", F.col("leaves").alias("inner_leaves"), "sum"), ["conv_id", "n"], "left")
    return summed.selectExpr("* EXCEPT (inner_leaves, sum)", "coalesce(inner_leaves, 1L) AS leaves", "coalesce(sum, saved) - saved AS saved_below")


def end_digests(cut: DataFrame, convs: DataFrame) -> DataFrame:
    """``(depth, pa, pb, ends_sha256)`` of every node at which conversations end.

    Ids come in sorted rows of at most 2**ID_BITS each and are hashed as they stream by, since a third of all conversations may end at one node.
    """
    last = cut.groupBy("conv_id").agg(F.bit_xor("xa").alias("pa"), F.bit_xor("xb").alias("pb"))
    ends = convs.join(last, "conv_id", "left").na.fill(0, list(KEYS)).withColumnRenamed("length", "depth")
    ends = ends.groupBy("depth", *KEYS, F.shiftright("conv_id", ID_BITS).alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    ends = ends.repartition(*KEYS).sortWithinPartitions(*KEYS, "depth", "block")
    ddl = "depth bigint, pa bigint, pb bigint, ends_sha256 string"
    schema = to_arrow_schema(T._parse_datatype_string(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for depth, a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", *KEYS, "ids"))):
                text = ",".join(map(str, ids)).encode()
                if (depth, a, b) == at:
                    state.update(b"," + text)
                    continue
                if at is not None:
                    done.append((*at, state.hexdigest()))
                at, state = (depth, a, b), hashlib.sha256(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*at, state.hexdigest()), schema)], schema=schema)

    return ends.mapInArrow(run, ddl)


def prefix_tree(conversations: DataFrame, segment: int = SEGMENT, batch_turns: int = BATCH_TURNS) -> DataFrame:
    """One row per node: smallest member, depth, parent, members, children, leaves below, tokens saved below, digest of the ids that end there."""
    turns, convs = rebuilt(conversations)
    cut = segments(turns, convs, segment)
    nodes = tree_nodes(cut, convs, segment, batch_turns)
    edges = subtree_sums(compacted_edges(nodes)).drop("saved", "words")
    digests = end_digests(cut, convs)
    edges = edges.withColumnRenamed("total", "edge_total")
    rows = nodes.drop("qa", "qb").join(redealt(edges, "conv_id", "n"), ["conv_id", "n"])
    rows = rows.join(digests, ["depth", *KEYS], "left")
    return rows.selectExpr(
        "conv_id", "depth", "CASE WHEN depth = 0 THEN NULL WHEN depth = top THEN up_conv ELSE conv_id END AS parent_conv_id", "n AS n_convs",
        "CASE WHEN depth < bottom THEN 1L ELSE children END AS n_children", "leaves AS n_leaves",
        "saved_below + (n - 1) * (edge_total - total + words) AS saved_tokens", f"coalesce(ends_sha256, '{hashlib.sha256(b'').hexdigest()}') AS ends_sha256",
    )
