"""Trigram language model in sharded Elias-Fano tries, and the scores of every text under it.

Tokens are words and one end per text. ``P(w | u, v)`` is interpolated Kneser-Ney down to unigrams.
Unigrams are the add-one estimates of the base, for every word. The model of a text is the even
mixture of this trigram model and the add-one unigram model (the base): where text has no word order
worth knowing it loses at most log10 2 per text against the base. The level between trigrams and
unigrams has contexts of at most about one in ``CONTEXTS`` tokens: a more frequent word v is divided by
a hash of the word before it. That goes by a word's share of the tokens, so a text's probability does not
hang on how many tokens there are, nor on the sizes of blocks and shards.

One shuffle carries all tokens: a map task turns a block of texts into a packed list of distinct
(u, v, w) for each shard, with training counts and the texts they occur in (equal texts of a block
are one). A shard owns contexts v: it adds up the blocks, builds the trie of its training trigrams,
looks every trigram up in it, and returns packed sums per text. Since every token but the end is the
context of the next one, its count, and with it the base score, comes from the same shard. Shards know
the unigrams of words of at least one in ``KNOWN_WORDS`` tokens, a bounded list that is broadcast; for a
trigram that ends in a rarer word they return the seen part and the share of the unigram. A last, small
shuffle brings each block's sums together, and with them the counts of its rarer words, which complete
those trigrams.

Cases: null text is empty (one token, the end); a null id is in training; repeated rows count as
often as they occur; without training rows every token is unknown with probability 1; an empty
table gives an empty result. ``docs`` must give the same rows in the same order whenever a task is
run again, as a stored table does. Words are known by 62-bit hashes, as neighbours of a known context by
40 bits of them.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.llm.elias_fano import Trie
from stallbook.llm.frames import utf8, words
from stallbook.llm.shipping import ship
from stallbook.operators.materialize import materialize

FOLDS, HELD_OUT = 7, 2
KNOWN_WORDS = 1_000_000
SHARD_TOKENS = 2_000_000
BLOCK_TOKENS = 1_500_000
DISCOUNT = 0.75
CONTEXTS = 4_000  # at most KNOWN_WORDS, so that every word to divide is in the list
REMEMBERED = 250_000
COUNT_ROWS = 4_000
ADD_ROWS = 500
NO_WORD, END = 0, 1
SHORT = (1 << 40) - 1
LOG10_2 = float(np.log10(2))


def word_id(word: bytes) -> int:
    return (xxhash.xxh64_intdigest(word, 42) >> 2) | 2  # 0 and 1 are taken


class Ids(dict):
    """Word to id, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = i = word_id(word)
        return i


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A 62-bit hash of ids (the finaliser of splitmix64)."""
    z = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(2)).astype(np.int64)


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def word_counts(rows: DataFrame) -> DataFrame:
    """``(w, train, everywhere)``: id and number of each word; summed per batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, COUNT_ROWS) for b in batches for at in range(0, b.num_rows, COUNT_ROWS)):
            train, rest = Counter(), Counter()
            for text, out in zip(batch.column("_utf8").to_pylist(), batch.column("_held").to_pylist()):
                (rest if out else train).update(words(text))
            names = list(train.keys() | rest.keys())
            yield pa.RecordBatch.from_pydict({"w": pa.array(map(word_id, names), pa.int64()), "train": pa.array([train[n] for n in names], pa.int64()), "everywhere": pa.array([train[n] + rest[n] for n in names], pa.int64())})

    counted = rows.select("_utf8", "_held").mapInArrow(run, "w bigint, train bigint, everywhere bigint")
    return counted.groupBy("w").agg(F.sum("train").alias("train"), F.sum("everywhere").alias("everywhere"))


class Unigrams:
    """Bounded part of the unigram model: frequent words with their counts. Counts of others come with each block."""

    def __init__(self, tokens: int, kinds: int, ends: int, everything: int, frequent: list[tuple[int, int, int]]):
        """``frequent`` has (id, training count, count) of words; ``tokens``, ``kinds`` and ``everything`` (all tokens) include the ends."""
        frequent = sorted([*frequent, (END, ends, ends)])
        self.ids = np.array([f[0] for f in frequent], np.int64)
        self.train = np.array([f[1] for f in frequent], np.int64)
        self.everywhere = np.array([f[2] for f in frequent], np.int64)
        self.short, at = np.unique(self.ids & SHORT, return_index=True)
        self.short_train = self.train[at]
        self.tokens, self.kinds, self.ends, self.everything = tokens, kinds, ends, max(1, everything)
        self.whole = float(tokens + kinds + 1)

    def place(self, ids: np.ndarray) -> np.ndarray:
        """Place of words in the list, -1 of rarer ones."""
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        return np.where(self.ids[at] == ids, at, -1)

    def log10(self, short: np.ndarray) -> np.ndarray:
        """Log probability of words given by the short form of their ids; -inf of rarer ones, which is not known here."""
        at = np.minimum(np.searchsorted(self.short, short), len(self.short) - 1)
        return np.where(self.short[at] == short, np.log10((self.short_train[at] + 1) / self.whole), -np.inf)

    def parts(self, ids: np.ndarray) -> np.ndarray:
        """Into how many contexts a word is divided."""
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        n = np.where(self.ids[at] == ids, self.everywhere[at], 0)
        return np.maximum(1, -(-n * CONTEXTS // self.everything))


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers of 0 or more (or floats), bytes of equal weight side by side, which compresses better."""
    out = []
    for a in arrays:
        if a.dtype.kind != "f":
            a = a.astype(np.min_scalar_type(int(a.max(initial=0))))
        out.append((a.dtype.str, np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes()))
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(out, protocol=5))


def _unpack(data: bytes) -> list[np.ndarray]:
    out = []
    for kind, planes in pickle.loads(zstandard.ZstdDecompressor().decompress(data)):
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).view(kind).ravel())
    return out


def _starts_of_runs(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


class Block:
    """Texts gathered by a map task until there are enough tokens."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.tokens: list[np.ndarray] = []
        self.train: list[int] = []
        self.docs: list[tuple] = []
        self.size = 0

    def add(self, doc_id, text: bytes | None, out: bool, ids: Ids) -> None:
        text = text or b""
        at = self.number.get(text)
        if at is None:
            at = self.number[text] = len(self.tokens)
            parts = words(text)
            self.tokens.append(np.fromiter(map(ids.__getitem__, parts), np.int64, len(parts)))
            self.train.append(0)
            self.size += len(parts) + 1
        self.train[at] += not out
        self.docs.append((doc_id, at, out))

    def rows(self, name: int, shards: int, unigrams: Unigrams) -> Iterator[tuple[int, int, bytes]]:
        """``(shard, block, payload)``; shard -1 - s passes the documents through shard s."""
        lengths = np.array([len(t) for t in self.tokens], np.int64)
        first = np.array([t[0] if len(t) else END for t in self.tokens], np.int64)
        yield -1 - name % shards, name, _pack_docs(self.docs, lengths + 1, first & SHORT)
        names, v = np.unique(np.concatenate([*self.tokens, np.array([NO_WORD, END])]), return_inverse=True)
        v = v[:-2].astype(np.int32)  # places in names; 0 and 1 are no word and the end
        self.tokens = []
        ends = np.cumsum(lengths)
        ends = ends[lengths > 0]
        u, w = np.roll(v, 1), np.roll(v, -1)
        u[np.concatenate(([0], ends[:-1]))[: len(ends)]] = NO_WORD
        w[ends - 1] = END
        text = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        parts = unigrams.parts(names)
        shard = (mixed(names, 1) % shards).astype(np.int32)[v]
        divided = np.flatnonzero(parts[v] > 1)
        short, shorter = np.unique(names & SHORT, return_inverse=True)
        u, w = shorter[u].astype(np.int32), shorter[w].astype(np.int32)
        shard[divided] = mixed(names[v[divided]] ^ (mixed(short, 3)[u[divided]] % parts[v[divided]] + 1), 1) % shards
        order = np.lexsort((w, u, v, shard))
        shard, v, u, w, text = (x[order] for x in (shard, v, u, w, text))
        del order
        new = _starts_of_runs(shard, v, u, w)
        train = np.array(self.train, np.int64)
        present, starts = np.unique(shard, return_index=True)
        for s, a, b in zip(present.tolist(), starts.tolist(), [*starts[1:].tolist(), len(shard)]):
            at = np.flatnonzero(new[a:b])
            counts = np.bincount(np.cumsum(new[a:b]) - 1, weights=train[text[a:b]]).astype(np.int64)
            own, lv = np.unique(v[a:b][at], return_inverse=True)
            beside, local = np.unique(np.concatenate([u[a:b][at], w[a:b][at]]), return_inverse=True)
            lu, lw = np.split(local, 2)
            yield s, name, _pack(np.diff(names[own], prepend=0), np.diff(short[beside], prepend=0), np.diff(lv, prepend=0), lu, lw, counts, np.diff(at, append=b - a), text[a:b])


def _pack_docs(docs: list[tuple], sizes: np.ndarray, first: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps((docs, sizes, first), protocol=5))


def _shard(frame: pd.DataFrame, shard: int, unigrams: Unigrams) -> list[tuple[int, bytes]]:
    """For each block, packed: sums per text (trigram score, base score, known tokens), the trigrams that end in a
    rarer word (text, word, seen part, share of the unigram), which are not in the sums, and the counts of its rarer words."""
    blocks = frame["block"].tolist()
    payloads = [_unpack(p) for p in frame["payload"]]
    owns, besides = ([np.cumsum(p[i].astype(np.int64)) for p in payloads] for i in (0, 1))
    names, short = np.unique(np.concatenate(owns)), np.unique(np.concatenate(besides))
    v, u, w = [], [], []
    for own, beside, (_, _, dv, lu, lw, *_) in zip(owns, besides, payloads):
        place = np.searchsorted(short, beside).astype(np.int32)
        v.append(np.searchsorted(names, own).astype(np.int32)[np.cumsum(dv.astype(np.int64))])
        u.append(place[lu])
        w.append(place[lw])
    v, u, w = (np.concatenate(x) for x in (v, u, w))
    counts = np.concatenate([p[5] for p in payloads]).astype(np.int64)
    # equal trigrams of the blocks are one
    order = np.lexsort((w, u, v))
    v, u, w = v[order], u[order], w[order]
    new = _starts_of_runs(v, u, w)
    one_of = np.empty(len(order), np.int32)
    one_of[order] = np.cumsum(new) - 1
    v, u, w = (x[new].astype(np.int64) for x in (v, u, w))
    del order, new
    trained = np.bincount(one_of, weights=counts, minlength=len(v)).astype(np.int64)
    # a divided word has one context per part
    parts = unigrams.parts(names)
    context = v * int(parts.max())
    divided = np.flatnonzero(parts[v] > 1)
    context[divided] += mixed(short, 3)[u[divided]] % parts[v[divided]]
    log_q = unigrams.log10(short)
    seen = np.flatnonzero(trained > 0)
    if len(divided):
        seen = seen[np.argsort(context[seen], kind="stable")]
    trie = Trie(context[seen], u[seen], w[seen], trained[seen], 10 ** log_q[w[seen]], DISCOUNT)
    # the trie's own trigrams are read in their order, the others searched for
    score = np.empty(len(v))
    score[seen] = trie.own_log10()
    other = np.flatnonzero(trained == 0)
    found, rest = trie.parts(context[other], u[other], w[other])
    score[other] = np.where(np.isneginf(found) & np.isfinite(log_q[w[other]]), rest + log_q[w[other]], found)
    # trigrams that end in a rarer word, and the share of its unigram
    rarer = np.isneginf(log_q)[w]
    open_rest = np.zeros(len(v), np.float32)
    open_rest[seen[rarer[seen]]] = trie.open_rest
    open_rest[other] = rest
    # counts of the words themselves: the whole list of a divided word is known from the frequent ones
    own = np.bincount(v, weights=trained, minlength=len(names)).astype(np.int64)
    place = unigrams.place(names)
    own = np.where(place >= 0, unigrams.train[place], own)
    base, known = np.log10((own + 1) / unigrams.whole)[v], (own > 0)[v]
    del trie, context, u, v, seen, other, found, rest
    out, first = [], 0
    for block, payload, mine in zip(blocks, payloads, owns):
        n = len(payload[5])
        which = np.repeat(one_of[first : first + n], payload[6])
        text = payload[7].astype(np.int64)
        m = int(text.max()) + 1
        late = rarer[which]
        sums = [np.bincount(text, weights=x, minlength=m) for x in (np.where(late, 0, score[which]), base[which], known[which])]
        some = np.flatnonzero(np.bincount(text, minlength=m))
        late = np.flatnonzero(late)
        late = late[np.argsort(w[which[late]], kind="stable")]
        at = which[late]
        own_at = np.searchsorted(names, mine)
        counted = np.flatnonzero(place[own_at] < 0)
        by_short = counted[np.argsort(mine[counted] & SHORT, kind="stable")]
        out.append((block, _pack(
            some, sums[0][some].astype(np.float32), sums[1][some], sums[2][some].astype(np.int64),
            text[late], np.diff(short[w[at]], prepend=0), score[at].astype(np.float32), open_rest[at],
            np.diff(mine[by_short] & SHORT, prepend=0), own[own_at[by_short]],
        )))
        first += n
    return out


def _combined(payload: bytes, found: list[bytes], model: Unigrams) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents of a block, and per text: tokens, known tokens, base score and score."""
    docs, sizes, first = pickle.loads(zstandard.ZstdDecompressor().decompress(payload))
    # in a fixed order, so that sums do not depend on which task was first
    parts = sorted(map(_unpack, found), key=lambda p: (len(p[0]), p[1].tobytes()))
    empty = np.empty(0, np.int64)
    rare, at = np.unique(np.concatenate([empty, *(np.cumsum(p[8].astype(np.int64)) for p in parts)]), return_index=True)
    counts = np.concatenate([empty, *(p[9].astype(np.int64) for p in parts)])[at]

    def log_q(short: np.ndarray) -> np.ndarray:
        out = model.log10(short)
        late = np.flatnonzero(np.isneginf(out))
        out[late] = np.log10((counts[np.searchsorted(rare, short[late])] + 1) / model.whole)
        return out

    score = log_q(first)
    base, known = np.full(len(sizes), np.log10((model.ends + 1) / model.whole)), np.full(len(sizes), int(model.ends > 0))
    for at, s, b, k, text, word, seen, rest, *_ in parts:
        score[at] += s
        base[at] += b
        known[at] += k.astype(np.int64)
        if len(text):
            whole = np.logaddexp2(seen / LOG10_2, (rest + log_q(np.cumsum(word.astype(np.int64)))) / LOG10_2) * LOG10_2
            score += np.bincount(text.astype(np.int64), weights=whole, minlength=len(sizes))
    return docs, sizes, known, base, np.maximum(score, base) + np.log10((1 + 10 ** -np.abs(score - base)) / 2)


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    ship(spark)
    id_type = dict(docs.dtypes)[doc_id]
    rows = docs.select(F.col(doc_id).alias("_id"), utf8(text).alias("_utf8"), held_out(doc_id).alias("_held"))
    counts = materialize(word_counts(rows), "words")
    ends, n_rows = rows.agg(F.count_if(~F.col("_held")), F.count(F.lit(1))).first()
    total = counts.agg(F.coalesce(F.sum("train"), F.lit(0)), F.count_if(F.col("train") > 0), F.coalesce(F.sum("everywhere"), F.lit(0))).first()
    tokens, kinds, everything = total[0] + ends, total[1] + (ends > 0), total[2] + n_rows
    # At most KNOWN_WORDS words can be this frequent.
    frequent = counts.where(F.col("everywhere") * KNOWN_WORDS >= everything).collect()
    unigrams = spark.sparkContext.broadcast(Unigrams(tokens, kinds, ends, everything, [tuple(r) for r in frequent]))
    shards = max(1, -(-everything // SHARD_TOKENS))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, block, done = Ids(), Block(), 0
        task = TaskContext.get().partitionId() << 24

        def rows_of(b: Block) -> Iterator[pa.RecordBatch]:
            for shard, name, payload in b.rows(task | done, shards, unigrams.value):
                yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "block": pa.array([name], pa.int64()), "payload": pa.array([payload], pa.binary())})

        for batch in (b.slice(at, ADD_ROWS) for b in batches for at in range(0, b.num_rows, ADD_ROWS)):
            for i, t, out in zip(*(batch.column(c).to_pylist() for c in ("_id", "_utf8", "_held"))):
                block.add(i, t, out, ids)
                if block.size >= BLOCK_TOKENS:
                    yield from rows_of(block)
                    block, done = Block(), done + 1
        if block.docs:
            yield from rows_of(block)

    def score_shard(key, frame: pd.DataFrame) -> pd.DataFrame:
        out = frame[frame["shard"] < 0][["block", "payload"]].assign(docs=True)
        own = frame[frame["shard"] >= 0]
        found = _shard(own, int(key[0]), unigrams.value) if len(own) else []
        return pd.concat([out, pd.DataFrame({"block": [b for b, _ in found], "payload": [p for _, p in found], "docs": False})]).astype({"block": "int64"})

    def combine(key, frame: pd.DataFrame) -> pd.DataFrame:
        model = unigrams.value
        docs_, sizes, known, base, score = _combined(frame["payload"][frame["docs"]].iloc[0], frame["payload"][~frame["docs"]].tolist(), model)
        of = np.array([d[1] for d in docs_], np.int64)
        return pd.DataFrame({
            "_id": pd.array([d[0] for d in docs_], dtype=object), "held_out": [d[2] for d in docs_], "n_tokens": sizes[of], "n_known": known[of],
            "train_tokens": model.tokens, "base_score": base[of], "score": score[of],
        })

    packed = rows.mapInArrow(gather, "shard bigint, block bigint, payload binary")
    by_shard = packed.groupBy(F.when(F.col("shard") < 0, -1 - F.col("shard")).otherwise(F.col("shard")).alias("to"))
    summed = by_shard.applyInPandas(score_shard, "block bigint, payload binary, docs boolean")
    out = summed.groupBy("block").applyInPandas(combine, f"_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return out.withColumnRenamed("_id", doc_id)
