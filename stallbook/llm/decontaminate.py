"""Operator 12: documents that repeat passages of benchmark items, found by winnowing.

A window is ``WINDOW`` consecutive words of an item, all words of a shorter one. Of every ``w`` neighbouring k-grams with
``w + k - 1`` = window length the one with the smallest hash (the last of equal ones) is kept as a fingerprint. A text
that repeats a window therefore keeps the same k-gram in it, so no window is missed, while far
fewer k-grams than words are looked up. Items shorter than ``WINDOW`` are grouped by length, each with k-grams of its own.

1. Items give fingerprints, and a bit table of them of fixed size.
2. One pass over the documents keeps the fingerprints whose bit is set, each with the words around it.
3. A semi-join with the items' fingerprints removes what only shares a bit.
4. Hits are extended: all windows of words around a fingerprint are joined with the items' windows, word for word.
5. Windows in the same items form one class, and documents with the same classes share one list of items,
   so a passage that many documents and many items hold is never expanded into all pairs of them.

Everything after step 2 is keyed by the text's digest, so copies of a document are looked up once.

Nulls: a null text has no words. A null item id is listed as an empty string. Repeated rows of documents give a row
each; repeated items count once. Ties of hashes are kept alike on both sides. Texts of any length are read in
whole. Empty tables: no documents give no rows, no items give no hits. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stallbook.llm.frames import redealt, utf8
from stallbook.llm.shipping import ship
from stallbook.operators.materialize import materialize

# Words are runs of these characters after A-Z became a-z; bytes of longer characters count as well.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WINDOW = 10
# Bits of the table that documents are looked up in: 4 MB whatever the number of items, read where it lies.
TABLE_BITS = 1 << 25
SLICE_BYTES = 2_000_000
KNOWN_WORDS = 200_000
STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(KEEP).split() if text else []


def kgram_size(window: int) -> int:
    """k and the number of neighbouring k-grams add up to the window and one; equal shares keep fewest k-grams that are still telling."""
    return (window + 1) // 2


class WordHashes(dict):
    """Hashes of words, as many remembered as fit ``KNOWN_WORDS``."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 12)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def winnowed(hashes: np.ndarray, lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the k-grams kept, for texts of ``lengths`` words that stand one after another."""
    k = kgram_size(window)
    w = window + 1 - k
    n = len(hashes)
    if n < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        grams = grams * STEP + hashes[i : n - k + 1 + i]
    grams = mixed(grams)
    least, at = grams[: n - window + 1].copy(), np.zeros(n - window + 1, np.int64)
    for i in range(1, w):
        other = grams[i : n - window + 1 + i]
        smaller = other <= least
        least[smaller] = other[smaller]
        at[smaller] = i
    # Only windows inside one text count.
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(n)
    inside = np.flatnonzero(left[: n - window + 1] >= window)
    places = np.unique(inside + at[inside])
    return places, grams[places]


def slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows of the batches, as many at a time as hold ``size`` bytes of text (one at least)."""
    for batch in batches:
        sizes = np.cumsum([len(t) if t is not None else 0 for t in (v.as_buffer() for v in batch.column("text"))])
        start = 0
        while start < batch.num_rows:
            below = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, below + size, side="right")))
            yield batch.slice(start, end - start)
            start = end


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T._parse_datatype_string(ddl))


def lower(text: str) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def item_windows(items: DataFrame) -> DataFrame:
    """``(item, size, words)``: every window of every item, as words joined by blanks."""
    words = F.regexp_extract_all(lower("text"), F.lit(WORD), F.lit(0))
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("all")).where("size(all) > 0")
    rows = rows.withColumn("size", F.least(F.size("all"), F.lit(WINDOW)))
    windows = F.expr("transform(sequence(0, size(all) - size), i -> array_join(slice(all, i + 1, size), ' '))")
    return rows.select("item", "size", F.explode(windows).alias("words")).distinct()


def item_fingerprints(windows: DataFrame) -> DataFrame:
    """``(size, print)``: the k-gram kept of every window."""
    schema = _arrow("size int, print bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            found: dict[tuple[int, int], None] = {}
            for size, text in zip(batch.column("size").to_pylist(), batch.column("words").to_pylist()):
                hashes = np.fromiter((known[w] for w in text.split(b" ")), np.uint64, size)
                for value in winnowed(hashes, np.array([size]), size)[1].view(np.int64):
                    found[size, int(value)] = None
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in found], pa.int32()), pa.array([p for _, p in found], pa.int64())], schema=schema)

    ship(windows.sparkSession)
    return windows.select("size", utf8("words").alias("words")).mapInArrow(run, "size int, print bigint").distinct()


def bit_table(prints: DataFrame, table_bits: int = TABLE_BITS) -> np.ndarray:
    """One bit per ``print`` modulo ``table_bits``: at most table_bits / 8 bytes (and one bucket) come to the driver."""
    bit = F.pmod("print", F.lit(table_bits))
    # Buckets of the built-in bitmaps count from 1, with 32,768 bits each.
    rows = prints.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    table = np.zeros(max(32_768, table_bits) // 8 + 4096, np.uint8)
    for row in rows.collect():
        # Bits 1 to 32,768 of bucket b are the numbers from (b - 1) * 32,768 + 1; number 0 is in bucket 0 or 1 by its place.
        table[max(0, row["bucket"]) * 4096 :][:4096] |= np.frombuffer(bytes(row["bits"]), np.uint8)
    return table


def bit_places(prints: np.ndarray, table_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte and bit of each print in ``bit_table``: Spark's bucket of bit b is b // 32768 + 1 (from b = 1 on), its place (b - 1) % 32768."""
    bit = (prints & np.uint64(table_bits - 1)).astype(np.int64)
    bucket = np.where(bit > 0, 1 + (bit - 1) // 32768, 0)
    place = np.where(bit > 0, (bit - 1) % 32768, 0)
    return bucket * 4096 + place // 8, place % 8


def looked_up(docs: DataFrame, sizes: list[int], table: np.ndarray, table_bits: int = TABLE_BITS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``(doc_id, digest, n_words, near)``: per document the kept fingerprints whose bit is set, with the words around each.

    ``near`` holds (size, print, start, words): up to size - k words on either side of the k-gram, the first one at ``start``.
    """
    ddl = "doc_id {}, digest binary, n_words bigint, near array<struct<size: int, print: bigint, start: int, words: string>>"
    ddl = ddl.format(docs.schema["doc_id"].dataType.simpleString())
    schema = _arrow(ddl)
    bits = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bit_of = WordHashes(), bits.value
        for batch in slices(batches, slice_bytes):
            texts = batch.column("text").to_pylist()
            words, lengths = [], np.zeros(len(texts), np.int64)
            for i, text in enumerate(texts):
                own = words_of(text)
                lengths[i] = len(own)
                words += own
            hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            ends = np.cumsum(lengths)
            near: list[list[dict]] = [[] for _ in texts]
            for size in sizes:
                places, prints = winnowed(hashes, lengths, size)
                byte, bit = bit_places(prints, table_bits)
                hit = (bit_of[byte] >> bit.astype(np.uint8)) & 1 > 0
                reach = size - kgram_size(size)
                for at, value in zip(places[hit].tolist(), prints[hit].view(np.int64).tolist()):
                    doc = int(np.searchsorted(ends, at, side="right"))
                    first = int(ends[doc] - lengths[doc])
                    start = max(first, at - reach)
                    around = b" ".join(words[start : min(int(ends[doc]), at + size)])
                    near[doc].append({"size": size, "print": value, "start": start - first, "words": around.decode(errors="replace")})
            digests = [hashlib.blake2b(t or b"", digest_size=16).digest() for t in texts]
            columns = [batch.column("doc_id"), digests, lengths, near]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    ship(docs.sparkSession)
    return docs.select("doc_id", utf8("text").alias("text")).mapInArrow(run, ddl)


def matched_windows(near: DataFrame, prints: DataFrame, windows: DataFrame) -> DataFrame:
    """``(digest, start, size, class)``: windows of documents that are windows of items, and the class of items that hold them."""
    found = near.selectExpr("digest", "inline(near)").distinct()
    found = found.join(prints, ["size", "print"], "left_semi")
    around = found.withColumn("all", F.split("words", " "))
    spots = F.expr("transform(sequence(0, size(all) - size), i -> struct(start + i AS start, array_join(slice(all, i + 1, size), ' ') AS words))")
    spots = around.where("size(all) >= size").select("digest", "size", F.inline(spots)).distinct()
    return spots.join(windows, ["size", "words"]).select("digest", "start", "size", "class")


def window_classes(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(size, words, class)`` of each distinct window and ``(class, item)``; windows in the same items have one class.

    A class is the count and three sums of hashes of its items, so no list of items is built to compare them.
    """
    hashes = [F.bit_xor(F.xxhash64(F.lit(i), "item")) for i in range(3)]
    classed = windows.groupBy("size", "words").agg(F.concat_ws(" ", F.count(F.lit(1)), *hashes).alias("class"))
    classed = materialize(classed, "window-classes")
    example = classed.groupBy("class").agg(F.min(F.struct("size", "words")).alias("w")).select("class", "w.size", "w.words")
    items = windows.join(example, ["size", "words"]).select("class", "item")
    return classed, items


def contamination(docs: DataFrame, items: DataFrame, table_bits: int = TABLE_BITS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` of every document."""
    windows = materialize(item_windows(items), "windows")
    prints = materialize(item_fingerprints(windows), "fingerprints")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most WINDOW of them
    rows = materialize(looked_up(docs, sizes, bit_table(prints, table_bits), table_bits, slice_bytes), "looked-up")
    classed, members = window_classes(windows)
    hits = materialize(matched_windows(rows.where("size(near) > 0").select("digest", "near"), prints, classed), "hits")
    members = materialize(members, "members")

    # Words hit: windows in order, each adds what reaches beyond all windows before it. A text bounds its windows.
    before = "max(start + size) OVER (PARTITION BY digest ORDER BY start, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    spans = hits.groupBy("digest", "start").agg(F.max("size").alias("size"))
    spans = spans.selectExpr("digest", f"greatest(0, start + size - greatest(start, coalesce({before}, 0))) AS added")
    found = spans.groupBy("digest").agg(F.sum("added").cast("bigint").alias("n_hit"))

    # Documents with the same classes of windows have the same items; each such set of classes is spelled out once.
    sets = hits.groupBy("digest").agg(F.sort_array(F.collect_set("class")).alias("classes"))
    sets = materialize(sets.select("digest", "classes", F.sha2(F.array_join("classes", ","), 256).alias("set")), "class-sets")
    distinct = sets.groupBy("set").agg(F.min("classes").alias("classes")).select("set", F.explode("classes").alias("class"))
    listed = distinct.join(members, "class").select("set", "item").distinct()
    listed = listed.groupBy("set").agg(F.count(F.lit(1)).alias("n_items"), F.sha2(F.array_join(F.sort_array(F.collect_list("item")), ","), 256).alias("items_sha256"))
    sets = sets.select("digest", "set").join(redealt(listed, "set"), "set").drop("set")
    found = redealt(found.join(sets, "digest"), "digest")

    out = rows.select("doc_id", "digest", "n_words").join(found, "digest", "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("items_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )
