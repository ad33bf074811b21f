"""Training-order token files: every sequence gets a global slot from a keyed permutation.

Texts are encoded, closed by an end id and cut into sequences of at most ``stride`` ids. The sequences
are written once; their place (file and row of the written table) numbers them 0..n-1 without a
sort. A keyed Feistel network on the next power of four, walked along its cycle until it falls
below n, permutes the numbers: slot = permutation(number), a bijection that any task computes for
itself. Range partition: shard k holds the slots from k * shard_size; a record has a fixed stride, so record s of a
shard starts at byte s * record_bytes and a reader can go on anywhere (``read_records``). Shards are dealt out by their number,
one per task, and written in ``WAVES`` ranges of shards one after the other: a wave's shuffle files go when its shards
are written, so the disk holds the shuffle of a part of the sequences at a time.

A record is the ids as little-endian uint16 (vocabularies above 65,535 ids: uint32), padded with
the end id, and one closing newline byte, the line end of Spark's text writer, which puts the
records down. Rerunning gives the same files for the same stored sequences; numbers follow the tasks that stored them, so
another partitioning of the texts gives other slots.

Cases: null or empty text is one sequence of the end id alone; repeated rows have sequences of
their own; an empty table has no shards. Long texts span several sequences; nothing is cut off.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm.bpe import vocabulary_path
from stallbook.llm.frames import map_rows
from stallbook.llm.shipping import ship
from stallbook.operators.load_order import with_load_order
from stallbook.operators.materialize import scratch_path

RANKS = "byte_bpe_50k.tiktoken"
STRIDE = 512
SHARD_RECORDS = 8_192
END_ID = 50_256
MAX_TASKS = 50_000  # beyond as many shards, a task writes several
WAVES = 4
BATCH_ROWS = 1_000  # texts that go to Python at a time
ROUNDS = 6
KEY = 97


def permuted(numbers: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """A keyed bijection of 0..n-1: balanced Feistel rounds, repeated while the value is n or more."""
    half = max(1, -(-max(1, n - 1).bit_length() // 2))
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(1, 1 << 62, ROUNDS, dtype=np.int64).astype(np.uint64) | np.uint64(1)
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        value = out[walking]
        left, right = value >> np.uint64(half), value & mask
        for k in keys:
            mix = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mix ^= mix >> np.uint64(29)
            mix = (mix * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
            left, right = right, left ^ (mix & mask)
        out[walking] = (left << np.uint64(half)) | right
        walking = walking[out[walking] >= n]
    return out.astype(np.int64)


_ENCODINGS: dict[str, object] = {}


def encoding(path: str):
    """The worker's tiktoken encoding of a file of ranks; special strings in a text are ordinary text."""
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def sequences(docs: DataFrame, doc_id: str, text: str, stride: int, end_id: int, path: str | None) -> DataFrame:
    """``(_id, seq_no, n_tokens, ids)``: whole texts cut into records' worth of ids, the last one ended by the end id."""
    path = path or vocabulary_path(RANKS)
    kind = dict(docs.dtypes)[doc_id]
    width = "<u2" if end_id < 1 << 16 else "<u4"

    def run(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"_id": [], "seq_no": [], "n_tokens": [], "ids": []}
        encode = encoding(path).encode_ordinary
        for i, t in zip(rows["_id"], rows["_text"]):
            ids = np.array([*encode(t or ""), end_id], width)
            for k, at in enumerate(range(0, len(ids), stride)):
                part = ids[at : at + stride]
                for c, x in zip(out, (i, k, len(part), part.tobytes())):
                    out[c].append(x)
        return out

    return map_rows(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")), run, f"_id {kind}, seq_no int, n_tokens int, ids binary")


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Inside, the session has these settings; then the former ones."""
    former = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in former.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Inside, the shuffle files of a query are removed when it ends.
SHUFFLES_REMOVED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Batches of Spark's own size, 10,000 texts, take tens of MB in the executor and in Python, and neither gives them back.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}


def placed(docs: DataFrame, doc_id: str, text: str, stride: int, end_id: int, key: int, path: str | None) -> tuple[DataFrame, int]:
    """Stored sequences with the ``slot`` of each, and their number; reading a slot needs none of the ids."""
    spark = docs.sparkSession
    folder, rows = scratch_path(spark, "sequences"), sequences(docs, doc_id, text, stride, end_id, path)
    with settings(spark, SMALL_BATCHES):
        rows.write.option("compression", "zstd").parquet(folder)  # ids take a good deal less room so
    stored = spark.read.schema(rows.schema).parquet(folder)
    total = stored.count()
    ship(spark)

    @F.pandas_udf("bigint")
    def slot_of(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), total, key))

    # Called nondeterministic only to be computed once a row: a filter on the slot would otherwise have it computed for itself,
    # by a second Python worker of the task, and again for the rows that it lets through.
    return with_load_order(stored, "_number").withColumn("slot", slot_of.asNondeterministic()(F.col("_number") - 1)).drop("_number"), total


def laid_out(sequences_: DataFrame, total: int, doc_id: str, stride: int, shard_records: int, end_id: int) -> DataFrame:
    """``layout`` of placed sequences."""
    width = np.dtype("<u2" if end_id < 1 << 16 else "<u4")
    size = stride * width.itemsize
    pad = np.full(stride, end_id, width).tobytes()
    tasks = max(1, min(-(-total // shard_records), MAX_TASKS))
    # A shard is a range of slots that every row knows by itself, so no sampling is needed to deal them out: a task per shard.
    dealt = sequences_.withColumn("shard", F.floor(F.col("slot") / shard_records).cast("bigint")).repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int")).sortWithinPartitions("shard", "slot")
    padded = F.concat("ids", F.substring(F.lit(pad), F.lit(1), F.lit(size) - F.length("ids")), F.lit(b"\n"))
    return dealt.select("slot", "shard", ((F.col("slot") % shard_records) * (size + 1)).alias("byte_offset"), F.col("_id").alias(doc_id), "seq_no", "n_tokens", padded.alias("record"))


def layout(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", stride: int = STRIDE, shard_records: int = SHARD_RECORDS, end_id: int = END_ID, key: int = KEY, path: str | None = None) -> DataFrame:
    """Per sequence: ``slot``, ``shard``, ``byte_offset``, id, ``seq_no``, ``n_tokens`` and the ``record`` bytes, in shard order."""
    return laid_out(*placed(docs, doc_id, text, stride, end_id, key, path), doc_id, stride, shard_records, end_id)


def write_shards(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``layout``'s records as files of fixed stride below ``path``, one folder ``shard=k`` each."""
    # The bytes pass as they are; the writer adds the newline that the record already ends with.
    body = F.expr("substring(record, 1, length(record) - 1)")
    records.sortWithinPartitions("shard", "slot").select("shard", body.cast("string").alias("value")).write.partitionBy("shard").option("lineSep", "\n").mode(mode).text(path)


def write_in_waves(rows: DataFrame, total: int, path: str, doc_id: str, stride: int, shard_records: int, end_id: int, waves: int = WAVES) -> None:
    """Write the shards of placed sequences, a range of shards at a time."""
    shards = max(1, -(-total // shard_records))
    step = -(-shards // waves) * shard_records
    with settings(rows.sparkSession, SHUFFLES_REMOVED):
        for start in range(0, max(1, total), step):
            part = rows.where(F.col("slot").between(start, start + step - 1))
            write_shards(laid_out(part, min(step, total - start), doc_id, stride, shard_records, end_id), path, "append" if start else "overwrite")


def read_records(spark: SparkSession, folder: str, stride: int = STRIDE, shard_records: int = SHARD_RECORDS, end_id: int = END_ID, first_slot: int = 0) -> DataFrame:
    """``(slot, record)`` of the shards below ``folder`` from ``first_slot`` on, cut out of the files at their offsets.

    Shards before that slot are not opened, and its own is entered at the record's offset. A task holds some of the files at a time, as many as fit a partition.
    """
    size = stride * np.dtype("<u2" if end_id < 1 << 16 else "<u4").itemsize + 1
    files = spark.read.format("binaryFile").load(folder)
    if "shard" not in files.columns:  # nothing was written
        files = files.withColumn("shard", F.lit(0))
    first, start = divmod(first_slot, shard_records)
    files = files.where(F.col("shard") >= first).select(F.col("shard").cast("bigint").alias("shard"), "content")
    # One Python call cuts a whole shard without copying it; an expression per record would fetch the shard's bytes anew each time.
    ship(spark)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                skipped = start if shard == first else 0
                data = content.as_buffer()[skipped * size :]
                n = len(data) // size
                ends = pa.py_buffer(np.arange(n + 1, dtype=np.int32) * np.int32(size))
                slots = shard * shard_records + skipped + np.arange(n, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(slots), pa.BinaryArray.from_buffers(pa.binary(), n, [None, ends, data])], names=["slot", "record"])

    return files.mapInArrow(cut, "slot bigint, record binary")


def training_files(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", stride: int = STRIDE, shard_records: int = SHARD_RECORDS, end_id: int = END_ID, key: int = KEY, path: str | None = None) -> DataFrame:
    """Write the shards below ``folder``; what ``digests`` gives, the digests being of the records read back from the files."""
    rows, total = placed(docs, doc_id, text, stride, end_id, key, path)
    write_in_waves(rows, total, folder, doc_id, stride, shard_records, end_id)
    read = read_records(docs.sparkSession, folder, stride, shard_records, end_id).select("slot", F.unhex(F.sha2("record", 256)).alias("_sha256"))
    # The join carries only what is not read off the slot. A record that was lost shows up as a row without a digest.
    found = rows.select("slot", "_id", "seq_no", "n_tokens").join(read, "slot", "left")
    size = stride * np.dtype("<u2" if end_id < 1 << 16 else "<u4").itemsize + 1
    shard = F.floor(F.col("slot") / shard_records).cast("bigint")
    offset = (F.col("slot") % shard_records) * size
    return found.select("slot", shard.alias("shard"), offset.alias("byte_offset"), F.col("_id").alias(doc_id), "seq_no", "n_tokens", F.lower(F.hex("_sha256")).alias("record_sha256"))


def digests(records: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``layout`` with the SHA-256 of each record in place of its bytes."""
    digest: Column = F.sha2("record", 256)
    return records.select("slot", "shard", "byte_offset", doc_id, "seq_no", "n_tokens", digest.alias("record_sha256"))
