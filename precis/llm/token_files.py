"""Token-id files: ids of whole texts in document order, range-coded in blocks that stand alone."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precis.llm.coder import BLOCK, LOWER_BITS, decode_blocks, encode_blocks
from precis.llm.common import with_totals_before
from precis.llm.tokenizing import encoder, in_portions

MAGIC = b"PTID2\0"
END_ID = 0
_SEGMENT_IDS = 2048 * BLOCK
_AT_ONCE = 2048


def pack(ids: np.ndarray) -> bytes:
    """Magic, number of ids and of blocks, lower bits of an id; per block its length in bytes and the crc32 of its ids; then the
    blocks.

    A block holds `BLOCK` ids of up to 32 bits, the last one what is left, little-endian 32-bit ids under the checksum.
    """
    highest = int(ids.max()) if len(ids) else 0
    if highest > 0xFFFFFFFF or (len(ids) and int(ids.min()) < 0):
        raise ValueError("ids must be whole numbers of up to 32 bits")
    lower = max(highest.bit_length() - 8, LOWER_BITS[0])
    full = len(ids) // BLOCK
    blocks: list[bytes] = []
    for at in range(0, full, _AT_ONCE):
        blocks += encode_blocks(ids[at * BLOCK : min(full, at + _AT_ONCE) * BLOCK].reshape(-1, BLOCK), lower)
    if len(ids) > full * BLOCK:
        blocks += encode_blocks(ids[full * BLOCK :].reshape(1, -1), lower)
    plain = ids.astype("<u4")
    index = [struct.pack("<II", len(b), zlib.crc32(plain[i * BLOCK : (i + 1) * BLOCK].tobytes())) for i, b in enumerate(blocks)]
    return b"".join([MAGIC, struct.pack("<QIB", len(ids), len(blocks), lower), *index, *blocks])


def unpack(data: bytes) -> np.ndarray:
    """The ids of a packed segment; ValueError if a block isn't what was written."""
    head = len(MAGIC)
    if data[:head] != MAGIC:
        raise ValueError("not a segment of token ids")
    total, count, lower = struct.unpack_from("<QIB", data, head)
    if lower not in LOWER_BITS:
        raise ValueError("not a segment of token ids")
    head += struct.calcsize("<QIB")
    index = np.frombuffer(data, "<u4", 2 * count, head).reshape(count, 2)
    ends = head + 8 * count + np.cumsum(index[:, 0].astype(np.int64))
    blocks = [data[e - int(n) : e] for e, n in zip(ends, index[:, 0], strict=True)]
    full = total // BLOCK
    parts = [decode_blocks(blocks[at : min(full, at + _AT_ONCE)], BLOCK, lower).ravel() for at in range(0, full, _AT_ONCE)]
    if total > full * BLOCK:
        parts.append(decode_blocks(blocks[full:], total - full * BLOCK, lower).ravel())
    ids = np.concatenate(parts).astype("<u4") if parts else np.empty(0, "<u4")
    for i, crc in enumerate(index[:, 1]):
        if zlib.crc32(ids[i * BLOCK : (i + 1) * BLOCK].tobytes()) != crc:
            raise ValueError(f"block {i} fails its checksum")
    return ids


def write(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Writes the ids of all rows in ascending order of key, null keys first, each followed by `end_id`.

    The table is range-partitioned by key; each task encodes its rows in order and writes segments of whole documents
    (about four million ids, or one longer document) as rows of a Parquet folder: part and number in the part, the
    keys and lengths of its documents, and the packed ids. Null texts are empty. Rows of one key go by their text.
    Only key and text are moved, once; a task that is run again writes the same segments.
    """
    own = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    laid = own.withColumn("hash", F.xxhash64("body")).repartitionByRange("key", "hash").sortWithinPartitions("key", "hash")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, part = encoder(tokenizer), TaskContext.get().partitionId()
        keys: list[int | None] = []
        lengths: list[np.ndarray] = []
        held: list[np.ndarray] = []
        size, number = 0, 0

        def segment() -> pa.RecordBatch:
            fields = [part, number, keys, np.concatenate(lengths).tolist(), size, pack(np.concatenate(held))]
            return pa.RecordBatch.from_arrays([pa.array([f], t) for f, t in zip(fields, kinds, strict=True)], names=names)

        kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary()]
        names = ["part", "number", "keys", "lengths", "n_ids", "data"]
        for batch in batches:
            bodies, own_keys = batch.column("body"), batch.column("key").to_pylist()
            for a, b in in_portions(bodies):
                ids, counts = codes.encode(bodies.slice(a, b - a))
                # An end id after each document.
                ids = np.insert(ids, np.cumsum(counts), np.uint32(end_id))
                keys += own_keys[a:b]
                lengths.append(counts + 1)
                held.append(ids)
                size += len(ids)
                if size >= _SEGMENT_IDS:
                    yield segment()
                    keys, lengths, held, size, number = [], [], [], 0, number + 1
        if keys:
            yield segment()

    schema = "part int, number int, keys array<bigint>, lengths array<bigint>, n_ids bigint, data binary"
    laid.select("key", "body").mapInArrow(segments, schema).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """`(part, number, at, key, ids)`: every document of the files, `at` its place in the segment; checksums are verified."""
    schema = "part int, number int, at bigint, key bigint, ids array<int>"
    return _each_document(spark, path, schema, lambda ids, ends: [ids[e - n : e].astype(np.int32).tolist() for e, n in ends])


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """`(key, start, n_tokens, ids_crc32)`: place, length and checksum of every document, worked out from the files."""
    schema = "part int, number int, at bigint, key bigint, n_tokens bigint, ids_crc32 bigint"
    crc = lambda ids, ends: [(int(n), zlib.crc32(ids[e - n : e].tobytes())) for e, n in ends]
    docs = _each_document(spark, path, schema, crc)
    sizes = spark.read.parquet(path).select("part", "number", "n_ids")
    starts = with_totals_before(sizes, [F.col("part"), F.col("number")], {"before": "n_ids"}, "segment-starts")
    return docs.join(starts.drop("n_ids"), ["part", "number"]).select(
        "key", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def _each_document(spark: SparkSession, path: str, schema: str, of) -> DataFrame:
    stored = spark.read.parquet(path).select("part", "number", "keys", "lengths", "data")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, number, keys, lengths, data = (batch.column(i).slice(row, 1) for i in range(5))
                ids, sizes = unpack(data[0].as_py()), np.array(lengths[0].as_py(), np.int64)
                ends = np.cumsum(sizes)
                found = of(ids, list(zip(ends, sizes, strict=True)))
                rows = len(sizes)
                first = [pa.array(np.full(rows, part[0].as_py()), pa.int32()), pa.array(np.full(rows, number[0].as_py()), pa.int32()), pa.array(ends - sizes, pa.int64()), pa.array(keys[0].as_py(), pa.int64())]
                if found and isinstance(found[0], tuple):
                    rest = [pa.array(list(c), pa.int64()) for c in zip(*found, strict=True)]
                else:
                    rest = [pa.array(found, pa.list_(pa.int32()))]
                names = [f.split()[0] for f in schema.split(", ")]
                yield pa.RecordBatch.from_arrays([*first, *rest], names=names)

    return stored.mapInArrow(documents, schema)
