"""Token ids in a binary file format: bit planes of fixed-size blocks, each compressed.

A store is a table of chunks, one binary record each, in shards by ascending doc_id, and an index.

Chunk: header (magic, documents, those without an id, ids, block size, planes), the documents' ids (0
for none; those come first) and token counts, the length of every plane, the planes. Ids are cut into blocks of 4096. Of each block the bits of equal
rank are put side by side (bit planes), so that the rare high bits become long runs; all blocks'
planes of one rank are compressed together with zstandard. A chunk holds whole documents, at least
65,536 ids unless it is the shard's last, and can be read alone. The index (shard, chunk, documents,
ids, start) tells where each chunk's ids begin in the whole.

Spark writes both as Parquet, one binary value per chunk, so that any file system works and a lost
executor's task is run again without a trace.

Cases: a null text is the empty text and has the end id only; rows that repeat a doc_id stand side by
side in the order of their texts' hashes; a null doc_id comes first and is read back as null; an empty
table gives a store without chunks; a document of any length lies in one chunk.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.texts import groups, rows, text_key
from tickloom.llm.tokens import BATCH_CHARS, Encoder

MAGIC = b"TLPLANE2"
HEADER = struct.Struct("<8sQQQII")
BLOCK = 4096
CHUNK_IDS = 65_536


def shuffle_planes(ids: np.ndarray, block: int = BLOCK) -> list[bytes]:
    """Bit planes of all blocks, lowest bit first; as many as the largest id needs."""
    planes = max(1, int(ids.max()).bit_length()) if len(ids) else 0
    padded = np.zeros(-(-len(ids) // block) * block, np.uint32)
    padded[: len(ids)] = ids
    return [np.packbits((padded >> np.uint32(p) & np.uint32(1)).astype(np.uint8)).tobytes() for p in range(planes)]


def join_planes(planes: list[bytes], count: int) -> np.ndarray:
    ids = np.zeros(count, np.uint32)
    for rank, plane in enumerate(planes):
        ids |= np.unpackbits(np.frombuffer(plane, np.uint8), count=count).astype(np.uint32) << np.uint32(rank)
    return ids


def pack(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, level: int = 3) -> bytes:
    press = zstandard.ZstdCompressor(level=level)
    planes = [press.compress(p) for p in shuffle_planes(ids)]
    nulls = doc_ids.count(None)
    table = np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array(counts, "<u8").tobytes()
    sizes = np.array([len(p) for p in planes], "<u8").tobytes()
    return HEADER.pack(MAGIC, len(doc_ids), nulls, len(ids), BLOCK, len(planes)) + table + sizes + b"".join(planes)


def unpack(chunk: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc ids, token counts, ids) of a chunk."""
    magic, docs, nulls, count, block, planes = HEADER.unpack_from(chunk)
    if magic != MAGIC:
        raise ValueError("not a token chunk")
    at = HEADER.size
    doc_ids = np.frombuffer(chunk, "<i8", docs, at)
    counts = np.frombuffer(chunk, "<u8", docs, at + 8 * docs).astype(np.int64)
    at += 16 * docs
    sizes = np.frombuffer(chunk, "<u8", planes, at).tolist()
    at += 8 * planes
    room, parts = -(-count // block) * block // 8, []
    for n in sizes:
        parts.append(zstandard.ZstdDecompressor().decompress(chunk[at : at + n], max_output_size=room))
        at += n
    return [None] * nulls + doc_ids[nulls:].tolist(), counts, join_planes(parts, count)


def write_store(docs: DataFrame, tokenizer: str, path: str, shards: int | None = None) -> None:
    """Write the token ids of all texts to `path`/chunks and `path`/index, in ascending doc_id.

    One shuffle deals the texts to ranges of doc_id, one shard each.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema(
        [("shard", pa.int64()), ("chunk", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64()), ("payload", pa.binary())]
    )

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, number = Encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        counts: list[int] = []
        held: list[np.ndarray] = []

        def close():
            ids = np.concatenate(held)
            return rows(schema, [shard], [number], [len(doc_ids)], [len(ids)], [pack(doc_ids, counts, ids)])

        for columns, texts in groups(batches, most=BATCH_CHARS):
            ids, borders = encoder.encode(texts)
            names = columns["doc_id"]
            start = 0
            while start < len(texts):
                # as many documents as fill the chunk, one at least
                need = CHUNK_IDS - sum(counts)
                stop = min(len(texts), max(start + 1, int(np.searchsorted(borders, borders[start] + need))))
                doc_ids += names[start:stop]
                counts += np.diff(borders[start : stop + 1]).tolist()
                held.append(ids[borders[start] : borders[stop]])
                start = stop
                if sum(counts) >= CHUNK_IDS:
                    yield close()
                    number, doc_ids, counts, held = number + 1, [], [], []
            pa.default_memory_pool().release_unused()
        if doc_ids:
            yield close()

    placed = (
        docs.select("doc_id", "text")
        .repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id", text_key(F.col("text")))
    )
    made = placed.mapInArrow(chunks, "shard long, chunk long, docs long, ids long, payload binary")
    made.write.option("compression", "none").parquet(f"{path}/chunks")
    written = spark.read.parquet(f"{path}/chunks").select("shard", "chunk", "docs", "ids")
    # a shard's number is its range's, so shards stand in the order of doc_id
    totals = written.groupBy("shard").agg(F.sum("ids").alias("total"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(
        "shard", F.coalesce(F.sum("total").over(before.orderBy("shard")), F.lit(0)).alias("base")
    )
    within = F.coalesce(F.sum("ids").over(before.partitionBy("shard").orderBy("chunk")), F.lit(0))
    index = written.withColumn("within", within).join(base, "shard")
    index.select("shard", "chunk", "docs", "ids", (F.col("base") + F.col("within")).alias("start")).write.parquet(
        f"{path}/index"
    )


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian uint32)."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, start in zip(batch["payload"], batch["start"].to_pylist()):
                doc_ids, counts, ids = unpack(payload.as_py())
                ends = np.cumsum(counts)
                raw, data = ids.astype("<u4"), []
                for end, count in zip(ends.tolist(), counts.tolist()):
                    data.append(raw[end - count : end].tobytes())
                yield rows(schema, doc_ids, start + ends - counts, counts, data)

    found = spark.read.parquet(f"{path}/chunks").select("shard", "chunk", "payload")
    placed = found.join(spark.read.parquet(f"{path}/index").select("shard", "chunk", "start"), ["shard", "chunk"])
    return placed.select("payload", "start").mapInArrow(each, "doc_id long, start long, n_tokens long, ids binary")


def crc_of_ids(ids):
    """Unsigned crc32 of the ids' bytes, in Spark."""
    return F.crc32(ids)


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
