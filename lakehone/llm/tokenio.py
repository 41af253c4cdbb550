"""Token files: frequency-ranked ids in one to four bytes each, their lengths in separate control bytes."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import codec, default_tokenizer
from .common import lower_batches, materialize, scratch, small_batches

#: Documents of one block of a file.
BLOCK_DOCS = 256


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes (two bits a value: its bytes less one) and data bytes of unsigned 32-bit values."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    most = 1 + sum(int(ranks.max(initial=0)) > x for x in (0xFF, 0xFFFF, 0xFFFFFF))
    code = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    keep = np.ones((len(ranks), most), bool)
    for i in range(1, most):
        keep[:, i] = ranks > (1 << 8 * i) - 1
        code[: len(ranks)] += keep[:, i]
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[:, :most][keep].tobytes()


#: Widths of the four values of each control byte.
WIDTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + np.uint8(1)


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values of pack()."""
    width = WIDTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    starts = np.cumsum(width, dtype=np.int64) - width
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    out = raw[starts].astype(np.uint32)
    for i in range(1, int(width.max(initial=1))):
        out |= (raw[starts + i] * (width > i)).astype(np.uint32) << np.uint32(8 * i)
    return out


def token_ids(docs: DataFrame, path: str, end: int | None) -> DataFrame:
    """doc_id, n, ids (16-bit little-endian if the vocabulary allows, else 32-bit), h (their checksum)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        c = codec(path)
        dtype = "<u2" if len(c.pieces) <= 65536 and (end is None or end < 65536) else "<u4"
        tail = np.array([] if end is None else [end], np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                ids = [np.concatenate([c.encode(t), tail]).astype(dtype) for t in part.column(1).to_pylist()]
                raw = [i.tobytes() for i in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(map(len, ids)), pa.int64()), pa.array(raw, pa.binary()), pa.array(list(map(zlib.crc32, raw)), pa.int64())], ["doc_id", "n", "ids", "h"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, ids binary, h long")


def write(docs: DataFrame, target: str, path: str | None = None, end: int | None = 2, shards: int | None = None) -> None:
    """Writes all documents' ids as token files under `target`, in ascending doc_id order (null first, then by their ids).

    target/ranks maps ranks to ids.  target/blocks holds, for each shard and block, the ids before it in the shard, doc ids, lengths, control bytes and data bytes.
    A null text is the empty one; rows that repeat are written again; an empty table gives no block; other columns are ignored.
    Ids are ranked by frequency over all documents, ties to the smaller id, so the frequent ones take one byte.
    """
    spark, path = docs.sparkSession, path or default_tokenizer()
    size = len(codec(path).pieces)
    width = 2 if size <= 65536 and (end is None or end < 65536) else 4
    with scratch(spark):
        _write(spark, materialize(token_ids(docs, path, end), "ids", "lz4_raw"), target, size, width, shards)


def _write(spark, rows: DataFrame, target: str, size: int, width: int, shards: int | None) -> None:
    """Ranks and blocks of rows (doc_id, n, ids, h)."""

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), f"<u{width}"), minlength=size)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["id", "n"])

    # No more rows than the vocabulary has ids.
    freq = rows.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    freq = freq.sort_values(["n", "id"], ascending=[False, True])
    by_rank = np.concatenate([freq.id.to_numpy(np.int64), np.setdiff1d(np.arange(size), freq.id.to_numpy(np.int64))])
    rank = np.empty(size, np.uint32)
    rank[by_rank] = np.arange(size, dtype=np.uint32)
    spark.createDataFrame([(bytearray(by_rank.astype("<u4").tobytes()),)], "ids binary").coalesce(1).write.parquet(f"{target}/ranks")

    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(shards, "doc_id", "h", "n").sortWithinPartitions("doc_id", "h", "n", "ids").withColumn("shard", F.spark_partition_id())

    def blocks(batches):
        held: list[tuple] = []
        number = first = 0

        def block():
            nonlocal number, first
            ids = rank[np.frombuffer(b"".join(r[2] for r in held), f"<u{width}")]
            control, data = pack(ids)
            out = pa.RecordBatch.from_arrays([pa.array([held[0][3]], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()), pa.array([[r[0] for r in held]], pa.list_(kind)), pa.array([np.array([r[1] for r in held], "<u4").tobytes()]), pa.array([len(ids)], pa.int64()), pa.array([control]), pa.array([data])], ["shard", "block", "first", "doc_ids", "lengths", "n", "control", "data"])
            number += 1
            first += len(ids)
            held.clear()
            return out

        words = 0
        for batch in batches:
            kind = batch.column(0).type
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                words += row[1]
                if len(held) == BLOCK_DOCS or words > 1 << 20:
                    yield block()
                    words = 0
        if held:
            yield block()

    kind = rows.schema["doc_id"].dataType.simpleString()
    with small_batches(spark):
        ordered.select("doc_id", "n", "ids", "shard").mapInArrow(blocks, f"shard int, block int, first long, doc_ids array<{kind}>, lengths binary, n long, control binary, data binary").write.option("compression", "lz4_raw").parquet(f"{target}/blocks")


def read(spark, target: str, digest: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (array of int), or with `digest` ids_crc32, from token files."""
    lower_batches(spark)
    blocks = spark.read.parquet(f"{target}/blocks")
    by_rank = np.frombuffer(bytes(spark.read.parquet(f"{target}/ranks").first().ids), "<u4")
    # A row for each shard: their number is that of the files.  A block knows its place in its shard, so blocks are not shuffled.
    shards = blocks.groupBy("shard").agg(F.sum("n").alias("n"))
    starts = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for doc_ids, lengths, n, control, data, first in zip(*(c.to_pylist() for c in batch.columns)):
                ids = by_rank[unpack(control, data, n)]
                size = np.frombuffer(lengths, "<u4").astype(np.int64)
                ends = np.cumsum(size)
                if digest:
                    raw = ids.astype("<u4").tobytes()
                    last, name = pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends - size, ends)], pa.int64()), "ids_crc32"
                else:
                    last, name = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int32))), "ids"
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, batch.schema.field(0).type.value_type), pa.array(ends - size + first), pa.array(size), last], ["doc_id", "start", "n_tokens", name])

    placed = blocks.join(F.broadcast(starts), "shard").withColumn("first", F.col("first") + F.col("shard_start"))
    found = placed.select("doc_ids", "lengths", "n", "control", "data", "first")
    return found.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<int>"))
