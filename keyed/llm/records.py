"""Token ids as files of length-delimited binary records, with an offset index for shuffled reads.

A record is: payload length (8 bytes), masked CRC-32 of those 8 bytes (4), payload, masked CRC-32 of the payload (4); all
little-endian. A payload is: 1 if there is a document id, else 0 (1 byte), the id (8, signed), bytes per token id (1: 2 or 4),
and the token ids, unsigned. The mask rotates the checksum right by 15 bits and adds 0xA282EAD8, so that a checksum stored
within checksummed data does no harm. File k holds the k-th range of document ids, in ascending order, nulls first.
"""

from __future__ import annotations

import functools
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyed.llm.common import ready, shuffle_partitions
from keyed.llm.tokens import encoder

_HEAD = struct.Struct("<QI")
_FRONT = struct.Struct("<BqB")
INDEX = "part long, file string, doc_id long, offset long, bytes long, n_tokens long"
_INDEX = pa.schema([("part", pa.int64()), ("file", pa.string()), ("doc_id", pa.int64()), ("offset", pa.int64()), ("bytes", pa.int64()), ("n_tokens", pa.int64())])


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def payload(doc_id: int | None, ids: np.ndarray) -> bytes:
    width = 2 if ids.max(initial=0) < 1 << 16 else 4
    return _FRONT.pack(doc_id is not None, doc_id or 0, width) + ids.astype(f"<u{width}").tobytes()


def parse(data: bytes) -> tuple[int | None, np.ndarray]:
    some, doc_id, width = _FRONT.unpack_from(data)
    return (doc_id if some else None), np.frombuffer(data, f"<u{width}", offset=_FRONT.size).astype("<u4")


def read_record(source) -> bytes | None:
    """The next payload, or None at the end. A damaged record raises."""
    head = source.read(_HEAD.size)
    if not head:
        return None
    length, check = _HEAD.unpack(head)
    if masked(head[:8]) != check:
        raise ValueError("damaged record length")
    data = source.read(length)
    if len(data) != length or masked(data) != struct.unpack("<I", source.read(4))[0]:
        raise ValueError("damaged record")
    return data


@functools.lru_cache(16)
def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write_records(docs: DataFrame, folder: str, tokenizer: str, end: int, doc_id: str = "doc_id", text: str = "text", files: int | None = None) -> DataFrame:
    """Encodes whole texts, adds the id ``end`` to each, writes the files and then the index; returns the index.

    A range shuffle on the document id (the text's hash within a repeated id) puts ascending ids into ascending files; each
    task sorts its range and streams it into one file. A task that runs again writes a file of another name, and the index,
    which Spark commits as a whole, names the file of the attempt that counts. ``folder`` must be a path or URI that all
    executors reach. Null or empty texts give one token; null ids come first; an empty table gives an empty index.
    """
    spark = ready(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    hashed = rows.withColumn("h", F.xxhash64("text"))
    n = files or shuffle_partitions(spark)
    ordered = hashed.repartitionByRange(n, F.asc_nulls_first("doc_id"), "h").sortWithinPartitions(F.asc_nulls_first("doc_id"), "h").drop("h")
    tail = np.array([end], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex[:8]}.rec"
        out, at = None, 0
        for batch in batches:
            if out is None:
                store, base = _filesystem(folder)
                store.create_dir(f"{base}/records", recursive=True)
                out = store.open_output_stream(f"{base}/records/{name}")
            found = []
            for d, ids in zip(batch.column(0).to_pylist(), encoder(tokenizer).encode(batch.column(1).to_pylist()), strict=True):
                ids = np.frombuffer(ids + tail, "<u4")
                data = frame(payload(d, ids))
                out.write(data)
                found.append((part, name, d, at, len(data), len(ids)))
                at += len(data)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), _INDEX.types, strict=True)], schema=_INDEX)
        if out is not None:
            out.close()

    ordered.mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return index(spark, folder)


def index(spark: SparkSession, folder: str) -> DataFrame:
    return ready(spark).read.schema(INDEX).parquet(f"{folder}/index")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Streams every file and checks every record: doc_id, start (ids of all documents before it), ids (packed 32-bit)."""
    totals = index(spark, folder).groupBy("part", "file").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("records"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = totals.select("file", "records", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    dealt = files.repartition(shuffle_partitions(spark), "file")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, base = _filesystem(folder)
                start, lot, n, size = row["start"], [], 0, 0
                with store.open_input_stream(f"{base}/records/{row['file']}", buffer_size=1 << 20) as source:
                    while (data := read_record(source)) is not None:
                        doc_id, ids = parse(data)
                        lot.append((doc_id, start, ids.tobytes()))
                        start += len(ids)
                        n += 1
                        size += 4 * len(ids)
                        if size > 4 << 20:
                            yield _ids_batch(lot)
                            lot, size = [], 0
                if n != row["records"]:
                    raise ValueError(f"{row['file']} has {n} records, not {row['records']}")
                if lot:
                    yield _ids_batch(lot)

    return dealt.mapInArrow(read, "doc_id long, start long, ids binary")


def _ids_batch(lot: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lot, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["doc_id", "start", "ids"])


def read_at(rows: DataFrame, folder: str) -> DataFrame:
    """Random access: the records of rows of the index, in whatever order and partitions these rows have."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lot, opened = [], {}
            for row in batch.to_pylist():
                store, base = _filesystem(folder)
                if row["file"] not in opened:
                    opened[row["file"]] = store.open_input_file(f"{base}/records/{row['file']}")
                opened[row["file"]].seek(row["offset"])
                doc_id, ids = parse(read_record(opened[row["file"]]))
                lot.append((doc_id, row["offset"], ids.tobytes()))
            for f in opened.values():
                f.close()
            if lot:
                yield _ids_batch(lot)

    return rows.mapInArrow(read, "doc_id long, start long, ids binary").withColumnRenamed("start", "offset")


def digests(records: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the packed ids."""
    return records.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
