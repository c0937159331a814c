"""Sorted-string-table shards of token ids, keyed by document.

A shard, integers little-endian:

    data blocks      entries in ascending key order: shared u8, rest u8, length u32, the key's last `rest` bytes, value
    index            for each block: first key (8 bytes, big-endian), offset u64, size u32
    Bloom filter     bits
    footer           index offset u64, blocks u32, Bloom offset u64, bytes u32, hashes u8, entries u64, ids u64, magic 8 bytes

A key is the document's id with its sign bit turned, 8 bytes big-endian, so that bytes sort as numbers do; null ids are not stored (doc_id is the key). shared says how many bytes a key has in common with the one before it in its block. A value is packed by narrow(). Only the block that the sparse index points to need be read for a lookup.
"""

from __future__ import annotations

import bisect
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .common import MOST_PARTS_SENT, MOST_SENT, materialize, scratch, slices, text_rows
from .packing import narrow, widen
from .tokens import Library, tool

MAGIC = b"TERRSST1"
FOOTER = struct.Struct("<QIQIBQQ8s")
ENTRY = struct.Struct("<BBI")
INDEX = struct.Struct("<8sQI")
MANIFEST = T.StructType([T.StructField(n, T.StringType() if n == "path" else T.LongType()) for n in ("part", "shard", "path", "first_id", "last_id", "entries", "ids", "bytes")])
ROWS = T.StructType([T.StructField("path", T.StringType()), T.StructField("doc_id", T.LongType()), T.StructField("before", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])


def key_of(doc_id: int) -> bytes:
    return (doc_id + (1 << 63)).to_bytes(8, "big")


def id_of(key: bytes) -> int:
    return int.from_bytes(key, "big") - (1 << 63)


def places(key: bytes, hashes: int, bits: int) -> Iterator[int]:
    h = xxhash.xxh3_128_intdigest(key)
    return ((h + i * ((h >> 64) | 1)) % bits for i in range(hashes))


class ShardWriter:
    def __init__(self, block: int, bits_a_key: int = 10, hashes: int = 7):
        self.block, self.bits_a_key, self.hashes = block, bits_a_key, hashes
        self.out, self.start, self.index, self.keys, self.ids, self.last = bytearray(), 0, [], [], 0, b""

    def add(self, doc_id: int, packed: bytes, n: int) -> None:
        key = key_of(doc_id)
        if len(self.out) - self.start >= self.block or not self.index:
            self.end_block()
            self.index.append([key, len(self.out), 0])
            self.start, self.last = len(self.out), b""
        shared = next((i for i, (a, b) in enumerate(zip(key, self.last, strict=False)) if a != b), min(8, len(self.last)))
        self.out += ENTRY.pack(shared, 8 - shared, len(packed)) + key[shared:] + packed
        self.keys.append(key)
        self.ids += n
        self.last = key

    def end_block(self) -> None:
        if self.index:
            self.index[-1][2] = len(self.out) - self.index[-1][1]

    def finish(self) -> bytes:
        self.end_block()
        at = len(self.out)
        for entry in self.index:
            self.out += INDEX.pack(*entry)
        bits = max(64, self.bits_a_key * len(self.keys) + 7 & ~7)
        bloom, bloom_at = bytearray(bits // 8), len(self.out)
        for key in self.keys:
            for b in places(key, self.hashes, bits):
                bloom[b >> 3] |= 1 << (b & 7)
        self.out += bloom + FOOTER.pack(at, len(self.index), bloom_at, len(bloom), self.hashes, len(self.keys), self.ids, MAGIC)
        return bytes(self.out)


class Shard:
    """Reads a shard: its bytes (or a memory map of them), or an open file, of which only footer, index, filter and the blocks asked for are read."""

    def __init__(self, data):
        if hasattr(data, "read_at"):
            total, self.fetch = data.size(), lambda at, n: data.read_at(n, at)
        else:
            held = memoryview(data)
            total, self.fetch = len(held), lambda at, n: held[at : at + n]
        self.index_at, self.blocks, bloom_at, bloom_bytes, self.hashes, self.entries, self.ids, magic = FOOTER.unpack(self.fetch(total - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard")
        self.index = list(INDEX.iter_unpack(self.fetch(self.index_at, self.blocks * INDEX.size)))
        self.bloom = self.fetch(bloom_at, bloom_bytes)

    def block(self, i: int) -> Iterator[tuple[bytes, bytes]]:
        _, start, size = self.index[i]
        held, at, last = self.fetch(start, size), 0, b""
        while at < size:
            shared, rest, n = ENTRY.unpack_from(held, at)
            at += ENTRY.size
            last = last[:shared] + bytes(held[at : at + rest])
            at += rest
            yield last, bytes(held[at : at + n])
            at += n

    def scan(self) -> Iterator[tuple[int, bytes]]:
        for i in range(self.blocks):
            for key, packed in self.block(i):
                yield id_of(key), widen(packed)

    def may_have(self, doc_id: int) -> bool:
        return all(self.bloom[b >> 3] >> (b & 7) & 1 for b in places(key_of(doc_id), self.hashes, 8 * len(self.bloom)))

    def find(self, doc_id: int) -> list[bytes]:
        """The ids of every row of a document, by Bloom filter and binary search of the block index."""
        key = key_of(doc_id)
        if not self.may_have(doc_id):
            return []
        i = max(0, bisect.bisect_left(self.index, key, key=lambda e: e[0]) - 1)
        found = []
        while i < self.blocks and self.index[i][0] <= key:
            found += [widen(v) for k, v in self.block(i) if k == key]
            i += 1
        return found


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def write(docs: DataFrame, tokenizer: str, cut: str, end_id: int, folder: str, shard_bytes: int = 16 << 20, block_bytes: int = 16 << 10) -> DataFrame:
    """Encodes every whole text, end_id last, and writes shards into folder, ascending by doc_id within and across shards. Returns the manifest: a row for each shard.

    Texts are dealt out and sorted by doc_id, then encoded and written in one go by each task. A task's shards have names of their own, and the manifest lists those of the attempt that ended well, so retries and speculation do no harm.
    Null and empty texts: the end id alone. Repeated ids: each row is an entry, in the order of their texts. Rows with null ids have no key and are left out. An empty table: an empty manifest.
    """
    end = np.uint32(end_id).tobytes()
    sent = text_rows(docs).where(F.col("doc_id").isNotNull()).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib, part, shard, out, rows = tool(Library, tokenizer, cut), TaskContext.get().partitionId(), 0, None, []
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)

        def close(first: int, last: int) -> None:
            nonlocal shard
            data, name = out.finish(), f"part-{part:06d}-{shard:05d}-{uuid.uuid4().hex}.sst"
            with fs.open_output_stream(f"{base}/{name}") as f:
                f.write(data)
            rows.append((part, shard, f"{folder}/{name}", first, last, len(out.keys), out.ids, len(data)))
            shard += 1

        first = last = 0
        for batch in batches:
            for piece in slices(batch):
                for doc, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), strict=True):
                    if out is None:
                        out, first = ShardWriter(block_bytes), doc
                    ids = lib.encode(text) + end
                    out.add(doc, narrow(ids), len(ids) // 4)
                    last = doc
                    if len(out.out) >= shard_bytes:
                        close(first, last)
                        out = None
        if out is not None:
            close(first, last)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string() if i == 2 else pa.int64()) for i in range(8)], names=MANIFEST.names)

    return materialize(sent.mapInArrow(run, MANIFEST), "manifest")


def read(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all entries before it), n_tokens and ids (binary, little-endian unsigned 32-bit) of every entry, read from the shards that the manifest lists. An empty manifest: no rows."""
    order = Window.orderBy("part")
    totals = manifest.groupBy("part").agg(F.sum("ids").alias("n")).select("part", (F.sum("n").over(order) - F.col("n")).alias("base"))
    inside = F.sum("ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("ids")
    place = manifest.withColumn("inside", inside).join(totals, "part").select(F.element_at(F.split("path", "/"), -1).alias("name"), (F.col("base") + F.col("inside")).alias("base"))
    if manifest.count() <= MOST_PARTS_SENT // 10:
        place = F.broadcast(place)
    # of an empty table no task made the folder
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    files = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content").join(place, "name").select("name", "base", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base, content in zip(*batch.columns, strict=True):
                rows, at, size = [], base.as_py(), 0
                for doc, ids in Shard(content.as_buffer()).scan():
                    rows.append((name.as_py(), doc, at, len(ids) // 4, ids))
                    at += len(ids) // 4
                    size += len(ids)
                    if size > 4 << 20:
                        yield rows_batch(rows)
                        rows, size = [], 0
                yield rows_batch(rows)

    return files.mapInArrow(run, ROWS).withColumnRenamed("before", "start").drop("path")


def lookup(manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, n_tokens and ids of every entry whose document wanted (column doc_id) names, for as many ids as sent() would broadcast; for more, join read().

    The manifest leaves the shards whose range holds a wanted id; of each, a task reads footer, index and filter, and the blocks that the index points to. Ids that no shard has, null ids and repeats in wanted give no rows of their own. Repeated ids in the table: each entry. Rows come in no order.
    """
    named = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct().limit(MOST_SENT + 1).toPandas()["doc_id"]
    if len(named) > MOST_SENT:
        raise ValueError(f"more than {MOST_SENT} ids: join read() instead")
    keys = manifest.sparkSession.sparkContext.broadcast(np.sort(named.to_numpy(np.int64)))
    schema = T.StructType([f for f in ROWS.fields if f.name in ("doc_id", "n_tokens", "ids")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first, last in zip(*(batch.column(c).to_pylist() for c in ("path", "first_id", "last_id")), strict=True):
                some = keys.value[np.searchsorted(keys.value, first) : np.searchsorted(keys.value, last, "right")].tolist()
                if not some:
                    continue
                fs, at = filesystem(path)
                with fs.open_input_file(at) as file:
                    shard = Shard(file)
                    for doc in some:
                        if found := shard.find(doc):
                            yield pa.RecordBatch.from_arrays([pa.array([doc] * len(found), pa.int64()), pa.array([len(x) // 4 for x in found], pa.int64()), pa.array(found, pa.binary())], names=schema.names)

    # a shard is megabytes of work and a short row here: rows are dealt out anew
    return manifest.select("path", "first_id", "last_id").repartition("path").mapInArrow(run, schema)


def rows_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=ROWS.names)


def round_trip(docs: DataFrame, tokenizer: str, cut: str = "words", end_id: int = 2) -> DataFrame:
    spark = docs.sparkSession
    folder = scratch(spark, "shards")
    return read(spark, write(docs, tokenizer, cut, end_id, folder), folder)


def digests(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
