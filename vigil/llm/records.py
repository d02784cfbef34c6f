"""Token ids as length-delimited binary records, with an offset index.

Documents are range-partitioned by id (rows of one id by their text), or by
their place in the table's files; the task of each range writes one file of
records in that order and one index row per record.  A record is

    length     u64 little-endian: bytes of the payload
    check      u32: masked CRC-32 of the 8 length bytes
    payload    u8 bytes per id (2 or 4), then the ids, little-endian
    check      u32: masked CRC-32 of the payload

(mask: rotate right by 15 bits and add 0xa282ead8).  The index, a Parquet
table, has each record's file, offset and length, so that records can be read
in any order.  A task writes under a name of its own attempt and renames at
the end: a lost executor's task is run again and replaces nothing but itself.

Texts are encoded in chunks that begin where white space follows a character
that is certainly none; the pre-tokenizer never joins characters across such a
place, so each distinct chunk is encoded once by the tokenizers library and
its ids are reused.  Null and empty texts are records of the end id alone;
repeated rows are records of their own; null ids come first; other columns
are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import textkernel as K
from vigil.llm.storage import ROW, Scratch, gives_back, located, qualified, small_batches
from vigil.operators.common import bounded_broadcast

_MASK = 0xA282EAD8
_TABLE_BITS = 21            # places for held chunks
_STORE_IDS = 12_000_000     # ids of held chunks


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = len(payload).to_bytes(8, "little")
    return b"".join([size, masked_crc(size).to_bytes(4, "little"), payload, masked_crc(payload).to_bytes(4, "little")])


def unframe(record: bytes) -> bytes:
    """The payload of one whole record; raises if a length or check is wrong."""
    size = int.from_bytes(record[:8], "little")
    if int.from_bytes(record[8:12], "little") != masked_crc(record[:8]) or len(record) != size + 16:
        raise ValueError("record length is damaged")
    payload = record[12:12 + size]
    if int.from_bytes(record[-4:], "little") != masked_crc(payload):
        raise ValueError("record payload is damaged")
    return payload


def pack_ids(ids: np.ndarray, width: int) -> bytes:
    return bytes([width]) + ids.astype("<u2" if width == 2 else "<u4").tobytes()


def unpack_ids(payload: bytes) -> np.ndarray:
    return np.frombuffer(payload, "<u2" if payload[0] == 2 else "<u4", offset=1)


_ASCII_ALNUM = ~K.byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
_ASCII_MARK = ~K.byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))


def chunk_starts(data: np.ndarray, offsets: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Byte positions where a chunk begins: each non-empty row's start, each
    space or newline after a character that is certainly no white space (ASCII
    21-7E, or a longer character whose lead byte no white space has), and each
    byte of ``marks`` (ASCII marks) after an ASCII letter or digit: the
    pre-tokenizer's letters and digits never go on into either."""
    gap = np.flatnonzero((data == 0x20) | (data == 0x0A))
    gap = gap[gap > 0]
    prev = data[gap - 1]
    ok = (prev > 0x20) & (prev < 0x7F)
    tail = np.flatnonzero((prev & 0xC0) == 0x80)
    at = gap[tail]
    two, three, four = (data[np.maximum(at - j, 0)] for j in (2, 3, 4))
    ok[tail] = ((two >= 0xC3) & (two <= 0xDF)) | (((two & 0xC0) == 0x80) & (
        (three >= 0xE4) & (three <= 0xEF) | ((three & 0xC0) == 0x80) & (four >= 0xF0)))
    rows = offsets[:-1][offsets[:-1] < offsets[1:]]
    begin = np.zeros(len(data) + 1, bool)
    begin[gap[ok]] = True
    begin[rows] = True
    begin[1:-1] |= marks[data[1:]] & _ASCII_ALNUM[data[:-1]]
    return np.flatnonzero(begin[:-1])


class ChunkEncoder:
    """Encodes rows with a tokenizer, each distinct chunk once while it is held.

    The held chunks are a table of 2^21 places addressed by the chunk's hash; a
    new chunk takes the place of the one it meets there."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        # no chunk begins inside an added token, which is found before the pre-tokenizer runs
        self.marks = _ASCII_MARK.copy()
        for token in self.tokenizer.get_added_tokens_decoder().values():
            if set(token.content) & {" ", "\n"} or token.lstrip or token.rstrip:
                raise ValueError(f"added token {token.content!r} takes in white space")
            self.marks[np.frombuffer(token.content.encode(), np.uint8)] = False
        self._forget()

    def _forget(self):
        self.hash = np.zeros(1 << _TABLE_BITS, np.uint64)
        self.at = np.zeros(1 << _TABLE_BITS, np.uint32)       # where the chunk's ids begin in the store
        self.size = np.full(1 << _TABLE_BITS, -1, np.int32)
        self.store = np.zeros(1 << 16, np.uint16 if self.width == 2 else np.uint32)
        self.used = 0

    def _learn(self, hashes: np.ndarray, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch(chunks, add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        total = int(size.sum())
        if self.used + total > len(self.store):
            self.store = np.concatenate([self.store, np.zeros(max(total, len(self.store)), self.store.dtype)])
        self.store[self.used:self.used + total] = np.fromiter(chain.from_iterable(got), self.store.dtype, total)
        at = self.used + np.cumsum(size) - size
        self.used += total
        place = hashes >> np.uint64(64 - _TABLE_BITS)
        self.hash[place], self.at[place], self.size[place] = hashes, at, size
        return at, size

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): the ids of row i are ``ids[first[i]:first[i+1]]``."""
        if self.used > _STORE_IDS:
            self._forget()
        start = chunk_starts(data, offsets, self.marks)
        end = np.append(start[1:], len(data))
        h = K.span_hash(data, end - start)
        place = h >> np.uint64(64 - _TABLE_BITS)
        at, size = self.at[place].astype(np.int64), self.size[place].astype(np.int64)
        new = np.flatnonzero((self.hash[place] != h) | (size < 0))
        if len(new):
            distinct, one, which = np.unique(h[new], return_index=True, return_inverse=True)
            raw = data.tobytes()
            new_at, new_size = self._learn(distinct, [raw[start[i]:end[i]].decode() for i in new[one]])
            at[new], size[new] = new_at[which], new_size[which]
        total = np.append(0, np.cumsum(size))
        ids = self.store[np.repeat(at - total[:-1], size) + np.arange(total[-1])]
        return ids, total[np.searchsorted(start, offsets)]


@lru_cache(maxsize=2)
def _encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


@gives_back
def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Writes one file of records of rows (id, text) and yields their index rows."""
    context = TaskContext.get()
    part, attempt = context.partitionId(), context.taskAttemptId()
    store, root = _filesystem(folder)
    name = f"{root}/records-{part:06d}.bin"
    encoder = _encoder(tokenizer)
    out, at, before = None, 0, 0
    for batch in batches:
        data, off = K.string_parts(batch.column(1))
        for a, b in K.slices(off, 2 * K.SLICE_BYTES):
            ids, first = encoder.encode(data[off[a]:off[b]], off[a:b + 1] - off[a])
            records = [frame(pack_ids(np.append(ids[first[i]:first[i + 1]], end_id), encoder.width)) for i in range(b - a)]
            if out is None:
                out = store.open_output_stream(f"{name}.{attempt}")
            out.write(b"".join(records))
            length = np.array([len(r) for r in records], np.int64)
            n = np.diff(first) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(np.full(b - a, part, np.int32)),
                 pa.array(at + np.cumsum(length) - length), pa.array(length),
                 pa.array(before + np.cumsum(n) - n), pa.array(n)],
                ["id", "part", "offset", "length", "before", "n_ids"])
            at += int(length.sum())
            before += int(n.sum())
    if out is not None:
        out.close()
        store.move(f"{name}.{attempt}", name)


@gives_back
def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Reads the records that index rows point to: (id, part, before, n_tokens, ids_crc32)."""
    store, root = _filesystem(folder)
    part, source = None, None
    try:
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            crc = np.zeros(batch.num_rows, np.int64)
            for i, (p, at, size) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                if p != part:
                    if source is not None:
                        source.close()
                    part, source = p, store.open_input_file(f"{root}/records-{p:06d}.bin")
                ids = unpack_ids(unframe(source.read_at(size, at)))
                n[i], crc[i] = len(ids), zlib.crc32(ids.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(4), pa.array(n), pa.array(crc)],
                                             ["id", "part", "before", "n_tokens", "ids_crc32"])
    finally:
        if source is not None:
            source.close()


def write_records(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  end_id: int = 0, order: list[str] | None = None) -> DataFrame:
    """Writes ``docs`` as record files into ``folder/data`` and returns the
    index (id, part, offset, length, before, n_ids), stored in
    ``folder/index``.  ``before`` counts the ids of the part's earlier records;
    parts are in ascending order of id, or of the columns ``order``."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = qualified(spark, folder)
    by = [F.col(c).alias(f"by{i}") for i, c in enumerate(order or [id_col])]
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *by)
    # rows alike in the order: by a hash of their text, so that they need not meet in one task
    keys = [*(f"by{i}" for i in range(len(by))), F.xxhash64("text")]
    long = T.LongType()
    schema = T.StructType([src.schema["id"], T.StructField("part", T.IntegerType()), T.StructField("offset", long),
                           T.StructField("length", long), T.StructField("before", long), T.StructField("n_ids", long)])
    jvm = spark.sparkContext._jvm
    data = jvm.org.apache.hadoop.fs.Path(f"{folder}/data")
    data.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(data)
    (src.repartitionByRange(*keys).sortWithinPartitions(*keys, "text").select("id", "text")
     .mapInArrow(partial(_write, folder=f"{folder}/data", tokenizer=tokenizer, end_id=end_id), schema)
     .write.parquet(f"{folder}/index"))
    return spark.read.schema(schema).parquet(f"{folder}/index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every record of the index, from the
    files; ``start`` counts the ids of all records before it."""
    folder = qualified(index.sparkSession, folder)
    rows = index.select("id", "part", "offset", "length", "before")
    schema = T.StructType([rows.schema["id"], rows.schema["part"], rows.schema["before"],
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    # one row per file
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    base = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("base"))
    return (rows.mapInArrow(partial(_read, folder=f"{folder}/data"), schema).join(bounded_broadcast(base), "part")
            .select("id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))


def write_and_read(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
                   table_order: bool = False) -> DataFrame:
    """Records in a new folder of the shared storage, read back: (id, start,
    n_tokens, ids_crc32).  By id, or in the order of the table's files."""
    run = Scratch(docs.sparkSession, "records")
    index = write_records(located(docs, run) if table_order else docs, run.root, tokenizer, id_col, text_col, end_id, ROW if table_order else None)
    return read_records(index, run.root).withColumnRenamed("id", id_col)
