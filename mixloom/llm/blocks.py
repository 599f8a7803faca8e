"""Documents in blocks, and arrays in packets.

Operators that look at every word ship far less when a block of documents, a few MB of text,
is the unit that asks and is answered: what repeats inside a block is sent once, and answers
come back by block. A staged block is a row ``(block, payload)`` in the shared folder; its
number is fixed when it is written, so every later pass sees the same blocks whatever happens
to executors. Packets are compressed arrays in a binary column, for rows that would cost
more than what they say.
"""

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.storage import staged

BLOCK_BYTES = 2 << 20
#: The upper bits of a block's number are those of the partition that wrote it.
BLOCK_BITS = 32


#: Packets of at least this many bytes are compressed; smaller ones cost a few bytes an array.
COMPRESSED_FROM = 512
HEAD = struct.Struct("<cI")


def pack(*items: np.ndarray | bytes | None) -> bytes:
    """One packet of flat arrays, byte strings and absent items. A packet of a few entries
    stays small, as there are many of those where buckets are many."""
    out = bytearray()
    for item in items:
        if item is None:
            out += HEAD.pack(b"-", 0)
        elif isinstance(item, bytes):
            out += HEAD.pack(b"=", len(item)) + item
        else:
            data = np.ascontiguousarray(item).tobytes()
            out += HEAD.pack(item.dtype.char.encode(), len(data)) + data
    if len(out) < COMPRESSED_FROM:
        return b"\0" + bytes(out)
    return b"\1" + zstandard.ZstdCompressor(level=1).compress(bytes(out))


def unpack(packet: bytes) -> tuple:
    """The items of a packet; its arrays are read-only."""
    data = packet[1:] if packet[:1] == b"\0" else zstandard.ZstdDecompressor().decompress(packet[1:])
    items, at = [], 0
    while at < len(data):
        kind, size = HEAD.unpack_from(data, at)
        at += HEAD.size
        body = data[at : at + size]
        items.append(None if kind == b"-" else body if kind == b"=" else np.frombuffer(body, kind.decode()))
        at += size
    return tuple(items)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """The size of a text column, for choosing how many buckets share the work."""
    return docs.agg(F.sum(F.octet_length(F.col(column).cast("string")))).first()[0] or 0


def sub_batches(batches: Iterator[pa.RecordBatch], text_at: int, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows again, in runs of at least ``size`` bytes of text (or one input batch); one
    row is never cut. Small input batches are put together."""
    held, bytes_held = [], 0
    for batch in batches:
        column = batch.column(text_at)
        lengths = np.diff(np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)) if len(column) else []
        begun = 0
        for at, length in enumerate(lengths):
            bytes_held += int(length)
            if bytes_held >= size:
                held.append(batch.slice(begun, at + 1 - begun))
                yield _joined(held)
                held, bytes_held, begun = [], 0, at + 1
        if begun < len(lengths):
            held.append(batch.slice(begun))
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _to_payload(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_payload(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_next_batch()


def stage_blocks(docs: DataFrame, text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Write ``docs`` as blocks of about ``block_bytes`` of text, in the order they are read,
    without a shuffle, and read them back."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << BLOCK_BITS
        for batch in sub_batches(batches, at, block_bytes):
            columns = [pa.array([number], pa.int64()), pa.array([_to_payload(batch)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "payload"])
            number += 1

    return staged(docs.mapInArrow(run, "block long, payload binary"), "blocks")


class Words:
    """The words of some texts: ``ids`` into ``dictionary``, and ``counts`` per text.

    Words are runs of other characters than ASCII white space; those bytes occur in UTF-8 as
    themselves only, so the bytes are split as they are.
    """

    def __init__(self, texts: list[bytes | None], lower: bool = False):
        flat, counts = [], []
        for text in texts:
            words = text.split() if text else []
            if lower:
                words = text.translate(LOWER).split() if text else []
            flat += words
            counts.append(len(words))
        encoded = pa.array(flat, pa.binary()).dictionary_encode()
        self.ids = encoded.indices.to_numpy(zero_copy_only=False)
        self.dictionary = encoded.dictionary.to_pylist()
        self.counts = np.array(counts, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.text_of = np.repeat(np.arange(len(counts)), self.counts)

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit lanes of a strong hash, by word of the dictionary."""
        lanes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.dictionary)), ">u8").astype(np.uint64)
        return lanes[::2], lanes[1::2]

    def words(self, begin: int, end: int) -> list[bytes]:
        return [self.dictionary[i] for i in self.ids[begin:end]]


#: Lower case for A to Z alone.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def mix(x: np.ndarray) -> np.ndarray:
    """An even spread of 64-bit numbers, one to one (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs_hash(lane: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every run of ``length`` consecutive entries."""
    n = max(0, len(lane) - length + 1)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = out * np.uint64(0x9E3779B97F4A7C15) + lane[k : k + n]
    return mix(out)


def by_bucket(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions in their order) for every bucket that occurs."""
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for number in np.flatnonzero(ends[1:] > ends[:-1]):
        yield int(number), order[ends[number] : ends[number + 1]]
