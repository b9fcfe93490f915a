"""Questions and answers between blocks of documents and buckets of keys.

Operators that look up something about nearly every position of every text
would shuffle a row per position. Here documents are gathered into blocks of a
bounded size first. A block asks about its sorted distinct keys in one packed
message per key bucket, and the bucket answers with one value per key, in the
same order. Each block names a key once, so a key that is frequent everywhere
costs a bucket one entry per block and no bucket is hot.

The blocks are a table bucketed by block number in the shared folder, so that
joining the answers to their blocks does not move the texts again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyferry.llm.common import stored
from keyferry.session import fresh_path, remove_path, unique_name

MESSAGE = "bucket int, block bigint, payload binary"


def squeeze(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes, behind their width."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes() if len(values) else b""
    return values.dtype.char.encode() + zstandard.ZstdCompressor(level=1).compress(planes)


def expand(packed: bytes) -> np.ndarray:
    kind = np.dtype(packed[:1].decode())
    planes = zstandard.ZstdDecompressor().decompress(packed[1:])
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, -1).T).view(kind).reshape(-1)


def squeeze_keys(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys as packed differences."""
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def expand_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(expand(packed), dtype=np.uint64)


def join_parts(parts: list[bytes]) -> bytes:
    """Several byte strings as one, with their lengths."""
    return np.array([len(parts), *map(len, parts)], np.int64).tobytes() + b"".join(parts)


def split_parts(joined: bytes) -> list[bytes]:
    n = int(np.frombuffer(joined[:8], np.int64)[0])
    sizes = np.frombuffer(joined[8: 8 * (n + 1)], np.int64)
    ends = 8 * (n + 1) + np.cumsum(sizes)
    return [joined[e - s: e] for s, e in zip(sizes, ends)]


class Numbers:
    """Block numbers that no other task of the job gives."""

    def __init__(self) -> None:
        self.next = TaskContext.get().partitionId() << 32

    def take(self) -> int:
        self.next += 1
        return self.next - 1


class BlockTable:
    """Blocks in a bucketed table; `answered` joins messages to them without moving the blocks."""

    def __init__(self, blocks: DataFrame, tag: str) -> None:
        self.spark = blocks.sparkSession
        self.name = unique_name("kf_blocks")
        self.path = fresh_path(self.spark, tag)
        # No fewer buckets than shuffle partitions, or Spark would rather shuffle the table.
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        blocks.write.format("parquet").option("path", self.path).bucketBy(self.buckets, "block").sortBy("block").saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def answered(self, *answers: DataFrame) -> DataFrame:
        """The blocks with one array column a0, a1, ... of (bucket, payload) per message table."""
        df = self.read()
        for i, a in enumerate(answers):
            own = a.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "payload"))).alias(f"a{i}"))
            df = df.join(own, "block", "left")
        return df

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove_path(self.spark, self.path)


def ask(messages: DataFrame, answer: Callable[[pd.DataFrame], pd.DataFrame], tag: str) -> DataFrame:
    """Gather messages by bucket and let `answer` make answer messages from all of one bucket."""
    return stored(messages.groupBy("bucket").applyInPandas(answer, MESSAGE), tag)


def messages(rows: Iterator[tuple[int, int, bytes]], size: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int, bytes]] = []

    def batch() -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[0] for r in held], pa.int32()), pa.array([r[1] for r in held], pa.int64()),
                                pa.array([r[2] for r in held], pa.binary())], names=["bucket", "block", "payload"])

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held = []
    if held:
        yield batch()


_EDGES: dict[int, np.ndarray] = {}


def _edges(buckets: int) -> np.ndarray:
    if buckets not in _EDGES:
        _EDGES[buckets] = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    return _EDGES[buckets]


def dealt(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, its keys) for sorted uint64 keys that are spread evenly; buckets are ranges."""
    bounds = np.concatenate([[0], np.searchsorted(keys, _edges(buckets)), [len(keys)]])
    for b in np.flatnonzero(np.diff(bounds)).tolist():
        yield b, keys[bounds[b]:bounds[b + 1]]
