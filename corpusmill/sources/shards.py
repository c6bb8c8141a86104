"""Token shards: fixed-length sequences of token ids in little-endian binary files."""

from __future__ import annotations

import mmap
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from corpusmill.errors import FormatError

# Names and NumPy types of the token widths.
TOKEN_TYPES = {"uint16-le": "<u2", "uint32-le": "<u4"}


def token_type(largest: int) -> str:
    """The narrowest token type that holds an id."""
    if largest < 0 or largest >= 1 << 32:
        raise FormatError("a token id does not fit into 32 bits")
    return "uint16-le" if largest < 1 << 16 else "uint32-le"


def sequences_of(content, kind: str, length: int) -> np.ndarray:
    """The bytes of a shard as an array of sequences; the bytes are not copied."""
    width = np.dtype(TOKEN_TYPES.get(kind) or _refuse(f"unknown token type {kind}"))
    size = length * width.itemsize
    if size <= 0 or len(content) % size:
        _refuse(f"{len(content)} bytes are no whole number of sequences of {length} tokens")
    return np.frombuffer(content, width).reshape(-1, length)


def _refuse(reason: str):
    raise FormatError(reason)


class ShardView:
    """The sequences of a shard file, read from the disk as they are used; ``view[i]`` is sequence ``i``."""

    def __init__(self, path: Path, kind: str, length: int):
        with path.open("rb") as file:
            content = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ) if path.stat().st_size else b""
        self.rows = sequences_of(content, kind, length)

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, index: int) -> np.ndarray:
        return self.rows[index]


def read_shards(spark: SparkSession, folder: str, kind: str, length: int) -> DataFrame:
    """Rows ``(path, sequence, tokens)`` of all sequences of the shards in a folder."""

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = sequences_of(content, kind, length).astype(np.int64)
                count = len(values)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(count + 1, dtype=np.int32) * length), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * count, pa.string()), pa.array(range(count), pa.int64()), lists], names=["path", "sequence", "tokens"]
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select("path", "content")
    return files.mapInArrow(run, "path string, sequence bigint, tokens array<bigint>")
