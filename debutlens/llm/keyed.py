"""Global values for the keys of text chunks, by a shuffle of packed key arrays.

A chunk of documents reduces its keys to sorted distinct 64-bit numbers and sends them out by key range, one
packed row per range; each range is summed up where its rows meet and answers every chunk with the global
values in the chunk's own key order. Rows are few and a key is sent once per chunk, so no key is hot.
"""

from __future__ import annotations

import math

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed(values: np.ndarray) -> bytes:
    """Any integer array, byte plane by byte plane, compressed; sorted keys go as differences (see `packed_keys`)."""
    head = values.dtype.str.encode().ljust(4)
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return head + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    kind = np.dtype(data[:4].decode().strip())
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[4:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def narrow(values: np.ndarray) -> np.ndarray:
    """The same counts in the least unsigned type that holds them."""
    most = int(values.max()) if len(values) else 0
    return values.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max))


def range_edges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each of the 2**bits ranges of the sorted keys starts, and the end."""
    firsts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(keys, firsts), [len(keys)]])


def plan(docs: DataFrame, text_col: str, chunk_bytes: int, range_bytes: int) -> tuple[int, int]:
    """Chunks, and bits of the ranges, for the texts' whole bytes."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)) + 64)).first()[0] or 0
    return max(1, math.ceil(size / chunk_bytes)), max(1, math.ceil(math.log2(max(2, size / range_bytes))))


def spread(df: DataFrame, key: str, n: int) -> DataFrame:
    """Deals `df` by a key of `n` values to as many tasks at least, so that no task gets more of them as the input grows."""
    return df.repartition(max(n, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), key)


def chunk_of(n_chunks: int) -> Column:
    """Spreads rows over chunks by their place in the input, so that no repeated key gathers."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_chunks)).cast("int")
