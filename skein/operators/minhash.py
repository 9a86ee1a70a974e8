"""Minwise signatures over arrays of 64-bit hashes, in numpy over whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def mix(h: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over uint64 values."""
    x = h.astype(np.uint64, copy=True)
    x += np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(flat: np.ndarray, sizes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(sets, bands) keys: minima of `rows` hash functions each, mixed with the band number; flat holds all sets in order."""
    live = sizes > 0
    first = np.append(0, np.cumsum(sizes[live]))[:-1]
    element = mix(flat.view(np.uint64), 11)
    keys = np.zeros((len(sizes), bands), dtype=np.uint64)
    for b in range(bands if live.any() else 0):
        key = np.full(int(live.sum()), b, dtype=np.uint64)
        for r in range(rows):
            odd = mix(np.array([b * rows + r], dtype=np.uint64), 12)[0] | np.uint64(1)
            low = np.minimum.reduceat((element ^ (odd >> np.uint64(7))) * odd, first)
            key = mix(key ^ low, 13)
        keys[live, b] = key
    return keys


def with_keys(df: DataFrame, sets: str, bands: int, rows: int, out: str = "keys") -> DataFrame:
    """Append the band keys of a column of arrays of bigint; other columns pass through."""
    at = df.columns.index(sets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(at)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            keys = signatures(flat, np.diff(lists.offsets.to_numpy()).astype(np.int64), bands, rows)
            offsets = np.arange(len(keys) + 1, dtype=np.int32) * bands
            yield batch.append_column(out, pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.view(np.int64).ravel())))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{kinds}, `{out}` array<bigint>")
