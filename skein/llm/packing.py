"""Problem 9: filling containers of fixed capacity along a space-filling curve.

Every text gets a hashed vector (a signed random projection of its distinct token ids), which is
projected to a few dimensions, scaled to integers and ordered by its Hilbert key. Rows are
range-partitioned by that key, so neighbours on the curve meet in one task, and each task packs
its stretch of the curve by best-fit decreasing inside windows. A container that is still open at
the end of its window stays open for the next window only: what a container holds lies within two
windows of the curve.

Defined results: null and empty texts are items of size 0 and still get a container; an item above
the capacity is split into full pieces and a rest, the only items that are split; equal keys are
ordered by id and piece, so ties and repeated rows have one result; an empty table gives no rows.
Only ids and sizes travel in the shuffle, never the texts.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm._common import mix, spread, stored
from skein.llm.tokens import VOCABULARY, encoder

CAPACITY = 2048
#: Dimensions of the projection and bits of each: the key has their product in bits.
DIMENSIONS, BITS = 4, 12
#: Items that are packed together; open containers pass to the next window and no further.
WINDOW = 512


@lru_cache(maxsize=2)
def directions(n_ids: int, dims: int) -> np.ndarray:
    """Signs of each token id in each dimension, from a hash: +1 or -1."""
    h = mix(np.arange(n_ids, dtype=np.uint64), 9)
    return np.stack([((h >> np.uint64(7 * d)) & np.uint64(1)).astype(np.float64) * 2 - 1 for d in range(dims)], axis=1)


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of integer points (rows), by the transposed-axes method over whole columns."""
    x = [points[:, d].astype(np.int64).copy() for d in range(points.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for d in range(n):
            inverted = (x[d] & q) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[d]) & p)
            x[0] ^= np.where(inverted, p, swap)
            if d:
                x[d] ^= swap
        q >>= 1
    for d in range(1, n):
        x[d] ^= x[d - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(n):
            key = (key << 1) | (((x[d] ^ t) >> b) & 1)
    return key


def curve_keys(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hilbert key of each text, from its distinct token ids."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    pair = np.unique((doc << 32) | ids.astype(np.int64))
    doc, token = pair >> 32, pair & 0xFFFFFFFF
    table = directions(1 << 17, DIMENSIONS)
    counts = np.maximum(1, np.bincount(doc, minlength=len(sizes)))
    vec = np.stack([np.bincount(doc, weights=table[token, d], minlength=len(sizes)) for d in range(DIMENSIONS)], axis=1)
    unit = vec / np.sqrt(counts)[:, None]
    grid = np.clip((1 + np.tanh(unit / 2)) / 2 * (1 << BITS), 0, (1 << BITS) - 1)
    return hilbert(grid.astype(np.int64))


class Packer:
    """Best-fit decreasing inside windows of a stream; open containers pass to the next window only."""

    def __init__(self, capacity: int):
        self.capacity, self.made, self.before = capacity, 0, 0
        self.free: list[tuple[int, int]] = []  # (room, container), sorted

    def window(self, sizes: np.ndarray) -> np.ndarray:
        """Container number of each item of one window."""
        out = np.zeros(len(sizes), dtype=np.int64)
        self.free, self.before = [f for f in self.free if f[1] >= self.before], self.made
        for k in np.argsort(-sizes, kind="stable"):
            need = int(sizes[k])
            i = bisect_left(self.free, (need, -1)) if need < self.capacity else len(self.free)
            if i == len(self.free):
                room, box = self.capacity, self.made
                self.made += 1
            else:
                room, box = self.free.pop(i)
            out[k] = box
            if room > need or need == 0:
                insort(self.free, (room - need, box))
        return out

    def take(self, sizes: np.ndarray, window: int = WINDOW) -> np.ndarray:
        return np.concatenate([self.window(sizes[at : at + window]) for at in range(0, len(sizes), window)] or [np.zeros(0, np.int64)])


def pack(sizes: np.ndarray, capacity: int, window: int = WINDOW) -> np.ndarray:
    """Container number of each item, in order of the curve."""
    return Packer(capacity).take(sizes, window)


def spans(keys: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """Distance on the curve between the first and the last item of each container with more than one item."""
    order = np.lexsort((keys, boxes))
    k, first = keys[order], np.flatnonzero(np.append(True, np.diff(boxes[order]) != 0))
    last = np.append(first[1:], len(k)) - 1
    return (k[last] - k[first])[last > first]


def pack_documents(df: DataFrame, id_col: str, text_col: str, capacity: int = CAPACITY, path: str = VOCABULARY) -> DataFrame:
    """(id, piece, n_tokens, container_id): the container of every text or piece of one."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            ids, sizes = bpe.encode(batch.column(1).to_pylist())
            keys = curve_keys(ids, sizes)
            pieces = np.maximum(1, -(-sizes // capacity))
            row = np.repeat(np.arange(len(sizes)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            held = np.minimum(capacity, sizes[row] - piece * capacity)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(held.astype(np.int32)), pa.array(keys[row])],
                names=["id", "piece", "n_tokens", "curve_key"],
            )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 40
        packer = Packer(capacity)
        for batch in batches:
            boxes = packer.take(batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(boxes + task)], names=["id", "piece", "n_tokens", "container_id"])

    pick = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = pick.schema[0].dataType.simpleString()
    # written once: the range bounds are sampled from it, and the texts are not encoded again for that
    items = stored(spread(pick).mapInArrow(measure, f"id {kind}, piece int, n_tokens int, curve_key bigint"), "items")
    ordered = items.repartitionByRange("curve_key", "id", "piece").sortWithinPartitions("curve_key", "id", "piece")
    return ordered.mapInArrow(fill, f"id {kind}, piece int, n_tokens int, container_id bigint").withColumnRenamed("id", id_col)
