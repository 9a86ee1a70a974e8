"""Problem 8: byte-level BPE over a whole corpus with batched numpy merge rounds.

The symbols of all distinct words of an Arrow batch lie in one flat array. In each round every
pair of neighbours is looked up by binary search in the sorted pair keys, the lowest rank of each
word is merged everywhere in that word, and words without a mergeable pair leave the active set.

Defined results: null and empty texts give an empty list; special-token strings in a text are
ordinary text; texts of any length are encoded whole; repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm._common import spread

#: Where the tokenizer files lie; a parameter of every function here.
VOCABULARY = os.environ.get("SKEIN_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the published pre-tokenisation pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Distinct words that a Python worker remembers between batches; only speed depends on it.
REMEMBERED = 200_000


class NumpyBpe:
    """Encoder for one vocabulary of byte strings with ranks."""

    def __init__(self, path: str, pattern: str = PATTERN):
        import regex

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.split = regex.compile(pattern).findall
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.bits = int(max(ranks.values())).bit_length()
        keys, merged = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append((a << self.bits) | b)
                    merged.append(rank)
        order = np.argsort(keys)
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.merged = np.array(merged, dtype=np.int64)[order]
        self.whole = ranks
        self.seen: dict[str, int] = {}
        self.flat = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(1, dtype=np.int64)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one flat array, and the length of each word's part."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        sym = self.byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        none = np.iinfo(np.int64).max
        while len(sym):
            key = (sym[:-1] << self.bits) | sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.merged[at], none)
            rank = np.append(rank, none)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(first, len(word)))
            low = np.repeat(np.minimum.reduceat(rank, first), size)
            ended = low == none
            if ended.any():
                done.append((sym[ended], word[ended]))
                live = ~ended
                sym, word, rank, low = sym[live], word[live], rank[live], low[live]
                if not len(sym):
                    break
            hit = rank == low
            # overlapping hits (a a a): every second one of a run counts, from the left
            run = np.flatnonzero(hit & ~np.append(False, hit[:-1]))
            if len(run) != hit.sum():
                start = np.zeros(len(hit), dtype=np.int64)
                start[run] = run
                start = np.maximum.accumulate(start)
                hit &= (np.arange(len(hit)) - start) % 2 == 0
            sym = np.where(hit, low, sym)
            keep = ~np.append(False, hit[:-1])
            sym, word = sym[keep], word[keep]
        sym = np.concatenate([s for s, _ in done]) if done else sym
        word = np.concatenate([w for _, w in done]) if done else word
        order = np.argsort(word, kind="stable")
        return sym[order].astype(np.int32), np.bincount(word, minlength=len(words))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one flat array, and the number of ids of each text."""
        if len(self.seen) > REMEMBERED:
            self.seen, self.flat, self.starts = {}, np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
        seen, fresh, index, counts = self.seen, [], [], []
        for text in texts:
            parts = self.split(text) if text else ()
            counts.append(len(parts))
            for w in parts:
                k = seen.get(w)
                if k is None:
                    k = seen[w] = len(seen)
                    fresh.append(w)
                index.append(k)
        if fresh:
            raw = [w.encode("utf-8", "surrogatepass") for w in fresh]
            ids, sizes = self.merge(raw)
            self.flat = np.concatenate([self.flat, ids])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        which = np.array(index, dtype=np.int64)
        begin, size = self.starts[which], self.starts[which + 1] - self.starts[which]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        take = np.arange(total) + np.repeat(begin - (ends - size), size)
        per_word = np.append(0, ends)
        bounds = np.append(0, np.cumsum(counts)).astype(np.int64)
        return self.flat[take], np.diff(per_word[bounds])


@lru_cache(maxsize=2)
def encoder(path: str) -> NumpyBpe:
    """One encoder per Python worker and vocabulary."""
    return NumpyBpe(path)


def encode_texts(df: DataFrame, id_col: str, text_col: str, path: str = VOCABULARY, out: str = "ids") -> DataFrame:
    """(id, ids) of every row; extra columns are not read, whatever their names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            ids, sizes = bpe.encode(batch.column(1).to_pylist())
            offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[id_col, out])

    pick = df.select(F.col(id_col), F.col(text_col))
    kind = pick.schema[0].dataType.simpleString()
    return spread(pick).mapInArrow(run, f"`{id_col}` {kind}, `{out}` array<int>")
