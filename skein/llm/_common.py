"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators.minhash import mix

__all__ = ["WORD", "WordRuns", "cut", "drop", "jaccard", "listed", "mix", "scratch", "shared_dir", "spread", "stored", "table", "with_sequences"]

#: A word is a maximal run of letters and numeric characters, after lower-casing.
WORD = r"[\p{L}\p{N}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the test data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only in local mode where none is configured (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="skein-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Materialise into the shared checkpoint folder and cut the lineage."""
    spark = df.sparkSession
    where = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(where)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's own part of the shared folder, which is removed when the driver ends."""
    own = f"{shared_dir(spark).rstrip('/')}/skein-{spark.sparkContext.applicationId}"
    if own not in _OWN:
        _OWN.add(own)
        atexit.register(_remove, spark, own)
    return f"{own}/{name}-{uuid.uuid4().hex}"


_OWN: set[str] = set()


def _remove(spark: SparkSession, own: str) -> None:
    try:
        drop(spark, own)
    except Exception:  # the session has ended before
        pass


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def listed(spark: SparkSession, path: str) -> list[str]:
    """Paths of what a folder holds, in order; none where there is no such folder."""
    fs, where = _folder(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(where)) if fs.exists(where) else []


def drop(spark: SparkSession, what: str | DataFrame) -> None:
    """Remove a folder, or the written table behind a data frame that `stored` gave."""
    fs, where = _folder(spark, what if isinstance(what, str) else what._written_at)
    fs.delete(where, True)


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write to the shared folder as parquet (partitioned by columns) and read back: survives executor loss, keeps row counts known."""
    path = scratch(df.sparkSession, name)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def spread(df: DataFrame, times: int = 2) -> DataFrame:
    """Give CPU-heavy Python stages enough partitions when the scan has few splits.

    Large inputs already have more splits than this, so no shuffle is added for them.
    """
    want = max(1, df.sparkSession.sparkContext.defaultParallelism) * times
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)


class WordRuns:
    """Distinct 64-bit hashes of the runs of n consecutive words of texts, over whole batches; sorted within each text."""

    def __init__(self, n: int):
        self.n = n
        self.find = regex.compile(WORD).findall
        self.hashes = _WordHashes()

    def words(self, text: str | None) -> list[int]:
        """Hash of each word of a text; null has none."""
        return [self.hashes[w] for w in self.find(text.lower())] if text else []

    def sets(self, words: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """(flat, sizes) of the sets of runs of each list of words."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.fromiter(chain.from_iterable(words), np.uint64, int(sizes.sum()))
        many = np.maximum(0, sizes - (self.n - 1))
        start = np.repeat(np.cumsum(sizes) - sizes - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        run = mix(flat[start], 40)
        for k in range(1, self.n):
            run = mix(run ^ flat[start + k], 40 + k)
        ends = np.cumsum(many)
        for a, b in zip((ends - many).tolist(), ends.tolist()):
            run[a:b].sort()
        new = np.append(True, run[1:] != run[:-1])[: len(run)]
        new[(ends - many)[many > 0]] = True
        total = np.append(0, np.cumsum(new))
        return run[new].view(np.int64), total[ends] - total[ends - many]


class _WordHashes(dict):
    """Hash of each word, kept while they are few enough for the memory of a task."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def with_sequences(df: DataFrame, text: str, n: int = 3, lead: str | None = None, out: str = "seqs", least: int = 0) -> DataFrame:
    """Append the sorted distinct runs of n words of a text, or of lead + space + text; other columns but the texts pass through.

    Rows whose text alone has fewer than `least` runs, or whose set is empty where least is positive, are left out.
    """
    rest = [c for c in df.columns if c not in (text, lead)]
    pick = df.select(*rest, text, *([lead] if lead else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = WordRuns(n)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                own = [runs.words(t) for t in part.column(len(rest)).to_pylist()]
                flat, sizes = runs.sets(own)
                keep = np.flatnonzero(sizes >= least)
                if lead:
                    front = part.column(len(rest) + 1).to_pylist()
                    flat, sizes = runs.sets([runs.words(front[k]) + own[k] for k in keep.tolist()])
                elif least:
                    flat, sizes = flat[np.repeat(sizes >= least, sizes)], sizes[keep]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(flat))
                held = part.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays([*(held.column(k) for k in range(len(rest))), lists], names=[*rest, out])

    kinds = ", ".join(f"`{c}` {pick.schema[c].dataType.simpleString()}" for c in rest)
    return pick.mapInArrow(run, f"{kinds}, `{out}` array<bigint>")


def jaccard(a: Column, b: Column) -> Column:
    """Exact Jaccard similarity of two arrays of distinct elements."""
    both = F.size(F.array_intersect(a, b))
    return both / F.nullif(F.size(a) + F.size(b) - both, F.lit(0))
