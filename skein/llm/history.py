"""Problem 2: deduplicating deliveries against all accepted history.

A store in the shared folder holds, for every accepted record, its minwise band keys and its
sequences. A delivery signs its own rows only, probes the keys of the history with its own, verifies
candidates by exact similarity, resolves repeats among its own rows, and appends what it accepted.
History is never signed or compared again.

A delivery is appended to the store as one small run; when there are `RUNS` runs they are moved into
tables of keys and of records that are partitioned by hash, so a delivery opens few files, however
many came before. Of the hashed tables only the buckets are read into which a key (or a candidate) of
the delivery falls; a small delivery's keys are sent to the history's splits instead of shuffling
the history. With many more buckets than keys a delivery reads a part of the store in proportion to
itself; a delivery with more keys than buckets reads the whole key column once, without texts.

Acceptance follows a total order (batch date, then id): a record is accepted unless it is similar
to an accepted earlier one. The accepted records are the lexicographically first independent set of
the similarity graph, so a delivery may hold one batch or several: the result is the same. Rows of one delivery with equal sets are compared once, through the first of
them. Deliveries must come in order: one with a row that is not later than all of the history is
refused, as it would have to take back what was accepted.

Band layout: 42 bands of 6 values. A pair of similarity exactly 0.8 shares no band with
probability (1 - 0.8^6)^42 = 3e-6, and similarities above it far less.

Defined results: null and short texts (fewer than `least` sequences) take no part; rows without a
readable batch date come last; equal dates are ordered by id; an empty delivery appends nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skein.llm._common import drop, jaccard, listed, scratch, stored, with_sequences
from skein.operators import minhash

BANDS, ROWS, THRESHOLD, LEAST = 42, 6, 0.8, 10
#: Buckets of the hashed part of the store (grow with the deployment, not with a run), and runs that are moved into it together.
BUCKETS, RUNS = 16, 16
#: Keys or ids (or ten times as many sequences) that are sent to the splits of the history; more of them meet it in a shuffle.
MOST_SENT = 200_000
#: Share of all rows that a delivery holds at least where a table of many batches is caught up.
CATCH_UP = 1 / 20
#: Rows of a delivery that are handled as one split.
ONE_SPLIT = 20_000
#: Edges of a delivery that are decided in order by one task; more of them are decided in rounds.
ONE_TASK = 200_000


def with_keys(df: DataFrame) -> DataFrame:
    """Append `keys array<bigint>`, the band keys of `seqs`; other columns pass through."""
    return minhash.with_keys(df, "seqs", BANDS, ROWS)


def bucket_of(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


class Store:
    """Accepted records: runs of (id, rank, seqs, keys), and what older runs were moved into: keys and records by the hash of key and id."""

    RUN, BANDS, RECORDS = "id bigint, rank string, seqs array<bigint>, keys array<bigint>", "key bigint, id bigint, bucket int", "id bigint, rank string, seqs array<bigint>, bucket int"

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.runs = listed(spark, f"{path}/runs")
        self.hashed = bool(listed(spark, f"{path}/records"))
        self.made = 1 + max((int(r.rpartition("-")[2]) for r in listed(spark, f"{path}/moved") + self.runs), default=-1)

    def empty(self) -> bool:
        return not self.runs and not self.hashed

    def append(self, rows: DataFrame) -> None:
        """Add rows (id, rank, seqs, keys) as a run; move the runs when there are many."""
        name = f"{self.path}/runs/run-{self.made:08d}"
        rows.select("id", "rank", "seqs", "keys").write.parquet(name)
        self.made += 1
        self.runs.append(name)
        if len(self.runs) >= RUNS:
            whole = self.spark.read.schema(self.RUN).parquet(*self.runs)
            for name, part, by in (("bands", whole.select(F.explode("keys").alias("key"), "id"), "key"), ("records", whole.select("id", "rank", "seqs"), "id")):
                part = part.withColumn("bucket", bucket_of(F.col(by), self.buckets))
                part.repartition("bucket", F.pmod(F.xxhash64(by), F.lit(997))).sortWithinPartitions("bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/{name}")
            self.hashed = True
            for run in self.runs:
                drop(self.spark, run)
            self.runs = []

    def _read(self, name: str, schema: str, columns: list, buckets: list[int] | None) -> DataFrame:
        parts = []
        if self.hashed:
            hashed = self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
            parts.append((hashed if buckets is None else hashed.where(F.col("bucket").isin(buckets))).drop("bucket"))
        if self.runs:
            parts.append(self.spark.read.schema(self.RUN).parquet(*self.runs).select(*columns))
        return reduce(DataFrame.unionByName, parts)

    def bands(self, buckets: list[int] | None = None) -> DataFrame:
        """(key, id) of the given buckets of the hashed part, and of all runs."""
        return self._read("bands", self.BANDS, [F.explode("keys").alias("key"), "id"], buckets)

    def records(self, buckets: list[int] | None = None) -> DataFrame:
        """(id, rank, seqs) of the given buckets of the hashed part, and of all runs."""
        return self._read("records", self.RECORDS, ["id", "rank", "seqs"], buckets)


def sent(df: DataFrame, n: int) -> DataFrame:
    """A side of n rows: sent to the other side's splits while it is small, else left to the shuffle."""
    return F.broadcast(df) if n <= MOST_SENT else df


class History:
    """The persisted store of accepted records, and what happens to a delivery."""

    def __init__(self, spark: SparkSession, path: str | None = None, threshold: float = THRESHOLD, buckets: int = BUCKETS):
        self.spark, self.threshold = spark, threshold
        self.store = Store(spark, path or scratch(spark, "history"), buckets)
        # the rank after which a delivery must come
        self.last = "" if self.store.empty() else self.store.records().agg(F.max("rank")).first()[0] or ""

    def deliver(self, rows: DataFrame) -> DataFrame:
        """Accept or reject rows (id, rank, seqs); returns (id, match) of the rejected ones.

        match is the first accepted record that the row resembles, in this delivery or before.
        """
        keyed = stored(with_keys(rows.select("id", "rank", "seqs").withColumn("copy", F.xxhash64("seqs"))), "delivery")
        copies = stored(first_copies(keyed), "copies")
        bounds = self.bounds(keyed)
        if not bounds:
            return keyed.select("id", F.col("id").alias("match"))
        decided = self.accept(keyed.join(copies, "id", "left_anti").drop("copy"), *bounds[0])
        return with_copies(decided, copies)

    def bounds(self, keyed: DataFrame, *by: str) -> list[tuple]:
        """(rows, sequences, first rank, last rank, buckets of the keys) of each delivery: one row each."""
        each = keyed.groupBy(*by).agg(F.count("*").alias("n"), F.sum(F.size("seqs")).alias("many"), F.min("rank").alias("low"), F.max("rank").alias("high"))
        at = keyed.select(*by, F.explode("keys").alias("key")).groupBy(*by).agg(F.collect_set(bucket_of(F.col("key"), self.store.buckets)).alias("at"))
        if not by:
            (row,), (held,) = each.collect(), at.collect()
            return [(*row, held[0])] if row[0] else []
        return [tuple(r) for r in each.join(at, list(by)).orderBy(*by).collect()]

    def accept(self, reps: DataFrame, n: int, many: int, low: str, high: str, at: list[int]) -> DataFrame:
        """(id, match) of the rejected ones of rows (id, rank, seqs, keys) with different sets; the others are appended.

        The rows are n at most, with `many` sequences, ranks from low to high and keys in the buckets `at`.
        """
        if low <= self.last:
            raise ValueError(f"a delivery from {low} on cannot follow a history up to {self.last}")
        self.last = high
        if n <= ONE_SPLIT:
            reps = reps.coalesce(1)  # a small delivery is one split, and one file of the store
        probe = reps.select(F.explode("keys").alias("key"), F.col("id").alias("b"))
        index = probe.select("key", F.col("b").alias("a"), F.lit(False).alias("old"))
        if not self.store.empty():
            index = index.unionByName(self.store.bands(at).select("key", F.col("id").alias("a"), F.lit(True).alias("old")))
        pairs = index.join(sent(probe, n * BANDS), "key").where("old or a < b").select("a", "b", "old").distinct()
        # counted while it is written: the pairs, and the buckets of the old side (one number a bucket at most)
        seen = Observation()
        pairs = stored(pairs.observe(seen, F.count("*").alias("n"), F.collect_set(F.when(F.col("old"), bucket_of(F.col("a"), self.store.buckets))).alias("at")), "pairs")
        met = seen.get["n"]
        left = reps.select("id", "rank", "seqs")
        if not self.store.empty():
            left = left.unionByName(self.store.records(list(seen.get["at"])))
        la = left.select(F.col("id").alias("a"), F.col("rank").alias("rank_a"), F.col("seqs").alias("sa"))
        rb = reps.select(F.col("id").alias("b"), F.col("rank").alias("rank_b"), F.col("seqs").alias("sb"))
        similar = la.join(sent(pairs, met), "a").join(sent(rb, many // 10), "b").where(jaccard(F.col("sa"), F.col("sb")) >= self.threshold)
        swap = F.col("rank_a") > F.col("rank_b")
        edges = similar.select(
            F.when(swap, F.col("b")).otherwise(F.col("a")).alias("early"),
            F.when(swap, F.col("a")).otherwise(F.col("b")).alias("late"),
            F.least("rank_a", "rank_b").alias("rank"),
            F.greatest("rank_a", "rank_b").alias("rank_late"),
            "old",
        )
        used = [pairs]
        decided = stored(in_one_pass(edges) if met <= ONE_TASK else in_rounds(edges, used), "decided")
        self.store.append(reps.join(sent(decided.select("id"), n), "id", "left_anti"))
        for df in used:
            drop(self.spark, df)
        return decided


def in_one_pass(edges: DataFrame) -> DataFrame:
    """(id, match) of the rejected records of a graph (early, late, rank, rank_late, old) of at most ONE_TASK edges, in one task in order of rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lost: dict[int, int] = {}
        for batch in batches:
            for early, late in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if late not in lost and early not in lost:
                    lost[late] = early
        yield pa.RecordBatch.from_arrays([pa.array(lost.keys(), pa.int64()), pa.array(lost.values(), pa.int64())], names=["id", "match"])

    # by the rank of the late side: all that is before it has been decided, and its first accepted partner comes first
    return edges.repartition(1).sortWithinPartitions("rank_late", "late", "rank", "early").select("early", "late").mapInArrow(run, "id bigint, match bigint")


def in_rounds(edges: DataFrame, used: list[DataFrame]) -> DataFrame:
    """The same for a graph of any size, by rounds of joins; tables written are added to used."""
    edges = stored(edges, "edges")
    used.append(edges)
    lost = first_independent(edges, used)
    fair = edges.join(lost.withColumnRenamed("late", "early"), "early", "left_anti")
    return fair.groupBy("late").agg(F.min(F.struct("rank", "early")).alias("f")).select(F.col("late").alias("id"), F.col("f.early").alias("match"))


def first_copies(rows: DataFrame, *within: str) -> DataFrame:
    """(id, rep) of the rows (id, rank, copy) whose set an earlier row has; rep is the first of them."""
    first = rows.groupBy(*within, "copy").agg(F.min(F.struct("rank", "id")).alias("f"), F.count("*").alias("n")).where("n > 1")
    return rows.select(*within, "id", "copy").join(first, [*within, "copy"]).where("id != f.id").select(*within, "id", F.col("f.id").alias("rep"))


def with_copies(decided: DataFrame, copies: DataFrame) -> DataFrame:
    """The rejected rows and, after their first ones, the copies."""
    after = copies.join(decided.select(F.col("id").alias("rep"), "match"), "rep", "left")
    return decided.unionByName(after.select("id", F.coalesce("match", "rep").alias("match")))


def first_independent(edges: DataFrame, used: list[DataFrame]) -> DataFrame:
    """(late) of the rejected records in the graph of (early, late, old): those with an accepted early neighbour; early ones that are old are accepted.

    Each round accepts every record that is no longer the late end of an undecided edge and rejects its
    neighbours; the rounds are bounded by the longest chain of repeats. Tables written are added to used.
    """
    now = stored(edges.where("old").select("late").distinct(), "lost")
    used.append(now)
    lost, open_ = now, edges.where("not old").select("early", "late")
    while True:
        e = open_.join(lost, "late", "left_anti").join(lost.withColumnRenamed("late", "early"), "early", "left_anti")
        roots = e.select("early").distinct().join(e.select(F.col("late").alias("early")).distinct(), "early", "left_anti")
        now = stored(e.join(roots, "early", "left_semi").select("late").distinct(), "lost")
        used.append(now)
        if now.isEmpty():
            return lost
        lost = lost.unionByName(now)


def lots(counts: list[tuple[str, int]], share: float) -> list[list[str]]:
    """Batch dates in order, consecutive ones together until they hold a share of all rows."""
    out: list[list[str]] = [[]]
    held, least = 0, share * sum(n for _, n in counts)
    for date, n in counts:
        out[-1].append(date)
        held += n
        if held >= least:
            out.append([])
            held = 0
    return [lot for lot in out if lot]


def dedup_history(df: DataFrame, id_col: str, batch_col: str, text_col: str, threshold: float = THRESHOLD, least: int = LEAST, share: float = CATCH_UP) -> DataFrame:
    """(id, batch, date, match, match_batch, match_date) of every rejected row, delivery by delivery in order of date.

    A table of many batches is caught up: consecutive small batch dates make one delivery until it holds a
    `share` of all rows, which any grouping allows (see above); a share of 0 makes one delivery for each date.
    """
    spark = df.sparkSession
    batch = F.coalesce(F.col(batch_col).cast("string"), F.lit(""))
    date = F.regexp_extract(batch, r"^\d{4}-\d{2}-\d{2}", 0)
    date = F.when(date == "", F.lit("9999-99-99")).otherwise(date)
    rank = F.concat(date, F.lpad(F.col(id_col).cast("string"), 20, "0"))
    pick = df.select(F.col(id_col).cast("bigint").alias("id"), batch.alias("batch"), date.alias("date"), rank.alias("rank"), F.col(text_col).alias("text"))
    rows = with_sequences(pick, "text", 3, least=least).withColumn("copy", F.xxhash64("seqs"))
    # written by date, so a delivery reads its own rows only
    staged = stored(with_keys(rows), "staged", "date")
    dates = [tuple(r) for r in staged.groupBy("date").agg(F.count("*")).orderBy("date").collect()]  # one row per batch date
    grouped = lots(dates, share)
    numbers = spark.createDataFrame([(d, k) for k, lot in enumerate(grouped) for d in lot], "date string, lot int")
    lotted = staged.join(F.broadcast(numbers), "date")  # one row per batch date
    copies = stored(first_copies(lotted, "lot"), "copies")
    copied = {r[0] for r in copies.select("lot").distinct().collect()}  # one value a delivery at most
    history, results = History(spark, threshold=threshold), []
    for k, *bounds in history.bounds(lotted, "lot"):
        part = staged.where(F.col("date").between(grouped[k][0], grouped[k][-1])).select("id", "rank", "seqs", "keys")
        if k in copied:
            part = part.join(copies.where(F.col("lot") == k).select("id"), "id", "left_anti")
        results.append(history.accept(part, *bounds))
    if not results:
        return staged.select("id", "batch", "date", F.col("id").alias("match"), F.col("batch").alias("match_batch"), F.col("date").alias("match_date")).limit(0)
    out = with_copies(spark.read.schema(results[0].schema).parquet(*[f for r in results for f in r.inputFiles()]), copies.select("id", "rep"))
    batches = staged.select("id", "batch", "date")
    other = batches.select(F.col("id").alias("match"), F.col("batch").alias("match_batch"), F.col("date").alias("match_date"))
    return out.join(batches, "id").join(other, "match").select("id", "batch", "date", "match", "match_batch", "match_date")
