"""Problem 7: the k most similar vectors of every vector by learned partitions.

On a bounded sample the exact neighbour graph is built and cut into balanced parts by recursive
bisection (smoothing over graph neighbours, cut at the median, improving swaps). A softmax
classifier learns each part from the vectors of the sample. Every row is indexed in its most
probable part and looks for neighbours in its `probes` most probable parts; candidates are scored
in blocked matrix products, and the best k of all probed parts remain.

The larger the table, the fewer rows of the sample are neighbours of each other, and the more often a
border runs between a row and its neighbours. So the rows are divided again by partitions that are
learned from disjoint folds of the sample, and every row is searched in them too: a pair that
one partition separates meets in another. The partitions follow one another, so the vectors of one
lie in the shuffle at a time.

The number of parts follows the number of rows, so a probe meets about `part_rows` vectors at any
size. Parts (and the rows that probe them) above twice the expected size are divided into blocks
that are all visited, so no row is dropped and no task gets an unbounded group.

Defined results: null, empty and all-zero vectors and vectors of another length than most of the
sample take no part; ties go to the smaller id; equal vectors are ordinary neighbours of each
other, and of more than k + 1 equal vectors only the k + 1 smallest ids are searched, as no other
can be among the k first (their own neighbours are these); fewer than k others give fewer rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm._common import mix, stored

#: Rows a part should hold, parts each row probes, neighbours wanted.
PART_ROWS, PROBES, K = 1000, 3, 5
#: Further partitions, each of a fold of the sample, and the parts of each in which every row looks too.
FOLDS, FOLD_PROBES = 3, 2
#: The classifier is fitted on a sample by hash of the id: ROWS_PER_PART for each part, but about
#: LEAST_SAMPLE rows at least and MOST_SAMPLE at most, which bounds the driver's memory and the parts.
ROWS_PER_PART, LEAST_SAMPLE, MOST_SAMPLE = 16, 8192, 65536


def graph(x: np.ndarray, k: int) -> np.ndarray:
    """Exact k nearest neighbours of each row of unit vectors, by blocks."""
    out = np.empty((len(x), k), dtype=np.int64)
    for a in range(0, len(x), 1024):
        s = x[a : a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -2
        out[a : a + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def bisect_graph(near: np.ndarray, x: np.ndarray, depth: int, rounds: int = 30, swaps: int = 12) -> np.ndarray:
    """Balanced parts 0 .. 2^depth - 1 of a neighbour graph; all parts of a level are cut together."""
    n = len(near)
    part = np.zeros(n, dtype=np.int64)
    rng = np.random.default_rng(7)
    source = np.repeat(np.arange(n), near.shape[1])
    target = near.ravel()
    u, v = np.concatenate([source, target]), np.concatenate([target, source])
    for _ in range(depth):
        inside = part[u] == part[v]
        a, b = u[inside], v[inside]
        degree = np.maximum(1, np.bincount(a, minlength=n))
        size = np.maximum(1, np.bincount(part))
        y = x @ rng.standard_normal(x.shape[1])
        for _ in range(rounds):
            y = 0.5 * y + 0.5 * np.bincount(a, weights=y[b], minlength=n) / degree
            y -= (np.bincount(part, weights=y) / size)[part]
            y /= np.sqrt(np.maximum(1e-30, np.bincount(part, weights=y * y) / size))[part]
        order = np.lexsort((y, part))
        first = np.append(0, np.cumsum(np.bincount(part)))[:-1]
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n) - first[part[order]]
        side = place >= (size[part] + 1) // 2
        for _ in range(swaps):
            gain = np.bincount(a, weights=np.where(side[a] != side[b], 1.0, -1.0), minlength=n)
            half = part * 2 + side
            rank_order = np.lexsort((-gain, half))
            begin = np.append(0, np.cumsum(np.bincount(half, minlength=2 * len(size))))[:-1]
            rank = np.empty(n, dtype=np.int64)
            rank[rank_order] = np.arange(n) - begin[half[rank_order]]
            best = np.full((2 * len(size), n // len(size) + 2), -np.inf)
            ok = rank < best.shape[1]
            best[half[ok], rank[ok]] = gain[ok]
            pays = (best[0::2] + best[1::2] > 0).sum(axis=1) // 2
            moved = rank < pays[part]
            if not moved.any():
                break
            side = side ^ moved
        part = part * 2 + side
    return part


def learn(x: np.ndarray, part: np.ndarray, near: np.ndarray, epochs: int = 12, batch: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of a softmax classifier; the target of a row is the share of its neighbours in each part."""
    parts = int(part.max()) + 1 if len(part) else 1
    w = np.stack([x[part == p].mean(axis=0) if (part == p).any() else np.zeros(x.shape[1]) for p in range(parts)], axis=1).astype(np.float32) * 10
    bias = np.zeros(parts, dtype=np.float32)
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(bias), np.zeros_like(bias)]
    rng, step = np.random.default_rng(5), 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), batch):
            i = order[a : a + batch]
            z = x[i] @ w + bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            share = 0.5 / near.shape[1]
            np.subtract.at(z, (np.repeat(np.arange(len(i)), near.shape[1]), part[near[i]].ravel()), share)
            np.subtract.at(z, (np.arange(len(i)), part[i]), 0.5)
            step += 1
            for p, g, m, v in ((w, x[i].T @ z / len(i), *moments[:2]), (bias, z.mean(axis=0), *moments[2:])):
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                p -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w, bias


def fit(x: np.ndarray, parts: int, k: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Classifier over about `parts` balanced parts (the next power of two) of a sample of unit vectors."""
    depth = max(0, int(np.ceil(np.log2(max(1, parts)))))
    k = min(k, len(x) - 1)
    if depth == 0 or k < 1:
        return np.zeros((x.shape[1], 1), dtype=np.float32), np.zeros(1, dtype=np.float32)
    near = graph(x, k)
    return learn(x, bisect_graph(near, x, depth), near)


class Router:
    """Routes vectors to parts; small enough to be part of the task closure (dimension x parts floats)."""

    def __init__(self, dim: int, w: np.ndarray, bias: np.ndarray, probes: int):
        self.dim, self.w, self.bias = dim, w, bias
        self.probes = min(probes, len(bias))
        self.blocks = self.slices = np.ones(len(bias), dtype=np.int64)

    def vectors(self, batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Ids, raw float32 vectors and unit vectors of the usable rows."""
        lists = batch.column(1)
        size = np.asarray(lists.value_lengths().fill_null(-1))
        keep = np.flatnonzero(size == self.dim)
        x = lists.take(pa.array(keep)).flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, self.dim)
        norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        fine = np.isfinite(norm) & (norm > 0)
        return batch.column(0).take(pa.array(keep[fine])), x[fine], (x[fine] / norm[fine, None]).astype(np.float32)

    def route(self, unit: np.ndarray) -> np.ndarray:
        """The most probable parts of each row, best first."""
        z = unit @ self.w + self.bias
        top = np.argpartition(-z, self.probes - 1, axis=1)[:, : self.probes] if self.probes < z.shape[1] else np.tile(np.arange(z.shape[1]), (len(z), 1))
        return np.take_along_axis(top, np.argsort(-np.take_along_axis(z, top, axis=1), axis=1, kind="stable"), axis=1)


def nearest(index_ids: np.ndarray, index: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, other, cosine) of the best k of an index for each query; float32 to choose, float64 to rank."""
    a = index.astype(np.float64)
    a /= np.sqrt((a * a).sum(axis=1))[:, None]
    q = x.astype(np.float64)
    q /= np.sqrt((q * q).sum(axis=1))[:, None]
    a32, want = a.astype(np.float32), min(len(a), k + 4)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(q), 512):
        s = q[at : at + 512].astype(np.float32) @ a32.T
        s[ids[at : at + 512, None] == index_ids[None, :]] = -4
        top = np.argpartition(-s, want - 1, axis=1)[:, :want] if want < len(a) else np.tile(np.arange(len(a)), (len(s), 1))
        # rows tied with the last choice could be lost by the partition: take all of them
        edge = np.take_along_axis(s, top, axis=1).min(axis=1)
        tied = np.flatnonzero((s >= edge[:, None] - 1e-6).sum(axis=1) > want)
        exact = np.einsum("qd,qkd->qk", q[at : at + 512], a[top])
        other = index_ids[top]
        exact[other == ids[at : at + 512, None]] = -4
        order = np.lexsort((other, -exact), axis=1)[:, :k]
        other, exact = np.take_along_axis(other, order, axis=1), np.take_along_axis(exact, order, axis=1)
        for r in tied:
            full = np.einsum("kd,d->k", a[s[r] >= edge[r] - 1e-6], q[at + r])  # as above: a pair has one cosine in every part
            names = index_ids[s[r] >= edge[r] - 1e-6]
            best = np.lexsort((names, -full))[:k]
            other[r, : len(best)], exact[r, : len(best)] = names[best], full[best]
        good = exact > -3
        out.append((np.repeat(ids[at : at + 512], good.sum(axis=1)), other[good], exact[good]))
    return tuple(np.concatenate([o[i] for o in out]) if out else np.zeros(0) for i in range(3))


def top_k(df: DataFrame, id_col: str, vector_col: str, k: int = K, part_rows: int = PART_ROWS, probes: int = PROBES) -> DataFrame:
    """(id, other, cosine, rank): up to k most similar other rows of every usable row."""
    spark = df.sparkSession
    pick = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v")).where("v is not null and size(v) > 0")
    total = df.count()
    least = min(MOST_SAMPLE, max(LEAST_SAMPLE, ROWS_PER_PART * -(-total // part_rows)))
    share = min(1_000_000, -(-1_000_000 * least // max(1, total)))
    sample = pick.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share).toArrow()
    dims = Counter(np.asarray(sample.column(1).combine_chunks().value_lengths()).tolist()) if len(sample) else Counter()
    empty = spark.createDataFrame([], "id bigint, other bigint, cosine double, rank int")
    if not dims:
        return empty
    router = Router(dims.most_common(1)[0][0], np.zeros((1, 1)), np.zeros(1), 1)
    unit = [router.vectors(b)[2] for b in sample.to_batches() if b.num_rows]
    unit = np.concatenate(unit)
    if not len(unit):
        return empty
    parts = max(1, min(-(-total // part_rows), len(unit) // ROWS_PER_PART))
    routers = [Router(router.dim, *fit(unit, parts), probes)]
    if parts > 1:
        for f in range(FOLDS):
            fold = unit[f::FOLDS]
            parts = max(1, min(-(-total // part_rows), len(fold) // ROWS_PER_PART))
            routers.append(Router(router.dim, *fit(fold, 1 << (parts.bit_length() - 1)), FOLD_PROBES))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, asked = ([np.zeros(len(r.bias), np.int64) for r in routers] for _ in range(2))
        for batch in batches:
            unit = router.vectors(batch)[2]
            for t, r in enumerate(routers):
                to = r.route(unit)
                home[t] += np.bincount(to[:, 0], minlength=len(r.bias))
                asked[t] += np.bincount(to.ravel(), minlength=len(r.bias))
        for t, r in enumerate(routers):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r.bias), t, np.int32)), pa.array(np.arange(len(r.bias), dtype=np.int32)), pa.array(home[t]), pa.array(asked[t])], names=["partition", "part", "home", "asked"])

    # the same rows that Router.vectors keeps: copies of others have no neighbours and must not take the short cut
    v = F.col("v").cast("array<float>")
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    usable = pick.where((F.size("v") == router.dim) & finite & F.exists(v, lambda x: x != 0))
    copies = usable.groupBy(F.xxhash64("v").alias("h")).agg(F.count("*").alias("n")).where(F.col("n") > k + 1).select("h")
    hot = stored(copies, "copies")
    repeated = None
    if not hot.isEmpty():
        named = usable.select("id", F.xxhash64("v").alias("h")).join(hot, "h")
        first = named.withColumn("r", F.row_number().over(Window.partitionBy("h").orderBy("id"))).where(F.col("r") <= k + 1)
        first = stored(first, "first-copies")
        rest = named.join(first.select("id"), "id", "left_anti")
        pick = pick.join(rest.select("id"), "id", "left_anti")
        repeated = rest.join(first.select("h", F.col("id").alias("other"), "r"), "h").where(F.col("r") <= k)
        repeated = repeated.select("id", "other", F.lit(1.0).alias("cosine"), F.col("r").cast("int").alias("rank"))
    # one row per part: bounded by the number of parts, which the sample bounds
    count = pick.mapInArrow(sizes, "partition int, part int, home bigint, asked bigint").groupBy("partition", "part").agg(F.sum("home"), F.sum("asked")).collect()
    for r in routers:
        r.blocks, r.slices = np.ones(len(r.bias), np.int64), np.ones(len(r.bias), np.int64)
    for t, part, home, asked in count:
        routers[t].blocks[part] = max(1, -(-home // (4 * part_rows)))
        routers[t].slices[part] = max(1, -(-asked // (4 * part_rows * routers[t].probes)))
    found = reduce(DataFrame.unionByName, [search(pick, r, k) for r in routers])
    best = Window.partitionBy("id").orderBy(F.desc("cosine"), "other")
    found = found.groupBy("id", "other").agg(F.max("cosine").alias("cosine")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found if repeated is None else found.unionByName(repeated)


@contextmanager
def unshuffled(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files behind."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def search(pick: DataFrame, router: Router, k: int) -> DataFrame:
    """(id, other, cosine): the best k of each row of (id, v) in every part of one partition that it probes."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x, unit = router.vectors(batch)
            if not len(x):
                continue
            to = router.route(unit)
            row, rank = np.divmod(np.arange(to.size), router.probes)
            part = to.ravel()
            own = mix(np.asarray(ids).astype(np.uint64), 21)
            nb, ns = router.blocks[part], router.slices[part]
            # every combination of block and slice, then those in which the row is indexed or asks
            many = nb * ns
            at = np.repeat(np.arange(len(row)), many)
            cell = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
            block, slot = cell // ns[at], cell % ns[at]
            h = own[row[at]]
            indexed = (rank[at] == 0) & ((h % nb[at].astype(np.uint64)).astype(np.int64) == block)
            asks = ((h >> np.uint64(20)) % ns[at].astype(np.uint64)).astype(np.int64) == slot
            use = np.flatnonzero(indexed | asks)
            at = at[use]
            raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * router.dim), len(x), [None, pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary())
            for c in range(0, len(at), 4096):
                i, j = at[c : c + 4096], use[c : c + 4096]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[i].astype(np.int32)), pa.array(block[j].astype(np.int32)), pa.array(slot[j].astype(np.int32)), ids.take(pa.array(row[i])), pa.array((indexed[j] + 2 * asks[j]).astype(np.int8)), raw.take(pa.array(row[i]))],
                    names=["part", "block", "slot", "id", "use", "v"],
                )

    def rank(t: pa.Table) -> pa.Table:
        ids, use = t.column("id").to_numpy(), t.column("use").to_numpy()
        x = np.frombuffer(b"".join(t.column("v").to_pylist()), dtype=np.float32).reshape(len(ids), router.dim)
        inside, asks = (use & 1) > 0, (use & 2) > 0
        if not inside.any() or not asks.any():
            found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        else:
            found = nearest(ids[inside], x[inside], ids[asks], x[asks], k)
        return pa.table({"id": found[0].astype(np.int64), "other": found[1].astype(np.int64), "cosine": found[2].astype(np.float64)})

    cells = pick.mapInArrow(emit, "part int, block int, slot int, id bigint, use tinyint, v binary")
    found = cells.groupBy("part", "block", "slot").applyInArrow(rank, "id bigint, other bigint, cosine double")
    with unshuffled(pick.sparkSession):
        return stored(found, "found")
