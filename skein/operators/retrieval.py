"""Ranked retrieval: vectors, BM25, term cosine and stemmed match, and their fusion and pooling."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skein.functions import text as T
from skein.functions.stem import stem
from skein.operators.relational import cut, ranked_list, spread

#: BM25 parameters, share of the mean weight that replaces negative ones, and the constant of rank fusion.
K1, B, FLOOR, RRF_K = 1.5, 0.75, 0.25, 60
#: Queries that are sent along with every block of vectors: a stated query set, checked before it is sent.
MOST_QUERIES = 20_000


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays in double precision; null where one has no length."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return dot / F.nullif(norm(a) * norm(b), F.lit(0.0))


class Best:
    """The best k of a stream of scored blocks for each of n queries; ties go to the smaller id."""

    def __init__(self, n: int, k: int, positive: bool = False):
        self.k, self.least = k, 0.0 if positive else -np.inf
        self.scores: list[np.ndarray] = [np.zeros(0)] * n
        self.ids: list[list] = [[]] * n
        self.bar = np.full(n, self.least)

    def add(self, first: int, scores: np.ndarray, ids: list) -> None:
        """Scores of queries first, first + 1, ... against rows ids."""
        for q in range(len(scores)):
            row, at = scores[q], first + q
            # all that reach the bar, so that ties are settled by id
            found = np.flatnonzero(row >= self.bar[at]) if len(self.ids[at]) >= self.k else np.flatnonzero(row > self.least)
            if len(found) > 4 * self.k:
                found = found[row[found] >= np.partition(row[found], -self.k)[-self.k]]
            if not len(found):
                continue
            whole = np.concatenate([self.scores[at], row[found]])
            names = self.ids[at] + [ids[i] for i in found.tolist()]
            order = sorted(range(len(names)), key=lambda i: (-whole[i], names[i]))[: self.k]
            self.scores[at], self.ids[at] = whole[order], [names[i] for i in order]
            if len(order) == self.k:
                self.bar[at] = self.scores[at][-1]

    def rows(self, q_ids: list, q_kind: pa.DataType, kind: pa.DataType) -> pa.RecordBatch:
        n = [len(i) for i in self.ids]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(chain.from_iterable([q] * m for q, m in zip(q_ids, n))), q_kind), pa.array(list(chain.from_iterable(self.ids)), kind), pa.array(np.concatenate([np.zeros(0), *self.scores]))],
            names=["query_id", "id", "score"],
        )


def _kinds(queries: DataFrame, corpus: DataFrame) -> str:
    return f"query_id {queries.schema['query_id'].dataType.simpleString()}, id {corpus.schema['id'].dataType.simpleString()}, score double"


def asked(queries: DataFrame, column: str) -> pd.DataFrame:
    """(query_id, column) of a stated query set, whose size is checked before it is sent to the tasks."""
    rows = queries.where(F.col(column).isNotNull()).select("query_id", column).limit(MOST_QUERIES + 1).toPandas()
    if len(rows) > MOST_QUERIES:
        raise ValueError(f"more than {MOST_QUERIES} queries: split the query set")
    return rows


def vector_top_k(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score, rank) of a stated query set (query_id, vector) against all rows (id, vector), exactly.

    Blocks of the corpus are multiplied with the query matrix; a task keeps its best k per query, so only
    queries x k rows of each task are shuffled. The query set is bounded and checked; a larger one is
    processed in groups by the caller.
    """
    rows = asked(queries, "vector")
    q = np.array(rows["vector"].tolist(), dtype=np.float64) if len(rows) else np.zeros((0, 1))
    length = np.sqrt((q * q).sum(axis=1)) if len(rows) else np.zeros(0)
    sent = corpus.sparkSession.sparkContext.broadcast((rows["query_id"][length > 0].tolist(), q[length > 0] / length[length > 0, None]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q = sent.value
        best, kind = Best(len(q), k), None
        for batch in batches:
            lists, kind = batch.column(1), batch.schema.field(0).type
            size = np.asarray(lists.value_lengths().fill_null(-1))
            keep = np.flatnonzero(size == q.shape[1])
            x = lists.take(pa.array(keep)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, q.shape[1])
            norm = np.sqrt((x * x).sum(axis=1))
            keep, x, norm = keep[norm > 0], x[norm > 0], norm[norm > 0]
            ids = batch.column(0).take(pa.array(keep)).to_pylist()
            for at in range(0, len(q) if ids else 0, 512):
                best.add(at, np.round(q[at : at + 512] @ (x / norm[:, None]).T, 12), ids)
        if kind is not None and len(q):
            yield best.rows(q_ids, q_kind, kind)

    q_kind = to_arrow_type(queries.schema["query_id"].dataType)
    found = corpus.where("vector is not null").select("id", "vector").mapInArrow(run, _kinds(queries, corpus))
    return ranked_list(found, "query_id", "score", "id", k)


_BLANK = re.compile(T.BLANK)


def split_words(text: str | None) -> list[str]:
    """Lower-cased words between white space, as `text.words` has them."""
    return [w for w in _BLANK.split(text.lower()) if w] if text else []


def bm25_weights(corpus: DataFrame) -> DataFrame:
    """(term, idf, avg_length) of every word of corpus (id, text): one count of texts per word; negative weights become a share of the mean weight."""
    words = corpus.select(T.words(F.lower(F.col("text"))).alias("w"))
    stats = words.agg(F.count("*").alias("n"), F.avg(F.size("w")).alias("avg_length"))
    df = words.select(F.explode(F.array_distinct("w")).alias("term")).groupBy("term").agg(F.count("*").alias("df")).join(F.broadcast(stats))  # one row
    raw = cut(df.withColumn("raw", F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)))
    mean = raw.agg(F.avg("raw").alias("mean"))
    return raw.join(F.broadcast(mean)).select("term", F.when(F.col("raw") < 0, FLOOR * F.col("mean")).otherwise(F.col("raw")).alias("idf"), "avg_length")


def _lexical(queries: DataFrame, corpus: DataFrame, k: int, score: str) -> DataFrame:
    """Ranked lists of a stated, checked set of queries over all texts: every text is scored in its own task, which keeps its best k per query.

    Only the words of the queries (with their weights) are sent to the tasks, and only queries x k rows
    of each task are shuffled: there is no row per query and text.
    """
    rows = asked(queries, "text")
    terms: dict[str, int] = {}
    pairs: dict[tuple[int, int], int] = {}
    for q, t in enumerate(rows["text"]):
        for w in split_words(t):
            at = terms.setdefault(w, len(terms)), q
            pairs[at] = pairs.get(at, 0) + 1
    order = sorted(pairs)
    first = np.searchsorted([t for t, _ in order], np.arange(len(terms) + 1))
    of = np.array([q for _, q in order], dtype=np.int64)
    count = np.array([pairs[x] for x in order], dtype=np.float64)
    weight, average = np.ones(len(terms)), 1.0
    if score == "bm25" and terms:
        spark = corpus.sparkSession
        held = spark.createDataFrame([(w, i) for w, i in terms.items()], "term string, i int").join(bm25_weights(corpus), "term").select("i", "idf", "avg_length").toPandas()
        weight = np.zeros(len(terms))
        weight[held["i"]] = held["idf"]
        average = float(held["avg_length"].iloc[0]) if len(held) else 1.0
    norm = np.sqrt(np.bincount(of, weights=count * count, minlength=len(rows)))
    sent = corpus.sparkSession.sparkContext.broadcast((rows["query_id"].tolist(), terms, first, of, count, weight, norm))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, terms, first, of, count, weight, norm = sent.value
        best, kind, n = Best(len(q_ids), k, positive=True), None, len(q_ids)
        step = max(1, 2_000_000 // max(1, n))
        for batch in batches:
            kind = batch.schema.field(0).type
            for start in range(0, batch.num_rows if n else 0, step):
                part = batch.slice(start, step)
                docs, term, tf, lengths, squares = [], [], [], [], []
                for d, t in enumerate(part.column(1).to_pylist()):
                    held = Counter(split_words(t))
                    lengths.append(sum(held.values()))
                    squares.append(sum(c * c for c in held.values()))
                    for w in held.keys() & terms.keys():
                        docs.append(d)
                        term.append(terms[w])
                        tf.append(held[w])
                docs, term, tf = np.array(docs, np.int64), np.array(term, np.int64), np.array(tf, np.float64)
                if score == "bm25":
                    part_of = weight[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * np.array(lengths, np.float64)[docs] / average))
                else:
                    part_of = tf
                many = first[term + 1] - first[term] if len(term) else np.zeros(0, np.int64)
                at = np.repeat(first[term] - np.cumsum(many) + many, many) + np.arange(int(many.sum())) if len(term) else np.zeros(0, np.int64)
                s = np.bincount(of[at] * part.num_rows + np.repeat(docs, many), weights=count[at] * np.repeat(part_of, many), minlength=n * part.num_rows).reshape(n, part.num_rows)
                if score != "bm25":
                    s = s / np.maximum(1e-300, norm[:, None] * np.sqrt(np.array(squares, np.float64))[None, :])
                best.add(0, np.round(s, 9), part.column(0).to_pylist())
        if kind is not None and n:
            yield best.rows(q_ids, q_kind, kind)

    q_kind = to_arrow_type(queries.schema["query_id"].dataType)
    found = spread(corpus.select("id", "text")).mapInArrow(run, _kinds(queries, corpus))
    return ranked_list(found, "query_id", "score", "id", k)


def bm25(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score, rank) of queries (query_id, text) over corpus (id, text); repeated query words count repeatedly."""
    return _lexical(queries, corpus, k, "bm25")


def term_cosine(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score, rank): cosine of term frequency vectors, the sparse stand-in for an encoder."""
    return _lexical(queries, corpus, k, "cosine")


def match_all(queries: DataFrame, corpus: DataFrame) -> DataFrame:
    """(query_id, id, n_terms): texts that hold every distinct word of a query."""
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0)))
    q = queries.select("query_id", words(F.col("text")).alias("w")).select("query_id", F.size("w").alias("n_terms"), F.explode("w").alias("term"))
    d = corpus.select("id", F.explode(words(F.col("text"))).alias("term"))
    hit = q.join(d, "term").groupBy("query_id", "n_terms", "id").agg(F.count("*").alias("n"))
    return hit.where("n = n_terms").select("query_id", "id", F.col("n_terms").cast("bigint").alias("n_terms"))


#: Words that a full-text query leaves out.
STOP = set("a an and are as at be but by for from had has have he her his i if in into is it its me my not of on or our she so that the their them they this to was we were what when which who will with you your".split())


def stems(text: str | None) -> list[str]:
    """Stems of the words of a text, in order; words that a query leaves out as empty strings, so that places stay."""
    return ["" if w in STOP else stem(w) for w in _ALNUM.findall(text.lower())] if text else []


_ALNUM = re.compile(r"[a-z0-9]+")


def cover(places: list[tuple[int, int]], want: int) -> float:
    """Number of terms divided by the length of the shortest window that holds them all; places are (position, term) in order."""
    count: dict[int, int] = {}
    best, left = 0, 0
    for at, term in places:
        count[term] = count.get(term, 0) + 1
        while len(count) == want:
            first, other = places[left]
            best = at - first + 1 if not best else min(best, at - first + 1)
            count[other] -= 1
            if not count[other]:
                del count[other]
            left += 1
    return want / best if best else 0.0


def stemmed_match(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score, rank): texts with all stems of a query, ranked by the density of the closest cover.

    Every text is matched in its own task against the stated, checked query set, of which a task keeps the
    best k each; only words of queries are looked at. Queries without a stem find nothing.
    """
    rows = asked(queries, "text")
    terms: dict[str, int] = {}
    wanted = [sorted({terms.setdefault(w, len(terms)) for w in stems(t) if w}) for t in rows["text"]]
    by_term: dict[int, list[int]] = {}
    for q, held in enumerate(wanted):
        for t in held:
            by_term.setdefault(t, []).append(q)
    sent = corpus.sparkSession.sparkContext.broadcast((rows["query_id"].tolist(), terms, wanted, by_term))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, terms, wanted, by_term = sent.value
        best, kind = Best(len(q_ids), k, positive=True), None
        for batch in batches:
            kind = batch.schema.field(0).type
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                places = [(at, terms[w]) for at, w in enumerate(stems(t)) if w in terms]
                met = Counter(q for term in {term for _, term in places} for q in by_term[term])
                for q, n in met.items():
                    if n == len(wanted[q]):
                        own = set(wanted[q])
                        best.add(q, np.array([[cover([p for p in places if p[1] in own], n)]]), [i])
        if kind is not None and q_ids:
            yield best.rows(q_ids, q_kind, kind)

    q_kind = to_arrow_type(queries.schema["query_id"].dataType)
    found = spread(corpus.select("id", "text")).mapInArrow(run, _kinds(queries, corpus))
    return ranked_list(found, "query_id", "score", "id", k)


# ---- fusion --------------------------------------------------------------------------------------------------------


def min_max(df: DataFrame, out: str = "norm") -> DataFrame:
    """Scores of each query scaled to 0..1; all 1 where they do not differ."""
    w = Window.partitionBy("query_id")
    low, high = F.min("score").over(w), F.max("score").over(w)
    return df.withColumn(out, F.when(high == low, F.lit(1.0)).otherwise((F.col("score") - low) / (high - low)))


def linear_fusion(a: DataFrame, b: DataFrame, alpha: float = 0.5, k: int = 10) -> DataFrame:
    """alpha times the scaled score of one list plus the rest of the other; a missing score is 0."""
    x = min_max(a).select("query_id", "id", F.col("norm").alias("na"))
    y = min_max(b).select("query_id", "id", F.col("norm").alias("nb"))
    both = x.join(y, ["query_id", "id"], "full_outer")
    score = F.round(alpha * F.coalesce("na", F.lit(0.0)) + (1 - alpha) * F.coalesce("nb", F.lit(0.0)), 9)
    return ranked_list(both.select("query_id", "id", score.alias("score")), "query_id", "score", "id", k)


def rank_fusion(a: DataFrame, b: DataFrame, wa: float = 0.5, wb: float = 0.5, k: int = 10, c: int = RRF_K) -> DataFrame:
    """Weighted reciprocal rank fusion of two ranked lists."""
    x = a.select("query_id", "id", F.col("rank").alias("ra"))
    y = b.select("query_id", "id", F.col("rank").alias("rb"))
    both = x.join(y, ["query_id", "id"], "full_outer")
    score = F.coalesce(F.lit(wa) / (c + F.col("ra")), F.lit(0.0)) + F.coalesce(F.lit(wb) / (c + F.col("rb")), F.lit(0.0))
    return ranked_list(both.select("query_id", "id", F.round(score, 12).alias("score")), "query_id", "score", "id", k)


def pool(sources: dict[str, DataFrame]) -> DataFrame:
    """One row per query and id: sources in order, rank and score of each, best score, and the number of sources."""
    every = None
    for o, (name, d) in enumerate(sources.items()):
        part = d.select("query_id", "id", F.lit(o).alias("o"), F.lit(name).alias("source"), "rank", F.round("score", 6).alias("score"))
        every = part if every is None else every.unionByName(part)
    cols = [F.max(F.when(F.col("source") == n, F.col(c))).alias(f"{n}_{c}") for n in sources for c in ("rank", "score")]
    g = every.groupBy("query_id", "id").agg(F.array_join(F.transform(F.sort_array(F.collect_set(F.struct("o", "source"))), lambda s: s["source"]), ",").alias("sources"), F.greatest(F.max("score"), F.lit(0.0)).alias("best_score"), F.count("*").alias("n_sources"), *cols)
    return g


def overlap(pooled: DataFrame) -> DataFrame:
    """Pooled rows by the set of sources that found them."""
    return pooled.groupBy("sources").agg(F.count("*").alias("n_rows"), F.count_distinct("query_id").alias("n_queries"))


#: Ways to search, by the name of the mode.
MODES: dict[str, Callable[[DataFrame, DataFrame, int], DataFrame]] = {
    "vector": term_cosine,
    "bm25": bm25,
    "hybrid": lambda q, c, k: rank_fusion(term_cosine(q, c, 2 * k), bm25(q, c, 2 * k), k=k),
    "linear": lambda q, c, k: linear_fusion(term_cosine(q, c, 2 * k), bm25(q, c, 2 * k), k=k),
    "stemmed": lambda q, c, k: stemmed_match(q, c, k),
}


def register_mode(name: str, search: Callable[[DataFrame, DataFrame, int], DataFrame]) -> None:
    """Add a way to search, or replace one of the same name."""
    MODES[name] = search


def retrieve(mode: str, queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score, rank and the other columns of corpus): the best k rows of corpus (id, text, ...) by a mode; the fused modes take 2 k of each list."""
    if mode not in MODES:
        raise KeyError(f"unknown mode: {mode}")
    found = MODES[mode](queries, corpus.select("id", "text"), k)
    return found.join(corpus, "id").select("query_id", "id", F.round("score", 6).alias("score"), "rank", *[c for c in corpus.columns if c != "id"])


def hashed_vectors(text: Column, dims: int = 64) -> Column:
    """A deterministic text vector: words hashed to signed positions, scaled to length 1; null for texts without words."""

    @F.pandas_udf("array<float>")
    def embed(texts: pd.Series) -> pd.Series:
        import xxhash

        out = []
        for t in texts:
            v = np.zeros(dims)
            for w in (t or "").lower().split():
                h = xxhash.xxh64_intdigest(w)
                v[h % dims] += 1.0 if h >> 63 else -1.0
            n = np.sqrt((v * v).sum())
            out.append((v / n).astype(np.float32) if n else None)
        return pd.Series(out)

    return embed(text)


def prompt(contexts: DataFrame, query: str, max_chars: int = 1500) -> DataFrame:
    """(query_id, prompt): the ranked texts of each query (query_id, rank, source, text) as numbered sources, then the question."""
    item = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] "), F.coalesce("source", F.lit("unknown")), F.lit("\n"), T.clipped(F.col("text"), max_chars))
    lines = contexts.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", item.alias("item")))).alias("l"), F.first(query).alias("q"))
    return lines.select("query_id", F.concat(F.array_join(F.transform("l", lambda x: x["item"]), "\n\n"), F.lit("\n\nQuestion: "), F.col("q")).alias("prompt"))
