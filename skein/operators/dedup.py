"""Exact and near-duplicate removal in input order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions import text as T
from skein.operators.minhash import with_keys
from skein.operators.relational import cut

#: Bands and rows of the signature, threshold of the verification, sequences below which only exact removal applies, words of a sequence.
BANDS, ROWS, THRESHOLD, LEAST, RUN = 42, 6, 0.8, 10, 3
#: Bands and rows where a shared band is accepted without verification: a pair at the threshold shares one with probability 0.4.
LOOSE = 9, 13


def with_shingles(df: DataFrame, text: str, out: str = "shingles", n: int = RUN) -> DataFrame:
    """Add the distinct 64-bit hashes of the runs of n words; a shorter text is one run, an empty one has none."""
    none = F.array().cast("array<bigint>")

    def runs(w):
        last = F.greatest(F.size(w) - n, F.lit(0))
        return F.when(F.size(w) > 0, F.array_distinct(F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, n), " "))))).otherwise(none)

    # the words are bound to a lambda variable, so they are split once per text and not once per run
    return df.withColumn(out, F.transform(F.array(T.words(F.lower(F.col(text)))), runs)[0])


def exact_duplicates(df: DataFrame, id_col: str, text: str, history: DataFrame | None = None) -> DataFrame:
    """(id, content_hash, first_id, is_first): the first row of each normalised text in order of id; known hashes have none."""
    h = df.select(F.col(id_col).alias("id"), T.content_hash(F.col(text)).alias("content_hash")).where("content_hash is not null")
    first = h.groupBy("content_hash").agg(F.min("id").alias("first_id"))
    out = h.join(first, "content_hash")
    if history is not None:
        out = out.join(history.select("content_hash", F.lit(True).alias("_known")), "content_hash", "left").withColumn("first_id", F.when(F.col("_known").isNull(), F.col("first_id"))).drop("_known")
    return out.select("id", "content_hash", "first_id", F.coalesce(F.col("id") == F.col("first_id"), F.lit(False)).alias("is_first"))


def shingle_sets(df: DataFrame, id_col: str, text: str, least: int = LEAST) -> DataFrame:
    """(id, shingles, copy) of the rows with enough sequences; equal sets have the same copy."""
    base = with_shingles(df.select(F.col(id_col).alias("id"), F.col(text).alias("_t")), "_t").where(F.size("shingles") >= least).select("id", F.sort_array("shingles").alias("shingles"))
    return cut(base.withColumn("copy", F.xxhash64("shingles")))


def near_pairs(df: DataFrame, id_col: str, text: str, least: int = LEAST, **options) -> DataFrame:
    """(a, b, similarity) of rows that share a band, a before b; see `set_pairs`."""
    return set_pairs(shingle_sets(df, id_col, text, least), **options)


def set_pairs(sets: DataFrame, threshold: float = THRESHOLD, verify: bool = True, bands: int | None = None, rows: int | None = None) -> DataFrame:
    """(a, b, similarity) of sets that share a band, a before b; verified by exact similarity unless `verify` is off.

    With the default layout a pair at similarity 0.8 is lost with probability 3e-6 where it is verified.
    Equal sets are compared once, through their first row; all pairs with and between copies follow from it,
    and `near_duplicates` lets the copies follow their first row.
    """
    layout = (BANDS, ROWS) if verify else LOOSE
    bands, rows = bands or layout[0], rows or layout[1]
    first = sets.groupBy("copy").agg(F.min("id").alias("id"))
    reps = cut(sets.join(first, ["copy", "id"], "left_semi").select("id", "shingles"))
    keys = with_keys(reps, "shingles", bands, rows).select("id", F.explode("keys").alias("key"))
    pairs = keys.select("key", F.col("id").alias("a")).join(keys.select("key", F.col("id").alias("b")), "key").where("a < b").select("a", "b").distinct()
    both = pairs.join(reps.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").join(reps.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    both = both.select("a", "b", (shared / (F.size("sa") + F.size("sb") - shared)).alias("similarity"))
    return both.where(F.col("similarity") >= threshold) if verify else both


def greedy(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, duplicate_of): null for rows kept in order of id; others resemble a kept earlier row, the first of which is named.

    The kept rows are the first independent set in order of id; each round decides all rows without
    an undecided earlier neighbour, so the rounds are bounded by the longest chain of repeats.
    """
    lost = cut(pairs.select("b").limit(0))
    while True:
        # what is still open: both ends undecided or kept
        e = pairs.select("a", "b").join(lost, "b", "left_anti").join(lost.withColumnRenamed("b", "a"), "a", "left_anti")
        roots = e.select("a").distinct().join(e.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        now = cut(e.join(roots, "a", "left_semi").select("b").distinct())
        if now.isEmpty():
            break
        lost = lost.unionByName(now)
    match = pairs.join(lost.select(F.col("b").alias("a")), "a", "left_anti").groupBy("b").agg(F.min("a").alias("duplicate_of"))
    return nodes.join(match.withColumnRenamed("b", "id"), "id", "left").select("id", "duplicate_of")


def near_duplicates(df: DataFrame, id_col: str, text: str, least: int = LEAST, exact: DataFrame | None = None, **options) -> DataFrame:
    """(id, duplicate_of) of every row: exact copies first, then greedy near-duplicates among the first rows; exact is what `exact_duplicates` gives."""
    exact = cut(exact_duplicates(df, id_col, text)) if exact is None else exact
    firsts = exact.where("is_first").select("id")
    kept = df.join(firsts.withColumnRenamed("id", id_col), id_col, "left_semi")
    sets = shingle_sets(kept, id_col, text, least)
    near = greedy(firsts, cut(set_pairs(sets, **options)))
    # a row with the set of an earlier one resembles just what that one resembles, and that one itself
    members = sets.select("id", "copy").join(sets.groupBy("copy").agg(F.min("id").alias("rep")), "copy").where("id != rep").select("id", "rep")
    follow = members.join(near.select(F.col("id").alias("rep"), F.coalesce("duplicate_of", "id").alias("of_rep")), "rep").select("id", "of_rep")
    near = near.join(follow, "id", "left").select("id", F.coalesce("of_rep", "duplicate_of").alias("duplicate_of"))
    of = near.withColumnRenamed("id", "first_id")
    out = exact.join(of, "first_id", "left")
    return out.select("id", F.when(F.col("is_first"), F.col("duplicate_of")).otherwise(F.coalesce("duplicate_of", "first_id")).alias("duplicate_of"))


def first_collisions(df: DataFrame, id_col: str, text: str, least: int = LEAST) -> DataFrame:
    """(id, duplicate_of): rows that share a band of the loose layout with an earlier row, and the first such row; nothing is verified."""
    pairs = near_pairs(df, id_col, text, least, verify=False)
    return pairs.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("duplicate_of"))


def save_state(sets: DataFrame, path: str) -> None:
    """Keep the signatures of accepted sets (id, shingles): band keys for probing, and the sets for verification."""
    keyed = with_keys(sets.select("id", "shingles"), "shingles", BANDS, ROWS)
    keyed.write.mode("append").parquet(path)


def against_state(sets: DataFrame, path: str, threshold: float = THRESHOLD) -> DataFrame:
    """(id, duplicate_of) of the sets (id, shingles) that resemble a kept one, the first of which is named; the kept ones are not signed again."""
    kept = sets.sparkSession.read.parquet(path)
    asked = with_keys(sets.select("id", "shingles"), "shingles", BANDS, ROWS).select("id", F.explode("keys").alias("key"))
    met = asked.join(kept.select(F.col("id").alias("a"), F.explode("keys").alias("key")), "key").select("id", "a").distinct()
    both = met.join(sets.select("id", "shingles"), "id").join(kept.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
    shared = F.size(F.array_intersect("shingles", "sa"))
    near = both.where(shared / (F.size("shingles") + F.size("sa") - shared) >= threshold)
    return near.groupBy("id").agg(F.min("a").alias("duplicate_of"))
