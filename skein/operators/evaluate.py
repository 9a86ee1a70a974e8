"""Retrieval quality: ranked metrics, groups and their disparity, selection and decision."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Cut-offs, grade from which a text is relevant, weights of the selection score, storage it is measured against.
CUTS, RELEVANT = (5, 10, 15), 1
WEIGHTS = {"ndcg": 0.47, "recall": 0.29, "mrr": 0.18, "storage": 0.06}
STORAGE_MB, GAP, DISPARITY = 120.0, 0.05, 0.1


def judged(qrels: DataFrame) -> DataFrame:
    """(query_id, id, grade): the latest judgment of each pair, failed ones left out."""
    w = Window.partitionBy("query_id", "relevant_chunk_id").orderBy(F.desc("created_at"), F.desc("judgment_id"))
    last = qrels.where("relevance >= 0").withColumn("_r", F.row_number().over(w)).where("_r = 1")
    return last.select("query_id", F.col("relevant_chunk_id").alias("id"), F.col("relevance").alias("grade"))


def per_query(queries: DataFrame, ranked: DataFrame, grades: DataFrame, cuts=CUTS, relevant: int = RELEVANT) -> DataFrame:
    """One row per query and cut-off: reciprocal rank, recall (null without relevant texts), precision, ndcg.

    queries has query_id and query_category; ranked has query_id, id, rank from 1.
    """
    gain = lambda g: F.pow(F.lit(2.0), g) - 1
    discount = lambda r: F.log(F.lit(2.0)) / F.log(r + 1.0)
    hits = ranked.where(F.col("rank") <= max(cuts)).join(grades, ["query_id", "id"], "left")
    good = F.col("grade") >= relevant
    found = hits.groupBy("query_id").agg(
        *[x for k in cuts for inside in [F.col("rank") <= k] for x in (
            F.min(F.when(inside & good, F.col("rank"))).alias(f"first_{k}"),
            F.count_if(inside & good).alias(f"hits_{k}"),
            F.count_if(inside).alias(f"shown_{k}"),
            F.sum(F.when(inside, gain(F.coalesce("grade", F.lit(0))) * discount(F.col("rank"))).otherwise(0.0)).alias(f"dcg_{k}"),
        )]
    )
    best = grades.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("grade"), "id")))
    ideal = best.groupBy("query_id").agg(F.count_if(good).alias("n_relevant"), *[F.sum(F.when(F.col("rank") <= k, gain(F.col("grade")) * discount(F.col("rank"))).otherwise(0.0)).alias(f"idcg_{k}") for k in cuts])
    wide = queries.join(found, "query_id", "left").join(ideal, "query_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    rows = F.array(*[
        F.struct(
            F.lit(k).alias("k"),
            F.coalesce(1.0 / F.col(f"first_{k}"), F.lit(0.0)).alias("reciprocal_rank"),
            (zero(f"hits_{k}") / F.nullif(F.col("n_relevant"), F.lit(0))).alias("recall"),
            F.coalesce(F.col(f"hits_{k}") / F.nullif(F.col(f"shown_{k}"), F.lit(0)), F.lit(0.0)).alias("precision"),
            F.coalesce(zero(f"dcg_{k}") / F.nullif(F.col(f"idcg_{k}"), F.lit(0.0)), F.lit(0.0)).alias("ndcg"),
        )
        for k in cuts
    ])
    return wide.select("query_id", "query_category", F.explode(rows).alias("m")).select("query_id", "query_category", "m.*")


def metrics(by_query: DataFrame) -> DataFrame:
    """(query_category, k, n_queries, mrr, recall, precision, ndcg) of each category and, with category `overall`, of all queries."""
    named = by_query.withColumn("query_category", F.coalesce("query_category", F.lit("uncategorised")))
    g = named.rollup("k", "query_category")
    out = g.agg(F.grouping("query_category").alias("_all"), F.count("*").alias("n_queries"), *[F.round(F.avg(c), 6).alias(n) for c, n in (("reciprocal_rank", "mrr"), ("recall", "recall"), ("precision", "precision"), ("ndcg", "ndcg"))])
    out = out.where("k is not null")
    return out.select(F.when(F.col("_all") == 1, F.lit("overall")).otherwise(F.col("query_category")).alias("query_category"), "k", "n_queries", "mrr", "recall", "precision", "ndcg")


def disparity(category_metrics: DataFrame, metric: str = "ndcg", k: int = 10) -> DataFrame:
    """(query_category, value, overall_mean, disparity, underperforming): categories far below the mean of the categories."""
    c = category_metrics.where((F.col("k") == k) & (F.col("query_category") != "overall")).select("query_category", F.col(metric).alias("value"))
    w = Window.partitionBy(F.lit(1))  # one row per category
    mean = F.round(F.avg("value").over(w), 4)
    out = c.select("query_category", "value", mean.alias("overall_mean"), F.round(F.max("value").over(w) - F.min("value").over(w), 4).alias("disparity"))
    out = out.withColumn("underperforming", F.col("value") < F.col("overall_mean") - DISPARITY)
    return out.withColumn("note", F.when(F.count("*").over(w) < 2, F.lit("fewer than two categories")))


def bias(category_metrics: DataFrame, metric: str = "ndcg", k: int = 10) -> DataFrame:
    """(config, disparity, place) of configs, the least biased first; configs with fewer than two categories are left out."""
    c = category_metrics.where((F.col("k") == k) & (F.col("query_category") != "overall")).groupBy("config")
    d = c.agg(F.count("*").alias("n"), F.round(F.max(metric) - F.min(metric), 4).alias("disparity")).where("n >= 2")
    return d.select("config", "disparity", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("disparity", "config")).alias("place"))  # one row per config


def storage_mb(n: int, dims: int) -> float:
    """Megabytes of n vectors: four bytes a dimension and 64 bytes of overhead; none for lexical lists (dims 0)."""
    return n * (dims * 4 + 64) / 2**20 if dims else 0.0


def selection(overall: DataFrame, storage: DataFrame) -> DataFrame:
    """(config, selection_score, place): configs by weighted quality; overall has config, k and metrics, storage has config and mb."""
    at = lambda m, k: F.max(F.when(F.col("k") == k, F.col(m)))
    s = overall.where("query_category = 'overall'").groupBy("config").agg(at("ndcg", 10).alias("ndcg"), at("recall", 10).alias("recall"), at("mrr", 5).alias("mrr"))
    s = s.join(storage, "config")
    score = WEIGHTS["ndcg"] * F.col("ndcg") + WEIGHTS["recall"] * F.col("recall") + WEIGHTS["mrr"] * F.col("mrr") + WEIGHTS["storage"] * F.least(F.lit(1.0), STORAGE_MB / F.greatest("mb", F.lit(1.0)))
    s = s.select("config", "ndcg", F.round(score, 6).alias("selection_score"))
    return s.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("selection_score"), "config")))  # one row per config


def decision(selected: DataFrame, candidates: list[str]) -> DataFrame:
    """(winner, candidate, relative_gap, accept): the best of the candidates against the winner by ndcg."""
    top = selected.where("place = 1").select(F.col("config").alias("winner"), F.col("ndcg").alias("best"))
    mine = selected.where(F.col("config").isin(*candidates)).orderBy("place").limit(1).select(F.col("config").alias("candidate"), F.col("ndcg").alias("own"))
    gap = F.round((F.col("best") - F.col("own")) / F.nullif("best", F.lit(0.0)), 6)
    return top.join(F.broadcast(mine)).select("winner", "candidate", gap.alias("relative_gap"), (gap <= GAP).alias("accept"))  # one row each


def grade_separation(ranked: DataFrame, grades: DataFrame) -> DataFrame:
    """(grade, n, mean_score): scores by grade, texts without judgment as `unjudged`."""
    hit = ranked.join(grades, ["query_id", "id"], "left")
    return hit.groupBy(F.coalesce(F.col("grade").cast("string"), F.lit("unjudged")).alias("grade")).agg(F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean_score"))


def grade_gap(ranked: DataFrame, grades: DataFrame) -> DataFrame:
    """(gap): mean score of the texts of grade 2 minus that of grade 0; null where one has none."""
    hit = ranked.join(grades, ["query_id", "id"])
    mean = lambda g: F.avg(F.when(F.col("grade") == g, F.col("score")))
    return hit.agg(F.round(mean(2) - mean(0), 4).alias("gap"))


def coerced(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns read as whole numbers; rows where one of them is none are left out."""
    out = df.withColumns({c: F.trim(F.col(c).cast("string")).try_cast("double") for c in columns})
    return out.na.drop(subset=columns).withColumns({c: F.col(c).cast("bigint") for c in columns})


def details(queries: DataFrame, ranked: DataFrame, grades: DataFrame) -> DataFrame:
    """One row per query: grade counts of its judgments, grade of the first text (-1 without judgment), hits among the first ten, grades and scores in order of rank."""
    hist = grades.groupBy("query_id").agg(*[F.count_if(F.col("grade") == g).alias(f"n_grade_{g}") for g in (0, 1, 2)])
    hit = ranked.join(grades, ["query_id", "id"], "left")
    top = hit.groupBy("query_id").agg(F.max(F.when(F.col("rank") == 1, F.coalesce("grade", F.lit(-1)))).alias("top_grade"), F.count_if((F.col("rank") <= 10) & (F.col("grade") >= RELEVANT)).alias("hits_at_10"), F.sort_array(F.collect_list(F.struct("rank", F.coalesce("grade", F.lit(-1)).alias("grade"), F.round("score", 4).alias("score")))).alias("l"))
    out = queries.select("query_id").join(hist, "query_id", "left").join(top, "query_id", "left")
    return out.select("query_id", *[F.coalesce(f"n_grade_{g}", F.lit(0)).cast("bigint").alias(f"n_grade_{g}") for g in (0, 1, 2)], F.coalesce("top_grade", F.lit(-1)).alias("top_grade"), F.coalesce("hits_at_10", F.lit(0)).cast("bigint").alias("hits_at_10"), F.transform("l", lambda x: x["grade"]).alias("grades"), F.transform("l", lambda x: x["score"]).alias("scores"))
