"""Drift of embeddings: reference statistics, centroid distance, shift by dimension, two-sample tests, composite flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Limits of centroid distance, 95th percentile of the shift, share of drifted dimensions; limits to be broken; queries needed.
CENTROID, SHIFT, SHARE, BROKEN, LEAST, ALPHA = 0.15, 2.0, 0.30, 2, 20, 0.05
#: Share of the baseline by which a score may fall.
DEGRADATION = 0.03
#: Buckets of values of a dimension in which ranks are counted; results do not depend on it.
BUCKETS = 4096


def long(df: DataFrame, vector: str) -> DataFrame:
    """(dim, x) of every component of every vector; null vectors give none."""
    return df.where(F.col(vector).isNotNull()).select(F.posexplode(vector).alias("dim", "x")).select("dim", F.col("x").cast("double").alias("x"))


def statistics(df: DataFrame, vector: str) -> DataFrame:
    """(dim, n, mean, std) with the population standard deviation: one partial aggregate per task and dimension."""
    return long(df, vector).groupBy("dim").agg(F.count("*").alias("n"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))


def centroid_distance(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(centroid_distance): one minus the cosine of the two mean vectors, from their statistics."""
    both = reference.select("dim", F.col("mean").alias("r")).join(current.select("dim", F.col("mean").alias("c")), "dim")
    d = 1 - F.sum(F.col("r") * F.col("c")) / F.nullif(F.sqrt(F.sum(F.col("r") ** 2)) * F.sqrt(F.sum(F.col("c") ** 2)), F.lit(0.0))
    return both.agg(d.alias("centroid_distance"))


def shift(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(shift_p95): the 95th percentile over dimensions of the shift of the mean in standard deviations."""
    both = reference.join(current.select("dim", F.col("mean").alias("m2")), "dim")
    z = F.abs(F.col("m2") - F.col("mean")) / F.greatest("std", F.lit(1e-8))
    return both.agg(F.percentile(z, 0.95).alias("shift_p95"))


def two_sample(reference: DataFrame, current: DataFrame, vector: str) -> DataFrame:
    """(dim, n_ref, n_cur, ks): the exact two-sample statistic of every dimension.

    Ranks are counted in two steps, so no task sorts a whole dimension: counts per bucket of values
    give each bucket its start, and a window inside the bucket does the rest. A bucket is a share of the
    dimension's own range, so the scale of the values does not matter.
    """
    a = long(reference, vector).select("dim", "x", F.lit(1).alias("r"), F.lit(0).alias("c"))
    b = long(current, vector).select("dim", "x", F.lit(0).alias("r"), F.lit(1).alias("c"))
    both = a.unionByName(b)
    range_ = both.groupBy("dim").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    bucket = F.coalesce(F.floor((F.col("x") - F.col("low")) * BUCKETS / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))), F.lit(0))
    points = both.join(range_, "dim").withColumn("bucket", bucket).groupBy("dim", "bucket", "x").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    per = points.groupBy("dim", "bucket").agg(F.sum("r").alias("br"), F.sum("c").alias("bc"))
    before = Window.partitionBy("dim").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("dim")
    per = per.select("dim", "bucket", F.coalesce(F.sum("br").over(before), F.lit(0)).alias("r0"), F.coalesce(F.sum("bc").over(before), F.lit(0)).alias("c0"), F.sum("br").over(whole).alias("n_ref"), F.sum("bc").over(whole).alias("n_cur"))
    inside = Window.partitionBy("dim", "bucket").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    run = points.withColumn("r1", F.sum("r").over(inside)).withColumn("c1", F.sum("c").over(inside)).join(per, ["dim", "bucket"])
    # null where one side has no vectors
    gap = F.abs(F.try_divide(F.col("r0") + F.col("r1"), F.col("n_ref")) - F.try_divide(F.col("c0") + F.col("c1"), F.col("n_cur")))
    return run.groupBy("dim").agg(F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"), F.max(gap).alias("ks"))


def drifted(tests: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """(dim, ks, drifted): whether the statistic passes the asymptotic critical value."""
    critical = F.sqrt(-F.log(F.lit(alpha / 2)) / 2) * F.sqrt(F.try_divide(F.col("n_ref") + F.col("n_cur"), F.col("n_ref") * F.col("n_cur")))
    return tests.select("dim", "ks", (F.col("ks") > critical).alias("drifted"))


def composite(reference: DataFrame, current: DataFrame, vector: str) -> DataFrame:
    """One row: the three measures, the limits broken, and the flag; no flag with fewer than LEAST current vectors."""
    rs, cs = statistics(reference, vector), statistics(current, vector)
    share = drifted(two_sample(reference, current, vector)).agg(F.avg(F.col("drifted").cast("double")).alias("drifted_share"))
    n = current.where(F.col(vector).isNotNull()).agg(F.count("*").alias("n_current"))
    one = centroid_distance(rs, cs).join(F.broadcast(shift(rs, cs))).join(F.broadcast(share)).join(F.broadcast(n))  # one row each
    broken = (F.col("centroid_distance") > CENTROID).cast("int") + (F.col("shift_p95") > SHIFT).cast("int") + (F.col("drifted_share") > SHARE).cast("int")
    return one.withColumn("limits_broken", F.coalesce(broken, F.lit(0))).withColumn("drift", (F.col("n_current") >= LEAST) & (F.col("limits_broken") >= BROKEN))


def trigger(tests: DataFrame, share: float = SHARE) -> DataFrame:
    """(drifted_share, refresh) of drifted tests: whether the share of drifted dimensions calls for a refresh of the corpus."""
    part = F.avg(F.col("drifted").cast("double"))
    return tests.agg(F.round(part, 6).alias("drifted_share"), F.coalesce(part > share, F.lit(False)).alias("refresh"))


def degraded(baseline: float, current: float, most: float = DEGRADATION) -> bool:
    """Whether a score has fallen by more than a share of the baseline."""
    return baseline > 0 and (baseline - current) / baseline > most
