"""Upserts, surrogate keys and join shapes over DataFrames."""

from __future__ import annotations

import tempfile
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in the given order. Limits each partition before the shuffle (WindowGroupLimit)."""
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_r = 1").drop("_r")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """Rows of both sides; where a key is in both, columns in `update` come from the new side, others stay.

    One full outer join on the key; `new` must hold each key once.
    """
    o, n = old.alias("o"), new.alias("n")
    on = reduce(lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
    both = o.join(n.withColumn("_new", F.lit(True)).alias("n"), on, "full_outer")
    matched = F.col("n._new").isNotNull()
    kept = F.coalesce(*[F.col(f"o.{k}").isNotNull() for k in keys[:1]])
    cols = []
    for c in old.columns:
        if c in keys:
            cols.append(F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c))
        elif c in update:
            cols.append(F.when(matched, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            cols.append(F.when(kept, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
    return both.select(*cols)


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Append the rows whose key is not there yet."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))


def update_columns(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Replace columns where the new side has a value for the key."""
    n = new.select(key, *[F.col(c).alias(f"_n_{c}") for c in columns])
    joined = old.join(n, key, "left")
    return joined.select(*[F.coalesce(f"_n_{c}", c).alias(c) if c in columns else F.col(c) for c in old.columns])


def get_or_create(dim: DataFrame, id_col: str, name_col: str, values: DataFrame, value_col: str) -> DataFrame:
    """The dimension with a new id for every value whose trimmed lower-cased form is not in it.

    Ids continue after the largest one, in the order of the normalised names. The numbering runs over
    new distinct names only, by range partitions with offsets, so no task holds all of them.
    """
    norm = lambda c: F.lower(F.trim(c))
    fresh = values.select(F.trim(value_col).alias("_v")).where("_v is not null and _v != ''").groupBy(norm(F.col("_v")).alias("_k")).agg(F.min("_v").alias(name_col))
    fresh = fresh.join(dim.select(norm(F.col(name_col)).alias("_k")), "_k", "left_anti")
    fresh = numbered(fresh, "_k", "_n")
    top = dim.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("_top"))
    fresh = fresh.join(F.broadcast(top))  # one row
    kind = dim.schema[id_col].dataType
    return dim.select(id_col, name_col).unionByName(fresh.select((F.col("_top") + F.col("_n")).cast(kind).alias(id_col), name_col))


def numbered(df: DataFrame, order: str, out: str) -> DataFrame:
    """Dense numbers from 1 in the order of a column, without sorting everything in one task.

    Rows are range-partitioned; a small count per partition gives each its offset. The partitioned rows are
    written once: the bounds of a second range exchange could differ from those the counts were taken with.
    """
    part = cut(df.repartitionByRange(F.col(order)).withColumn("_p", F.spark_partition_id()))
    per = part.groupBy("_p").agg(F.count("*").alias("_c"))
    offset = per.withColumn("_o", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_c")
    inside = part.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(order)))
    return inside.join(offset, "_p").withColumn(out, F.col("_o") + F.col("_i")).drop("_p", "_o", "_i")


def asof_join(left: DataFrame, right: DataFrame, by: list[str], time: str, take: list[str]) -> DataFrame:
    """For each left row the last right row of the same key at or before its time: one union, one window, no pairs."""
    cols = [c for c in left.columns if c not in (*by, time)]
    a = left.select(*by, time, F.lit(1).alias("_side"), F.struct(*cols).alias("_row"), F.lit(None).cast(right.select(F.struct(*take)).schema[0].dataType).alias("_val"))
    b = right.select(*by, time, F.lit(0).alias("_side"), F.lit(None).cast(left.select(F.struct(*cols)).schema[0].dataType).alias("_row"), F.struct(*take).alias("_val"))
    w = Window.partitionBy(*by).orderBy(time, "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b).withColumn("_last", F.last("_val", ignorenulls=True).over(w)).where("_side = 1")
    return both.select(*by, time, "_row.*", *[F.col(f"_last.{c}").alias(c) for c in take])


def ranked_list(df: DataFrame, query: str, score: str, tie: str, k: int, rank: str = "rank") -> DataFrame:
    """The best k rows of each query by score, ties by the tie column."""
    w = Window.partitionBy(query).orderBy(F.desc(score), tie)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def missing_any(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which one of the columns is null."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def reconcile(written: DataFrame, reported: int) -> int:
    """Number of rows written; an error unless it is positive and equals the reported number."""
    n = written.count()
    if n != reported or n == 0:
        raise ValueError(f"{n} rows written, {reported} reported")
    return n


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only in local mode where none is configured, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="skein-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Write to the checkpoint folder the cluster names and cut the lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Enough partitions for expression-heavy stages where a scan has few splits; larger inputs stay as they are."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want)
