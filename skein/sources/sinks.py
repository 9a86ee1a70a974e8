"""Sinks: partitioned writes, quarantine, checkpoints with a pointer, reports and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators.relational import reconcile


def _path(spark: SparkSession, where: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(where)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def write_processed(df: DataFrame, path: str, batch: str = "scrape_batch_id", form: str = "parquet") -> None:
    """One directory per batch; files follow the partitioning, not the documents."""
    df.write.mode("overwrite").partitionBy(batch).format(form).save(path)


def write_quarantine(df: DataFrame, path: str, batch: str = "scrape_batch_id", reason: str = "filter_reason") -> None:
    """Rejected rows by batch and reason; numbers in a reason are masked, so directories stay few."""
    masked = df.where(F.col(reason).isNotNull()).withColumn("reason", F.regexp_replace(reason, r"\d+", "n"))
    masked.write.mode("overwrite").partitionBy(batch, "reason").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report of one row as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


class Checkpoints:
    """Step outputs with a pointer to the last complete one, so a run can resume after it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def save(self, order: int, step: str, df: DataFrame) -> DataFrame:
        where = f"{self.path}/{order:02d}_{step}"
        df.write.mode("overwrite").parquet(where)
        # the pointer is written last and by one commit: a lost executor leaves the former one
        self.spark.createDataFrame([(order, step, where)], "step_order int, step string, path string").coalesce(1).write.mode("overwrite").json(f"{self.path}/_latest")
        return self.spark.read.schema(df.schema).parquet(where)

    def load_latest(self) -> tuple[int, str, DataFrame] | None:
        p, fs = _path(self.spark, f"{self.path}/_latest")
        if not fs.exists(p):
            return None
        row = self.spark.read.schema("step_order int, step string, path string").json(f"{self.path}/_latest").first()
        return (row.step_order, row.step, self.spark.read.parquet(row.path)) if row else None

    def clear(self) -> None:
        p, fs = _path(self.spark, self.path)
        fs.delete(p, True)


def verify(spark: SparkSession, path: str, report_path: str, column: str = "written") -> int:
    """Rows at path against the number in the report."""
    row = spark.read.json(report_path).first()
    if row is None:
        raise ValueError(f"no report at {report_path}")
    return reconcile(spark.read.parquet(path), row[column])


def append_log(df: DataFrame, path: str, time: str = "logged_at") -> None:
    """Append query log rows, partitioned by day."""
    df.withColumn("day", F.to_date(time)).write.mode("append").partitionBy("day").parquet(path)
