"""Scans: JSON documents, CSV with untidy headers, checkpoints, site maps, result pages, manifests, configuration."""

from __future__ import annotations

import os
import re
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


RAW_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("document_id", "source_platform", "source_url", "title", "raw_content", "published_at", "scraped_at", "scrape_type", "scrape_batch_id", "source_metadata")])


def read_documents(spark: SparkSession, paths: list[str], suffix: str = "*.json", schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """JSON documents of several prefixes in one scan, with the file of each; broken files give a row with `_corrupt_record`.

    A legacy digest column in the files is not in the schema and so not read.
    """
    wide = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    df = spark.read.schema(wide).option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).option("pathGlobFilter", suffix).json(paths)
    return df.withColumn("_source_path", F.col("_metadata.file_path"))


def list_files(spark: SparkSession, prefix: str, suffix: str) -> DataFrame:
    """(path, length, modified) of the files below a prefix with a suffix, last path first; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(prefix)
    return files.select("path", "length", F.col("modificationTime").alias("modified")).orderBy(F.desc("path"))


def read_csv(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """CSV with quoted line breaks; header names are trimmed; missing required columns are an error."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    df = df.toDF(*[c.strip() for c in df.columns])
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation queries from CSV, trimmed."""
    df = read_csv(spark, path, ("query_id", "query_text", "query_category"))
    return df.select(*[F.trim(c).alias(c) for c in ("query_id", "query_text", "query_category")])


def not_yet_seen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the seen table."""
    return df.join(seen.select(key), key, "left_anti")


def sitemap_entries(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """(loc, lastmod) of a site map index (`sitemap`) or URL set (`url`), newest first, undated last."""
    schema = T.StructType([T.StructField("loc", T.StringType()), T.StructField("lastmod", T.StringType())])
    df = spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", True).schema(schema).load(path)
    df = df.select(F.trim("loc").alias("loc"), F.split_part("lastmod", F.lit("T"), F.lit(1)).alias("lastmod"))
    return df.orderBy(F.desc(F.coalesce("lastmod", F.lit("0000-00-00"))), "loc")


def wanted_sitemaps(entries: DataFrame, prefix: str, since: str, undated: bool) -> DataFrame:
    """Entries below a prefix from a date on; undated ones only where asked for."""
    dated = (F.col("lastmod") >= since) if undated else (F.col("lastmod") > since)
    return entries.where(F.col("loc").startswith(prefix) & (F.coalesce(dated, F.lit(undated))))


def wanted_urls(entries: DataFrame, pattern: str, since: str | None = None, keep_undated: bool = True) -> DataFrame:
    """Addresses that match a pattern, from a date on, each once (its newest entry)."""
    df = entries.where(F.lower("loc").rlike(pattern))
    if since:
        df = df.where(F.coalesce(F.col("lastmod") >= since, F.lit(keep_undated)))
    return df.groupBy(F.col("loc").alias("url")).agg(F.max("lastmod").alias("lastmod"))


def page_nodes(pages: DataFrame, col: str, limit: int | None = None, order: str | None = None) -> DataFrame:
    """Nodes of JSON result pages `{"edges": [{"node": {...}}]}` as (page, place, JSON of the node).

    order is the column that numbers the pages. Pages from the first one without edges on are left out, and `limit`
    keeps the first nodes in order of page and place.
    """
    edges = F.coalesce(F.from_json(col, "struct<edges: array<struct<node: string>>>")["edges"], F.array().cast("array<struct<node: string>>"))
    number = F.col(order) if order else F.lit(0)
    each = pages.select(number.alias("page"), edges.alias("edges"))
    if order:
        end = each.where(F.size("edges") == 0).agg(F.min("page").alias("end"))
        each = each.join(F.broadcast(end)).where("end is null or page < end")  # one row
    out = each.select("page", F.posexplode(F.transform("edges", lambda e: e["node"])).alias("place", "node")).where("node is not null")
    return out if limit is None else out.orderBy("page", "place").limit(limit)


def newest_manifest(manifests: DataFrame, source: str) -> DataFrame:
    """The manifest with the last path among those of one source."""
    mine = manifests.where(F.contains("path", F.lit("scrape_")) & F.contains("path", F.lit(f"/{source}/")))
    return mine.groupBy().agg(F.max_by(F.struct(*manifests.columns), "path").alias("m")).where("m is not null").select("m.*")


def resolve_env(config: Any, env: dict[str, str] | None = None) -> Any:
    """A configuration with ${NAME} replaced; a name that is not set is an error."""
    env = os.environ if env is None else env

    def one(m: re.Match) -> str:
        if m[1] not in env:
            raise KeyError(f"environment variable {m[1]} is not set")
        return env[m[1]]

    if isinstance(config, dict):
        return {k: resolve_env(v, env) for k, v in config.items()}
    if isinstance(config, list):
        return [resolve_env(v, env) for v in config]
    return re.sub(r"\$\{(\w+)\}", one, config) if isinstance(config, str) else config


def read_config(path: str) -> dict:
    """A YAML configuration with its environment names resolved."""
    import yaml

    return resolve_env(yaml.safe_load(Path(path).read_text()))


def same_model(df: DataFrame, model: str) -> DataFrame:
    """The table itself, or an error at run time where a row was made with another model."""
    ok = F.assert_true(F.col("model") == model, F.concat(F.lit(f"expected model {model}, found "), F.coalesce("model", F.lit("none"))))
    return df.where(ok.isNull())


def chunks_scan(df: DataFrame) -> DataFrame:
    """A chunk table with nulls as empty strings and zeros."""
    kinds = dict(df.dtypes)
    return df.select(*[F.coalesce(c, F.lit("" if kinds[c] == "string" else 0)).alias(c) if kinds[c] in ("string", "int", "bigint") else F.col(c) for c in df.columns])


def batch_day(batch: Column) -> Column:
    """The date that a batch id begins with."""
    return F.to_date(F.regexp_extract(batch, r"^\d{4}-\d{2}-\d{2}", 0))


def metadata(df: DataFrame, col: str) -> DataFrame:
    """Add `meta` (variant, null where the JSON is broken) and `meta_state` (missing, broken, valid)."""
    parsed = F.try_parse_json(col)
    state = F.when(F.col(col).isNull(), "missing").when(parsed.isNull(), "broken").otherwise("valid")
    return df.withColumn("meta", parsed).withColumn("meta_state", state)


__all__ = ["RAW_SCHEMA", "batch_day", "chunks_scan", "list_files", "metadata", "newest_manifest", "not_yet_seen", "page_nodes", "read_config", "read_csv", "read_documents", "read_queries", "resolve_env", "same_model", "sitemap_entries", "wanted_sitemaps", "wanted_urls"]
