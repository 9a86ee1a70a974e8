"""Loading documents into tables: what could be read, what was written, and the rows of metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import patterns as P
from skein.functions import text as T


def read_states(files: DataFrame, path: str, body: str, required: list[str]) -> DataFrame:
    """(path, document, state, message) of files (path, body): `ok`, `failed_read` for what is no JSON object, `failed_insert` for one without a required field.

    Every row has a state of its own: one bad file fails nothing else.
    """
    parsed = F.try_parse_json(body)
    field = lambda c: F.try_variant_get(parsed, f"$.{c}", "string")
    read = F.startswith(F.trim(F.coalesce(body, F.lit(""))), F.lit("{")) & parsed.isNotNull()
    missing = F.array_compact(F.array(*[F.when(F.trim(F.coalesce(field(c), F.lit(""))) == "", F.lit(c)) for c in required]))
    state = F.when(~read, "failed_read").when(F.size(missing) > 0, "failed_insert").otherwise("ok")
    message = F.when(F.col("state") == "failed_read", F.when(F.col("_blank"), "empty file").otherwise("no JSON object")).when(F.col("state") == "failed_insert", F.concat(F.lit("missing "), F.array_join("_missing", ", ")))
    out = files.select(F.col(path).alias("path"), F.when(read, F.col(body)).alias("document"), state.alias("state"), missing.alias("_missing"), (F.trim(F.coalesce(body, F.lit(""))) == "").alias("_blank"))
    return out.select("path", "document", "state", message.alias("message"))


def summary(states: DataFrame) -> DataFrame:
    """One row: total, inserted, skipped, and how many could not be read or inserted."""
    n = lambda s: F.count_if(F.col("state") == s)
    return states.agg(F.count("*").alias("total"), n("ok").alias("inserted"), (n("failed_read") + n("failed_insert")).alias("skipped"), n("failed_read").alias("failed_reads"), n("failed_insert").alias("failed_inserts"))


def metadata_rows(docs: DataFrame) -> DataFrame:
    """Metadata of the documents that have a company and a role: their names, safe enumerations, the first interview type, topics."""
    full = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    first: Column = F.get("interview_types", F.lit(0))
    out = docs.where(full("company") & full("role"))
    enums = [T.safe_enum(F.col(c), P.ENUMS[c]).alias(c) for c in ("experience_level", "interview_outcome", "difficulty")]
    return out.select("document_id", F.trim("company").alias("company"), F.trim("role").alias("role"), *enums, "num_rounds", T.safe_enum(first, P.ENUMS["interview_types"]).alias("interview_type"), F.coalesce("topics", F.array().cast("array<string>")).alias("topics"))


def manifest(log: DataFrame, url: str, error: str, when: str) -> DataFrame:
    """One row of a scrape log: collected, failed, the latest time, and the first ten addresses that failed."""
    bad = F.col(error).isNotNull()
    first = log.where(bad).select(F.col(url).alias("u")).distinct().orderBy("u").limit(10).agg(F.array_sort(F.collect_list("u")).alias("error_urls"))
    return log.agg(F.count_if(~bad).alias("collected"), F.count_if(bad).alias("errors"), F.max(when).alias("last")).join(F.broadcast(first))  # one row each
