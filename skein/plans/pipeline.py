"""The document pipeline: named steps in configured order, each a transform that tags rows instead of dropping them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.functions import patterns as P
from skein.functions import text as T
from skein.operators import dedup, entities
from skein.sources.sinks import Checkpoints

Step = Callable[..., DataFrame]
REGISTRY: dict[str, Step] = {}


def register_step(name: str, step: Step) -> None:
    """Add a step, or replace one of the same name."""
    REGISTRY[name] = step


def step(name: str) -> Callable[[Step], Step]:
    return lambda f: REGISTRY.setdefault(name, f)


def reject(df: DataFrame, name: str, reason) -> DataFrame:
    """Tag rows that are not yet rejected and have a reason now."""
    now = F.col("filter_reason").isNull() & F.col("_why").isNotNull()
    tagged = df.withColumn("_why", reason).withColumn("filter_step", F.when(now, F.lit(name)).otherwise(F.col("filter_step")))
    return tagged.withColumn("filter_reason", F.coalesce("filter_reason", "_why")).drop("_why")


@step("content_normalizer")
def content_normalizer(df: DataFrame) -> DataFrame:
    """Clean text, title and word count; empty inputs and results below 20 characters are rejected."""
    blank = ~F.coalesce(F.col("raw_content").rlike(r"\S"), F.lit(False))
    out = df.withColumn("content", T.normalise(F.coalesce("raw_content", F.lit("")), F.col("source_platform")))
    out = out.withColumn("title", T.clean_title(F.col("title")))
    out = out.withColumn("word_count", T.word_count(F.col("content"))).withColumn("source_platform", T.platform(F.col("source_platform")))
    return reject(out, "content_normalizer", F.when(blank, "empty_raw_content").when(F.length("content") < 20, "empty_after_cleaning"))


@step("pii_remover")
def pii_remover(df: DataFrame) -> DataFrame:
    """Redacted content and title, and counts of the redactions in the content; never rejects."""
    out = df.withColumn("_c", T.redact_and_count(F.col("content"))).withColumn("title", T.redact(F.col("title")))
    return out.withColumn("pii_counts", F.col("_c.counts")).withColumn("content", F.col("_c.text")).drop("_c")


@step("quality_filter")
def quality_filter(df: DataFrame) -> DataFrame:
    """Length, error pages, language and signal, in this order; the score of what passes."""
    lang = T.language(F.col("content"))
    reason = T.rejection(F.col("content"), F.col("word_count"))
    low = F.lit("low_interview_signal")
    reason = F.when(reason.isNull() | (reason == low), F.when(~lang.eqNullSafe("en"), F.lit("non_english")).otherwise(reason)).otherwise(reason)
    out = reject(df, "quality_filter", reason)
    return out.withColumn("quality_score", F.when(F.col("filter_reason").isNull(), T.quality_score(F.col("word_count"), T.signal_ratio(F.col("content")))))


@step("deduplicator")
def deduplicator(df: DataFrame) -> DataFrame:
    """Exact and near duplicates among the rows not rejected so far, the first in order of ingest_seq stays."""
    df = reject(df, "deduplicator", F.when(~F.coalesce(F.col("content").rlike(r"\S"), F.lit(False)), "empty_content_at_dedup"))
    live = dedup.cut(df.where("filter_reason is null").select("ingest_seq", "content"))
    exact = dedup.cut(dedup.exact_duplicates(live, "ingest_seq", "content"))
    of = dedup.near_duplicates(live, "ingest_seq", "content", exact=exact).withColumnRenamed("id", "ingest_seq")
    exact = exact.select(F.col("id").alias("ingest_seq"), "content_hash", "is_first")
    out = df.drop("content_hash").join(exact, "ingest_seq", "left").join(of, "ingest_seq", "left")
    out = reject(out, "deduplicator", F.when(~F.col("is_first"), "exact_duplicate").when(F.col("duplicate_of").isNotNull(), "near_duplicate"))
    return out.drop("is_first", "duplicate_of")


def with_company_and_role(df: DataFrame, companies: DataFrame | None = None, job_roles: DataFrame | None = None, id_col: str | None = None) -> DataFrame:
    """Add company and role by all tiers; companies (name) and job_roles (title) are the lists, of any size, empty where none is given.

    Rows are told apart by id_col; without one by ingest_seq or document_id, or else the first column.
    """
    id_col = id_col or next(c for c in ("ingest_seq", "document_id", df.columns[0]) if c in df.columns)
    none = df.sparkSession.createDataFrame([], "alias string, canonical string")
    docs = df.select(F.col(id_col).alias("id"), "title", "content")
    company = entities.companies(docs, none if companies is None else companies.select(F.col("name").alias("alias"), F.col("name").alias("canonical")))
    role = entities.roles(docs, none if job_roles is None else job_roles.select(F.col("title").alias("alias"), F.col("title").alias("canonical")))
    return df.join(company.join(role, "id", "left").withColumnRenamed("id", id_col), id_col, "left")


@step("entity_extractor")
def entity_extractor(df: DataFrame, companies: DataFrame | None = None, job_roles: DataFrame | None = None) -> DataFrame:
    """Company, role, level, types, rounds, topics, outcome and difficulty; never rejects."""
    both = F.concat_ws(" ", "title", "content")
    text = F.col("content")
    out = with_company_and_role(df, companies, job_roles)
    out = out.withColumn("experience_level", T.first_match(both, P.LEVELS)).withColumn("interview_types", T.all_matches(text, P.INTERVIEW_TYPES, "unknown"))
    out = out.withColumn("num_rounds", T.num_rounds(text)).withColumn("topics", F.sort_array(T.all_matches(text, P.TOPICS)))
    return out.withColumn("interview_outcome", T.outcome(text)).withColumn("difficulty", T.first_match(text, P.DIFFICULTY))


@step("schema_validator")
def schema_validator(df: DataFrame) -> DataFrame:
    """Required fields, platform and enumerations; a missing field rejects, a stray value becomes null."""
    required = ("document_id", "source_platform", "source_url", "content_hash", "title", "content")
    missing = F.array_compact(F.array(*[F.when(~F.coalesce(F.col(c).rlike(r"\S"), F.lit(False)), F.lit(c)) for c in required]))
    bad = ~F.col("source_platform").isin(*set(P.PLATFORMS.values()))
    reason = F.when(F.size(missing) > 0, F.concat(F.lit("schema_validation_failed: missing "), F.array_join(missing, ", "))).when(bad, F.concat(F.lit("schema_validation_failed: platform "), F.col("source_platform")))
    out = reject(df, "schema_validator", reason)
    for c in ("experience_level", "interview_outcome", "difficulty"):
        out = out.withColumn(c, T.safe_enum(F.col(c), P.ENUMS[c]))
    return out.withColumn("interview_types", F.filter("interview_types", lambda x: x.isin(*P.ENUMS["interview_types"])))


ORDER = ["content_normalizer", "pii_remover", "quality_filter", "deduplicator", "entity_extractor", "schema_validator"]


@dataclass
class Pipeline:
    """Steps by name; a checkpoint after each named in `checkpoint_after` lets a run resume.

    After the steps in `materialise_after` the rows are written to the shared folder and read back, so
    later steps that use the clean text several times do not clean it again. `options` has further
    arguments of a step by its name.
    """

    steps: list[str] = field(default_factory=lambda: list(ORDER))
    disabled: set[str] = field(default_factory=set)
    checkpoint_after: set[str] = field(default_factory=set)
    materialise_after: set[str] = field(default_factory=lambda: {"content_normalizer", "pii_remover", "quality_filter"})
    options: dict[str, dict] = field(default_factory=dict)

    def plan(self, df: DataFrame) -> DataFrame:
        """All steps over the raw documents; one plan but for the iteration inside deduplication."""
        return self.run(df, None)

    def run(self, df: DataFrame, checkpoints: Checkpoints | None, resume: bool = False) -> DataFrame:
        names = [s for s in self.steps if s not in self.disabled]
        if unknown := [s for s in names if s not in REGISTRY]:
            raise KeyError(f"unknown steps: {', '.join(unknown)}")
        start, current = 0, df.withColumn("filter_step", F.lit(None).cast("string")).withColumn("filter_reason", F.lit(None).cast("string"))
        if resume and checkpoints and (last := checkpoints.load_latest()):
            start, current = last[0] + 1, last[2]
        for i, name in enumerate(names[start:], start):
            current = REGISTRY[name](current, **self.options.get(name, {}))
            if checkpoints and name in self.checkpoint_after:
                current = checkpoints.save(i, name, current)
            elif name in self.materialise_after:
                current = dedup.cut(current)
        return current


def kept(df: DataFrame) -> DataFrame:
    return df.where("filter_reason is null")


def report(df: DataFrame) -> DataFrame:
    """(filter_step, filter_reason, n): rows by the step and reason that rejected them; numbers in reasons are masked."""
    why = F.coalesce(F.regexp_replace("filter_reason", r"\d+", "n"), F.lit("kept"))
    return df.groupBy(F.coalesce("filter_step", F.lit("none")).alias("filter_step"), why.alias("filter_reason")).agg(F.count("*").alias("n"))


def statistics(df: DataFrame, steps: list[str] | None = None) -> DataFrame:
    """(step, n_input, n_output, n_filtered, pass_rate, reasons) of tagged rows: every step's share of what the steps before left; one row a step."""
    order = steps or ORDER
    why = F.regexp_replace("filter_reason", r"\d+", "n")
    per = df.groupBy(F.col("filter_step").alias("step"), why.alias("why")).agg(F.count("*").alias("n"))
    per = per.groupBy("step").agg(F.sum("n").alias("n"), F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.coalesce("why", F.lit("kept")).alias("k"), "n"))))).alias("reasons"))
    names = F.array(*[F.struct(F.lit(i).alias("o"), F.lit(s).alias("step")) for i, s in enumerate(order)])
    rows = per.agg(F.sum("n").alias("all")).select("all", F.explode(names).alias("x")).select("all", "x.o", "x.step").join(F.broadcast(per.where("step is not null")), "step", "left")
    before = F.coalesce(F.sum(F.coalesce("n", F.lit(0))).over(Window.orderBy("o").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a step
    out = rows.select("step", (F.col("all") - before).alias("n_input"), F.coalesce("n", F.lit(0)).alias("n_filtered"), "reasons", "o")
    return out.select("step", "n_input", (F.col("n_input") - F.col("n_filtered")).alias("n_output"), "n_filtered", F.coalesce(F.try_divide(F.col("n_input") - F.col("n_filtered"), "n_input"), F.lit(0.0)).alias("pass_rate"), F.coalesce("reasons", F.lit("{}")).alias("reasons"))
