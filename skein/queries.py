"""Every query by name over the test tables, with DuckDB SQL for those that SQL can express.

Queries read whole tables. Text patterns are used in their ASCII forms on both sides.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.functions import patterns as P
from skein.functions import text as T
from skein.operators import chunk, dedup, drift, entities, evaluate, loading, retrieval
from skein.operators import relational as R
from skein.plans import pipeline
from skein.sources import parsers, readers
from skein.streaming import streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _list(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def _re(pattern: str) -> str:
    return pattern.replace("'", "''")


#: SQL pieces shared by several queries.
WORDS = r"list_filter(string_split_regex({0}, '[ \t\n\r\f]+'), lambda w: w <> '')"
SIGNAL = f"len(list_filter({WORDS.format('lower({0})')}, lambda w: w IN {_list(P.SIGNAL)}))"
PLATFORM = "CASE WHEN lower(trim(source_platform)) IN ('gfg', 'geeksforgeeks') THEN 'gfg' ELSE lower(trim(source_platform)) END"


# ---- documents: quality, normalisation, extraction -----------------------------------------------------------------


@query(
    rf"""
    WITH d AS (
        SELECT ingest_seq, {PLATFORM} AS platform, coalesce(raw_content, '') AS t,
               len({WORDS.format("coalesce(raw_content, '')")}) AS n,
               {SIGNAL.format("coalesce(raw_content, '')")} AS hits,
               trim(regexp_replace(lower(coalesce(raw_content, '')), '[ \t\n\r\f]+', ' ', 'g')) AS norm
        FROM raw_documents),
    f AS (SELECT *, CASE WHEN n > 0 THEN hits / n ELSE 0 END AS ratio, min(ingest_seq) OVER (PARTITION BY norm) AS first_id FROM d),
    r AS (
        SELECT platform, n, CASE WHEN n = 0 THEN 'empty' WHEN n < 50 THEN 'too_short' WHEN n > 15000 THEN 'too_long'
            WHEN regexp_matches(substr(t, 1, 500), '(?i)(?:{_re("|".join(P.ERROR_PAGE))})') THEN 'error_or_junk_page'
            WHEN ratio < 0.02 THEN 'low_interview_signal' WHEN ingest_seq <> first_id THEN 'exact_duplicate' ELSE 'kept' END AS reason,
            0.5 * (CASE WHEN n < 200 THEN n / 200.0 WHEN n <= 2000 THEN 1.0 ELSE greatest(0.5, 1.0 - (n - 2000) / 10000.0) END) + 0.5 * least(1.0, ratio / 0.10) AS score
        FROM f)
    SELECT platform, reason, count(*) AS n_documents, CAST(sum(n) AS BIGINT) AS n_words, round(avg(score), 6) AS mean_score FROM r GROUP BY ALL
    """
)
def corpus_quality_report(spark, sf):
    """Flagship: normalise, gate, exact duplicates, score, and the histogram of reasons by platform, in one plan."""
    d = load(spark, sf, "raw_documents")
    t = F.coalesce("raw_content", F.lit(""))
    d = d.select("ingest_seq", T.platform(F.col("source_platform")).alias("platform"), T.word_count(t).alias("n"), T.signal_ratio(t).alias("ratio"), T.is_error_page(t).alias("junk"), T.content_hash(t).alias("h"))
    d = R.cut(d)  # the flags are computed once, and the text is in no shuffle
    failed = (
        F.when(F.col("n") == 0, "empty").when(F.col("n") < P.MIN_WORDS, "too_short").when(F.col("n") > P.MAX_WORDS, "too_long")
        .when(F.col("junk"), "error_or_junk_page").when(F.col("ratio") < P.MIN_SIGNAL, "low_interview_signal")
    )
    # only hashes that more than one row has are joined, and only rows without another reason ask
    first = d.groupBy("h").agg(F.min("ingest_seq").alias("first_id"), F.count("*").alias("copies")).where("copies > 1").select("h", "first_id")
    d = d.withColumn("failed", failed).withColumn("h", F.when(F.col("failed").isNull(), F.col("h")))
    d = d.join(first, "h", "left")
    reason = F.coalesce("failed", F.when(F.col("ingest_seq") != F.col("first_id"), "exact_duplicate"), F.lit("kept"))
    length = F.when(F.col("n") < 200, F.col("n") / 200.0).when(F.col("n") <= 2000, F.lit(1.0)).otherwise(F.greatest(F.lit(0.5), 1.0 - (F.col("n") - 2000) / 10000.0))
    score = 0.5 * length + 0.5 * F.least(F.lit(1.0), F.col("ratio") / 0.10)
    return d.groupBy("platform", reason.alias("reason")).agg(F.count("*").alias("n_documents"), F.sum("n").cast("bigint").alias("n_words"), F.round(F.avg(score), 6).alias("mean_score"))


@query(rf"SELECT document_id, CAST(len({WORDS.format('content')}) AS INTEGER) AS counted, word_count AS stated, len({WORDS.format('content')}) <> word_count AS stale FROM processed_documents")
def word_count_check(spark, sf):
    d = load(spark, sf, "processed_documents")
    n = T.word_count(F.col("content"))
    return d.select("document_id", n.alias("counted"), F.col("word_count").alias("stated"), (n != F.col("word_count")).alias("stale"))


@query(f"SELECT {PLATFORM} AS platform, count(*) AS n, count(DISTINCT document_id) AS n_ids FROM raw_documents GROUP BY ALL")
def platform_counts(spark, sf):
    d = load(spark, sf, "raw_documents")
    return d.groupBy(T.platform(F.col("source_platform")).alias("platform")).agg(F.count("*").alias("n"), F.count_distinct("document_id").alias("n_ids"))


#: The Markdown rules for an engine without back references: emphasis is written out by its marks, longest first.
_SQL_EMPHASIS = "|".join(f"{re.escape(m)}(.+?){re.escape(m)}" for m in ("***", "**", "*", "___", "__", "_"))
_SQL_MARKDOWN = [(_SQL_EMPHASIS, r"\1\2\3\4\5\6") if r"\1" in p else (p.replace("(?d)", "").replace("(?dm)", "(?m)"), r.replace("$", "\\")) for p, r in P.MARKDOWN]


@query("SELECT ingest_seq, " + reduce(lambda s, r: f"regexp_replace({s}, '{_re(r[0])}', '{r[1]}', 'g')", _SQL_MARKDOWN, "replace(raw_content, chr(13), '')") + " AS plain FROM raw_documents WHERE raw_content IS NOT NULL")
def markdown_strip(spark, sf):
    """All Markdown rules over whole posts."""
    d = R.spread(load(spark, sf, "raw_documents").where("raw_content is not null").select("ingest_seq", "raw_content"))
    return d.select("ingest_seq", T.strip_markdown(F.replace("raw_content", F.lit("\r"), F.lit(""))).alias("plain"))


_SQL_EMOJI = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in P.EMOJI) + "]+"
_SQL_QUOTES = reduce(lambda t, kv: f"replace({t}, chr({ord(kv[0])}), '{kv[1].replace(chr(39), chr(39) * 2)}')", [kv for kv in P.ENCODING.items() if kv[0] != "\x00"], "coalesce(title, '')")


@query(f"SELECT ingest_seq, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({_SQL_QUOTES}, '{_SQL_EMOJI}', '', 'g'), '[^\\S\\n]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '\\n\\s+\\n', chr(10) || chr(10), 'g'), ' +\\n', chr(10), 'g'), '^\\s+|\\s+$', '', 'g') AS title FROM raw_documents")
def title_clean(spark, sf):
    """Plain quotes, all emoji ranges and white space of every title; `titles_normalised` decodes markup as well (no SQL form)."""
    return load(spark, sf, "raw_documents").select("ingest_seq", T.squeeze(T.strip_emoji(T.straight_quotes(F.coalesce("title", F.lit(""))))).alias("title"))


@query()
def titles_normalised(spark, sf):
    """Decoding, plain quotes and every emoji range, as in the pipeline (no SQL form); `title_clean` has three ranges."""
    return R.spread(load(spark, sf, "raw_documents").select("ingest_seq", "title")).select("ingest_seq", T.clean_title(F.col("title")).alias("title"))


@query()
def content_normalised(spark, sf):
    """The whole normaliser (entities, HTML, NFC: no SQL form)."""
    return R.spread(load(spark, sf, "raw_documents")).select("ingest_seq", T.normalise(F.coalesce("raw_content", F.lit("")), F.col("source_platform")).alias("content"))


_SQL_PII = [(k, p) for k, p in P.REDACTION if "(?=" not in p and "(?<" not in p]


def _sql_counts(col: str) -> str:
    parts, t = [], col
    for i, (k, p) in enumerate(_SQL_PII):
        parts.append((k, f"len(regexp_extract_all({t}, '{_re(p)}'))"))
        t = f"regexp_replace({t}, '{_re(p)}', '[{k.upper()}]', 'g')"
    kinds = dict.fromkeys(k for k, _ in parts)
    return ", ".join(f"CAST({' + '.join(x for k2, x in parts if k2 == k)} AS BIGINT) AS n_{k}" for k in kinds) + f", {t} AS redacted"


@query(f"SELECT id, {_sql_counts('query_text')} FROM query_logs WHERE query_text IS NOT NULL")
def pii_rules_queries(spark, sf):
    """Redaction by the fixed rules that RE2 can express, with counts by type."""
    q = load(spark, sf, "query_logs").where("query_text is not null")
    t = F.col("query_text")
    kinds = dict.fromkeys(k for k, _ in _SQL_PII)
    both = q.select("id", T.redact_and_count(t, _SQL_PII).alias("r"))
    return both.select("id", *[F.coalesce(F.try_element_at("r.counts", F.lit(k)), F.lit(0)).cast("bigint").alias(f"n_{k}") for k in kinds], F.col("r.text").alias("redacted"))


def _redacted(d: DataFrame, key: str, text: str) -> DataFrame:
    both = d.select(key, T.redact_and_count(F.col(text)).alias("r"))
    return both.select(key, F.to_json("r.counts").alias("pii_counts"), F.col("r.text").alias("redacted"))


@query()
def pii_all_rules_queries(spark, sf):
    """All fixed rules, lookaround included, over every query text; `pii_rules_queries` has those that SQL can express."""
    return _redacted(R.spread(load(spark, sf, "query_logs").where("query_text is not null").select("id", "query_text")), "id", "query_text")


@query()
def pii_rules_documents(spark, sf):
    """All fixed rules, lookaround included, over whole documents."""
    return _redacted(R.spread(load(spark, sf, "raw_documents").where("raw_content is not null").select("ingest_seq", "raw_content")), "ingest_seq", "raw_content")


def _sql_any(col: str, words: list[str]) -> str:
    return f"regexp_matches({col}, '\\b(?:{_re('|'.join(T._quoted(w) for w in words))})\\b')"


def _sql_first(col: str, table: dict, default: str = "'unknown'") -> str:
    return "CASE " + " ".join(f"WHEN {_sql_any(col, v)} THEN '{k}'" for k, v in table.items()) + f" ELSE {default} END"


@query(
    f"""
    WITH d AS (SELECT document_id, lower(content) AS t, lower(substr(content, CAST(floor(length(content) * 0.7) AS INTEGER) + 1)) AS tail FROM processed_documents)
    SELECT document_id, {_sql_first('t', P.LEVELS)} AS experience_level, {_sql_first('t', P.DIFFICULTY)} AS difficulty,
           coalesce({_sql_first('tail', P.OUTCOMES, 'NULL')}, {_sql_first('t', P.OUTCOMES)}) AS outcome FROM d
    """
)
def first_keyword_matches(spark, sf):
    """Level, difficulty and outcome by ordered keyword lists; the outcome is looked for at the end first."""
    c = F.col("content")
    return R.spread(load(spark, sf, "processed_documents")).select("document_id", T.first_match(c, P.LEVELS).alias("experience_level"), T.first_match(c, P.DIFFICULTY).alias("difficulty"), T.outcome(c).alias("outcome"))


def _sql_all(col: str, table: dict) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {_sql_any(col, v)} THEN '{k}' END" for k, v in table.items()) + ")"


@query(f"WITH d AS (SELECT document_id, lower(content) AS t FROM processed_documents) SELECT document_id, {_sql_all('t', P.INTERVIEW_TYPES)} AS types, {_sql_all('t', dict(sorted(P.TOPICS.items())))} AS topics FROM d")
def all_keyword_matches(spark, sf):
    c = F.col("content")
    return R.spread(load(spark, sf, "processed_documents")).select("document_id", F.array_join(T.all_matches(c, P.INTERVIEW_TYPES), ",").alias("types"), F.array_join(F.sort_array(T.all_matches(c, P.TOPICS)), ",").alias("topics"))


@query(
    "WITH d AS (SELECT document_id, greatest(coalesce(list_max(list_transform(regexp_extract_all(content, '" + _re(P.ROUND_COUNT) + "', 1), lambda x: TRY_CAST(x AS INTEGER))), 0), "
    "len(list_distinct(list_transform(flatten([" + ", ".join(f"regexp_extract_all(content, '{_re(m)}', 1)" for m in P.ROUND_MARKERS) + "]), lambda x: trim(lower(x)))))) AS n FROM processed_documents) "
    "SELECT document_id, CAST(CASE WHEN n > 0 THEN n END AS INTEGER) AS num_rounds FROM d"
)
def round_counts(spark, sf):
    return load(spark, sf, "processed_documents").select("document_id", T.num_rounds(F.col("content")).alias("num_rounds"))


@query(
    "SELECT document_id, coalesce(" + ", ".join(f"CASE WHEN length(trim(regexp_extract(title, '{_re(p)}', 1))) BETWEEN 2 AND 50 THEN trim(regexp_extract(title, '{_re(p)}', 1)) END" for p in P.TITLE_COMPANY) + ") AS company FROM processed_documents"
)
def company_in_title(spark, sf):
    return load(spark, sf, "processed_documents").select("document_id", T.company_in_title(F.col("title")).alias("company"))


@query(
    r"""
    WITH hit AS (
        SELECT d.document_id, c.name, row_number() OVER (PARTITION BY d.document_id ORDER BY length(c.name) DESC, lower(c.name)) AS r
        FROM processed_documents d JOIN companies c ON regexp_matches(lower(d.title), concat('\b', regexp_escape(lower(c.name)), '\b')))
    SELECT d.document_id, h.name AS company FROM processed_documents d LEFT JOIN hit h ON d.document_id = h.document_id AND h.r = 1
    """
)
def longest_alias(spark, sf):
    """The longest known company name that a title holds; words are joined with a list of any size."""
    d, c = load(spark, sf, "processed_documents"), load(spark, sf, "companies")
    docs = d.select(F.col("document_id").alias("id"), F.array("title").alias("texts"))
    found = entities.first_alias(docs, c.select(F.col("name").alias("alias"), F.col("name").alias("canonical")), "company")
    return docs.select("id").join(found, "id", "left").withColumnRenamed("id", "document_id")


_LEVEL = r"[\s\-]*(\d{1,2}|i{1,3}|iv|vi{0,3}|ix|x)?"


def _sql_tier(order: int, text: str, before: str, after: str, level: bool) -> str:
    pattern = f"concat('{_re(before)}', regexp_escape(alias), '{_re(after)}')"
    n = f"regexp_extract({text}, {pattern}, 1)" if level else "''"
    return f"SELECT id, {order} AS o, alias, canonical, {n} AS level FROM r WHERE contains({text}, alias) AND regexp_matches({text}, {pattern})"


_SQL_ROLES = " UNION ALL ".join(
    [_sql_tier(0, "title", r"\b", _LEVEL + r"\b", True)]
    + [_sql_tier(1 + i, "head", t, _LEVEL, True) for i, t in enumerate(P.ROLE_TRIGGERS)]
    + [_sql_tier(20 + i, c, r"\b", r"\b", False) for i, c in enumerate(("title", "head", "content"))]
)
_SQL_FORM = ", ".join(f"CASE WHEN length(trim(regexp_extract(title, '{_re(p)}', 1))) BETWEEN 2 AND 50 THEN trim(regexp_extract(title, '{_re(p)}', 1)) END" for p in P.TITLE_COMPANY)
_SQL_CAPITAL = lambda t: f"list_filter(regexp_extract_all({t}, '{_re(T.CAPITALS)}', 1), lambda x: length(x) BETWEEN 2 AND 50 AND lower(x) NOT IN {_list(P.NOT_COMPANIES)})[1]"
_SQL_INITIALS = lambda v: f"array_to_string(list_transform(string_split(lower({v}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"
_SQL_ROMAN = "CASE " + " ".join(f"WHEN {{0}} = '{k}' THEN '{v}'" for k, v in P.ROMAN.items()) + " ELSE {0} END"


@query(
    f"""
    WITH d AS (SELECT document_id AS id, title, content, substr(content, 1, 500) AS head FROM processed_documents),
    n AS (SELECT lower(name) AS alias, min(name) AS canonical FROM companies GROUP BY 1),
    raw AS (SELECT id, trim(coalesce({_SQL_FORM})) AS form, trim(coalesce({_SQL_CAPITAL("title")}, {_SQL_CAPITAL("head")})) AS capital FROM d),
    hit AS (SELECT d.id, n.alias, n.canonical, CASE WHEN regexp_matches(lower(title), p) THEN 1 WHEN regexp_matches(lower(head), p) THEN 2 WHEN regexp_matches(lower(content), p) THEN 3 END AS place
            FROM d JOIN (SELECT *, concat('\\b', regexp_escape(alias), '\\b') AS p FROM n) n ON contains(lower(concat_ws(' ', title, content)), alias)),
    listed AS (SELECT id, first(canonical ORDER BY place, length(alias) DESC, alias) AS listed FROM hit WHERE place IS NOT NULL GROUP BY id),
    company AS (SELECT raw.id, coalesce(CASE WHEN form IS NOT NULL THEN coalesce(a.canonical, {_SQL_INITIALS("form")}) END, listed, CASE WHEN capital IS NOT NULL THEN coalesce(b.canonical, {_SQL_INITIALS("capital")}) END) AS company
                FROM raw LEFT JOIN listed ON raw.id = listed.id LEFT JOIN n a ON lower(form) = a.alias LEFT JOIN n b ON lower(capital) = b.alias),
    r AS (SELECT d.id, lower(title) AS title, lower(head) AS head, lower(content) AS content, j.alias, j.canonical FROM d JOIN (SELECT lower(title) AS alias, min(title) AS canonical FROM job_roles GROUP BY 1) j ON contains(lower(concat_ws(' ', d.title, d.content)), j.alias)),
    t AS ({_SQL_ROLES}),
    role AS (SELECT id, first(CASE WHEN level <> '' THEN canonical || ' ' || {_SQL_ROMAN.format("level")} WHEN o < 20 THEN canonical
                ELSE array_to_string(list_transform(string_split(canonical, ' '), lambda w: CASE WHEN regexp_full_match(w, 'I{{1,3}}|IV|VI{{0,3}}|IX|X') THEN {_SQL_ROMAN.format("lower(w)")} ELSE w END), ' ') END ORDER BY o, length(alias) DESC, alias, canonical, level) AS role FROM t GROUP BY id)
    SELECT d.id AS document_id, role, company FROM d LEFT JOIN role ON d.id = role.id LEFT JOIN company ON d.id = company.id
    """
)
def roles_and_companies(spark, sf):
    """Role by title, phrase or text; company by title, list (title, beginning, whole text) or capitals, under its canonical name."""
    d = R.spread(load(spark, sf, "processed_documents").select("document_id", "title", "content"))
    return pipeline.with_company_and_role(d, load(spark, sf, "companies"), load(spark, sf, "job_roles"), "document_id").select("document_id", "role", "company")


@query(f"SELECT document_id, {', '.join(f'CASE WHEN lower(trim({c})) IN {_list(v)} THEN lower(trim({c})) END AS {c}' for c, v in P.ENUMS.items() if c != 'interview_types')}, coalesce(document_id, '') <> '' AND trim(coalesce(title, '')) <> '' AND trim(coalesce(content, '')) <> '' AND trim(coalesce(company, '')) <> '' AND trim(coalesce(role, '')) <> '' AS complete FROM processed_documents")
def schema_check(spark, sf):
    d = load(spark, sf, "processed_documents")
    full = reduce(lambda a, b: a & b, [F.trim(F.coalesce(c, F.lit(""))) != "" for c in ("document_id", "title", "content", "company", "role")])
    return d.select("document_id", *[T.safe_enum(F.col(c), v).alias(c) for c, v in P.ENUMS.items() if c != "interview_types"], full.alias("complete"))


@query("SELECT CASE WHEN source_metadata IS NULL THEN 'missing' WHEN json_valid(source_metadata) THEN 'valid' ELSE 'broken' END AS state, count(*) AS n FROM raw_documents GROUP BY ALL")
def metadata_states(spark, sf):
    return readers.metadata(load(spark, sf, "raw_documents"), "source_metadata").groupBy(F.col("meta_state").alias("state")).agg(F.count("*").alias("n"))


@query("SELECT document_id, source_platform || '_' || substr(replace(replace(to_base64(unhex(sha256(source_url))), '+', '-'), '/', '_'), 1, 6) AS key FROM raw_documents WHERE source_url IS NOT NULL AND source_platform IS NOT NULL")
def document_keys(spark, sf):
    d = load(spark, sf, "raw_documents").where("source_url is not null and source_platform is not null")
    return d.select("document_id", T.document_key(F.col("source_platform"), F.col("source_url")).alias("key"))


@query(
    "WITH g AS (SELECT judgment_id, lower(coalesce(relevance_reason, '')) AS t FROM eval_dataset) SELECT judgment_id, CASE "
    + " ".join(f"WHEN {' OR '.join(f'contains(t, {chr(39)}{x}{chr(39)})' for x in subs)} THEN '{k}'" for k, subs in P.FETCH_ERRORS)
    + " ELSE 'other' END AS category FROM g"
)
def error_categories(spark, sf):
    return load(spark, sf, "eval_dataset").select("judgment_id", T.error_category(F.col("relevance_reason")).alias("category"))


_SQL_SCRIPTS = "list_max([" + ", ".join(f"{{'n': len(regexp_extract_all(head, '{p}')) * {10 if k == 'ja' else 1}, 'o': -{i}, 'l': '{k}'}}" for i, (k, p) in enumerate(T.SCRIPTS)) + "])"
_SQL_VOTES = "list_max([" + ", ".join(f"{{'n': len(list_filter(w, lambda x: x IN {_list(v.split())})), 'o': -{i}, 'l': '{k}'}}" for i, (k, v) in enumerate(T.STOP_WORDS.items())) + "])"


@query(
    rf"""
    WITH h AS (SELECT doc_id, coalesce(text, '') AS t, substr(coalesce(text, ''), 1, 1000) AS head FROM documents),
    w AS (SELECT *, {WORDS.format("regexp_replace(lower(head), '[.,;:!?()\"]', ' ', 'g')")} AS w, len(regexp_extract_all(head, '[A-Za-z\x{{00C0}}-\x{{024F}}]')) AS latin FROM h),
    v AS (SELECT *, {_SQL_SCRIPTS} AS script, {_SQL_VOTES} AS word FROM w)
    SELECT doc_id, CASE WHEN length(t) < 50 THEN 'en' WHEN script.n > latin THEN script.l WHEN latin = 0 THEN 'en' WHEN word.n > 0 THEN word.l WHEN len(list_filter(w, lambda x: x IN {_list(P.SIGNAL)})) > 0 THEN 'en' ELSE 'und' END AS lang FROM v
    """
)
def language_votes(spark, sf):
    """Language by script and function words, over all documents."""
    return R.spread(load(spark, sf, "documents").select("doc_id", "text")).select("doc_id", T.language(F.coalesce("text", F.lit(""))).alias("lang"))


@query(
    "SELECT ingest_seq, strftime(coalesce("
    + ", ".join(f"try_strptime(trim(published_at), '{f}')" for f in ("%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%d %b, %Y", "%b %d, %Y", "%d/%m/%Y"))
    + "), '%Y-%m-%d %H:%M:%S') AS published FROM raw_documents"
)
def published_dates(spark, sf):
    """Times of posts from any of the formats in use; null where none fits."""
    return load(spark, sf, "raw_documents").select("ingest_seq", F.date_format(T.published(F.col("published_at")), "yyyy-MM-dd HH:mm:ss").alias("published"))


@query("WITH m AS (SELECT 'org/' || replace(lower(title), ' ', '-') AS model, role_id FROM job_roles) SELECT role_id, 'embeddings_' || replace(string_split(model, '/')[-1], '-', '_') AS column_name, model || '_dim384_' || CASE WHEN role_id % 2 = 0 THEN 'hybrid_v0.5_b0.5_rrf60' ELSE 'vector' END AS run, 'db_load_' || strftime(TIMESTAMP '2026-01-02 03:04:05' + role_id * INTERVAL 1 HOUR, '%Y%m%dT%H%M%S') || '.json' AS report FROM m")
def file_names(spark, sf):
    """Names of vector columns, evaluation runs and load reports."""
    model = F.concat(F.lit("org/"), F.replace(F.lower("title"), F.lit(" "), F.lit("-")))
    mode = F.when(F.col("role_id") % 2 == 0, "hybrid").otherwise("vector")
    at = F.timestamp_seconds(F.lit(1767323045) + F.col("role_id") * 3600)
    return load(spark, sf, "job_roles").select("role_id", T.embedding_column(model).alias("column_name"), T.run_name(model, F.lit(384), mode, F.lit(0.5), F.lit(0.5), F.lit(60)).alias("run"), T.report_name(at).alias("report"))


# ---- duplicates ----------------------------------------------------------------------------------------------------


@query(
    r"""
    WITH h AS (SELECT ingest_seq AS id, sha256(trim(regexp_replace(lower(raw_content), '[ \t\n\r\f]+', ' ', 'g'))) AS content_hash FROM raw_documents WHERE raw_content IS NOT NULL)
    SELECT id, content_hash, min(id) OVER (PARTITION BY content_hash) AS first_id, id = min(id) OVER (PARTITION BY content_hash) AS is_first FROM h
    """
)
def exact_dedup(spark, sf):
    return dedup.exact_duplicates(load(spark, sf, "raw_documents"), "ingest_seq", "raw_content")


_SETS = rf"""
    w AS (SELECT ingest_seq AS id, {WORDS.format('lower(raw_content)')} AS w FROM raw_documents WHERE raw_content IS NOT NULL),
    s AS (SELECT id, list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM w WHERE len(w) >= 3),
    big AS (SELECT id, list_sort(s) AS s, len(s) AS n FROM s WHERE len(s) >= 10),
    rep AS (SELECT min(id) AS id, any_value(s) AS s, any_value(n) AS n FROM big GROUP BY s),
    e AS (SELECT id, n, unnest(s) AS x FROM rep),
    p AS (SELECT a.id AS a, b.id AS b, count(*) AS k, any_value(a.n) AS na, any_value(b.n) AS nb FROM e a JOIN e b ON a.x = b.x AND a.id < b.id GROUP BY a.id, b.id),
    near AS (SELECT a, b, k / (na + nb - k) AS j FROM p WHERE k / (na + nb - k) >= 0.8)"""


@query(f"WITH {_SETS} SELECT a, b, round(j, 9) AS similarity FROM near")
def near_dup_pairs(spark, sf):
    """Verified near-duplicate pairs between first rows of equal sets; 42 bands of 6, so a pair at 0.8 is lost with probability 3e-6."""
    p = dedup.near_pairs(load(spark, sf, "raw_documents"), "ingest_seq", "raw_content", bands=42, rows=6)
    return p.select("a", "b", F.round("similarity", 9).alias("similarity"))


@query(
    rf"""
    WITH RECURSIVE h AS (SELECT ingest_seq AS id, raw_content, min(ingest_seq) OVER (PARTITION BY trim(regexp_replace(lower(raw_content), '[ \t\n\r\f]+', ' ', 'g'))) AS first_id FROM raw_documents WHERE raw_content IS NOT NULL),
    w AS (SELECT id, {WORDS.format('lower(raw_content)')} AS w FROM h WHERE id = first_id),
    s AS (SELECT id, list_distinct(list_transform(range(1, greatest(1, len(w) - 2) + 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS s FROM w WHERE len(w) > 0),
    e AS (SELECT id, len(s) AS n, unnest(s) AS x FROM s WHERE len(s) >= 10),
    p AS (SELECT a.id AS a, b.id AS b, count(*) AS k, any_value(a.n) AS na, any_value(b.n) AS nb FROM e a JOIN e b ON a.x = b.x AND a.id < b.id GROUP BY a.id, b.id),
    edge AS MATERIALIZED (SELECT a, b FROM p WHERE k / (na + nb - k) >= 0.8),
    lates AS (SELECT row_number() OVER (ORDER BY b) AS step, b, list_sort(list(a)) AS early FROM edge GROUP BY b),
    walk AS (
        SELECT CAST(0 AS BIGINT) AS step, CAST([] AS BIGINT[]) AS lost
        UNION ALL SELECT l.step, CASE WHEN len(list_filter(l.early, lambda x: NOT list_contains(walk.lost, x))) > 0 THEN list_append(walk.lost, l.b) ELSE walk.lost END FROM walk JOIN lates l ON l.step = walk.step + 1),
    lost AS (SELECT lost FROM walk ORDER BY step DESC LIMIT 1),
    near AS (SELECT b AS id, min(a) AS of FROM edge, lost WHERE NOT list_contains(lost.lost, a) GROUP BY b)
    SELECT h.id, CASE WHEN h.id = h.first_id THEN n.of ELSE coalesce(n.of, h.first_id) END AS duplicate_of FROM h LEFT JOIN near n ON n.id = h.first_id
    """
)
def near_dedup_greedy(spark, sf):
    """Kept and rejected rows in input order."""
    return dedup.near_duplicates(load(spark, sf, "raw_documents"), "ingest_seq", "raw_content")


@query()
def near_dup_collisions(spark, sf):
    """Rows that share a band with an earlier one, without verification, and the first such row (depends on the hash: no SQL form)."""
    return dedup.first_collisions(load(spark, sf, "raw_documents"), "ingest_seq", "raw_content")


# ---- chunks --------------------------------------------------------------------------------------------------------


@query(
    rf"SELECT CASE WHEN len({WORDS.format('content')}) < 150 THEN 'single_chunk' WHEN regexp_matches(content, '(?im){_re(chunk.ROUND)}') THEN 'structural' ELSE 'fixed_window' END AS strategy, count(*) AS n_documents FROM processed_documents GROUP BY ALL"
)
def chunk_strategies(spark, sf):
    return load(spark, sf, "processed_documents").groupBy(chunk.strategy(F.col("content")).alias("strategy")).agg(F.count("*").alias("n_documents"))


@query()
def chunk_documents(spark, sf):
    """Windows and rounds of every document (packing is a fold over sentences: no SQL form)."""
    return chunk.chunk_documents(load(spark, sf, "processed_documents"))


@query(
    """
    SELECT c.chunk_id, concat_ws(' | ', CASE WHEN coalesce(d.company, '') <> '' THEN 'Company: ' || d.company END, CASE WHEN coalesce(d.role, '') <> '' THEN 'Role: ' || d.role END,
        CASE WHEN coalesce(c.round_label, '') <> '' THEN 'Round: ' || c.round_label END, CASE WHEN c.total_chunks > 1 THEN 'Part: ' || (c.chunk_index + 1) || ' of ' || c.total_chunks END) AS header
    FROM document_chunks c LEFT JOIN processed_documents d ON c.document_id = d.document_id
    """
)
def chunk_headers(spark, sf):
    c, d = load(spark, sf, "document_chunks"), load(spark, sf, "processed_documents").select("document_id", "company", "role")
    h = chunk.header(F.col("company"), F.col("role"), F.col("round_label"), F.col("chunk_index"), F.col("total_chunks"))
    return c.join(d, "document_id", "left").select("chunk_id", F.regexp_replace(h, r" \| $", "").alias("header"))


@query(
    "SELECT c.chunk_id, CASE WHEN instr(d.content, c.raw_text) > 0 THEN instr(d.content, c.raw_text) - 1 ELSE 0 END AS start_at, CASE WHEN instr(d.content, c.raw_text) > 0 THEN instr(d.content, c.raw_text) - 1 + length(c.raw_text) ELSE length(d.content) END AS end_at FROM document_chunks c JOIN processed_documents d ON c.document_id = d.document_id"
)
def chunk_offsets(spark, sf):
    c, d = load(spark, sf, "document_chunks"), load(spark, sf, "processed_documents").select("document_id", "content")
    at = F.expr("locate(raw_text, content)")
    j = c.join(d, "document_id")
    return j.select("chunk_id", F.when(at > 0, at - 1).otherwise(0).cast("bigint").alias("start_at"), F.when(at > 0, at - 1 + F.length("raw_text")).otherwise(F.length("content")).cast("bigint").alias("end_at"))


@query("SELECT count(*) AS n_chunks, count(*) FILTER (coalesce(document_id, '') = '') AS missing_document, count(*) FILTER (word_count > 550) AS too_long, count(*) FILTER (total_chunks > 1 AND NOT contains(chunk_text, 'Part: ')) AS missing_part FROM document_chunks")
def chunk_violations(spark, sf):
    return chunk.violations(load(spark, sf, "document_chunks"))


@query("SELECT strategy, count(*) AS n_chunks, count(DISTINCT document_id) AS n_documents FROM document_chunks GROUP BY ALL")
def chunk_manifest(spark, sf):
    return load(spark, sf, "document_chunks").groupBy("strategy").agg(F.count("*").alias("n_chunks"), F.count_distinct("document_id").alias("n_documents"))


@query("SELECT chunk_id, coalesce(round_label, '') AS round_label, coalesce(chunk_index, 0) AS chunk_index, coalesce(word_count, 0) AS word_count, length(coalesce(raw_text, '')) AS n_chars FROM document_chunks")
def chunk_defaults(spark, sf):
    """The chunk table as the searches read it: nulls as empty strings and zeros."""
    c = readers.chunks_scan(load(spark, sf, "document_chunks").select("chunk_id", "round_label", "chunk_index", "word_count", "raw_text"))
    return c.select("chunk_id", "round_label", "chunk_index", "word_count", F.length("raw_text").cast("bigint").alias("n_chars"))


# ---- statements over the store -------------------------------------------------------------------------------------


@query(
    """
    SELECT d.document_id, c.company_id, r.role_id FROM processed_documents d
    LEFT JOIN companies c ON lower(trim(d.company)) = lower(trim(c.name)) LEFT JOIN job_roles r ON lower(trim(d.role)) = lower(trim(r.title))
    WHERE d.document_id NOT IN (SELECT document_id FROM document_chunks WHERE strategy = 'structural')
    """
)
def unchunked_documents(spark, sf):
    """Three left joins and a null-aware anti join."""
    for n in ("processed_documents", "companies", "job_roles", "document_chunks"):
        load(spark, sf, n).createOrReplaceTempView(f"v_{n}")
    return spark.sql(
        """
        SELECT d.document_id, c.company_id, r.role_id FROM v_processed_documents d
        LEFT JOIN v_companies c ON lower(trim(d.company)) = lower(trim(c.name)) LEFT JOIN v_job_roles r ON lower(trim(d.role)) = lower(trim(r.title))
        WHERE d.document_id NOT IN (SELECT document_id FROM v_document_chunks WHERE strategy = 'structural')
        """
    )


@query("SELECT id, query_embedding IS NULL AS no_embedding, llm_response IS NULL AS no_response FROM query_logs WHERE query_embedding IS NULL OR llm_response IS NULL")
def missing_columns(spark, sf):
    q = load(spark, sf, "query_logs")
    return R.missing_any(q, ["query_embedding", "llm_response"]).select("id", F.col("query_embedding").isNull().alias("no_embedding"), F.col("llm_response").isNull().alias("no_response"))


@query(
    """
    SELECT c.chunk_id, d.source_url, co.company_id, r.role_id FROM document_chunks c JOIN processed_documents d ON c.document_id = d.document_id
    JOIN companies co ON lower(trim(d.company)) = lower(trim(co.name)) JOIN job_roles r ON lower(trim(d.role)) = lower(trim(r.title))
    """
)
def star_join(spark, sf):
    c, d = load(spark, sf, "document_chunks").select("chunk_id", "document_id"), load(spark, sf, "processed_documents")
    key = lambda x: F.lower(F.trim(x))
    d = d.select("document_id", "source_url", key("company").alias("ck"), key("role").alias("rk"))
    co, r = load(spark, sf, "companies").select("company_id", key("name").alias("ck")), load(spark, sf, "job_roles").select("role_id", key("title").alias("rk"))
    # dimensions are joined to the documents first, so each document and not each chunk is looked up
    return c.join(d.join(co, "ck").join(r, "rk"), "document_id").select("chunk_id", "source_url", "company_id", "role_id")


_LATEST = "SELECT * FROM (SELECT document_id, title, source_url, raw_content, scraped_at, row_number() OVER (PARTITION BY document_id ORDER BY ingest_seq DESC) AS r FROM raw_documents) WHERE r = 1"


@query(
    f"""
    WITH n AS ({_LATEST})
    SELECT coalesce(o.document_id, n.document_id) AS document_id, CASE WHEN o.document_id IS NOT NULL THEN o.title ELSE n.title END AS title,
           CASE WHEN n.document_id IS NOT NULL THEN n.raw_content ELSE o.content END AS content, CASE WHEN n.document_id IS NOT NULL THEN n.scraped_at ELSE o.scraped_at END AS scraped_at
    FROM processed_documents o FULL OUTER JOIN n ON o.document_id = n.document_id
    """
)
def upsert_documents(spark, sf):
    """Insert or update by document: content and time come from the last fetch, the title stays."""
    raw = R.latest(load(spark, sf, "raw_documents"), ["document_id"], [F.desc("ingest_seq")])
    new = raw.select("document_id", "title", F.col("raw_content").alias("content"), "scraped_at")
    old = load(spark, sf, "processed_documents").select("document_id", "title", "content", "scraped_at")
    return R.upsert(old, new, ["document_id"], ["content", "scraped_at"])


@query(
    """
    WITH n AS (SELECT min(trim(company)) AS name, lower(trim(company)) AS k FROM processed_documents WHERE trim(company) <> '' GROUP BY 2),
    f AS (SELECT * FROM n WHERE k NOT IN (SELECT lower(trim(name)) FROM companies))
    SELECT company_id, name FROM companies
    UNION ALL SELECT CAST((SELECT max(company_id) FROM companies) + row_number() OVER (ORDER BY encode(k)) AS INTEGER), name FROM f
    """
)
def get_or_create_companies(spark, sf):
    return R.get_or_create(load(spark, sf, "companies"), "company_id", "name", load(spark, sf, "processed_documents"), "company")


@query(
    "SELECT query_id, relevant_chunk_id, judgment_id, relevance FROM (SELECT *, row_number() OVER (PARTITION BY query_id, relevant_chunk_id ORDER BY created_at DESC, judgment_id DESC) AS r FROM eval_dataset) WHERE r = 1"
)
def upsert_judgments(spark, sf):
    """The last judgment of each query and chunk."""
    e = load(spark, sf, "eval_dataset").select("query_id", "relevant_chunk_id", "judgment_id", "relevance", "created_at")
    return R.latest(e, ["query_id", "relevant_chunk_id"], [F.desc("created_at"), F.desc("judgment_id")]).drop("created_at")


@query(
    """
    SELECT document_id, source_platform FROM processed_documents
    UNION ALL SELECT document_id, min(source_platform) FROM raw_documents r WHERE document_id NOT IN (SELECT document_id FROM processed_documents) GROUP BY document_id
    """
)
def insert_ignore(spark, sf):
    old = load(spark, sf, "processed_documents").select("document_id", "source_platform")
    new = load(spark, sf, "raw_documents").groupBy("document_id").agg(F.min("source_platform").alias("source_platform"))
    return R.insert_ignore(old, new, ["document_id"])


@query(
    "SELECT c.chunk_id, c.chunk_index, coalesce(d.word_count, c.word_count) AS word_count FROM document_chunks c LEFT JOIN (SELECT document_id, word_count FROM processed_documents WHERE company IS NOT NULL) d ON c.document_id = d.document_id"
)
def update_columns(spark, sf):
    c = load(spark, sf, "document_chunks").select("chunk_id", "document_id", "chunk_index", "word_count")
    d = load(spark, sf, "processed_documents").where("company is not null").select("document_id", "word_count")
    return R.update_columns(c, d, "document_id", ["word_count"]).drop("document_id")


@query(
    "SELECT query_id, count(*) AS n_judged, count(*) FILTER (relevance >= 1) AS n_relevant, max(relevance) AS best, min(relevant_chunk_id) FILTER (relevance = 2) AS first_best FROM eval_dataset GROUP BY ALL"
)
def qrels(spark, sf):
    e = load(spark, sf, "eval_dataset")
    return e.groupBy("query_id").agg(F.count("*").alias("n_judged"), F.count_if(F.col("relevance") >= 1).alias("n_relevant"), F.max("relevance").alias("best"), F.min(F.when(F.col("relevance") == 2, F.col("relevant_chunk_id"))).alias("first_best"))


@query("SELECT relevance, count(*) AS n FROM eval_dataset GROUP BY ALL")
def relevance_histogram(spark, sf):
    return load(spark, sf, "eval_dataset").groupBy("relevance").agg(F.count("*").alias("n"))


@query("SELECT query_category, count(DISTINCT query_id) AS n_queries, count(*) AS n FROM eval_dataset GROUP BY ALL")
def queries_by_category(spark, sf):
    """Distinct counts in two aggregations, so a query with a tenth of the rows is counted map-side first."""
    e = load(spark, sf, "eval_dataset").groupBy("query_category", "query_id").agg(F.count("*").alias("n"))
    return e.groupBy("query_category").agg(F.count("query_id").alias("n_queries"), F.sum("n").alias("n"))


@query("SELECT DISTINCT query_text FROM query_logs")
def distinct_queries(spark, sf):
    return load(spark, sf, "query_logs").select("query_text").distinct()


@query("SELECT id, logged_at FROM query_logs WHERE logged_at >= (SELECT max(logged_at) FROM query_logs) - INTERVAL 7 DAY AND query_embedding IS NOT NULL")
def recent_queries(spark, sf):
    """Rows of the last seven days of the log that have an embedding; the end of the log stands for now."""
    q = load(spark, sf, "query_logs").select("id", "logged_at", "query_embedding")
    end = q.agg(F.max("logged_at").alias("last"))
    return q.where("query_embedding is not null").join(F.broadcast(end)).where(F.col("logged_at") >= F.col("last") - F.expr("INTERVAL 7 DAYS")).select("id", "logged_at")


@query("SELECT count(*) AS n_all, count(*) FILTER (latency_ms >= 0) AS n_timed, round(avg(latency_ms) FILTER (latency_ms >= 0), 6) AS mean_ms, round(quantile_cont(latency_ms, 0.95) FILTER (latency_ms >= 0), 6) AS p95_ms FROM query_logs")
def latency_report(spark, sf):
    q = load(spark, sf, "query_logs")
    ok = F.when(F.col("latency_ms") >= 0, F.col("latency_ms"))
    return q.agg(F.count("*").alias("n_all"), F.count(ok).alias("n_timed"), F.round(F.avg(ok), 6).alias("mean_ms"), F.round(F.percentile(ok, 0.95), 6).alias("p95_ms"))


# ---- joins, windows and sets over the star schema ------------------------------------------------------------------


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(avg(l_quantity), 6) AS avg_qty, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def pricing_summary(spark, sf):
    l = load(spark, sf, "lineitem").where("l_shipdate <= timestamp '1998-09-02'")  # noqa: E741
    disc = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base"), F.round(F.sum(disc), 2).alias("sum_disc"), F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.count("*").alias("n"))


@query(
    """
    SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name
    """
)
def local_revenue(spark, sf):
    """Six-way join; small dimensions are joined first and sent along by size, the large ones meet once."""
    t = {n: load(spark, sf, n) for n in ("customer", "orders", "lineitem", "supplier", "nation", "region")}
    s = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "s_nationkey", "n_name")
    o = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    j = t["lineitem"].select("l_orderkey", "l_suppkey", "l_extendedprice", "l_discount").join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(s, (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
    return j.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def semi_and_anti(spark, sf):
    c, o = load(spark, sf, "customer").select("c_custkey"), load(spark, sf, "orders")
    urgent, pending = o.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), o.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(urgent, "c_custkey", "left_semi").join(pending, "c_custkey", "left_anti")


@query("SELECT o_custkey, o_orderkey, o_totalprice, r FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 3")
def top_orders(spark, sf):
    o = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return R.ranked_list(o, "o_custkey", "o_totalprice", "o_orderkey", 3, "r")


@query("SELECT o_custkey, o_orderkey, round(sum(o_totalprice) OVER w, 2) AS running, lag(o_orderkey) OVER w AS before FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)")
def running_totals(spark, sf):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return load(spark, sf, "orders").select("o_custkey", "o_orderkey", F.round(F.sum("o_totalprice").over(w.rowsBetween(Window.unboundedPreceding, 0)), 2).alias("running"), F.lag("o_orderkey").over(w).alias("before"))


@query("SELECT n_regionkey, c_mktsegment, count(*) AS n, round(avg(c_acctbal), 6) AS mean FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_regionkey, c_mktsegment)")
def rollup_report(spark, sf):
    c = load(spark, sf, "customer").join(load(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.rollup("n_regionkey", "c_mktsegment").agg(F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 6).alias("mean"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, grouping(o_orderstatus) AS g1, grouping(o_orderpriority) AS g2 FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def cube_report(spark, sf):
    o = load(spark, sf, "orders")
    return o.cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.grouping("o_orderstatus").cast("bigint").alias("g1"), F.grouping("o_orderpriority").cast("bigint").alias("g2"))


@query(
    """
    (SELECT c_nationkey AS k, 'union' AS kind FROM customer UNION SELECT s_nationkey, 'union' FROM supplier)
    UNION ALL (SELECT c_nationkey, 'intersect' FROM customer INTERSECT SELECT s_nationkey, 'intersect' FROM supplier)
    UNION ALL (SELECT c_nationkey, 'except' FROM customer EXCEPT SELECT s_nationkey, 'except' FROM supplier)
    """
)
def set_operations(spark, sf):
    c, s = load(spark, sf, "customer").select(F.col("c_nationkey").alias("k")), load(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"))
    tag = lambda d, n: d.select("k", F.lit(n).alias("kind"))
    return tag(c.union(s).distinct(), "union").union(tag(c.intersect(s), "intersect")).union(tag(c.subtract(s), "except"))


@query("SELECT p.o_orderkey, p.o_custkey, e.event_id FROM (SELECT o_orderkey, o_custkey, o_orderdate FROM orders) p ASOF LEFT JOIN (SELECT user_id, max(event_id) AS event_id, ts FROM events GROUP BY user_id, ts) e ON p.o_custkey = e.user_id AND TIMESTAMP '2024-01-20 00:00:00' + (p.o_orderkey % 1000) * INTERVAL 1 MINUTE >= e.ts")
def asof_events(spark, sf):
    """For each order, at a time derived from its key, the customer's last event before: an as-of join without pairs."""
    o = load(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"), (F.timestamp_seconds(F.lit(1705708800) + F.pmod("o_orderkey", F.lit(1000)) * 60)).cast("timestamp_ntz").alias("ts"), "o_orderkey")
    e = load(spark, sf, "events").groupBy("user_id", F.col("ts").cast("timestamp_ntz").alias("ts")).agg(F.max("event_id").alias("event_id"))
    return R.asof_join(o, e, ["user_id"], "ts", ["event_id"]).select("o_orderkey", F.col("user_id").alias("o_custkey"), "event_id")


@query("SELECT event_type, json_extract_string(props, '$.k') AS k, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_properties(spark, sf):
    e = load(spark, sf, "events")
    return e.groupBy("event_type", F.get_json_object("props", "$.k").alias("k")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT event_type, count(*) FILTER (hour(ts) < 6) AS night, count(*) FILTER (hour(ts) BETWEEN 6 AND 11) AS morning, count(*) FILTER (hour(ts) BETWEEN 12 AND 17) AS day, count(*) FILTER (hour(ts) > 17) AS evening FROM events GROUP BY ALL")
def events_by_daytime(spark, sf):
    e = load(spark, sf, "events").withColumn("h", F.hour("ts"))
    return e.groupBy("event_type").agg(F.count_if(F.col("h") < 6).alias("night"), F.count_if(F.col("h").between(6, 11)).alias("morning"), F.count_if(F.col("h").between(12, 17)).alias("day"), F.count_if(F.col("h") > 17).alias("evening"))


# ---- retrieval -----------------------------------------------------------------------------------------------------


def _arms(spark, sf, k: int = 15):
    q = load(spark, sf, "eval_queries").select("query_id", F.col("query_text").alias("text"))
    c = load(spark, sf, "document_chunks").select(F.col("chunk_id").alias("id"), F.col("raw_text").alias("text"))
    return q, c, retrieval.term_cosine(q, c, k), retrieval.bm25(q, c, k)


def _sql_arms(source: str = "document_chunks", text: str = "raw_text", k: int = 15) -> str:
    """Ranked lists bm (BM25) and co (term cosine) of eval_queries over the chunks of a source."""
    return rf"""
    cw AS (SELECT chunk_id AS id, {WORDS.format(f"lower(coalesce({text}, ''))")} AS w FROM {source}),
    post AS (SELECT id, len(w) AS length, term, count(*) AS tf FROM (SELECT id, w, unnest(w) AS term FROM cw) GROUP BY id, length, term),
    qw AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({WORDS.format("lower(query_text)")}) AS term FROM eval_queries) GROUP BY ALL),
    st AS (SELECT count(*) AS n, avg(len(w)) AS avg_length FROM cw),
    dfs AS (SELECT term, ln(n - count(*) + 0.5) - ln(count(*) + 0.5) AS raw, avg_length FROM post, st GROUP BY term, n, avg_length),
    idf AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM dfs) ELSE raw END AS idf, avg_length FROM dfs),
    bs AS (SELECT query_id, id, round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / avg_length))), 9) AS score FROM qw JOIN idf USING (term) JOIN post USING (term) GROUP BY ALL),
    bm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM bs WHERE score > 0) WHERE rank <= {k}),
    cn AS (SELECT id, sqrt(sum(tf * tf)) AS norm FROM post GROUP BY id), qn AS (SELECT query_id, sqrt(sum(qtf * qtf)) AS qnorm FROM qw GROUP BY query_id),
    cs AS (SELECT query_id, id, round(sum(qtf * tf) / (any_value(norm) * any_value(qnorm)), 9) AS score FROM qw JOIN post USING (term) JOIN cn USING (id) JOIN qn USING (query_id) GROUP BY ALL),
    co AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM cs) WHERE rank <= {k})"""


_RETRIEVAL = _sql_arms()


@query(f"WITH {_RETRIEVAL} SELECT query_id, id, score, rank FROM bm")
def bm25_top_k(spark, sf):
    return _arms(spark, sf)[3]


@query(f"WITH {_RETRIEVAL} SELECT query_id, id, score, rank FROM co")
def cosine_top_k(spark, sf):
    return _arms(spark, sf)[2]


@query(
    """
    WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 100 = 0),
    s AS (SELECT query_id, vec_id AS id, round(list_cosine_similarity(v, CAST(embedding AS DOUBLE[])), 12) AS score FROM q, embeddings),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s)
    SELECT query_id, id, round(score, 6) AS score, rank FROM r WHERE rank <= 10
    """
)
def vector_top_k(spark, sf):
    """Exact cosine search: every row whose id is divisible by 100 is a query, against all rows."""
    e = load(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    q = e.where("id % 100 = 0").withColumnRenamed("id", "query_id")
    return retrieval.vector_top_k(q, e, 10).select("query_id", "id", F.round("score", 6).alias("score"), "rank")


@query(r"WITH q AS (SELECT role_id AS query_id, list_distinct(regexp_extract_all(lower(title), '[a-z0-9]+')) AS w FROM job_roles), qt AS (SELECT query_id, len(w) AS n_terms, unnest(w) AS term FROM q), d AS (SELECT chunk_id AS id, unnest(list_distinct(regexp_extract_all(lower(chunk_text), '[a-z0-9]+'))) AS term FROM document_chunks) SELECT query_id, id, n_terms FROM qt JOIN d USING (term) GROUP BY query_id, id, n_terms HAVING count(*) = n_terms")
def match_all_words(spark, sf):
    """Chunks that hold every word of a job title."""
    c = load(spark, sf, "document_chunks").select(F.col("chunk_id").alias("id"), F.col("chunk_text").alias("text"))
    return retrieval.match_all(load(spark, sf, "job_roles").select(F.col("role_id").alias("query_id"), F.col("title").alias("text")), c)


@query()
def stemmed_match(spark, sf):
    """Chunks with the stems of all words of a job title, ranked by cover density (stemmer: no SQL form)."""
    c = load(spark, sf, "document_chunks").select(F.col("chunk_id").alias("id"), F.col("chunk_text").alias("text"))
    return retrieval.stemmed_match(load(spark, sf, "job_roles").select(F.col("role_id").alias("query_id"), F.col("title").alias("text")), c, 15)


_NORM = "CASE WHEN max(score) OVER w = min(score) OVER w THEN 1.0 ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END"


@query(
    f"""
    WITH {_RETRIEVAL},
    a AS (SELECT query_id, id, {_NORM} AS na FROM co WINDOW w AS (PARTITION BY query_id)), b AS (SELECT query_id, id, {_NORM} AS nb FROM bm WINDOW w AS (PARTITION BY query_id)),
    f AS (SELECT query_id, id, round(0.5 * coalesce(na, 0) + 0.5 * coalesce(nb, 0), 9) AS score FROM a FULL OUTER JOIN b USING (query_id, id)),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM f)
    SELECT query_id, id, round(score, 6) AS score, rank FROM r WHERE rank <= 10
    """
)
def linear_fusion(spark, sf):
    _, _, a, b = _arms(spark, sf)
    return retrieval.linear_fusion(a, b).select("query_id", "id", F.round("score", 6).alias("score"), "rank")


@query(
    f"""
    WITH {_RETRIEVAL},
    f AS (SELECT query_id, id, round(coalesce(0.5 / (60 + co.rank), 0) + coalesce(0.5 / (60 + bm.rank), 0), 12) AS score FROM co FULL OUTER JOIN bm USING (query_id, id)),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM f)
    SELECT query_id, id, round(score, 9) AS score, rank FROM r WHERE rank <= 10
    """
)
def rank_fusion(spark, sf):
    _, _, a, b = _arms(spark, sf)
    return retrieval.rank_fusion(a, b).select("query_id", "id", F.round("score", 9).alias("score"), "rank")


@query(
    f"""
    WITH {_RETRIEVAL}, p AS (
        SELECT coalesce(co.query_id, bm.query_id) AS query_id, coalesce(co.id, bm.id) AS id, concat_ws(',', CASE WHEN co.id IS NOT NULL THEN 'vector' END, CASE WHEN bm.id IS NOT NULL THEN 'bm25' END) AS sources
        FROM co FULL OUTER JOIN bm ON co.query_id = bm.query_id AND co.id = bm.id)
    SELECT sources, count(*) AS n_rows, count(DISTINCT query_id) AS n_queries FROM p GROUP BY ALL
    """
)
def source_overlap(spark, sf):
    _, _, a, b = _arms(spark, sf)
    return retrieval.overlap(retrieval.pool({"vector": a, "bm25": b}))


_FUSED = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (SELECT query_id, id, round(coalesce(0.5 / (60 + co.rank), 0) + coalesce(0.5 / (60 + bm.rank), 0), 12) AS score FROM co FULL OUTER JOIN bm USING (query_id, id))) WHERE rank <= {0}"
_POOL = ("vector", "co"), ("bm25", "bm"), ("hybrid", "hy")


@query(
    f"""
    WITH {_RETRIEVAL}, hy AS ({_FUSED.format(10)}),
    p AS ({" UNION ALL ".join(f"SELECT query_id, id, {i} AS o, '{n}' AS source, rank, round(score, 6) AS score FROM {t}" for i, (n, t) in enumerate(_POOL))})
    SELECT query_id, id, string_agg(source, ',' ORDER BY o) AS sources, greatest(max(score), 0.0) AS best_score, count(*) AS n_sources,
           {", ".join(f"max({c}) FILTER (source = '{n}') AS {n}_{c}" for n, _ in _POOL for c in ("rank", "score"))} FROM p GROUP BY query_id, id
    """
)
def pooled_candidates(spark, sf):
    q, c, a, b = _arms(spark, sf)
    return retrieval.pool({"vector": a, "bm25": b, "hybrid": retrieval.rank_fusion(a, b)})


@query(
    f"""
    WITH {_sql_arms(k=8)},
    i AS (SELECT bm.query_id, bm.rank, '[' || bm.rank || '] ' || bm.id || chr(10) || CASE WHEN length(c.raw_text) > 1500 THEN substr(c.raw_text, 1, 1500) || '...' ELSE c.raw_text END AS item FROM bm JOIN document_chunks c ON bm.id = c.chunk_id)
    SELECT i.query_id, string_agg(item, chr(10) || chr(10) ORDER BY rank) || chr(10) || chr(10) || 'Question: ' || any_value(q.query_text) AS prompt FROM i JOIN eval_queries q USING (query_id) GROUP BY i.query_id
    """
)
def prompts(spark, sf):
    """The best texts of each query as one prompt."""
    q, c, _, b = _arms(spark, sf, 8)
    top = b.join(c, "id").join(q.withColumnRenamed("text", "question"), "query_id").withColumn("source", F.col("id"))
    return retrieval.prompt(top, "question")


def _corpus(spark, sf):
    """Chunks with the address, company and role of their document; those without company or role are left out."""
    c, d = load(spark, sf, "document_chunks").select("chunk_id", "document_id", "chunk_text"), load(spark, sf, "processed_documents")
    key = lambda x: F.lower(F.trim(x))
    d = d.select("document_id", "source_url", key("company").alias("ck"), key("role").alias("rk"))
    co, r = load(spark, sf, "companies").select(F.col("name").alias("company"), key("name").alias("ck")), load(spark, sf, "job_roles").select(F.col("title").alias("role"), key("title").alias("rk"))
    return c.join(d.join(co, "ck").join(r, "rk"), "document_id").select(F.col("chunk_id").alias("id"), F.col("chunk_text").alias("text"), "source_url", "company", "role")


_SQL_CORPUS = "(SELECT c.chunk_id, c.chunk_text, d.source_url, co.name AS company, r.title AS role FROM document_chunks c JOIN processed_documents d ON c.document_id = d.document_id JOIN companies co ON lower(trim(d.company)) = lower(trim(co.name)) JOIN job_roles r ON lower(trim(d.role)) = lower(trim(r.title)))"


@query(f"WITH {_sql_arms(_SQL_CORPUS, 'chunk_text', 16)}, hy AS ({_FUSED.format(8)}) SELECT hy.query_id, hy.id, round(hy.score, 6) AS score, hy.rank, c.chunk_text AS text, c.source_url, c.company, c.role FROM hy JOIN {_SQL_CORPUS} c ON hy.id = c.chunk_id")
def retrieved_chunks(spark, sf):
    """What a search returns: the best eight chunks of the hybrid mode with address, company and role; each list is asked for twice as many."""
    q = load(spark, sf, "eval_queries").select("query_id", F.col("query_text").alias("text"))
    return retrieval.retrieve("hybrid", q, _corpus(spark, sf), 8)


# ---- evaluation ----------------------------------------------------------------------------------------------------

_GRADES = "g AS (SELECT query_id, relevant_chunk_id AS id, relevance AS grade FROM (SELECT *, row_number() OVER (PARTITION BY query_id, relevant_chunk_id ORDER BY created_at DESC, judgment_id DESC) AS r FROM eval_dataset WHERE relevance >= 0) WHERE r = 1)"
_METRICS = f"""{_RETRIEVAL}, {_GRADES}, ks AS (SELECT unnest([5, 10, 15]) AS k),
    h AS (SELECT bm.query_id, bm.id, bm.rank, bm.score, g.grade FROM bm LEFT JOIN g USING (query_id, id)),
    got AS (SELECT query_id, k, min(rank) FILTER (grade >= 1) AS first_hit, count(*) FILTER (grade >= 1) AS hits, count(*) AS shown, sum((pow(2, coalesce(grade, 0)) - 1) / log2(rank + 1)) AS dcg FROM h JOIN ks ON rank <= k GROUP BY ALL),
    gi AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY grade DESC, id) AS rank FROM g),
    ideal AS (SELECT query_id, k, sum((pow(2, grade) - 1) / log2(rank + 1)) AS idcg FROM gi JOIN ks ON rank <= k GROUP BY ALL),
    rel AS (SELECT query_id, count(*) FILTER (grade >= 1) AS n_relevant FROM g GROUP BY query_id),
    pq AS (SELECT q.query_id, q.query_category, ks.k, coalesce(1.0 / first_hit, 0) AS rr, coalesce(hits, 0) / nullif(n_relevant, 0) AS recall, coalesce(hits / nullif(shown, 0), 0) AS prec, coalesce(coalesce(dcg, 0) / nullif(idcg, 0), 0) AS ndcg
           FROM eval_queries q CROSS JOIN ks LEFT JOIN got ON got.query_id = q.query_id AND got.k = ks.k LEFT JOIN ideal ON ideal.query_id = q.query_id AND ideal.k = ks.k LEFT JOIN rel ON rel.query_id = q.query_id),
    cat AS (SELECT coalesce(query_category, 'uncategorised') AS query_category, k, count(*) AS n_queries, round(avg(rr), 6) AS mrr, round(avg(recall), 6) AS recall, round(avg(prec), 6) AS precision, round(avg(ndcg), 6) AS ndcg FROM pq GROUP BY ALL),
    overall AS (SELECT 'overall' AS query_category, k, count(*) AS n_queries, round(avg(rr), 6) AS mrr, round(avg(recall), 6) AS recall, round(avg(prec), 6) AS precision, round(avg(ndcg), 6) AS ndcg FROM pq GROUP BY k)"""


def _evaluated(spark, sf):
    q = load(spark, sf, "eval_queries")
    return q, _arms(spark, sf)[3], evaluate.judged(load(spark, sf, "eval_dataset"))


@query(f"WITH {_METRICS} SELECT * FROM cat UNION ALL SELECT * FROM overall")
def retrieval_metrics(spark, sf):
    q, ranked, grades = _evaluated(spark, sf)
    return evaluate.metrics(evaluate.per_query(q, ranked, grades))


@query(f"WITH {_METRICS}, c AS (SELECT query_category, ndcg AS value FROM cat WHERE k = 10) SELECT query_category, value, round(avg(value) OVER (), 4) AS overall_mean, round(max(value) OVER () - min(value) OVER (), 4) AS disparity, value < round(avg(value) OVER (), 4) - 0.1 AS underperforming, CASE WHEN count(*) OVER () < 2 THEN 'fewer than two categories' END AS note FROM c")
def category_disparity(spark, sf):
    q, ranked, grades = _evaluated(spark, sf)
    return evaluate.disparity(evaluate.metrics(evaluate.per_query(q, ranked, grades)))


@query(f"WITH {_METRICS} SELECT coalesce(CAST(grade AS VARCHAR), 'unjudged') AS grade, count(*) AS n, round(avg(score), 6) AS mean_score FROM h GROUP BY ALL")
def grade_separation(spark, sf):
    _, ranked, grades = _evaluated(spark, sf)
    return evaluate.grade_separation(ranked, grades)


@query(f"WITH {_METRICS} SELECT round(avg(score) FILTER (grade = 2) - avg(score) FILTER (grade = 0), 4) AS gap FROM h")
def grade_gap(spark, sf):
    _, ranked, grades = _evaluated(spark, sf)
    return evaluate.grade_gap(ranked, grades)


@query(
    f"""
    WITH {_METRICS}, gh AS (SELECT query_id, {", ".join(f"count(*) FILTER (grade = {g}) AS n_grade_{g}" for g in (0, 1, 2))} FROM g GROUP BY query_id),
    t AS (SELECT query_id, coalesce(max(grade) FILTER (rank = 1), -1) AS top_grade, count(*) FILTER (rank <= 10 AND grade >= 1) AS hits, string_agg(CAST(coalesce(grade, -1) AS VARCHAR), ',' ORDER BY rank) AS grades, round(sum(round(score, 4)), 4) AS score_sum FROM h GROUP BY query_id)
    SELECT q.query_id, {", ".join(f"coalesce(n_grade_{g}, 0) AS n_grade_{g}" for g in (0, 1, 2))}, coalesce(top_grade, -1) AS top_grade, coalesce(hits, 0) AS hits_at_10, grades, score_sum FROM eval_queries q LEFT JOIN gh USING (query_id) LEFT JOIN t USING (query_id)
    """
)
def query_details(spark, sf):
    """Judgments and hits of every query, with the grades and the sum of the scores of what was found."""
    q, ranked, grades = _evaluated(spark, sf)
    d = evaluate.details(q, ranked, grades)
    total = F.round(F.aggregate("scores", F.lit(0.0), lambda s, x: s + x), 4)
    return d.withColumn("score_sum", F.when(F.size("scores") > 0, total)).withColumn("grades", F.when(F.size("grades") > 0, F.array_join("grades", ","))).drop("scores")


def _runs(spark, sf):
    """Three configurations over the same chunks: metrics of each category and of all queries."""
    q, _, a, b = _arms(spark, sf)
    grades = evaluate.judged(load(spark, sf, "eval_dataset"))
    queries = load(spark, sf, "eval_queries")
    runs = {"cosine": a, "bm25": b, "hybrid": retrieval.rank_fusion(a, b, k=15)}
    return R.cut(reduce(DataFrame.unionByName, [evaluate.metrics(evaluate.per_query(queries, r, grades)).withColumn("config", F.lit(n)) for n, r in runs.items()]))


def _compared(spark, sf):
    n = load(spark, sf, "document_chunks").agg(F.count("*").alias("n"))
    mb = n.select(F.explode(F.array(*[F.struct(F.lit(c).alias("config"), F.lit(d).alias("d")) for c, d in (("cosine", 384), ("bm25", 0), ("hybrid", 384))])).alias("x"), "n")
    storage = mb.select("x.config", F.when(F.col("x.d") > 0, F.col("n") * (F.col("x.d") * 4 + 64) / 2**20).otherwise(0.0).alias("mb"))
    return evaluate.selection(_runs(spark, sf), storage)


_SQL_RUNS = f"""{_METRICS}, hy AS ({_FUSED.format(15)}), cf AS (SELECT * FROM (VALUES ('cosine', 384), ('bm25', 0), ('hybrid', 384)) c(config, d)),
    runs AS (SELECT 'cosine' AS config, query_id, id, rank FROM co UNION ALL SELECT 'bm25', query_id, id, rank FROM bm UNION ALL SELECT 'hybrid', query_id, id, rank FROM hy),
    got3 AS (SELECT config, query_id, k, min(rank) FILTER (grade >= 1) AS first_hit, count(*) FILTER (grade >= 1) AS hits, sum((pow(2, coalesce(grade, 0)) - 1) / log2(rank + 1)) AS dcg FROM runs LEFT JOIN g USING (query_id, id) JOIN ks ON rank <= k GROUP BY ALL),
    pq3 AS (SELECT cf.config, coalesce(q.query_category, 'uncategorised') AS query_category, ks.k, coalesce(1.0 / first_hit, 0) AS rr, coalesce(hits, 0) / nullif(n_relevant, 0) AS recall, coalesce(coalesce(dcg, 0) / nullif(idcg, 0), 0) AS ndcg
            FROM eval_queries q CROSS JOIN ks CROSS JOIN cf LEFT JOIN got3 ON got3.config = cf.config AND got3.query_id = q.query_id AND got3.k = ks.k LEFT JOIN ideal ON ideal.query_id = q.query_id AND ideal.k = ks.k LEFT JOIN rel ON rel.query_id = q.query_id),
    ov3 AS (SELECT config, k, round(avg(rr), 6) AS mrr, round(avg(recall), 6) AS recall, round(avg(ndcg), 6) AS ndcg FROM pq3 GROUP BY ALL),
    s3 AS (SELECT config, max(ndcg) FILTER (k = 10) AS ndcg, max(recall) FILTER (k = 10) AS recall, max(mrr) FILTER (k = 5) AS mrr FROM ov3 GROUP BY config),
    sel AS (SELECT config, ndcg, round(0.47 * ndcg + 0.29 * recall + 0.18 * mrr + 0.06 * least(1.0, 120.0 / greatest(CASE WHEN d > 0 THEN n * (d * 4 + 64) / 1048576.0 ELSE 0.0 END, 1.0)), 6) AS selection_score FROM s3 JOIN cf USING (config), (SELECT count(*) AS n FROM document_chunks)),
    placed AS (SELECT *, row_number() OVER (ORDER BY selection_score DESC, config) AS place FROM sel)"""


@query(f"WITH {_SQL_RUNS} SELECT * FROM placed")
def selection_scores(spark, sf):
    """Three configurations against the same judgments, ranked by their selection score."""
    return _compared(spark, sf)


@query(
    f"WITH {_SQL_RUNS}, t AS (SELECT config AS winner, ndcg AS best FROM placed WHERE place = 1), m AS (SELECT config AS candidate, ndcg AS own FROM placed WHERE config IN ('bm25', 'cosine') ORDER BY place LIMIT 1) "
    "SELECT winner, candidate, round((best - own) / nullif(best, 0), 6) AS relative_gap, round((best - own) / nullif(best, 0), 6) <= 0.05 AS accept FROM t, m"
)
def decision_gate(spark, sf):
    return evaluate.decision(_compared(spark, sf), ["bm25", "cosine"])


@query(
    f"WITH {_SQL_RUNS}, c3 AS (SELECT config, query_category, round(avg(ndcg), 6) AS ndcg FROM pq3 WHERE k = 10 GROUP BY ALL), d3 AS (SELECT config, round(max(ndcg) - min(ndcg), 4) AS disparity FROM c3 GROUP BY config HAVING count(*) >= 2) "
    "SELECT *, row_number() OVER (ORDER BY disparity, config) AS place FROM d3"
)
def config_bias(spark, sf):
    """Configurations from the least to the most biased one by the disparity of their categories."""
    return evaluate.bias(_runs(spark, sf))


@query("SELECT judgment_id, CAST(TRY_CAST(substr(query_id, 3) AS DOUBLE) AS BIGINT) AS query_no, CAST(relevance AS BIGINT) AS relevance FROM eval_dataset WHERE TRY_CAST(substr(query_id, 3) AS DOUBLE) IS NOT NULL AND relevance IS NOT NULL")
def coerced_numbers(spark, sf):
    """Judgments whose query number and grade read as numbers."""
    e = load(spark, sf, "eval_dataset").select("judgment_id", F.substr("query_id", F.lit(3)).alias("query_no"), "relevance")
    return evaluate.coerced(e, ["query_no", "relevance"])


@query(f"WITH {_RETRIEVAL}, {_GRADES} SELECT bm.query_id, bm.id, bm.rank FROM bm WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.query_id = bm.query_id AND g.id = bm.id)")
def judgments_to_resume(spark, sf):
    """Candidates that still have to be judged: an anti join on two keys with what has been judged."""
    _, ranked, grades = _evaluated(spark, sf)
    return ranked.join(grades, ["query_id", "id"], "left_anti").select("query_id", "id", "rank")


# ---- drift ---------------------------------------------------------------------------------------------------------

_DIMS = "l AS (SELECT id, logged_at > (SELECT max(logged_at) FROM query_logs) - INTERVAL 30 DAY AS cur, generate_subscripts(query_embedding, 1) - 1 AS dim, CAST(unnest(query_embedding) AS DOUBLE) AS x FROM query_logs WHERE query_embedding IS NOT NULL), s AS (SELECT dim, cur, count(*) AS n, avg(x) AS mean, stddev_pop(x) AS std FROM l GROUP BY ALL), rs AS (SELECT * FROM s WHERE NOT cur), cs AS (SELECT * FROM s WHERE cur)"


def _split(spark, sf):
    q = load(spark, sf, "query_logs").select("id", "logged_at", "query_embedding")
    end = q.agg(F.max("logged_at").alias("last"))
    q = q.join(F.broadcast(end)).withColumn("cur", F.col("logged_at") > F.col("last") - F.expr("INTERVAL 30 DAYS"))
    return q.where("not cur"), q.where("cur")


@query(f"WITH {_DIMS} SELECT CAST(dim AS INTEGER) AS dim, n, round(mean, 6) AS mean, round(std, 6) AS std FROM rs")
def reference_statistics(spark, sf):
    s = drift.statistics(_split(spark, sf)[0], "query_embedding")
    return s.select("dim", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(f"WITH {_DIMS} SELECT round(1 - sum(rs.mean * cs.mean) / (sqrt(sum(rs.mean * rs.mean)) * sqrt(sum(cs.mean * cs.mean))), 6) AS centroid_distance, round(quantile_cont(abs(cs.mean - rs.mean) / greatest(rs.std, 1e-8), 0.95), 6) AS shift_p95 FROM rs JOIN cs USING (dim)")
def centroid_and_shift(spark, sf):
    a, b = _split(spark, sf)
    rs, cs = drift.statistics(a, "query_embedding"), drift.statistics(b, "query_embedding")
    one = drift.centroid_distance(rs, cs).join(F.broadcast(drift.shift(rs, cs)))  # one row each
    return one.select(F.round("centroid_distance", 6).alias("centroid_distance"), F.round("shift_p95", 6).alias("shift_p95"))


@query(
    f"""
    WITH {_DIMS}, v AS (SELECT dim, x, count(*) FILTER (NOT cur) AS r, count(*) FILTER (cur) AS c FROM l GROUP BY dim, x),
    f AS (SELECT dim, abs(sum(r) OVER w / sum(r) OVER (PARTITION BY dim) - sum(c) OVER w / sum(c) OVER (PARTITION BY dim)) AS gap FROM v WINDOW w AS (PARTITION BY dim ORDER BY x))
    SELECT CAST(dim AS INTEGER) AS dim, round(max(gap), 9) AS ks FROM f GROUP BY dim
    """
)
def two_sample_test(spark, sf):
    a, b = _split(spark, sf)
    return drift.two_sample(a, b, "query_embedding").select("dim", F.round("ks", 9).alias("ks"))


_SQL_KS = f"""{_DIMS}, v AS (SELECT dim, x, count(*) FILTER (NOT cur) AS r, count(*) FILTER (cur) AS c FROM l GROUP BY dim, x),
    f AS (SELECT dim, abs(sum(r) OVER w / sum(r) OVER (PARTITION BY dim) - sum(c) OVER w / sum(c) OVER (PARTITION BY dim)) AS gap FROM v WINDOW w AS (PARTITION BY dim ORDER BY x)),
    n AS (SELECT dim, sum(r) AS nr, sum(c) AS nc FROM v GROUP BY dim),
    t AS (SELECT f.dim, CASE WHEN any_value(nr) > 0 AND any_value(nc) > 0 THEN max(gap) > sqrt(-ln(0.025) / 2) * sqrt((any_value(nr) + any_value(nc)) / (any_value(nr) * any_value(nc))) END AS drifted FROM f JOIN n USING (dim) GROUP BY f.dim),
    m AS (SELECT 1 - sum(rs.mean * cs.mean) / (sqrt(sum(rs.mean * rs.mean)) * sqrt(sum(cs.mean * cs.mean))) AS centroid, quantile_cont(abs(cs.mean - rs.mean) / greatest(rs.std, 1e-8), 0.95) AS shift FROM rs JOIN cs USING (dim)),
    o AS (SELECT centroid, shift, (SELECT avg(CAST(drifted AS DOUBLE)) FROM t) AS share, (SELECT count(DISTINCT id) FROM l WHERE cur) AS n_current FROM m)"""


@query(
    f"WITH {_SQL_KS}, b AS (SELECT *, coalesce(CAST(centroid > 0.15 AS INTEGER) + CAST(shift > 2.0 AS INTEGER) + CAST(share > 0.30 AS INTEGER), 0) AS limits_broken FROM o) "
    "SELECT round(centroid, 6) AS centroid_distance, round(shift, 6) AS shift_p95, round(share, 6) AS drifted_share, n_current, limits_broken, n_current >= 20 AND limits_broken >= 2 AS drift FROM b"
)
def drift_flag(spark, sf):
    """The three measures of drift, the limits they break, and the flag."""
    a, b = _split(spark, sf)
    d = drift.composite(a, b, "query_embedding")
    return d.select(*[F.round(c, 6).alias(c) for c in ("centroid_distance", "shift_p95", "drifted_share")], "n_current", "limits_broken", "drift")


@query(f"WITH {_SQL_KS} SELECT round(share, 6) AS drifted_share, coalesce(share > 0.30, FALSE) AS refresh FROM o")
def drift_trigger(spark, sf):
    """The share of drifted dimensions, and whether it calls for a refresh of the corpus."""
    a, b = _split(spark, sf)
    return drift.trigger(drift.drifted(drift.two_sample(a, b, "query_embedding")))


# ---- pages, pipeline, streams --------------------------------------------------------------------------------------


@query()
def article_pages(spark, sf):
    """All raw posts read as pages: heading, text, tags and what they say of the kind of visit, date."""
    pages = parsers.parse_articles(R.spread(load(spark, sf, "raw_documents").select("source_url", "raw_content")), "source_url", "raw_content")
    return pages.withColumn("experience_type", parsers.experience_type(F.col("tags"), F.col("title")))


@query("SELECT ingest_seq, CASE " + " ".join(f"WHEN regexp_matches(raw_content, '{_re(p)}') THEN '{k}'" for k, p in parsers.PAYWALL) + " END AS reason FROM raw_documents WHERE raw_content IS NOT NULL")
def paywall_signs(spark, sf):
    """The first sign of a paywall on every page."""
    d = load(spark, sf, "raw_documents").where("raw_content is not null")
    return d.select("ingest_seq", parsers.paywall(F.col("raw_content")).alias("reason"))


@query("SELECT regexp_extract(source_url, '^https?://([^/?#]+)', 1) AS host, count(*) AS n, count(DISTINCT source_url) AS n_urls, min(scrape_batch_id) AS first_batch FROM raw_documents GROUP BY ALL")
def url_report(spark, sf):
    d = load(spark, sf, "raw_documents")
    return d.groupBy(F.regexp_extract("source_url", r"^https?://([^/?#]+)", 1).alias("host")).agg(F.count("*").alias("n"), F.count_distinct("source_url").alias("n_urls"), F.min("scrape_batch_id").alias("first_batch"))


@query(
    """
    WITH f AS (SELECT trim(coalesce(source_metadata, '')) AS t FROM raw_documents),
    s AS (SELECT CASE WHEN NOT (json_valid(t) AND t LIKE '{%') THEN 'failed_read' WHEN trim(coalesce(json_extract_string(t, '$.tags'), '')) = '' OR trim(coalesce(json_extract_string(t, '$.reactions'), '')) = '' THEN 'failed_insert' ELSE 'ok' END AS s FROM f)
    SELECT count(*) AS total, count(*) FILTER (s = 'ok') AS inserted, count(*) FILTER (s <> 'ok') AS skipped, count(*) FILTER (s = 'failed_read') AS failed_reads, count(*) FILTER (s = 'failed_insert') AS failed_inserts FROM s
    """
)
def load_summary(spark, sf):
    """Every metadata document read on its own: how many were loaded, could not be read, or lack a required field."""
    return loading.summary(loading.read_states(load(spark, sf, "raw_documents"), "source_url", "source_metadata", ["tags", "reactions"]))


@query(
    "SELECT document_id, trim(company) AS company, trim(role) AS role, "
    + ", ".join(f"CASE WHEN lower(trim({c})) IN {_list(P.ENUMS[c])} THEN lower(trim({c})) END AS {c}" for c in ("experience_level", "interview_outcome", "difficulty"))
    + f", num_rounds, CASE WHEN lower(trim(interview_types[1])) IN {_list(P.ENUMS['interview_types'])} THEN lower(trim(interview_types[1])) END AS interview_type, array_to_string(coalesce(topics, []), ',') AS topics FROM processed_documents WHERE trim(coalesce(company, '')) <> '' AND trim(coalesce(role, '')) <> ''"
)
def metadata_rows(spark, sf):
    """Metadata of the documents that have a company and a role."""
    return loading.metadata_rows(load(spark, sf, "processed_documents")).withColumn("topics", F.array_join("topics", ","))


@query("SELECT count(*) FILTER (json_valid(source_metadata)) AS collected, count(*) FILTER (NOT json_valid(source_metadata)) AS errors, max(scraped_at) AS last, (SELECT string_agg(u, ' ' ORDER BY u) FROM (SELECT DISTINCT source_url AS u FROM raw_documents WHERE NOT json_valid(source_metadata) ORDER BY u LIMIT 10)) AS error_urls FROM raw_documents WHERE source_metadata IS NOT NULL")
def scrape_manifest(spark, sf):
    """What a run collected and what failed (here: metadata that is cut off), with the first addresses that failed."""
    d = load(spark, sf, "raw_documents").where("source_metadata is not null").withColumn("error", F.when(F.try_parse_json("source_metadata").isNull(), "broken"))
    return loading.manifest(d, "source_url", "error", "scraped_at").withColumn("error_urls", F.nullif(F.array_join("error_urls", " "), F.lit("")))


@query("SELECT company, n, first_at, last_at FROM (SELECT trim(company) AS company, count(*) AS n, min(scraped_at) AS first_at, max(scraped_at) AS last_at FROM processed_documents WHERE trim(coalesce(company, '')) <> '' GROUP BY 1) ORDER BY n DESC, company LIMIT 10")
def top_companies(spark, sf):
    """The ten companies with most documents (a report of ten rows), with the first and last time of a fetch."""
    d = load(spark, sf, "processed_documents").where(F.trim(F.coalesce("company", F.lit(""))) != "")
    return d.groupBy(F.trim("company").alias("company")).agg(F.count("*").alias("n"), F.min("scraped_at").alias("first_at"), F.max("scraped_at").alias("last_at")).orderBy(F.desc("n"), "company").limit(10)


@query()
def pipeline_report(spark, sf):
    """The six steps over all raw documents: rows by the step and reason that rejected them."""
    return pipeline.report(pipeline.Pipeline().plan(R.spread(load(spark, sf, "raw_documents"))))


@query()
def pipeline_documents(spark, sf):
    """The processed documents that come out of the pipeline."""
    lists = {"companies": load(spark, sf, "companies"), "job_roles": load(spark, sf, "job_roles")}
    out = pipeline.kept(pipeline.Pipeline(options={"entity_extractor": lists}).plan(R.spread(load(spark, sf, "raw_documents"))))
    return out.select("document_id", "source_platform", "source_url", "content_hash", "title", "content", "word_count", "company", "role", "experience_level", "interview_outcome", "difficulty", "num_rounds", F.array_join("topics", ",").alias("topics"), "quality_score")


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_tumbling(spark, sf):
    """Hourly counts by a streaming query over all files, complete mode."""
    out = streams.run_now(streams.tumbling(streams.parquet_stream(spark, f"{sf}/events.parquet")), f"t_{uuid.uuid4().hex}", "complete")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


@query(
    """
    WITH d AS (SELECT date_trunc('day', ts) - i * INTERVAL 1 DAY AS window_start, value FROM events, range(0, 7) t(i))
    SELECT window_start, count(*) AS n, round(avg(value), 6) AS mean FROM d GROUP BY ALL
    """
)
def stream_sliding(spark, sf):
    out = streams.run_now(streams.sliding(streams.parquet_stream(spark, f"{sf}/events.parquet")), f"s_{uuid.uuid4().hex}", "complete")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n", F.round("mean", 6).alias("mean"))


@query(
    """
    WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events),
    s AS (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT user_id, ts, max(b) AS b FROM (SELECT user_id, ts, min(b) OVER (PARTITION BY user_id, ts) AS b FROM g) GROUP BY user_id, ts)),
    e AS (SELECT user_id, k, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end FROM s GROUP BY user_id, k)
    SELECT e.user_id, e.session_start, e.session_end, count(*) AS n FROM e JOIN events v ON v.user_id = e.user_id AND v.ts >= e.session_start AND v.ts < e.session_end GROUP BY ALL
    """
)
def session_windows(spark, sf):
    return streams.sessions(load(spark, sf, "events"))


@query("SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY user_id")
def stream_totals(spark, sf):
    """Custom state per user in a stream; the last update of each user is its total."""
    out = streams.run_now(streams.running_totals(streams.parquet_stream(spark, f"{sf}/events.parquet")), f"u_{uuid.uuid4().hex}", "update")
    return out.groupBy("user_id").agg(F.max_by(F.struct("n", "total"), "n").alias("x")).select("user_id", "x.n", F.round("x.total", 4).alias("total"))
