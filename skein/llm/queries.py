"""Queries of the training-data operators, each over its whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import canonical, history, markup, mojibake, neardup, neighbours, packing, pii, splitting, tokens
from skein.llm._common import table


def _fields(spark: SparkSession, sf: str) -> list[tuple[str, DataFrame, str, str]]:
    chunks, docs = table(spark, sf, "document_chunks"), table(spark, sf, "processed_documents")
    return [("content", docs, "document_id", "content"), ("chunk_text", chunks, "chunk_id", "chunk_text"), ("raw_text", chunks, "chunk_id", "raw_text")]


def p1_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Readable text of every post, and the number of groups of markup in it."""
    return markup.clean_texts(table(spark, sf, "raw_documents"), "ingest_seq", "source_url", "raw_content")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Posts in which the wrappers of their host accept at least one group of markup."""
    return p1_clean(spark, sf).where("n_markup > 0").select("ingest_seq")


def p1_wrappers(spark: SparkSession, sf: str) -> DataFrame:
    """The wrappers inferred for each host, as union-free regular expressions."""
    posts = table(spark, sf, "raw_documents").select(markup.host_of(F.col("source_url")).alias("host"), "raw_content")
    own, everywhere = markup.infer_wrappers(posts, "host", "raw_content")
    return markup.readable(own.unionByName(everywhere))


def p2_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Every rejected post with the accepted post that it repeats, of the same batch date or an earlier one."""
    out = history.dedup_history(table(spark, sf, "raw_documents"), "ingest_seq", "scrape_batch_id", "raw_content")
    return out.withColumnRenamed("id", "ingest_seq")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected posts whose first accepted match lies in an earlier batch, smaller ingest_seq first."""
    out = p2_repeats(spark, sf).where("match_date < date")
    return out.select(F.least("ingest_seq", "match").alias("ingest_seq_a"), F.greatest("ingest_seq", "match").alias("ingest_seq_b"))


def p3_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """Every piece of every oversized or small item of the three fields."""
    each = [splitting.split_items(d, i, t).select(F.lit(name).alias("field_name"), "*") for name, d, i, t in _fields(spark, sf)]
    return reduce(DataFrame.unionByName, each)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Items that the splitter had to cut: it cuts exactly those beyond a limit."""
    return p3_pieces(spark, sf).where("n_pieces > 1 and piece = 0").select("field_name", "item_id")


def _free_texts(spark: SparkSession, sf: str) -> DataFrame:
    raw, logs = table(spark, sf, "raw_documents"), table(spark, sf, "query_logs")
    a = raw.select(F.lit("raw_documents").alias("src"), F.col("ingest_seq").alias("id"), F.col("raw_content").alias("text"))
    return a.unionByName(logs.select(F.lit("query_logs").alias("src"), "id", F.col("query_text").alias("text")))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Each distinct personal value of a post or query, with its type."""
    out = pii.find(_free_texts(spark, sf))
    return out.select(F.col("src").alias("source_table"), F.col("id").alias("record_id"), "pii_type", "pii_value").distinct()


def p4_redacted(spark: SparkSession, sf: str) -> DataFrame:
    """Every post and query with typed placeholders in place of personal values."""
    texts = _free_texts(spark, sf)
    return pii.redact(texts, pii.find(texts)).withColumnsRenamed({"src": "source_table", "id": "record_id"})


def p5_values(spark: SparkSession, sf: str) -> DataFrame:
    """Every filled company and role with the entry it means."""
    lists = {
        "company": table(spark, sf, "companies").select(F.col("company_id").alias("ref_id"), F.col("name").alias("title")),
        "role": table(spark, sf, "job_roles").select(F.col("role_id").alias("ref_id"), "title"),
    }
    return canonical.map_values(table(spark, sf, "processed_documents"), "document_id", lists)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """The entry that each filled company and role means, or -1."""
    return p5_values(spark, sf).select("document_id", "field_name", "ref_id")


def p5_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """Report of the values that mean no entry, with their number of rows."""
    return p5_values(spark, sf).where("ref_id = -1").groupBy("field_name", "value").agg(F.count("*").alias("n_rows"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs of similar posts, smaller ingest_seq first."""
    similar = neardup.Similar(table(spark, sf, "raw_documents"), "ingest_seq", F.col("raw_content"), F.col("title"))
    return similar.all_pairs().select(F.col("a").alias("ingest_seq_a"), F.col("b").alias("ingest_seq_b"))


def p6_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Each post's class of copies, its group, and the links of its class."""
    similar = neardup.Similar(table(spark, sf, "raw_documents"), "ingest_seq", F.col("raw_content"), F.col("title"))
    return neardup.groups(similar).withColumnRenamed("id", "ingest_seq")


def p7_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The five most similar other queries of each."""
    return neighbours.top_k(table(spark, sf, "query_logs"), "id", "query_embedding")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs where one is among the five of the other, each once."""
    out = p7_neighbours(spark, sf)
    return out.select(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).distinct()


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of every text."""
    return tokens.encode_texts(table(spark, sf, "documents"), "doc_id", "text")


def p9_containers(spark: SparkSession, sf: str) -> DataFrame:
    """The container of every document, or of every piece of one."""
    return packing.pack_documents(table(spark, sf, "documents"), "doc_id", "text")


def p10_restored(spark: SparkSession, sf: str) -> DataFrame:
    """Affected documents with the text as far as it can be restored."""
    return mojibake.restore_texts(table(spark, sf, "documents"), "doc_id", "text")


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in which some character was labelled as wrongly decoded."""
    return p10_restored(spark, sf).select("doc_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_clean, p1_wrappers, p2_found, p2_repeats, p3_found, p3_pieces, p4_found, p4_redacted, p5_found, p5_unmatched, p5_values, p6_found, p6_groups, p7_found, p7_neighbours, p8_ids, p9_containers, p10_found, p10_restored)}

#: Merges, packing, wrappers, extraction and labelling have no SQL form; their tests compare with brute force and round trips.
#: Problem 7 in SQL is the exact search: at the size of the SQL check there is one part, which is searched whole.
ORACLES: dict[str, str] = {
    "p3_found": r"""
        WITH items AS (
            SELECT 'content' AS field_name, document_id AS item_id, content AS t FROM processed_documents
            UNION ALL SELECT 'chunk_text', chunk_id, chunk_text FROM document_chunks
            UNION ALL SELECT 'raw_text', chunk_id, raw_text FROM document_chunks)
        SELECT field_name, item_id FROM items
        WHERE length(t) > 4000
           OR len(list_filter(string_split_regex(t, '[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'), lambda x: x <> '')) > 500
    """,
    "p6_found": r"""
        WITH w AS (
            SELECT ingest_seq AS id, regexp_extract_all(lower(coalesce(raw_content, '')), '[\p{L}\p{N}]+') AS r,
                   regexp_extract_all(lower(concat(coalesce(title, ''), ' ', coalesce(raw_content, ''))), '[\p{L}\p{N}]+') AS w FROM raw_documents),
        s AS (
            SELECT id, list_distinct(list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2]))) AS s,
                   len(list_distinct(list_transform(range(1, len(r) - 1), lambda i: concat(r[i], ' ', r[i + 1], ' ', r[i + 2])))) AS own FROM w WHERE len(r) >= 3),
        e AS (SELECT id, len(s) AS n, unnest(s) AS x FROM s WHERE own >= 10),
        p AS (SELECT a.id AS a, b.id AS b, count(*) AS k, any_value(a.n) AS na, any_value(b.n) AS nb FROM e a JOIN e b ON a.x = b.x AND a.id < b.id GROUP BY a.id, b.id)
        SELECT a AS ingest_seq_a, b AS ingest_seq_b FROM p WHERE k / (na + nb - k) >= 0.8
    """,
    "p7_found": """
        WITH v AS (SELECT id, CAST(query_embedding AS DOUBLE[]) AS v FROM query_logs WHERE query_embedding IS NOT NULL AND list_max(list_transform(query_embedding, lambda x: abs(x))) > 0),
        s AS (SELECT a.id AS a, b.id AS b, list_cosine_similarity(a.v, b.v) AS c FROM v a JOIN v b ON a.id <> b.id),
        r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY c DESC, b) AS r FROM s)
        SELECT DISTINCT least(a, b) AS id_a, greatest(a, b) AS id_b FROM r WHERE r <= 5
    """,
}
