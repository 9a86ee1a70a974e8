"""Every core query runs on the smallest tables; those with SQL give the same rows as DuckDB."""

import math
import os

import duckdb
import pytest

import skein.queries as Q


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return round(v, 6)
    return str(v).split("+")[0] if hasattr(v, "isoformat") else v


def rows(cols, got):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in got], key=repr)


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, sf, duck, name):
    df = Q.QUERIES[name](spark, sf)
    mine = rows(df.columns, df.collect())
    if name in Q.ORACLES:
        cur = duck.execute(Q.ORACLES[name])
        cols = [c[0] for c in cur.description]
        assert sorted(cols) == sorted(df.columns)
        assert mine == rows(cols, cur.fetchall())
    else:
        assert df.columns


def test_whole_operators_over_all_rows(spark, tmp_path):
    pages = [(1, '<div class="paywall-box">x</div>', "\U0001f9e0 \u201cA\u201d &amp; \u2764 b"), (2, "Member-only story", None), (3, "```\nx = 1\n```\n> **bold** and `code`\n---", "t"), (4, None, "t")]
    spark.createDataFrame(pages, "ingest_seq int, raw_content string, title string").write.parquet(f"{tmp_path}/raw_documents.parquet")
    texts = [(1, "ask @some_user or github.com/some/repo now"), (2, "@Override is kept"), (3, None)]
    spark.createDataFrame(texts, "id int, query_text string").write.parquet(f"{tmp_path}/query_logs.parquet")
    got = lambda q, *c: [tuple(r) for r in Q.QUERIES[q](spark, str(tmp_path)).select(*c).orderBy(c[0]).collect()]
    assert got("paywall_signs", "ingest_seq", "reason") == [(1, "paywall_class"), (2, "member_badge"), (3, None)]
    assert got("pii_all_rules_queries", "id", "redacted") == [(1, "ask [USERNAME] or [PERSONAL_URL] now"), (2, "@Override is kept")]
    assert got("titles_normalised", "ingest_seq", "title") == [(1, '"A" & b'), (2, ""), (3, "t"), (4, "t")]
    plain = dict(got("markdown_strip", "ingest_seq", "plain"))
    assert set(plain) == {1, 2, 3} and plain[3].split() == "[code block removed] bold and code".split()


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
