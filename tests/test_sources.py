"""Sources, sinks, parsers, pipeline and streams."""

import json
import random

import pytest
from pyspark.sql import functions as F

from skein.plans import pipeline
from skein.sources import parsers, readers, sinks
from skein.streaming import streams


def test_documents_and_files(spark, tmp_path):
    for p, d in (("a", {"document_id": "1", "raw_content": "x", "content_hash": "old"}), ("b", {"document_id": "2", "title": "t"})):
        (tmp_path / p).mkdir()
        (tmp_path / p / "d.json").write_text(json.dumps(d))
    (tmp_path / "b" / "broken.json").write_text("{")
    df = readers.read_documents(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert df.count() == 3 and "content_hash" not in df.columns
    assert df.where("document_id is not null").count() == 2 and df.cache().where("_corrupt_record is not null").count() == 1
    files = [r.path for r in readers.list_files(spark, str(tmp_path), ".json").collect()]
    assert len(files) == 3 and files == sorted(files, reverse=True)
    assert [r.document_id for r in readers.not_yet_seen(df.where("document_id is not null"), df.where("document_id = '1'"), "document_id").collect()] == ["2"]


def test_csv(spark, tmp_path):
    f = tmp_path / "q.csv"
    f.write_text('query_id , query_text,query_category\n1," two\nlines ",c\n')
    assert [tuple(r) for r in readers.read_queries(spark, str(f)).collect()] == [("1", "two\nlines", "c")]
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(f), ("absent",))


def test_sitemaps(spark, tmp_path):
    f = tmp_path / "s.xml"
    f.write_text('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>https://a/interview-experience-x</loc><lastmod>2025-02-01T00:00:00</lastmod></url><url><loc>https://a/interview-experience-x</loc><lastmod>2025-03-01</lastmod></url><url><loc>https://a/other</loc></url><url><loc>https://a/interview-experience-y</loc></url></urlset>')
    e = readers.sitemap_entries(spark, str(f), "url")
    assert e.first().lastmod == "2025-03-01"
    assert sorted(tuple(r) for r in readers.wanted_urls(e, "interview-experience", "2025-02-15").collect()) == [("https://a/interview-experience-x", "2025-03-01"), ("https://a/interview-experience-y", None)]
    assert readers.wanted_sitemaps(e, "https://a/", "2025-03-01", False).count() == 0
    assert readers.wanted_sitemaps(e, "https://a/", "2025-03-01", True).count() == 3


def test_pages_manifests_config(spark):
    pages = spark.createDataFrame([('{"edges": [{"node": {"id": 1}}, {"node": {"id": 2}}]}',), ("broken",)], "p string")
    assert [r.node for r in readers.page_nodes(pages, "p").collect()] == ['{"id":1}', '{"id":2}']
    m = spark.createDataFrame([("m/gfg/scrape_1.json", "a"), ("m/gfg/scrape_2.json", "b"), ("m/other/scrape_9.json", "c")], "path string, last string")
    assert readers.newest_manifest(m, "gfg").first().last == "b" and readers.newest_manifest(m, "none").count() == 0
    assert readers.resolve_env({"a": ["${X}-1", 2]}, {"X": "v"}) == {"a": ["v-1", 2]}
    with pytest.raises(KeyError):
        readers.resolve_env("${ABSENT}", {})
    ok = spark.createDataFrame([("m1", 1)], "model string, x int")
    assert readers.same_model(ok, "m1").count() == 1
    with pytest.raises(Exception, match="expected model"):
        readers.same_model(ok, "m2").collect()


def test_parsers(spark):
    page = '<html><head><title>x</title></head><body><header>nav</header><h1>Head</h1><div class="article--viewer_x"><p>One</p><nav>no</nav><p>Two<br>Three</p></div>Last Updated : 12 Sep, 2025</body></html>'
    df = spark.createDataFrame([("u", page), ("v", "<body><p>plain body</p></body>"), ("w", ""), ("z", None)], "url string, html string")
    got = {r.url: r for r in parsers.parse_articles(df, "url", "html").collect()}
    assert got["u"].title == "Head" and got["u"].content == "One\nTwo\nThree" and got["u"].last_updated == "12 Sep, 2025"
    assert got["v"].title == "Untitled" and set(got) == {"u", "v"}
    state = json.dumps({"Paragraph:a_2": {"text": "body", "type": "P"}, "Paragraph:a_1": {"text": "Top", "type": "H3"}, "Post:a": {"text": "no", "type": "P"}, "Paragraph:a_10": {"text": "x()", "type": "PRE"}})
    s = spark.createDataFrame([(state,)], "s string").select(parsers.state_to_markdown(F.col("s")).alias("m")).first().m
    assert s == "### Top\n\nbody\n\n```\nx()\n```"
    p = spark.createDataFrame([("A Member-only story",), ('{"isLocked": true}',), ("free",)], "h string").select(parsers.paywall(F.col("h")).alias("r"))
    assert [r.r for r in p.collect()] == ["member_badge", "locked_state", None]
    a = spark.createDataFrame([("<article><h2>T</h2><p>" + "long text " * 20 + "</p></article>",), ("<p>short</p>",)], "h string")
    got = [r.content for r in parsers.article_fallbacks(a, "h").collect()]
    assert got[0].startswith("## T\n\nlong text") and got[1] is None
    m = spark.createDataFrame([('<meta property="og:description" content="d"> 5 min read',)], "h string").select(parsers.page_metadata(F.col("h")).alias("m")).first().m
    assert m.description == "d" and m.reading_minutes == 5 and m.image is None
    t = spark.createDataFrame([([("Acme", "TOPIC"), ("Zed", "COMPANY")], "x")], "tags array<struct<name string, tagType string>>, title string")
    assert t.select(parsers.company_of_tags(F.col("tags"), F.col("title"), ["Acme"]).alias("c")).first().c == "Zed"
    c = spark.createDataFrame([([("a", False), ("b", True)],)], "c array<struct<content string, hidden boolean>>")
    assert c.select(parsers.comments(F.col("c")).alias("x")).first().x == ["a"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "b1", "too_short_5_words"), (2, "b1", None)], "id int, scrape_batch_id string, filter_reason string")
    sinks.write_processed(df, f"{tmp_path}/p")
    sinks.write_quarantine(df, f"{tmp_path}/q")
    assert [r.reason for r in spark.read.parquet(f"{tmp_path}/q").collect()] == ["too_short_n_words"]
    sinks.write_report(spark.createDataFrame([(2,)], "written int"), f"{tmp_path}/r")
    assert sinks.verify(spark, f"{tmp_path}/p", f"{tmp_path}/r") == 2
    sinks.write_csv(df, f"{tmp_path}/c")
    assert readers.read_csv(spark, f"{tmp_path}/c").count() == 2
    log = spark.sql("select 1 as id, timestamp'2025-01-02 03:04:05' as logged_at")
    sinks.append_log(log, f"{tmp_path}/l")
    sinks.append_log(log, f"{tmp_path}/l")
    assert spark.read.parquet(f"{tmp_path}/l").count() == 2


def documents(spark):
    good = "This interview had a technical round and coding questions. " * 10
    near = good + "One more interview sentence at the end."
    rows = [(1, "d1", "gfg", "u1", "Acme Interview Experience", good), (2, "d2", "GFG", "u2", "t", good.upper()), (3, "d3", "medium", "u3", "t", near), (4, "d4", "medium", "u4", "t", "   "), (5, "d5", "leetcode", "u5", "t", "short but clean text here"), (6, "d6", "odd", "u6", "t", "An online interview round about graph questions. " * 12), (7, "d7", "gfg", "u7", "t", None)]
    return spark.createDataFrame(rows, "ingest_seq long, document_id string, source_platform string, source_url string, title string, raw_content string")


def test_pipeline_reasons(spark):
    out = pipeline.Pipeline().plan(documents(spark)).cache()
    why = {r.ingest_seq: (r.filter_step, r.filter_reason) for r in out.collect()}
    assert why[1] == (None, None) and why[2] == ("deduplicator", "exact_duplicate") and why[4][1] == "empty_raw_content" and why[5][1].startswith("too_short") and why[7][1] == "empty_raw_content"
    assert why[6] == ("schema_validator", "schema_validation_failed: platform odd")
    first = out.where("ingest_seq = 1").first()
    assert first.company == "Acme" and first.source_platform == "gfg" and 0 < first.quality_score <= 1
    assert sum(r.n for r in pipeline.report(out).collect()) == 7


def test_pipeline_finds_near_duplicates_at_the_threshold(spark):
    rng = random.Random(8)
    rows = []
    for g in range(40):
        words = [f"w{rng.randrange(9000)}" for _ in range(100)]
        # three changed words change nine of 98 runs: similarity 89 / 107
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join("new" if i in (20, 50, 80) else w for i, w in enumerate(words)))]
    near = lambda a, b: len(a & b) / len(a | b)
    runs = [{tuple(t.split()[k : k + 3]) for k in range(98)} for _, t in rows]
    assert all(0.8 <= near(runs[2 * g], runs[2 * g + 1]) < 0.84 for g in range(40))
    df = spark.createDataFrame([(i, t, None, None) for i, t in rows], "ingest_seq long, content string, filter_step string, filter_reason string")
    out = pipeline.deduplicator(df)
    assert {r.ingest_seq for r in out.where("filter_reason = 'near_duplicate'").collect()} == {2 * g + 1 for g in range(40)}


def test_entities_by_every_tier(spark):
    late = "we talked about graphs and trees " * 30
    rows = [(1, "My day", "then I met Zeta Labs staff. " + late + "and so I joined acme corp as sde."), (2, "Acme Corp and me", "nothing"), (3, "Bolt Interview Experience", "applied for sde 2 at acme corp"), (4, "My day", "then I met Zeta Labs staff."), (5, "My day", "nothing")]
    df = spark.createDataFrame(rows, "id int, title string, content string")
    companies = spark.createDataFrame([("Acme Corp",), ("Acme",), (None,)], "name string")
    roles = spark.createDataFrame([("SDE",)], "title string")
    out = pipeline.Pipeline(steps=["entity_extractor"], options={"entity_extractor": {"companies": companies, "job_roles": roles}}).plan(df)
    got = {r.id: (r.company, r.role) for r in out.collect()}
    assert got == {1: ("Acme Corp", "SDE"), 2: ("Acme Corp", None), 3: ("Bolt", "SDE 2"), 4: ("Zeta Labs", None), 5: (None, None)}
    plain = {r.id: (r.company, r.role) for r in pipeline.entity_extractor(df).collect()}
    assert plain[1] == plain[4] == ("Zeta Labs", None) and plain[3] == ("Bolt", None)


def test_pipeline_resumes(spark, tmp_path):
    c = sinks.Checkpoints(spark, f"{tmp_path}/ck")
    assert c.load_latest() is None
    p = pipeline.Pipeline(checkpoint_after={"quality_filter"}, materialise_after=set())
    full = p.run(documents(spark), c)
    assert c.load_latest()[1] == "quality_filter"
    again = p.run(documents(spark).limit(0), c, resume=True)
    key = lambda d: sorted((r.ingest_seq, r.filter_reason or "") for r in d.collect())
    assert key(full) == key(again)
    c.clear()
    assert c.load_latest() is None


def test_registry(spark):
    pipeline.register_step("mine", lambda df: df.withColumn("mine", F.lit(1)))
    assert "mine" in pipeline.Pipeline(steps=["mine"]).plan(documents(spark)).columns
    with pytest.raises(KeyError):
        pipeline.Pipeline(steps=["absent"]).plan(documents(spark))


def test_streams(spark, tmp_path):
    df = spark.sql("select id, id % 3 as user_id, timestamp'2025-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id as int), 0) as ts, 'e' as event_type, 1.0d as value from range(120)")
    for i, d in enumerate(df.randomSplit([0.5, 0.5], 1)):
        d.coalesce(1).write.mode("append").parquet(f"{tmp_path}/ev")
    path = f"{tmp_path}/ev"
    got = streams.run_now(streams.tumbling(streams.parquet_stream(spark, path, 1)), "t_tumbling", "complete")
    assert sorted(r.n for r in got.collect()) == [60, 60]
    doubled = streams.parquet_stream(spark, path)
    got = streams.run_now(streams.without_repeats(doubled.union(streams.parquet_stream(spark, path)), ["id"]), "t_dedup", "append")
    assert got.count() == 120
    got = streams.run_now(streams.running_totals(streams.parquet_stream(spark, path)), "t_state", "update")
    assert sorted(tuple(r) for r in got.groupBy("user_id").agg(F.max("n")).collect()) == [(0, 40), (1, 40), (2, 40)]
    q = streams.ingest(streams.parquet_stream(spark, path), lambda b: b.where("value > 0"), f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 120
    s = streams.run_now(streams.sessions(streams.parquet_stream(spark, path)), "t_sessions", "append")
    assert s.count() == 0  # still open at the end of the data
    assert streams.sessions(spark.read.parquet(path)).count() == 3


def test_pages_end_at_the_first_empty_one(spark):
    page = lambda *ids: json.dumps({"edges": [{"node": {"id": i}} for i in ids]})
    pages = spark.createDataFrame([(3, page(5)), (1, page(1, 2)), (2, page(3, 4)), (4, page()), (5, page(9))], "n int, p string")
    assert [r.node for r in readers.page_nodes(pages, "p", order="n").orderBy("page", "place").collect()] == [f'{{"id":{i}}}' for i in range(1, 6)]
    assert sorted(r.node for r in readers.page_nodes(pages, "p", 3, "n").collect()) == [f'{{"id":{i}}}' for i in (1, 2, 3)]


def test_answers_and_metadata(spark):
    body = {"topicId": "7", "slug": "s", "title": "Acme onsite", "content": "<p>" + "word " * 20 + "</p>", "createdAt": "2025", "reactions": [{"reactionType": "UP", "count": 3}], "tags": [{"name": "Acme", "slug": "acme", "tagType": "COMPANY"}, {"name": "", "slug": "x", "tagType": "T"}], "comments": [{"id": "1", "content": "<b>hi</b>", "hidden": False}, {"id": "2", "content": "no", "hidden": True}]}
    df = spark.createDataFrame([(1, json.dumps(body)), (2, json.dumps(body | {"content": "short"})), (3, "broken"), (4, None), (5, json.dumps({"content": "long enough " * 9}))], "id int, j string")
    got = {r.id: r for r in parsers.answers(df, "j", "https://a/", ["Acme"]).collect()}
    assert set(got) == {1, 5} and got[1].source_url == "https://a/7/s/" and got[1].tags == ["Acme"] and got[1].reactions == {"UP": 3} and got[1].company == "Acme"
    assert [c.strip() for c in got[1].comments] == ["hi"] and got[5].title == "Untitled" and got[5].comments == []
    page = '<meta content="d" property="og:description"><link href="https://c" rel="canonical"><meta name="twitter:data1" content="5 min read">'
    state = json.dumps({"Tag:a": {"displayTitle": "Coding", "id": "c"}, "Tag:b": {"id": "jobs"}, "Post:x": {"id": "no"}})
    m = spark.createDataFrame([(page, state), (None, None)], "h string, s string").select(parsers.page_metadata(F.col("h"), F.col("s")).alias("m")).collect()
    assert (m[0].m.description, m[0].m.canonical, m[0].m.reading_minutes, m[0].m.image) == ("d", "https://c", 5, None) and sorted(m[0].m.tags) == ["Coding", "jobs"] and m[1].m.tags == []
    chips = '<div class="HeadingAndChipComponent_mainContainer__dataChips_x"><a>On Campus</a><a>Acme</a><a>Acme</a></div><p>text</p>'
    assert parsers.parse_articles(spark.createDataFrame([("u", chips)], "url string, html string"), "url", "html").first().tags == ["On Campus", "Acme"]


def test_step_statistics(spark):
    rows = [(i, "quality_filter", f"too_short_{i}_words") for i in range(3)] + [(9, "content_normalizer", "empty_raw_content"), (10, None, None), (11, None, None)]
    s = {r.step: r for r in pipeline.statistics(spark.createDataFrame(rows, "id int, filter_step string, filter_reason string")).collect()}
    assert (s["content_normalizer"].n_input, s["content_normalizer"].n_output) == (6, 5) and s["quality_filter"].pass_rate == 0.4 and s["quality_filter"].reasons == '{"too_short_n_words":3}'
    assert (s["schema_validator"].n_input, s["schema_validator"].n_filtered) == (2, 0)


def test_language_gate(spark):
    words = " interview round asked coding question offer "
    texts = {1: "The interviewer asked me about the project and" + words * 20, 2: "Собеседование прошло хорошо и потом мне задали вопрос" + " слово" * 300 + words * 3, 3: "索引は準備していましたが難しかったです。" * 20 + words * 30, 4: "Der Kandidat war nicht sicher und die Frage ist eine schwere" + " der Weg und das Ziel" * 30 + words * 2}
    df = spark.createDataFrame([(i, t, len(t.split()), None, None) for i, t in texts.items()], "ingest_seq int, content string, word_count int, filter_step string, filter_reason string")
    got = {r.ingest_seq: r.filter_reason for r in pipeline.quality_filter(df).collect()}
    assert got == {1: None, 2: "non_english", 3: "non_english", 4: "non_english"}
