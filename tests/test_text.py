"""Text functions on small inputs."""

import pytest
from pyspark.sql import functions as F

from skein.functions import patterns as P
from skein.functions import text as T
from skein.functions.stem import stem
from skein.operators import entities


def one(spark, f, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(f(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first().x


@pytest.mark.parametrize("text, n", [(None, 0), ("", 0), ("  a  b\n", 2), ("x" * 100_000, 1), ("a b " * 50_000, 100_000)])
def test_word_count(spark, text, n):
    assert one(spark, T.word_count, text) == n


def test_platform(spark):
    assert [one(spark, T.platform, x) for x in (" GeeksForGeeks", "Medium", "Other ", None)] == ["gfg", "medium", "other", ""]


@pytest.mark.parametrize("raw, want", [
    ("<p>Hello&nbsp;<b>you</b></p><script>x()</script>", "Hello you"),
    ("# Title\n- item\n**bold** and [text](http://a.b)", "Title\nitem\nbold and text"),
    ("CafÃ© open", "Café open"),
    ("’quoted’ \U0001F600", "'quoted'"),
    ("a\n\n\n\nb   \n c", "a\n\nb\n c"),
    ("", ""),
])
def test_normalise(spark, raw, want):
    assert one(spark, lambda c: T.normalise(c, F.lit("gfg")), raw) == want


def test_platform_boilerplate(spark):
    text = "Start Last Updated : 12 Sep, 2025 middle\nSimilar Reads\nall of this goes"
    assert one(spark, lambda c: T.strip_boilerplate(c, F.lit("gfg")), text) == "Start  middle"
    assert "Similar Reads" in one(spark, lambda c: T.strip_boilerplate(c, F.lit("medium")), text)


def test_redaction_order_and_counts(spark):
    text = "mail a.b@c.org or 98765 43210, u/some_user, linkedin.com/in/me, PIN: 560001, ABCDE1234F, @Override @handle"
    r = one(spark, lambda c: T.redact_and_count(c), text)
    assert r.text == "mail [EMAIL] or [PHONE], [USERNAME], [PERSONAL_URL], [ADDRESS], [ID_NUMBER], @Override [USERNAME]"
    assert r.counts == {"email": 1, "phone": 1, "personal_url": 1, "username": 2, "address": 1, "id_number": 1}
    assert one(spark, T.redact, text) == r.text
    assert one(spark, T.redaction_counts, "") == {}


@pytest.mark.parametrize("text, reason", [("a " * 10, "too_short_10_words"), ("a " * 15_001, "too_long_15001_words"), ("404 not found " * 30, "error_or_junk_page"), ("word " * 60, "low_interview_signal"), ("interview round " * 60, None)])
def test_rejection(spark, text, reason):
    assert one(spark, lambda c: T.rejection(c, T.word_count(c)), text) == reason


@pytest.mark.parametrize("n, ratio, score", [(100, 0.05, 0.5), (200, 0.1, 1.0), (2000, 0.0, 0.5), (12_000, 1.0, 0.75)])
def test_quality_score(spark, n, ratio, score):
    assert spark.range(1).select(T.quality_score(F.lit(n), F.lit(ratio)).alias("x")).first().x == score


def test_extraction(spark):
    assert one(spark, lambda c: T.first_match(c, P.LEVELS), "an SDE 2 and senior role") == "mid"
    assert one(spark, lambda c: T.first_match(c, P.LEVELS), None) == "unknown"
    assert one(spark, lambda c: T.all_matches(c, P.INTERVIEW_TYPES, "unknown"), "a phone screen, then onsite") == ["phone_screen", "onsite"]
    assert one(spark, lambda c: T.all_matches(c, P.INTERVIEW_TYPES, "unknown"), "nothing") == ["unknown"]
    assert one(spark, T.outcome, "I was rejected before. " * 10 + "Finally I got the offer") == "offer"
    assert one(spark, T.num_rounds, "Round 1 then round 2, technical interview") == 3
    assert one(spark, T.num_rounds, "5 rounds of interview") == 5
    assert one(spark, T.num_rounds, "nothing") is None
    assert one(spark, T.company_in_title, "Acme Interview Experience for SDE") == "Acme"


def names(spark, *pairs):
    return spark.createDataFrame(list(pairs), "alias string, canonical string")


def test_longest_alias_wins(spark):
    docs = spark.createDataFrame([(1, ["At Acme Labs now", "acme"]), (2, ["acmes", None]), (3, [None, "so Acme, then"]), (4, ["C++ at .NET house", ""])], "id int, texts array<string>")
    found = entities.first_alias(docs, names(spark, ("acme labs", "Labs"), ("Acme", "Acme"), (".net", "Dot"), (None, "x"), ("++", "y")), "company")
    assert {r.id: r.company for r in found.collect()} == {1: "Labs", 3: "Acme"}
    many = names(spark, ("Acme", "Acme")).unionByName(spark.range(10_500).select(F.concat(F.lit("Firm"), "id").alias("alias"), F.concat(F.lit("Firm"), "id").alias("canonical")))
    assert {r.id: r.company for r in entities.first_alias(docs, many, "company").collect()} == {1: "Acme", 3: "Acme"}  # a list of any size


@pytest.mark.parametrize("answer, grade", [('{"relevance": 2}', 2), ("```json\n{\"relevance\": 1}\n```", 1), ("grade 0 it is", 0), ("none", -1), ("", -1)])
def test_parse_grade(spark, answer, grade):
    assert one(spark, T.parse_grade, answer) == grade


def test_small_helpers(spark):
    assert one(spark, lambda c: T.lenient_bool(c), " Yes ") is True and one(spark, T.lenient_bool, None) is False
    assert one(spark, lambda c: T.lenient_int(c, 7), "x") == 7 and one(spark, lambda c: T.lenient_int(c, 7), " 3 ") == 3
    assert one(spark, lambda c: T.safe_enum(c, ["easy"]), " EASY ") == "easy" and one(spark, lambda c: T.safe_enum(c, ["easy"]), "odd") is None
    assert len(one(spark, T.clipped, "x" * 2000)) == 1503
    assert [one(spark, T.error_category, x) for x in ("HTTP 404", "read timed out", "HTTP 503", "odd", None)] == ["404", "timeout", "server_error", "other", "other"]
    assert one(spark, lambda c: T.language(c), "der Hund und die Katze sind nicht hier und das ist gut so wie es ist") == "de"
    assert one(spark, T.published, "15 Sep, 2025").isoformat() == "2025-09-15T00:00:00"
    assert one(spark, T.published, "soon") is None


def test_roles_and_companies(spark):
    rows = [(1, "SDE-2 at Acme", "nothing"), (2, "My day", "i applied for the role of data engineer iii there"), (3, "x", "long ago " * 100 + "an sde told me"), (4, None, None), (5, "Blue acme Interview Experience", "sde"), (6, "t", "I went to Blue Acme Labs, then to ACME")]
    docs = spark.createDataFrame(rows, "id int, title string, content string")
    listed = names(spark, ("data engineer", "Data Engineer"), ("sde", "Software Engineer II"))
    assert {r.id: r.role for r in entities.roles(docs, listed).collect()} == {1: "Software Engineer II 2", 2: "Data Engineer 3", 3: "Software Engineer 2", 5: "Software Engineer 2"}
    got = {r.id: r.company for r in entities.companies(docs, names(spark, ("acme", "Acme Inc"))).collect()}
    assert got == {1: "Acme Inc", 2: None, 3: None, 4: None, 5: "Blue Acme", 6: "Acme Inc"}
    assert {r.id: r.company for r in entities.companies(docs, names(spark)).collect()}[6] == "Blue Acme Labs"
    assert one(spark, T.company_by_capitals, "nothing here") is None and one(spark, T.company_by_capitals, "we used Python there") is None


@pytest.mark.parametrize("text, want", [("Собеседование прошло хорошо, и потом мне прислали задание на дом от команды", "ru"), ("索引は準備していましたが、整列アルゴリズムは難しかったです。面接官は親切で、質問は三つありました。結果は来週までにメールで届くそうです。", "ja"), ("मुझे साक्षात्कार में तीन प्रश्न पूछे गए और फिर परिणाम की प्रतीक्षा करनी पड़ी", "hi"), ("Der Hund und die Katze sind nicht hier und das ist gut so wie es ist", "de"), ("Les questions étaient dans la deuxième partie et le jury est sympathique pour nous", "fr"), ("The interviewer asked me for the second time and it was in the afternoon", "en"), ("qwzx vbnm plokij uhygt fredc swaq qwzx vbnm plokij uhygt", "und"), ("short", "en"), ("1234567890 " * 10, "en")])
def test_language(spark, text, want):
    assert one(spark, T.language, text) == want


@pytest.mark.parametrize("word, want", [("consistency", "consist"), ("happiness", "happi"), ("generalization", "general"), ("hopping", "hop"), ("hoping", "hope"), ("databases", "databas"), ("skies", "sky"), ("cries", "cri"), ("ties", "tie"), ("gas", "gas"), ("communication", "communic"), ("agreed", "agre"), ("analytically", "analyt"), ("saying", "say"), ("controlling", "control"), ("roll", "roll"), ("a", "a"), ("", "")])
def test_stems(word, want):
    assert stem(word) == want


def test_names_of_files(spark):
    assert one(spark, T.embedding_column, "org/Some-Model-L6-v2") == "embeddings_some_model_l6_v2"
    assert one(spark, lambda m: T.run_name(m, F.lit(384), F.lit("bm25"), F.lit(0.5), F.lit(0.5), F.lit(60)), "m") == "m_dim384_bm25"
    assert one(spark, lambda m: T.run_name(m, F.lit(384), F.lit("hybrid"), F.lit(0.7), F.lit(0.3), F.lit(60)), "m") == "m_dim384_hybrid_v0.7_b0.3_rrf60"
    assert one(spark, lambda t: T.report_name(t.cast("timestamp")), "2026-01-02 03:04:05") == "db_load_20260102T030405.json"
