"""Relational operators, deduplication, chunking, retrieval, evaluation and drift on small inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.operators import chunk, dedup, drift, evaluate, loading, retrieval
from skein.operators import relational as R


def rows(df, *order):
    return sorted(tuple(r) for r in df.select(*order or df.columns).collect())


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, title string, body string")
    new = spark.createDataFrame([(2, "B", "Y"), (3, "C", None)], "id int, title string, body string")
    assert rows(R.upsert(old, new, ["id"], ["body"])) == [(1, "a", "x"), (2, "b", "Y"), (3, "C", None)]
    assert rows(R.upsert(old.limit(0), new, ["id"], ["body"])) == [(2, "B", "Y"), (3, "C", None)]
    assert rows(R.insert_ignore(old, new, ["id"])) == [(1, "a", "x"), (2, "b", "y"), (3, "C", None)]
    assert rows(R.update_columns(old, new, "id", ["body"])) == [(1, "a", "x"), (2, "b", "Y")]


def test_get_or_create(spark):
    dim = spark.createDataFrame([(5, "Acme")], "company_id int, name string")
    values = spark.createDataFrame([(" acme ",), ("Zed",), ("zed",), ("Bolt",), (None,), ("  ",)], "company string")
    assert rows(R.get_or_create(dim, "company_id", "name", values, "company")) == [(5, "Acme"), (6, "Bolt"), (7, "Zed")]
    assert rows(R.get_or_create(dim.limit(0), "company_id", "name", values, "company")) == [(1, " acme ".strip()), (2, "Bolt"), (3, "Zed")]


def test_numbers_are_dense(spark):
    got = rows(R.numbered(spark.range(1000).selectExpr("cast(id * 7 % 1000 as string) as k"), "k", "n"), "n")
    assert got == [(i,) for i in range(1, 1001)]


def test_asof(spark):
    left = spark.createDataFrame([("a", 5, 1), ("a", 1, 2), ("b", 9, 3)], "k string, t int, v int")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 5, "y"), ("a", 9, "z")], "k string, t int, w string")
    assert rows(R.asof_join(left, right, ["k"], "t", ["w"]), "v", "w") == [(1, "y"), (2, None), (3, None)]


def test_reconcile(spark):
    assert R.reconcile(spark.range(3), 3) == 3
    for n, reported in ((0, 0), (3, 4)):
        with pytest.raises(ValueError):
            R.reconcile(spark.range(n), reported)


def brute_greedy(texts, t=0.8):
    sets, kept, out = {}, [], {}
    seen = {}
    for i, x in texts:
        norm = " ".join(x.lower().split())
        w = norm.split()
        s = {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)}
        match = None
        if norm in seen:
            first = seen[norm]
            match = first if out[first] is None else out[first]
        elif len(s) >= 10:
            match = next((k for k in kept if len(s & sets[k]) / len(s | sets[k]) >= t), None)
        seen.setdefault(norm, i)
        out[i] = match
        if match is None and len(s) >= 10:
            kept.append(i)
            sets[i] = s
    return out


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(999)}"
    return " ".join(w)


def test_greedy_against_brute_force(spark):
    rng = random.Random(3)
    texts = []
    for g in range(12):
        base = [f"w{rng.randrange(4000)}" for _ in range(60)]
        texts += [edited(rng, base, k) for k in (0, 0, 1, 2, 3, 4)]
    rng.shuffle(texts)
    texts += ["short text", "short  TEXT", ""]
    data = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, "extra") for i, t in data], "id long, body string, copy string")
    got = dict(rows(dedup.near_duplicates(df, "id", "body", bands=42, rows=6)))
    assert got == brute_greedy(data)


def test_copies_of_a_set_follow_its_first_row(spark):
    block, other = [f"w{i}" for i in range(30)], [f"v{i}" for i in range(30)]
    texts = [" ".join(block * 2), " ".join(block * 3), "x " + " ".join(other * 2), " ".join(other * 2), " ".join(other * 3), " ".join(other * 3).upper()]
    data = list(enumerate(texts))
    got = dict(rows(dedup.near_duplicates(spark.createDataFrame(data, "id long, body string"), "id", "body")))
    assert got == brute_greedy(data) == {0: None, 1: 0, 2: None, 3: 2, 4: 2, 5: 2}


def test_dedup_of_nothing(spark):
    df = spark.createDataFrame([(1, None)], "id long, body string")
    assert rows(dedup.near_duplicates(df, "id", "body")) == []


def test_chunks_of_a_text(spark):
    plain = "One two three. " * 40
    long_ = "\n".join(["Some words before."] + [f"Round {i}: Coding\n" + "They asked about a tree. " * 30 for i in (1, 2, 3)])
    df = spark.createDataFrame([("a", plain, "Acme", "SDE"), ("b", long_, None, ""), ("c", None, "x", "y"), ("d", "  ", "x", "y")], "document_id string, content string, company string, role string")
    got = chunk.chunk_documents(df).toPandas().sort_values(["document_id", "chunk_index"])
    a, b = got[got.document_id == "a"], got[got.document_id == "b"]
    assert list(a.strategy) == ["single_chunk"] and a.chunk_text.iloc[0].startswith("Company: Acme | Role: SDE | One two")
    assert list(b.round_label) == ["Preamble", "Round 1: Coding", "Round 2: Coding", "Round 3: Coding"]
    assert list(b.chunk_index) == [0, 1, 2, 3] and set(b.total_chunks) == {4} and b.chunk_text.iloc[1].startswith("Round: Round 1: Coding | Part: 2 of 4 | ")
    assert all(long_[r.char_start_offset : r.char_end_offset] == r.raw_text for r in b.itertuples())
    assert set(got.document_id) == {"a", "b"}
    again = chunk.chunk_documents(df).toPandas()
    assert set(again.chunk_id) == set(got.chunk_id)


def test_windows_overlap_and_lose_nothing():
    text = " ".join(f"Sentence number {i} has seven words here." for i in range(400))
    w = chunk.windows(text)
    assert all(len(x.split()) <= 500 for x in w) and len(w) > 5
    for x, y in zip(w, w[1:]):
        k = next(k for k in range(60, -1, -1) if x.split()[len(x.split()) - k :] == y.split()[:k])
        assert 0 < k <= 50
    assert {s for x in w for s in x.split(". ")} and all(f"number {i} " in " ".join(w) for i in range(400))
    assert chunk.windows("") == []
    assert len(chunk.windows("x " * 600 + ". Then more.")) == 2  # a sentence beyond the size stays whole


def vectors(spark, x):
    return spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "id long, vector array<float>")


def test_vector_top_k(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, 16))
    x[7] = x[3]
    e = vectors(spark, x).unionByName(spark.createDataFrame([(900, None), (901, [0.0] * 16), (902, [1.0])], "id long, vector array<float>"))
    q = e.where("id < 5").withColumnRenamed("id", "query_id")
    got = rows(retrieval.vector_top_k(q, e, 4), "query_id", "rank", "id")
    u = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float64)
    for qid in range(5):
        s = np.round(np.float32(x).astype(np.float64)[qid] @ np.float32(x).astype(np.float64).T / np.linalg.norm(np.float32(x).astype(np.float64)[qid]) / np.linalg.norm(np.float32(x).astype(np.float64), axis=1), 12)
        want = sorted(range(200), key=lambda i: (-s[i], i))[:4]
        assert [g[2] for g in got if g[0] == qid] == want
    assert u.shape == (200, 16)


def test_bm25_and_fusion(spark):
    c = spark.createDataFrame([("d1", "red fox"), ("d2", "red red dog"), ("d3", "blue sky now"), ("d4", None)], "id string, text string")
    q = spark.createDataFrame([("q1", "red"), ("q2", "purple"), ("q3", "blue sky")], "query_id string, text string")
    b = retrieval.bm25(q, c, 5)
    assert {r[0] for r in rows(b)} <= {"q1", "q3"} and rows(b.where("query_id = 'q3'"), "id") == [("d3",)]
    v = spark.createDataFrame([("q1", "a", 0.9, 1), ("q1", "b", 0.5, 2)], "query_id string, id string, score double, rank int")
    w = spark.createDataFrame([("q1", "b", 7.0, 1), ("q1", "c", 7.0, 2)], "query_id string, id string, score double, rank int")
    assert rows(retrieval.linear_fusion(v, w), "rank", "id", "score") == [(1, "a", 0.5), (2, "b", 0.5), (3, "c", 0.5)]
    assert rows(retrieval.rank_fusion(v, w), "rank", "id") == [(1, "b"), (2, "a"), (3, "c")]
    p = {r.id: r for r in retrieval.pool({"vector": v, "bm25": w}).collect()}
    assert p["b"].sources == "vector,bm25" and p["b"].best_score == 7.0 and p["a"].bm25_rank is None
    assert rows(retrieval.linear_fusion(v.limit(0), w.limit(0))) == []


def test_stemmed_match(spark):
    c = spark.createDataFrame([("d1", "Designing systems is fun"), ("d2", "a design of many different running systems"), ("d3", "design only")], "id string, text string")
    q = spark.createDataFrame([(1, "the system designs"), (2, "of the")], "query_id int, text string")
    assert rows(retrieval.stemmed_match(q, c, 5), "query_id", "id", "rank") == [(1, "d1", 1), (1, "d2", 2)]
    assert [retrieval.stem(w) for w in ("running", "systems", "relational", "flies", "is")] == ["run", "system", "relat", "fli", "is"]


def test_hashed_vectors_and_prompt(spark):
    df = spark.createDataFrame([("q", 1, "s", "alpha beta", "why?"), ("q", 2, None, "gamma", "why?")], "query_id string, rank int, source string, text string, question string")
    v = df.select(retrieval.hashed_vectors(F.col("text")).alias("v")).first().v
    assert abs(sum(x * x for x in v) - 1) < 1e-6
    assert retrieval.prompt(df, "question").first().prompt == "[1] s\nalpha beta\n\n[2] unknown\ngamma\n\nQuestion: why?"


@pytest.mark.parametrize("ranked, mrr, recall, ndcg", [(["c1", "c2", "c3"], 1.0, 1.0, 1.0), (["c3", "c1", "c2"], 0.5, 1.0, 0.659002), (["c3"], 0.0, 0.0, 0.0), ([], 0.0, 0.0, 0.0)])
def test_metrics(spark, ranked, mrr, recall, ndcg):
    q = spark.createDataFrame([("q", "cat")], "query_id string, query_category string")
    r = spark.createDataFrame([("q", c, i) for i, c in enumerate(ranked, 1)], "query_id string, id string, rank int")
    g = spark.createDataFrame([("q", "c1", 2), ("q", "c2", 1), ("q", "c3", 0)], "query_id string, id string, grade int")
    m = evaluate.metrics(evaluate.per_query(q, r, g)).where("k = 5 and query_category = 'overall'").first()
    assert (m.mrr, m.recall) == (mrr, recall) and abs(m.ndcg - ndcg) < 1e-4


def test_judgments_keep_the_last(spark):
    e = spark.createDataFrame([(1, "q", "c", 0, "2025-01-01"), (2, "q", "c", 2, "2025-01-02"), (3, "q", "d", -1, "2025-01-02")], "judgment_id long, query_id string, relevant_chunk_id string, relevance int, created_at string")
    assert rows(evaluate.judged(e)) == [("q", "c", 2)]


def test_storage_and_decision(spark):
    assert evaluate.storage_mb(2**20, 0) == 0 and evaluate.storage_mb(2**20, 384) == 1600
    s = spark.createDataFrame([("a", 0.8, 0.9, 1), ("b", 0.77, 0.8, 2), ("c", 0.1, 0.2, 3)], "config string, ndcg double, selection_score double, place int")
    assert tuple(evaluate.decision(s, ["b", "c"]).first()) == ("a", "b", 0.0375, True)


def test_drift(spark):
    rng = np.random.default_rng(2)
    ref = vectors(spark, rng.standard_normal((300, 4)))
    same, moved = vectors(spark, rng.standard_normal((200, 4))), vectors(spark, rng.standard_normal((200, 4)) + 4)
    assert drift.composite(ref, same, "vector").first().drift is False
    far = drift.composite(ref, moved, "vector").first()
    assert far.drift is True and far.drifted_share == 1.0
    assert drift.composite(ref, moved.limit(5), "vector").first().drift is False
    a = np.array([r.vector for r in ref.orderBy("id").collect()])
    b = np.array([r.vector for r in moved.orderBy("id").collect()])
    for r in drift.two_sample(ref, moved, "vector").collect():
        x, y = np.sort(a[:, r.dim]), np.sort(b[:, r.dim])
        z = np.concatenate([x, y])
        assert abs(r.ks - np.abs(np.searchsorted(x, z, "right") / len(x) - np.searchsorted(y, z, "right") / len(y)).max()) < 1e-12


def test_best_settles_ties_by_id():
    b = retrieval.Best(2, 3)
    b.add(0, np.array([[0.5, 0.5, 0.5, 0.5, 0.1], [0.1, 0.2, 0.3, 0.4, 0.5]]), ["e", "d", "c", "b", "x"])
    b.add(0, np.array([[0.5, 0.9], [0.5, 0.0]]), ["a", "z"])
    assert b.ids == [["z", "a", "b"], ["a", "x", "b"]] and b.scores[0].tolist() == [0.9, 0.5, 0.5]


def test_lexical_search_equals_brute_force(spark):
    rng = random.Random(4)
    docs = [(f"d{i:03d}", " ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(0, 25)))) for i in range(300)] + [("e1", None), ("e2", " "), ("e3", "W1 w1\tw2")]
    queries = [(q, " ".join(f"w{rng.randrange(34)}" for _ in range(4))) for q in range(12)] + [(50, None), (51, ""), (52, "zzz"), (53, "w1 w1")]
    q, c = spark.createDataFrame(queries, "query_id int, text string"), spark.createDataFrame(docs, "id string, text string").repartition(5)
    bag = {i: (t or "").lower().split() for i, t in docs}
    got: dict = {}
    for r in retrieval.term_cosine(q, c, 5).collect():
        got.setdefault(r.query_id, []).append((r.id, r.score))
    for k, t in queries:
        a = (t or "").lower().split()
        norm = lambda w: sum(w.count(x) ** 2 for x in set(w)) ** 0.5
        s = {i: round(sum(a.count(x) * w.count(x) for x in set(a)) / (norm(a) * norm(w)), 9) for i, w in bag.items() if set(a) & set(w)}
        want = sorted(s.items(), key=lambda x: (-x[1], x[0]))[:5]
        assert sorted(got.get(k, []), key=lambda x: (-x[1], x[0])) == want
    assert retrieval.bm25(q, c.limit(0), 5).count() == 0 and retrieval.bm25(q.limit(0), c, 5).count() == 0


def test_retrieve_by_mode(spark):
    q = spark.createDataFrame([(1, "red fox")], "query_id int, text string")
    c = spark.createDataFrame([("a", "a red fox ran", "u1"), ("b", "red", "u2"), ("c", "blue", "u3")], "id string, text string, source_url string")
    for mode in retrieval.MODES:
        assert [r.id for r in retrieval.retrieve(mode, q, c, 2).orderBy("rank").collect()][0] == "a"
    assert set(retrieval.retrieve("hybrid", q, c, 2).columns) == {"query_id", "id", "score", "rank", "text", "source_url"}
    retrieval.register_mode("first", lambda q, c, k: retrieval.bm25(q, c, 1))
    assert retrieval.retrieve("first", q, c, 2).count() == 1
    del retrieval.MODES["first"]
    with pytest.raises(KeyError):
        retrieval.retrieve("none", q, c, 2)


def test_loading(spark):
    files = [("a", '{"id": "1", "title": "t"}'), ("b", '{"id": "2"'), ("c", None), ("d", '{"id": " "}'), ("e", "[1]"), ("f", '{"id": "3", "title": "x", "n": [1]}')]
    s = loading.read_states(spark.createDataFrame(files, "p string, j string"), "p", "j", ["id", "title"])
    assert {r.path: (r.state, r.message) for r in s.collect()} == {"a": ("ok", None), "b": ("failed_read", "no JSON object"), "c": ("failed_read", "empty file"), "d": ("failed_insert", "missing id, title"), "e": ("failed_read", "no JSON object"), "f": ("ok", None)}
    assert tuple(loading.summary(s).first()) == (6, 2, 4, 3, 1)
    docs = [("1", "Acme", "SDE", " SENIOR ", "odd", None, 3, ["onsite", "virtual"], ["dsa"]), ("2", "Acme", None, None, None, None, None, None, None), ("3", " ", "x", None, None, None, None, None, None), ("4", "B", "C", None, None, None, None, [], None)]
    df = spark.createDataFrame(docs, "document_id string, company string, role string, experience_level string, interview_outcome string, difficulty string, num_rounds int, interview_types array<string>, topics array<string>")
    assert rows(loading.metadata_rows(df)) == [("1", "Acme", "SDE", "senior", None, None, 3, "onsite", ["dsa"]), ("4", "B", "C", None, None, None, None, None, [])]
    log = spark.createDataFrame([(f"u{i:02d}", "bad" if i % 2 else None, f"2025-01-{i + 1:02d}") for i in range(30)], "url string, error string, at string")
    m = loading.manifest(log, "url", "error", "at").first()
    assert (m.collected, m.errors, m.last, m.error_urls) == (15, 15, "2025-01-30", [f"u{i:02d}" for i in range(1, 20, 2)])
    assert loading.manifest(log.where("error is null"), "url", "error", "at").first().error_urls == []


def test_evaluation_reports(spark):
    c = spark.createDataFrame([("a", "x", 10, 0.9), ("a", "y", 10, 0.4), ("b", "x", 10, 0.6), ("b", "y", 10, 0.5), ("b", "overall", 10, 0.1), ("c", "x", 10, 0.5)], "config string, query_category string, k int, ndcg double")
    assert rows(evaluate.bias(c)) == [("a", 0.5, 2), ("b", 0.1, 1)]
    one = evaluate.disparity(c.where("config = 'c'").select("query_category", "k", "ndcg")).first()
    assert one.note == "fewer than two categories"
    df = spark.createDataFrame([("1", "2.0"), ("x", "1"), (None, "1"), (" 7 ", "3")], "a string, b string")
    assert rows(evaluate.coerced(df, ["a", "b"])) == [(1, 2), (7, 3)]
    ranked = spark.createDataFrame([(1, "a", 1, 0.9), (1, "b", 2, 0.5), (1, "c", 3, 0.1)], "query_id int, id string, rank int, score double")
    grades = spark.createDataFrame([(1, "a", 2), (1, "c", 0)], "query_id int, id string, grade int")
    assert evaluate.grade_gap(ranked, grades).first().gap == 0.8 and evaluate.grade_gap(ranked, grades.limit(0)).first().gap is None
    d = evaluate.details(spark.createDataFrame([(1,), (2,)], "query_id int"), ranked, grades).orderBy("query_id").collect()
    assert d[0].grades == [2, -1, 0] and d[0].scores == [0.9, 0.5, 0.1] and d[1].grades is None


def test_drift_trigger(spark):
    t = spark.createDataFrame([(0, True), (1, False), (2, False)], "dim int, drifted boolean")
    assert tuple(drift.trigger(t).first()) == (0.333333, True) and tuple(drift.trigger(t, 0.5).first()) == (0.333333, False)
    assert tuple(drift.trigger(t.limit(0)).first()) == (None, False)
    assert drift.degraded(0.72, 0.69) and not drift.degraded(0.72, 0.70) and not drift.degraded(0, 0)


def test_two_sample_does_not_depend_on_scale(spark):
    rng = np.random.default_rng(2)
    x, y = rng.standard_normal(300), rng.standard_normal(200) + 0.4
    want = max(abs((x <= v).mean() - (y <= v).mean()) for v in np.concatenate([x, y]))
    for scale in (1e-7, 1.0, 1e6):
        a, b = (spark.createDataFrame([([float(v * scale)],) for v in z], "v array<double>") for z in (x, y))
        assert abs(drift.two_sample(a, b, "v").first().ks - want) < 1e-12
    same = spark.createDataFrame([([1.0],)] * 5, "v array<double>")
    assert drift.two_sample(same, same, "v").first().ks == 0.0


def test_near_duplicates_against_kept_state(spark, tmp_path):
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    sets = lambda data: dedup.shingle_sets(spark.createDataFrame(data, "id long, t string"), "id", "t")
    path = f"file://{tmp_path}/state"
    dedup.save_state(sets([(1, text(1)), (2, text(2))]), path)
    dedup.save_state(sets([(3, text(3))]), path)
    got = dedup.against_state(sets([(10, text(2) + " more"), (11, text(3)), (12, text(9))]), path)
    assert rows(got) == [(10, 2), (11, 3)]
    loose = dedup.first_collisions(spark.createDataFrame([(1, text(1)), (2, text(1) + " x"), (3, text(4)), (4, text(1))], "id long, t string"), "id", "t")
    assert dict(rows(loose)).get(2, 1) == 1 and 3 not in dict(rows(loose))
