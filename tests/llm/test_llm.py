"""Training-data operators against brute force, round trips and hard inputs."""

import base64
import os
import random
import re

import duckdb
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from skein.llm import canonical, history, markup, mojibake, neardup, neighbours, packing, pii, splitting, tokens
from skein.llm import queries as Q
from skein.llm._common import with_sequences

LONG = "word " * 40_000


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols or df.columns).collect())


#: Columns of each query, and a column that no row leaves empty.
COLUMNS = {
    "p1_found": "ingest_seq", "p1_clean": "ingest_seq clean_text n_markup", "p1_wrappers": "kind host expression support", "p2_found": "ingest_seq_a ingest_seq_b", "p2_repeats": "ingest_seq batch date match match_batch match_date",
    "p3_found": "field_name item_id", "p3_pieces": "item_id field_name piece n_pieces overlap_chars body_start body_end piece_text", "p4_found": "source_table record_id pii_type pii_value", "p4_redacted": "source_table record_id redacted n_pii",
    "p5_found": "document_id field_name ref_id", "p5_unmatched": "field_name value n_rows", "p5_values": "document_id field_name value ref_id", "p6_found": "ingest_seq_a ingest_seq_b", "p6_groups": "class_id ingest_seq group_id n_links",
    "p7_found": "id_a id_b", "p7_neighbours": "id other cosine rank", "p8_ids": "doc_id ids", "p9_containers": "container_id doc_id piece n_tokens", "p10_found": "doc_id", "p10_restored": "doc_id restored",
}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, sf, duck, name):
    df = Q.QUERIES[name](spark, sf)
    first, *rest = COLUMNS[name].split()
    assert sorted(df.columns) == sorted([first, *rest])
    got = df.collect()
    assert got and all(r[first] is not None for r in got)
    if name.endswith("_found"):
        assert len(set(got)) == len(got)
    if name in Q.ORACLES:
        cur = duck.execute(Q.ORACLES[name])
        cols = [c[0] for c in cur.description]
        assert sorted(tuple(r[c] for c in cols) for r in got) == sorted(cur.fetchall())


def test_found_equals_what_the_operator_says(spark, sf):
    """The found rows are those of the operator's own result."""
    q = {n: Q.QUERIES[n](spark, sf).collect() for n in ("p1_found", "p1_clean", "p2_found", "p2_repeats", "p4_found", "p4_redacted", "p10_found", "p10_restored")}
    assert {r.ingest_seq for r in q["p1_found"]} == {r.ingest_seq for r in q["p1_clean"] if r.n_markup}
    assert {(r.ingest_seq_a, r.ingest_seq_b) for r in q["p2_found"]} == {tuple(sorted((r.ingest_seq, r.match))) for r in q["p2_repeats"] if r.match_date < r.date}
    red = {(r.source_table, r.record_id): r.redacted for r in q["p4_redacted"]}
    assert all(f"[{r.pii_type.upper()}]" in red[r.source_table, r.record_id] for r in q["p4_found"])
    assert {r.doc_id for r in q["p10_found"]} == {r.doc_id for r in q["p10_restored"]}


def test_repeats_equal_a_sequential_pass(spark, sf):
    posts = spark.read.parquet(f"{sf}/raw_documents.parquet").select("ingest_seq", "scrape_batch_id", "raw_content").collect()
    word = regex.compile(r"[\p{L}\p{N}]+")
    kept, want = [], set()
    for r in sorted(posts, key=lambda r: (r.scrape_batch_id[:10], r.ingest_seq)):
        w = word.findall((r.raw_content or "").lower())
        own = set(zip(w, w[1:], w[2:]))
        if len(own) < 10:
            continue
        match = next((k for k in kept if len(own & k[2]) / len(own | k[2]) >= 0.8), None)
        if match is None:
            kept.append((r.ingest_seq, r.scrape_batch_id[:10], own))
        elif match[1] < r.scrape_batch_id[:10]:
            want.add(tuple(sorted((r.ingest_seq, match[0]))))
    assert set(map(tuple, Q.p2_found(spark, sf).collect())) == want and want


# ---- tokens and packing --------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference_encoder():
    import tiktoken

    with open(tokens.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_tokens_match_the_public_encoder(spark, sf, reference_encoder):
    hard = [None, "", " ", "\n\n  x", "aaaaaaaaaaaaa", "<|endoftext|>", "naïve café 日本語 🙂👩‍💻", "a" * 5000, LONG, "\u200b\ufeff", "same", "same"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(hard)], "doc_id long, text string, ids string")
    df = df.unionByName(spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id") + 1000, "text", F.lit("y")).toDF("doc_id", "text", "ids"))
    texts = {r.doc_id: r.text for r in df.collect()}
    got = {r.doc_id: list(r.ids) for r in tokens.encode_texts(df, "doc_id", "text").collect()}
    assert got == {i: reference_encoder(t or "") for i, t in texts.items()}
    assert tokens.encode_texts(df.limit(0), "doc_id", "text").count() == 0


def test_containers(spark, sf):
    df = spark.createDataFrame([(0, None), (1, ""), (2, LONG), (3, "short")], "doc_id long, text string").unionByName(spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text"))
    got = packing.pack_documents(df, "doc_id", "text").toPandas()
    sizes = {r.doc_id: len(r.ids) for r in tokens.encode_texts(df, "doc_id", "text").collect()}
    assert got.groupby("container_id").n_tokens.sum().max() <= packing.CAPACITY
    assert got.groupby("doc_id").n_tokens.sum().to_dict() == sizes
    assert set(got[got.piece > 0].doc_id) == {i for i, n in sizes.items() if n > packing.CAPACITY}
    assert (got.n_tokens.sum() / packing.CAPACITY) / got.container_id.nunique() > 0.9
    again = packing.pack_documents(df, "doc_id", "text").toPandas()
    key = lambda d: sorted(map(tuple, d.values.tolist()))
    assert key(got) == key(again)


def test_hilbert_visits_every_cell_by_single_steps():
    n = 3
    cells = np.array([[x, y] for x in range(1 << n) for y in range(1 << n)])
    order = cells[np.argsort(packing.hilbert(cells, n))]
    assert len(set(packing.hilbert(cells, n).tolist())) == len(cells)
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_pack_never_overfills():
    rng = np.random.default_rng(0)
    sizes = rng.integers(0, 2049, 5000)
    boxes = packing.pack(sizes, 2048, 500)
    assert np.bincount(boxes, weights=sizes).max() <= 2048
    assert len(packing.pack(np.zeros(0, np.int64), 2048)) == 0


def test_containers_hold_neighbours_on_the_curve():
    """What a container holds lies within two windows, and far closer than in a random order."""
    rng = np.random.default_rng(1)
    sizes, keys = rng.integers(1, 600, 40_000), np.sort(rng.integers(0, 1 << 48, 40_000))
    boxes = packing.pack(sizes, 2048)
    place = np.arange(len(sizes))
    assert packing.spans(place, boxes).max() < 2 * packing.WINDOW
    shuffled = rng.permutation(len(sizes))
    random_boxes = packing.pack(sizes[shuffled], 2048)
    assert packing.spans(keys, boxes).mean() * 10 < packing.spans(keys[shuffled], random_boxes).mean()
    assert sizes.sum() / 2048 / len(np.unique(boxes)) > 0.99


# ---- splitting -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["", " ", "x" * 9001, "ab " * 3000, "\n" * 9000, "# A\n\n" + "Sentence one. " * 400 + "\n\n## B\n- item\n" * 300, "日本語。" * 2000, "e\u0301" * 4000, "```\n" + "code line\n" * 1000 + "```", "a\u00a0b " * 400, LONG])
def test_pieces(text):
    s = splitting.Splitter()
    cuts = s.split(text)
    words = lambda t: len(re.findall(splitting.WORD_RUN, t))
    assert "".join(text[a:b] for _, a, b in cuts) == text
    if words(text) <= 500 and len(text) <= 4000:
        assert cuts == [(0, 0, len(text))]
        return
    assert len(cuts) > 1
    for o, a, b in cuts:
        assert words(text[o:b]) <= 500 and b - o <= 4000 and words(text[o:a]) <= 50 and b > a


def test_pieces_begin_at_headings():
    text = "".join(f"## Part {i}\n\n" + "A sentence of seven words is here. " * 40 + "\n\n" for i in range(6))
    assert all(text[a:b].startswith("## Part") for _, a, b in splitting.Splitter().split(text))
    with pytest.raises(ValueError):
        splitting.Splitter(words=10, overlap=10)


def test_pieces_stay_inside_one_parent():
    big = " ".join(f"Sentence {i} has some words in it." for i in range(130))
    text = f"## A\n\n{big}\n\n## B\n\nShort b.\n\n## C\n\nShort c.\n"
    s = splitting.Splitter()
    pieces = [text[a:b] for _, a, b in s.split(text)]
    assert pieces[0].startswith("## A\n\nSentence 0") and len(pieces) == 4
    assert pieces[2].startswith("Sentence") and "##" not in pieces[2]  # the rest of A is not joined with its uncle
    assert pieces[3] == "## B\n\nShort b.\n\n## C\n\nShort c.\n"  # siblings are


def test_split_items(spark):
    df = spark.createDataFrame([("a", "short", 1), ("b", LONG, 2), ("c", None, 3), ("d", "", 4), ("b2", "x" * 4001, 5)], "id string, t string, piece int")
    got = splitting.split_items(df, "id", "t").toPandas()
    assert set(got.item_id) == {"a", "b", "d", "b2"} and set(got[got.n_pieces > 1].item_id) == {"b", "b2"}
    assert splitting.split_items(df.limit(0), "id", "t").count() == 0


# ---- near duplicates and history -----------------------------------------------------------------------------------


def corpus(seed=1, groups=25, size=70):
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(20, size))]
        for k in (0, 0, 1, 2, 3, 5):
            w = list(base)
            for _ in range(k):
                p = rng.randrange(len(w))
                w[p : p + 1] = rng.choice([[f"e{rng.randrange(99)}"], [], [w[p], "ins"]])
            out.append(" ".join(w))
    rng.shuffle(out)
    return out + ["too short", "", None]


def seqs(t):
    w = re.findall(r"[^\W_]+", (t or "").lower())
    return set(zip(w, w[1:], w[2:]))


def similar(a, b):
    return len(a & b) / len(a | b) >= 0.8


@pytest.mark.parametrize("most_bits", [28, 0])
def test_near_duplicates_lose_no_pair(spark, monkeypatch, most_bits):
    monkeypatch.setattr(neardup, "MOST_BITS", most_bits)
    texts = corpus() + ["hot copy of one text with enough words to take part in the comparison here"] * 30
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "id long, body string, seqs string")
    s = neardup.Similar(df, "id", F.col("body"))
    sets = {i: seqs(t) for i, t in enumerate(texts) if len(seqs(t)) >= 10}
    want = {(i, j) for i in sets for j in sets if i < j and similar(sets[i], sets[j])}
    assert set(rows(s.all_pairs())) == want
    group = dict(rows(neardup.groups(s), "id", "group_id"))
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in want:
        parent[max(root(i), root(j))] = min(root(i), root(j))
    assert group == {i: root(i) for i in sets}
    empty = neardup.Similar(df.limit(0), "id", F.col("body"))
    assert empty.all_pairs().count() == 0 and neardup.groups(empty).count() == 0


@pytest.mark.parametrize("one_task, most_sent", [(200_000, 1_000_000), (0, 0)])
def test_history_equals_a_sequential_pass(spark, monkeypatch, one_task, most_sent):
    monkeypatch.setattr(history, "ONE_TASK", one_task)
    monkeypatch.setattr(history, "MOST_SENT", most_sent)
    texts = corpus(2)
    rng = random.Random(5)
    data = [(i, f"2025-01-{rng.randrange(1, 8):02d}_weekly" if i % 17 else None, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "seq long, batch string, body string, match string")
    kept, want = [], {}
    for i, b, t, _ in sorted(data, key=lambda r: (r[1][:10] if r[1] else "9999-99-99", r[0])):
        s = seqs(t)
        if len(s) < 10:
            continue
        m = next((k for k, ks in kept if similar(s, ks)), None)
        if m is None:
            kept.append((i, s))
        else:
            want[i] = m
    for share in (0, 1 / 3, 1) if one_task else (1 / 3,):
        got = history.dedup_history(df, "seq", "batch", "body", share=share)
        assert dict(rows(got, "id", "match")) == want
    assert history.dedup_history(df.limit(0), "seq", "batch", "body").count() == 0


def test_lots_keep_the_order():
    counts = [("a", 1), ("b", 2), ("c", 90), ("d", 3), ("e", 4)]
    assert history.lots(counts, 0) == [["a"], ["b"], ["c"], ["d"], ["e"]]
    assert history.lots(counts, 0.05) == [["a", "b", "c"], ["d", "e"]] and history.lots(counts, 1) == [["a", "b", "c", "d", "e"]] and history.lots([], 0.1) == []


def delivery(spark, texts, first=0):
    df = spark.createDataFrame([(first + i, f"{first + i:04d}", t) for i, t in enumerate(texts)], "id long, rank string, text string")
    return with_sequences(df, "text", 3, least=10)


def test_history_survives_sessions(spark, tmp_path):
    texts = ["one text that has more than ten words in it so it can take part", "another text that has nothing in common with it but also many words inside"]
    assert history.History(spark, f"file://{tmp_path}/h").deliver(delivery(spark, texts)).count() == 0
    later = history.History(spark, f"file://{tmp_path}/h")
    assert rows(later.deliver(delivery(spark, texts + texts[:1], 10))) == [(10, 0), (11, 1), (12, 0)]
    with pytest.raises(ValueError):  # a delivery that is not later than the history
        later.deliver(delivery(spark, ["some other text that nobody has seen so far in any of the deliveries"], 11))
    assert later.deliver(delivery(spark, [])).count() == 0


def test_history_moves_runs_and_reads_few_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "RUNS", 3)
    h = history.History(spark, f"file://{tmp_path}/h", buckets=64)
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(15))
    for k in range(4):
        assert h.deliver(delivery(spark, [text(100 * k + i) for i in range(20)], 100 * k)).count() == 0
    assert h.store.hashed and len(h.store.runs) == 1
    one = h.deliver(delivery(spark, [text(5)], 900))
    assert rows(one) == [(900, 5)]
    at = [spark.range(5, 6).select(history.bucket_of(F.col("id"), 64)).first()[0]]
    assert 1 <= h.store.records(at).where("id < 300").count() < 60 / 8  # one bucket of the hashed part
    assert h.store.bands(at).where("id < 300").count() < 60 * history.BANDS / 8
    again = history.History(spark, f"file://{tmp_path}/h", buckets=64)
    assert again.last == "0319" and again.store.records().count() == 80


# ---- neighbours ----------------------------------------------------------------------------------------------------


def test_neighbours_recall_and_hard_rows(spark):
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((40, 24))
    x = (centers[rng.integers(0, 40, 3000)] + 0.4 * rng.standard_normal((3000, 24))).astype(np.float32)
    x[100:120] = x[99]
    data = [(i, v.tolist(), "x") for i, v in enumerate(x)] + [(9000, None, "x"), (9001, [0.0] * 24, "x"), (9002, [1.0, 2.0], "x"), (9003, [float("nan")] * 24, "x"), (9004, [], "x")]
    df = spark.createDataFrame(data, "id long, v array<float>, other string")
    got = rows(neighbours.top_k(df, "id", "v", part_rows=200), "id", "other")
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    s = u @ u.T
    np.fill_diagonal(s, -2)
    want = {(i, int(j)) for i in range(3000) for j in np.argsort(-s[i], kind="stable")[:5] if not 99 <= i < 120}
    mine = {g for g in got if not 99 <= g[0] < 120}
    assert len(want & mine) / len(want) > 0.9 and {g[0] for g in got} == set(range(3000))
    assert [g[1] for g in got if g[0] == 110] == [99, 100, 101, 102, 103] and [g[1] for g in got if g[0] == 99] == [100, 101, 102, 103, 104]
    assert neighbours.top_k(df.limit(0), "id", "v").count() == 0
    assert rows(neighbours.top_k(df.where("id < 3"), "id", "v"), "id", "rank") == [(i, r) for i in range(3) for r in (1, 2)]


def test_neighbours_that_the_sample_lacks(spark, monkeypatch):
    """Of most groups of similar rows a large table's sample holds one row or none: no border may part them for good."""
    monkeypatch.setattr(neighbours, "LEAST_SAMPLE", 1500)
    monkeypatch.setattr(neighbours, "MOST_SAMPLE", 1500)
    rng = np.random.default_rng(8)
    x = (np.repeat(rng.standard_normal((1500, 64)), 8, axis=0) + 0.6 * rng.standard_normal((12000, 64))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<float>")
    got = rows(neighbours.top_k(df, "id", "v", part_rows=150), "id", "other")
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    s = u @ u.T
    np.fill_diagonal(s, -2)
    want = {(i, int(j)) for i, js in enumerate(np.argpartition(-s, 4, axis=1)[:, :5]) for j in js}
    assert len(got) == len(set(got)) == 60000 and len(want & set(got)) / len(want) > 0.95


def test_unusable_copies_have_no_neighbours(spark):
    x = np.random.default_rng(6).standard_normal((300, 24)).astype(np.float32)
    x[:9] = x[0]
    bad = ([0.0] * 24, [1.0, 2.0], [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23)
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + 10 * b + i, v) for b, v in enumerate(bad) for i in range(9)]
    got = rows(neighbours.top_k(spark.createDataFrame(data, "id long, v array<float>"), "id", "v"), "id", "other")
    assert {a for g in got for a in g} == set(range(300)) and len(got) == 1500
    assert [b for a, b in got if a == 8] == [0, 1, 2, 3, 4]


def test_parts_are_balanced():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1000, 8)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    part = neighbours.bisect_graph(neighbours.graph(x, 5), x, 4)
    assert np.bincount(part).max() - np.bincount(part).min() <= 4


# ---- markup --------------------------------------------------------------------------------------------------------

PLAIN = ["for (auto& kv : freq) { if (kv.second > 4 && seen[kv.first] < k) heap.push(kv.first); }", "Map<String, List<Integer>> idx = new HashMap<>();", "cout << x << endl, 2**62 slots, a < b and c > d", "paying $40 to $55 per hour", "C:\\temp\\new_65 and \\d+", "Q&A; and R&D; x <- ch or p->next", "my_old_notes_v3.txt ~ roughly [0, 2) arr[i][j] = 8 and {x, y}", "", None, "a_i * b_j * 3"]
MARKED = ["<p>open", "closed.</div>", "one &nbsp; two", "&lt;b&gt;x", "<!-- c -->", "**unbalanced start", "[more](http://a.b)", "[[See also]]", "== Notes ==", "# Title", "text\n----", "$\\approx 3$", "\\ldots{} end", "{{tpl|x}}", "'''bold'''", "```\ncode\n```", "`code`", "~~gone~~", "$$x^2$$", "\\begin{itemize}\n\\item a\n\\end{itemize}", "| a | b |\n|---|---|"]


#: Texts that show what their marks are for: what is opened is closed, list items repeat, headings differ.
SHOWING = ["<p>one</p><div>two</div>", "**bold** and __more__ and ~~less~~", "== One ==\n\n# Two\n\n# Three", "first\n----\nmore", "second\n====\nmore", "- a\n- b", "<b>x</b> vector<int> v", "set<int> w; Map<string> m"]


@pytest.fixture(scope="module")
def learned(spark):
    """Kinds of markup that the wrappers of one host show."""
    df = spark.createDataFrame([("h", t) for t in SHOWING + MARKED], "host string, t string")
    (row,) = markup.rules(*markup.infer_wrappers(df, "host", "t")).collect()
    return set(row.kinds)


@pytest.mark.parametrize("text", PLAIN)
def test_plain_text_has_no_markup(learned, text):
    got, n = markup.clean(text, learned, set())
    assert n == 0 and got == markup.tidy(text or "")


@pytest.mark.parametrize("text", MARKED)
def test_markup_is_found(learned, text):
    assert markup.clean(text, learned, set())[1] >= 1
    assert markup.clean(text, set(), set())[1] == 0  # nothing counts without the wrappers


def test_cleaning_keeps_structure():
    every = lambda text: {g[0] for g in markup.groups(text, markup.lex(text))}
    clean = lambda text: markup.clean(text, every(text), set())
    text = "<nav>Home</nav><h2>Round &amp; one</h2><ul><li>a <b>b</b></li><li>c</li></ul><pre>x &lt; y</pre><math>\\frac{a}{b}</math>"
    got = clean(text)[0]
    assert "## Round & one" in got and "- a b" in got and "- c" in got and "```\nx < y\n```" in got and "$\\frac{a}{b}$" in got and "Home" not in got
    assert clean("\\section{Top}\n\\textbf{bold} and \\href{http://x}{text}")[0] == "## Top\nbold and text"
    assert clean("<p>" * 500 + LONG)[1] >= 1
    # nothing depends on a distance: a brace, a mark, a formula and a fence that close far away
    assert clean("\\textbf{" + "word " * 2000 + "}.")[0] == "word " * 2000 + "."
    assert clean("**" + "`x` " * 600 + "y**")[0] == "`x` " * 600 + "y"
    assert clean("$$" + "a+" * 3000 + "b$$")[0] == "$" + "a+" * 3000 + "b$"
    assert clean("```\n" + "- x\n" * 600 + "```\n- y")[1] == 2


def wrappers(spark, texts):
    df = spark.createDataFrame([("h", t) for t in texts], "host string, t string")
    return {r.kind: r for r in markup.readable(markup.infer_wrappers(df, "host", "t")[0]).collect()}


def test_wrappers_align(spark):
    got = wrappers(spark, ["<ul><li>a</li><li>b</li></ul>", "<ul><li>c</li></ul> <i>x</i>", "<ul><li>d <b>e</b></li>x</ul>"])
    assert got["<ul>"].expression in ("<ul> ( <li> )+ ( #text )? </ul>", "<ul> ( <li> )+ ( 'x' )? </ul>") and got["<ul>"].support == 3
    assert got["<li>"].expression.startswith("<li> #text") and got["<li>"].expression.endswith("</li>") and "<b>" in got["<li>"].expression
    assert got["<b>"].expression == "<b> 'e' </b>"


def test_wrappers_do_not_depend_on_the_order(spark):
    texts = [f"<div><h2>t{i}</h2>" + "<p>x</p>" * (i % 3) + "<ul><li>a</li></ul>" * (i % 2) + "</div>" for i in range(12)]
    assert wrappers(spark, texts) == wrappers(spark, texts[::-1])


def test_expressions_stay_small():
    """Many different shapes give a long and deep expression, which is generalised and still closes what it opens."""
    rng = random.Random(3)
    names = [f"<n{i}>" for i in range(40)]
    whole = ("<div>", "</div>")
    for _ in range(300):
        whole = markup.align(whole, ("<div>", *rng.choices(names, k=rng.randrange(1, 30)), (markup.SLOT, "t"), "</div>"))
    depth = lambda s: 1 + max((depth(n[1]) for n in s if not isinstance(n, str) and n[0] != markup.SLOT), default=0)
    assert len(whole) <= markup.LONGEST and depth(whole) <= markup.DEEPEST + 4
    assert markup.is_template("<div>", whole) and set(names) <= set(markup.flat(whole))


def test_ambiguous_groups_need_a_wrapper(spark):
    cols = "id long, url string, body string, host string"
    lists = [(1, "http://a.b/1", "- one\n- two", "x"), (2, "http://a.b/2", "- three", "x"), (4, None, None, "x"), (5, "http://a.b/3", " ", "x")]
    df = spark.createDataFrame(lists + [(3, "http://c.d/1", "vector<int> v", "x"), (6, "http://c.d/2", "<em>open", "x")], cols)
    assert rows(markup.clean_texts(df, "id", "url", "body"), "id", "n_markup") == [(1, 1), (2, 1), (3, 0), (4, 0), (5, 0), (6, 0)]
    closed = df.unionByName(spark.createDataFrame([(7, "http://e.f/1", "<em>closed</em>", "x")], cols))  # another host shows it
    assert rows(markup.clean_texts(closed, "id", "url", "body"), "id", "n_markup") == [(1, 1), (2, 1), (3, 0), (4, 0), (5, 0), (6, 1), (7, 1)]
    lone = spark.createDataFrame([(3, "http://c.d/1", "- lone dash", "x")], cols)
    assert rows(markup.clean_texts(lone, "id", "url", "body"), "id", "n_markup", "clean_text") == [(3, 0, "- lone dash")]
    assert markup.clean_texts(df.limit(0), "id", "url", "body").count() == 0


# ---- personal information, canonical values, encodings -------------------------------------------------------------


@pytest.mark.parametrize("most_sent", [200_000, 0])
def test_personal_values(spark, monkeypatch, most_sent):
    monkeypatch.setattr(pii, "MOST_SENT", most_sent)
    lines = ["Write to {0}.{1}@mail.example.org today", "I sat next to {N} during the test", "Thanks to {N} for the referral", "Call me on +44 20 7946 0{i} for a referral", "Call me on 0{i}7-55512 for a referral", "I live at 12 Fennel Court, Velanagar 560{i}, so"]
    first, last = ["Anvika", "Pavlo", "Odrin", "Mirelo"], ["Rosmede", "Karmolen", "Vintresh"]
    data, n = [], 0
    for i in range(100, 160):
        a, b = first[i % 4], last[i % 3]
        for line in lines:
            data.append(("t", n, line.format(a.lower(), b.lower(), N=f"{a} {b}", i=i)))
            n += 1
    data += [("t", n + 1, None), ("t", n + 2, ""), ("t", n + 3, "The clock said 1735689200 in seconds. " * 2000), ("t", n + 4, "seen anvika rosmede again, and Rosmede, Pavlo")]
    df = spark.createDataFrame(data, "src string, id long, text string")
    got = {(r.id, r.pii_type, r.pii_value) for r in pii.find(df).collect()}
    assert {(n + 4, "name", "anvika rosmede"), (n + 4, "name", "Rosmede, Pavlo")} <= got
    assert {v for _, t, v in got if t == "email"} == {d[2].split()[2] for d in data if d[2] and d[2].startswith("Write to")}
    phones = {v for _, t, v in got if t == "phone"}
    assert "+44 20 7946 0100" in phones and any(p.endswith("-55512") for p in phones) and not any("1735689200" in p for p in phones)
    assert any(t == "address" and v == "12 Fennel Court, Velanagar 560100" for _, t, v in got)
    red = {r.id: r.redacted for r in pii.redact(df, pii.find(df)).collect()}
    assert red[n + 4] == "seen [NAME] again, and [NAME]" and red[3] == "Call me on [PHONE] for a referral" and n + 1 not in red
    assert pii.find(df.limit(0)).count() == 0


def test_personal_values_do_not_depend_on_how_words_are_sent(spark, monkeypatch):
    lines = ["asked J. Rosmede twice", "then Anvika Anvika said", "zoe\u0308 Rosmede, A. and Pavlo K. Rosmede", "M. O'Dell-Vint and anvika von der Rosmede", "12 Fennel Court, Velanagar, then", "3 Low Row,Upper Velanagar Beta", "no one"]
    texts = spark.createDataFrame([("t", i, t) for i, t in enumerate(lines)] + [("t", None, "met J. Rosmede")], "src string, id long, text string")
    names = spark.createDataFrame([(w,) for w in ("rosmede", "anvika", "pavlo", "zoe", "odellvint")], "item string")
    towns = spark.createDataFrame([("velanagar",), ("upper velanagar beta",)], "item string")
    places = spark.createDataFrame([("t", 4, 0), ("t", 5, 0)], "src string, id long, at int")
    got = []
    for most_sent in (200_000, 0):
        monkeypatch.setattr(pii, "MOST_SENT", most_sent)
        got.append({tuple(r) for r in pii.again(texts, names, towns, places).collect()})
    assert got[0] == got[1]
    assert {(0, "J. Rosmede"), (1, "Anvika Anvika"), (3, "M. O'Dell-Vint"), (4, "12 Fennel Court, Velanagar"), (5, "3 Low Row,Upper Velanagar Beta"), (None, "J. Rosmede")} <= {(r[1], r[5]) for r in got[0]}


@pytest.mark.parametrize("text, want", [("a.b@c.org", 1), ("a [at] b [dot] org", 1), ("A (at) b.org", 1), ("x at b dot org", 1), ("root@node14", 0), ("@Override", 0), ("at noon", 0)])
def test_email_spellings(text, want):
    assert len(pii.emails(text)) == want


def test_canonical_values(spark):
    names = ["Software Engineer", "Software Engineer II", "Data Analyst", "Site Reliability Engineer", "Data Analyst", None]
    e = spark.createDataFrame([(i, t) for i, t in enumerate(names, 1)], "ref_id int, title string")
    cases = {"software enginer": 1, "Engineer, Software": 1, "Software Engineer 2": 2, "SOFTWARE-ENGINEER II": 2, "dta analyst": 3, "DataAnalyst (Remote)": 3, "S.R.E.": 4, "SRE": 4, "softwareengineer": 1, "Florist": -1, "N/A": -1, "x" * 5000: -1, "Data Analyst @ Town": 3, "D4ta An4lyst": 3}
    df = spark.createDataFrame([(str(i), v, "z") for i, v in enumerate(cases)] + [("n1", None, "z"), ("n2", " \u00a0 ", "z")], "id string, role string, field string")
    got = {r.value: r.ref_id for r in canonical.map_values(df, "id", {"role": e}).collect()}
    assert got == cases
    assert {r.ref_id for r in canonical.map_values(df, "id", {"role": e.limit(0)}).collect()} == {-1}
    assert canonical.map_values(df.limit(0), "id", {"role": e}).count() == 0


def test_near_words_lose_none(spark):
    """Words of any length, around the change from deletion variants to parts."""
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    listed = sorted({word(n) for n in [3, 4, 5, 8, 15, 16, 17, 18, 19, 30, 60, 200] for _ in range(4)})
    said = set(listed)
    for w in listed:
        for _ in range(6):
            x = list(w)
            for _ in range(rng.randrange(1, 4)):
                p = rng.randrange(len(x))
                x[p : p + 1] = rng.choice([[], [x[p], "a"], ["b"], [x[p]] * 2, x[p : p + 2][::-1]])
            said.add("".join(x) or "a")
    df = lambda ws: spark.createDataFrame([("f", w) for w in sorted(ws)], "field string, word string")
    got = {(r.word, r.entry_word) for r in canonical.near_words(df(said), df(listed)).collect()}
    limit = lambda a, b: min(canonical.allowed(len(a)), canonical.allowed(len(b)))
    assert got == {(a, b) for a in said for b in listed if canonical.distance(a, b, limit(a, b)) <= limit(a, b)}


def test_values_of_any_length(spark):
    long = "pneumono" * 25
    e = spark.createDataFrame([(1, long + " institute"), (2, long[:100] + " institute"), (3, "Acme")], "ref_id int, title string")
    cases = {long[:120] + "x" + long[120:] + " institute": 1, (long + "institute")[:-3] + "ute": 1, "z" * 5000: -1, "Acme Ltd": 3}
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(cases)], "id string, company string")
    assert {r.value: r.ref_id for r in canonical.map_values(df, "id", {"company": e}).collect()} == cases


def test_excess_words_count(spark):
    """Words beside many entries weigh little, others speak against the entry."""
    names = [f"{w} Systems" for w in ("Alder", "Birch", "Cedar", "Dogwood", "Elm", "Fir")] + ["Maple"]
    e = spark.createDataFrame(list(enumerate(names)), "ref_id int, title string")
    values = [f"{n} Ltd" for n in names] + ["Maple Ltd", "Maple Hardware Grocery Quinlan", "Bldr Systems", "Cdr Sys"]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "id string, company string")
    got = {r.value: r.ref_id for r in canonical.map_values(df, "id", {"company": e}).collect()}
    assert got["Maple Ltd"] == 6 and got["Alder Systems Ltd"] == 0 and got["Maple Hardware Grocery Quinlan"] == -1


def test_edit_distance():
    assert [canonical.distance(a, b, 3) for a, b in (("abc", "abc"), ("abc", "acb"), ("abc", "xyz"), ("abc", "abcdefg"), ("", "ab"))] == [0, 1, 3, 4, 2]


CLEAN = {
    "fr": "Après réflexion, l’équipe était très précise et l’été à côté du café fut agréable. ",
    "pt": "A decisão não saiu, e a organização citou as funções e a conexão. ",
    "ru": "Через несколько дней пришёл ответ, и там снова упомянули тестирование и потоки. ",
    "ja": "索引は準備していましたが、整列アルゴリズムは難しかったです。",
}


@pytest.mark.parametrize("lang, true, read", [("fr", "utf-8", "cp1252"), ("fr", "utf-8", "mac-roman"), ("pt", "utf-8", "cp437"), ("pt", "utf-8", "latin-1"), ("ru", "cp1251", "latin-1"), ("ru", "koi8-r", "cp1251"), ("ru", "utf-8", "cp1251"), ("ja", "shift_jis", "latin-1"), ("ja", "utf-8", "latin-1")])
def test_round_trip_of_encodings(lang, true, read):
    base = [t * 6 for t in CLEAN.values()] * 5
    counts: dict[int, int] = {}
    for k in mojibake.count_pairs(base).tolist():
        counts[k] = counts.get(k, 0) + 1
    labeller = mojibake.Labeller(mojibake.Model(counts))
    assert labeller.restore(base) == {}
    whole = CLEAN[lang].encode(true, "ignore")
    broken = "".join(bytes([b]).decode(read, "ignore") or chr(b) for b in whole)
    part = CLEAN[lang] + "\n" + broken
    got = labeller.restore([broken, part, "plain ascii", "lost \ufffd here", ""])
    want = whole.decode(true)
    assert got[0] == want and got[1] == CLEAN[lang] + "\n" + want and set(got) == {0, 1, 3}


@pytest.mark.parametrize("times", [1, 2, 5])
def test_texts_garbled_many_times(times):
    counts: dict[int, int] = {}
    for k in mojibake.count_pairs([t * 6 for t in CLEAN.values()] * 5).tolist():
        counts[k] = counts.get(k, 0) + 1
    text = whole = CLEAN["fr"] * 2
    for _ in range(times):
        text = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in text.encode())
    got = mojibake.Labeller(mojibake.Model(counts)).restore(["é", text, "x"])
    assert got == {1: whole}


def test_encodings_in_spark(spark):
    df = spark.createDataFrame([(i, t * 3, "x") for i, t in enumerate([*CLEAN.values()] * 10)] + [(100, "CafÃ© est agrÃ©able", "x"), (101, None, "x"), (102, "", "x"), (103, LONG + "é", "x")], "doc_id long, text string, restored string")
    assert rows(mojibake.restore_texts(df, "doc_id", "text")) == [(100, "Café est agréable")]
    assert mojibake.restore_texts(df.limit(0), "doc_id", "text").count() == 0
