"""Problem 5: mapping free-entered values to a canonical list by token-level repair and soft TF-IDF.

All work is done once per distinct value. Values are cut into tokens; each distinct token is joined
to the vocabulary of the reference list by edit distance (an equality join on deletion variants, or
on parts for long words, then exact distance) and as the beginning of a word. A value meets the
entries that share one of its heaviest repaired tokens: an entry without any of them cannot reach the
threshold. Value and entry are then compared by soft TF-IDF, the cosine of their weighted tokens,
where a pair of tokens counts with its similarity: one minus the relative distance, or what an
abbreviation is worth (a token that begins like a word, or like a run of words, and has its letters
in their order). No list of short forms, legal forms or remarks is needed: the weight of a word is its
inverse entry frequency (of the most frequent word it may be), and that of a word no entry has is the
inverse frequency of the entries whose values have it. What stands beside any entry ("Ltd", "remote") weighs next to nothing, what nobody
else has weighs in full against the entry.

Values that no entry reaches are tried as one word (all letters joined, which also repairs moved
spaces) and as initials of an entry, if these are unique. The rest means no entry (-1).

Defined results: null, empty and blank values (no-break spaces count as blank) give no row; equal
scores go to the larger common weight, then to the smaller id; an empty list maps everything to -1;
repeated entries of the list resolve to the smallest id; tokens of any length are compared whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm._common import stored
from skein.llm.splitting import WORD_RUN

#: Cosine from which an entry is meant, and worth of an abbreviation.
REACH, ABBREVIATED = 0.6, 0.85
#: Longest words that are indexed by deletion variants; longer ones are indexed by their parts.
LONG = 16
_CAMEL = re.compile(r"(?<=[a-zà-ÿ])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")
_ASIDE = re.compile(r"\([^)]*\)|\[[^\]]*\]|\s[-–—@|]\s.*$|\s@\s?.*$|,?\s(?:at|for)\s.*$")
_TOKEN = re.compile(r"[a-z]+|\d+")
#: Digits and signs, and the letters they stand for inside words.
_LIKE = str.maketrans("013457$@", "oleastsa")


def plain(text: str) -> str:
    """Lower case without accents, with digits inside letters read as the letters they look like, and x/y between single letters as xy."""
    text = unicodedata.normalize("NFKD", text)
    text = "".join(c for c in text if not unicodedata.combining(c)).lower()
    text = re.sub(r"\b([a-z])/([a-z])\b", r"\1\2", text)
    return re.sub(r"[a-z0-9$@]*[a-z][a-z0-9$@]*", lambda m: re.sub(r"(?<=[a-z])[013457$@]|[013457$@](?=[a-z])", lambda d: d[0].translate(_LIKE), m[0].lstrip("@")), text)


def roman(n: int) -> str:
    out = ""
    for value, sign in ((10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        out, n = out + sign * (n // value), n % value
    return out


def tokens(value: str) -> list[str]:
    """Tokens of a value; remarks are left out where other tokens remain, and small numbers are written in letters."""
    mixed = any(c.islower() for c in value) and any(c.isupper() for c in value) and not re.search(r"\b[a-z][A-Z]{2}", value)
    text = _CAMEL.sub(" ", value) if mixed else value
    text = plain(re.sub(r"^\s*\w{3,12}:\s", "", text))
    found = _TOKEN.findall(_ASIDE.sub(" ", text)) or _TOKEN.findall(text)
    return [roman(int(t)) if t.isdigit() and 0 < int(t[:3]) < 20 and len(t) < 3 else t for t in found]


def distance(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions of neighbours, or most + 1 when it is larger; only the diagonals within most are filled."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    far = most + 1
    before: list[int] = []
    row = [j if j <= most else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        last, row = row, [far] * (len(b) + 1)
        if i <= most:
            row[0] = i
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            y = b[j - 1]
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row[j] = min(d, far)
        if min(row) > most:
            return far
        before = last
    return row[-1]


def allowed(n: int) -> int:
    """Edits allowed in a token of n characters."""
    return 0 if n < 4 else 1 if n < 6 else 2


@lru_cache(maxsize=100_000)
def deletions(word: str, most: int) -> frozenset[str]:
    """The word and all forms with up to so many characters left out."""
    out = level = {word}
    for _ in range(most):
        level = {w[:i] + w[i + 1 :] for w in level for i in range(len(w))}
        out = out | level
    return frozenset(out)


def parts(n: int, most: int) -> list[tuple[int, int]]:
    """(start, end) of the most + 1 parts of a word of n characters: at most edits leave one of them whole (a transposition can touch two, so there is one more)."""
    k = 2 * most + 1
    return [(n * i // k, n * (i + 1) // k) for i in range(k)]


def listed_keys(word: str, most: int) -> set[str]:
    """Keys under which a word of the list is found."""
    if len(word) <= LONG:
        return set(deletions(word, most))
    return {f"{len(word)}:{i}:{word[a:b]}" for i, (a, b) in enumerate(parts(len(word), most))}


def asked_keys(word: str, most: int) -> set[str]:
    """Keys under which a word looks for those of the list within `most` edits."""
    out = set(deletions(word, most)) if len(word) <= LONG + most else set()
    for n in range(max(LONG + 1, len(word) - most), len(word) + most + 1):
        for i, (a, b) in enumerate(parts(n, most)):
            out |= {f"{n}:{i}:{word[a + d : b + d]}" for d in range(-most, most + 1) if a + d >= 0 and b + d <= len(word)}
    return out


@lru_cache(maxsize=200_000)
def abbreviates(short: str, words: str) -> bool:
    """Whether a token begins like a word, or like joined words, is clearly shorter, and has its letters in their order (but for one)."""
    if not 2 <= len(short) <= 0.8 * len(words) or short[0] != words[0]:
        return False
    at = missed = 0
    for c in short[1:]:
        found = words.find(c, at + 1)
        at, missed = (found, missed) if found >= 0 else (at, missed + 1)
    return missed == 0 or (missed == 1 and len(short) >= 4)


@lru_cache(maxsize=200_000)
def alike(a: str, b: str) -> float:
    """Similarity of a token of a value and a word of an entry; 0 where they are different words."""
    if a == b:
        return 1.0
    most = min(allowed(len(a)), allowed(len(b)))
    d = distance(a, b, most)
    if d <= most:
        return 1 - d / max(len(a), len(b))
    return ABBREVIATED if abbreviates(a, b) else 0.0


def compare(value: list[str], entry: list[str], weight: list[float]) -> tuple[float, float, float, list[str]]:
    """(common weight, squared weight of the entry, of the value's tokens that it repairs, tokens left over), each token used once."""
    left, open_ = list(dict.fromkeys(value)), dict(zip(entry, weight))
    total = sum(w * w for w in open_.values())
    common = held = 0.0
    for sim, w, t in sorted(((alike(t, w), w, t) for t in left for w in open_), reverse=True):
        if sim > 0 and t in left and w in open_:
            common, held = common + open_[w] ** 2 * sim, held + open_[w] ** 2
            left.remove(t)
            del open_[w]
    # what is left of the value may stand for a run of words that is left of the entry
    at = 0
    while at < len(entry):
        end = at
        while end < len(entry) and entry[end] in open_:
            end += 1
        run = entry[at:end]
        whole = "".join(run)
        t = next((t for t in left if len(run) > 1 and (t == whole or distance(t, whole, allowed(len(t))) <= allowed(len(t)) or abbreviates(t, whole))), None)
        if t is not None:
            square = sum(open_.pop(w) ** 2 for w in dict.fromkeys(run))
            common, held = common + square * (1.0 if t == whole else ABBREVIATED), held + square
            left.remove(t)
        at = max(end, at) + 1
    return common, total, held, left


def _table(rows: list[tuple], names: str, kinds: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=k) for c, k in zip(cols, kinds)], names=names.split())


TEXT, TEXTS, REAL = pa.string(), pa.list_(pa.string()), pa.float64()


def _cut(df: DataFrame) -> DataFrame:
    """(field, name, tokens, joined, initials) from (field, name)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for f, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                t = tokens(v)
                short = plain(v).replace(".", "").strip()
                rows.append((f, v, t, "".join(t), short if re.fullmatch(r"[a-z]{2,6}", short) else ""))
            yield _table(rows, "field name tokens joined initials", [TEXT, TEXT, TEXTS, TEXT, TEXT])

    return df.select("field", "name").mapInArrow(run, "field string, name string, tokens array<string>, joined string, initials string")


def _keyed(df: DataFrame, keys, most: int | None) -> DataFrame:
    """(field, word, key) of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(f, w, k) for f, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for k in keys(w, allowed(len(w)) if most is None else most)]
            yield _table(rows, "field word key", [TEXT] * 3)

    return df.select("field", "word").mapInArrow(run, "field string, word string, key string")


def near_words(words: DataFrame, vocabulary: DataFrame, most: int | None = None) -> DataFrame:
    """(field, word, entry_word, sim): words of both sides within the allowed edit distance."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for f, a, b in zip(*(batch.column(i).to_pylist() for i in range(3))):
                limit = min(allowed(len(a)), allowed(len(b))) if most is None else most
                d = distance(a, b, limit)
                if d <= limit:
                    rows.append((f, a, b, 1 - d / max(len(a), len(b))))
            yield _table(rows, "field word entry_word sim", [TEXT] * 3 + [REAL])

    # a word can only meet one of the list that is about as long
    longest = vocabulary.groupBy("field").agg(F.max(F.length("word")).alias("longest"))
    fit = words.join(longest, "field").where(F.length("word") <= F.col("longest") + 2).select("field", "word")
    left, right = _keyed(fit, asked_keys, most), _keyed(vocabulary, listed_keys, most).withColumnRenamed("word", "entry_word")
    pairs = left.join(right, ["field", "key"]).select("field", "word", "entry_word").distinct()
    return pairs.mapInArrow(check, "field string, word string, entry_word string, sim double")


def beginnings(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(field, word, entry_word): words that are the beginning of a word of the list, two letters or more."""
    start = vocabulary.select("field", F.col("word").alias("entry_word"), F.explode(F.sequence(F.lit(2), F.greatest(F.lit(2), F.length("word") - 1))).alias("n"))
    return words.join(start.select("field", "entry_word", F.substring("entry_word", F.lit(1), F.col("n")).alias("word")), ["field", "word"]).where("word != entry_word")


def heaviest(words: Column) -> Column:
    """The tokens of array<struct<high, low, word, entry_words>>, heaviest first, but for the light ones at the end that alone could not lift an entry to REACH.

    A token weighs `low` at least where an entry does not have it, and `high` at most where it has it.
    """
    order = F.reverse(F.array_sort(words))
    square = lambda part, w: F.aggregate(part, F.lit(0.0), lambda s, x: s + x[w] * x[w])
    after = lambda i: square(F.slice(order, i + 1, F.size(order)), "high")
    before = lambda i: square(F.slice(order, F.lit(1), i), "low")
    return F.filter(order, lambda x, i: after(i) >= F.lit(REACH**2) * (after(i) + before(i)))


def match_values(values: DataFrame, entries: DataFrame) -> DataFrame:
    """(field, name, ref_id) of distinct values (field, name), from entries (field, ref_id, title); ref_id is -1 for none."""
    cut = stored(_cut(values), "values")
    titles = entries.where("title is not null").groupBy("field", F.col("title").alias("name")).agg(F.min("ref_id").alias("ref_id"))
    listed = stored(_cut(titles).join(titles, ["field", "name"]).where(F.size("tokens") > 0), "entries")
    has = listed.select("field", "ref_id", F.explode(F.array_distinct("tokens")).alias("word"))
    total = listed.groupBy("field").agg(F.count("*").alias("entries"))
    weight = has.groupBy("field", "word").agg(F.count("*").alias("df")).join(total, "field")
    weight = stored(weight.select("field", "word", F.log(1 + F.col("entries") / F.col("df")).alias("w")), "weights")
    said = cut.select("field", "name", F.explode(F.array_distinct("tokens")).alias("word"))
    words = said.select("field", "word").distinct()
    near = near_words(words, weight).select("field", "word", "entry_word").unionByName(beginnings(words, weight)).distinct()
    near = near.join(weight.withColumnRenamed("word", "entry_word"), ["field", "entry_word"])
    near = stored(near.groupBy("field", "word").agg(F.max("w").alias("high"), F.min("w").alias("low"), F.collect_set("entry_word").alias("entry_words")), "near")
    found = said.join(near, ["field", "word"]).groupBy("field", "name").agg(F.collect_list(F.struct("high", "low", "word", "entry_words")).alias("words"))
    found = found.select("field", "name", F.explode(F.flatten(F.transform(heaviest(F.col("words")), lambda x: x["entry_words"]))).alias("word")).distinct()
    met = found.join(has, ["field", "word"]).select("field", "name", "ref_id").distinct()
    of_entry = has.join(weight, ["field", "word"]).groupBy("field", "ref_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "w"))).alias("ws"))
    of_entry = listed.select("field", "ref_id", F.col("tokens").alias("entry")).join(of_entry, ["field", "ref_id"])
    both = met.join(cut.select("field", "name", "tokens"), ["field", "name"]).join(of_entry, ["field", "ref_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for f, v, r, t, e, w in zip(*(batch.column(i).to_pylist() for i in range(6))):
                w = dict(w)
                rows.append((f, v, r, *compare(t, e, [w[x] for x in e])))
            yield _table(rows, "field name ref_id common total held rest", [TEXT, TEXT, pa.int32(), REAL, REAL, REAL, TEXTS])

    scored = both.select("field", "name", "ref_id", "tokens", "entry", "ws").mapInArrow(run, "field string, name string, ref_id int, common double, total double, held double, rest array<string>")
    scored = stored(scored.where(F.col("common") >= REACH * F.sqrt(F.col("total") * F.col("held"))), "scored")
    by_name = Window.partitionBy("field", "name")
    first = scored.withColumn("r", F.row_number().over(by_name.orderBy(F.desc(F.col("common") / F.sqrt(F.col("total") * F.col("held"))), F.desc("common"), "ref_id"))).where("r = 1")
    beside = first.select("field", "ref_id", F.explode("rest").alias("word")).groupBy("field", "word").agg(F.count_distinct("ref_id").alias("df")).join(total, "field")
    beside = beside.select("field", "word", F.log(1 + F.col("entries") / F.col("df")).alias("u"))
    alone = F.log(1 + F.col("entries"))  # a word that stands beside no entry weighs like one of a single entry
    excess = scored.select("field", "name", "ref_id", F.explode("rest").alias("word")).join(total, "field").join(beside, ["field", "word"], "left")
    excess = excess.join(near.select("field", "word", "low"), ["field", "word"], "left")
    excess = excess.groupBy("field", "name", "ref_id").agg(F.sum(F.coalesce("low", "u", alone) ** 2).alias("excess"))
    scored = scored.join(excess, ["field", "name", "ref_id"], "left").withColumn("score", F.col("common") / F.sqrt(F.col("total") * (F.col("held") + F.coalesce("excess", F.lit(0.0)))))
    best = by_name.orderBy(F.desc("score"), F.desc("common"), "ref_id")
    ranked = stored(scored.where(F.col("score") >= REACH).withColumn("r", F.row_number().over(best)).where("r = 1").select("field", "name", "ref_id"), "ranked")
    open_ = cut.join(ranked.select("field", "name"), ["field", "name"], "left_anti")
    whole = listed.select("field", F.col("joined").alias("word"), "ref_id").where("length(word) >= 4")
    joined = open_.select("field", "name", F.col("joined").alias("word")).where("length(word) >= 6")
    same = near_words(joined.select("field", "word").distinct(), whole.select("field", "word").distinct(), 2).where("length(entry_word) >= 8 or sim > 0.84")
    same = joined.join(same, ["field", "word"]).join(whole.withColumnRenamed("word", "entry_word"), ["field", "entry_word"])
    same = same.withColumn("r", F.row_number().over(by_name.orderBy(F.desc("sim"), "ref_id"))).where("r = 1").select("field", "name", "ref_id")
    short = listed.where(F.size("tokens") >= 2).select("field", F.array_join(F.transform("tokens", lambda t: F.substring(t, 1, 1)), "").alias("initials"), "ref_id")
    short = short.groupBy("field", "initials").agg(F.min("ref_id").alias("ref_id"), F.count("*").alias("n")).where("n = 1").drop("n")
    short = open_.where("initials != ''").join(short, ["field", "initials"]).select("field", "name", "ref_id")
    last = same.withColumn("o", F.lit(1)).unionByName(short.withColumn("o", F.lit(2))).groupBy("field", "name").agg(F.min(F.struct("o", "ref_id")).alias("f"))
    found = ranked.unionByName(last.select("field", "name", F.col("f.ref_id").alias("ref_id")))
    return values.join(found, ["field", "name"], "left").select("field", "name", F.coalesce("ref_id", F.lit(-1)).cast("int").alias("ref_id"))


def filled(value: Column) -> Column:
    """Neither null nor only white space."""
    return F.coalesce(value.rlike(WORD_RUN), F.lit(False))


def map_values(df: DataFrame, id_col: str, fields: dict[str, DataFrame]) -> DataFrame:
    """(id, field_name, value, ref_id) of every filled value; fields gives for each column its list (ref_id, title)."""
    names = list(fields)
    long = df.select(F.col(id_col).alias("id"), F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("name")) for n in names])).alias("x"))
    long = long.select("id", "x.field", "x.name").where(filled(F.col("name")))
    values = long.groupBy("field", "name").agg(F.count("*").alias("n")).select("field", "name")
    entries = None
    for n, e in fields.items():
        part = e.select(F.lit(n).alias("field"), F.col("ref_id").cast("int"), F.col("title"))
        entries = part if entries is None else entries.unionByName(part)
    matched = match_values(values, entries)
    out = long.join(matched, ["field", "name"])
    return out.select(F.col("id").alias(id_col), F.col("field").alias("field_name"), F.col("name").alias("value"), "ref_id")
