"""Problem 4: personal information found by bootstrapped contextual extraction.

Seeds are what no other text can be: e-mail addresses written with @ and dots, international telephone
numbers, identity numbers of a fixed form, postal addresses with a code, and the names that e-mail
addresses and titles spell out. Every mention of a candidate (something that could be an e-mail address
in words, a postal address without a code, a number of any form, a run of capitalised words) gives
edges between the item (the form of the address or number, the word of a name) and its lexical patterns
(the words before it, the words after it). Spark scores patterns by the items they hold and items by the
patterns they stand in, for some rounds; addresses and numbers of ambiguous form and unseen names are
accepted where confident patterns or items say so, and the names and towns learned are then found in
any spelling, anywhere.

The graph is aggregated before it is shuffled and has one row per item and pattern, not per
mention; where very many items share a pattern, the pattern's side of a join has one row for each type,
so adaptive execution can split the other. The words of
accepted names and the towns are sent to the tasks while they are few; beyond that the words of each
text meet them in a join.

Defined results: null and empty texts hold nothing; one row per distinct value and type in a
record; of overlapping spans those of addresses and numbers come before names, then the one that begins
first, the longer one if they begin together, always against spans that are kept themselves; texts are
read whole; placeholders are [EMAIL], [PHONE], [ID_NUMBER], [ADDRESS], [NAME].
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm._common import spread, stored

#: Rounds of scoring; one score, and the mean of two, that accept a number; score of a word of a name; support that halves a score.
ROUNDS, DECISIVE, ACCEPT, NAME_WORD, DOUBT = 3, 0.75, 0.5, 0.5, 1.0
TYPES = ("email", "phone", "id_number", "address", "name")
#: Words of names, or towns, that are sent to the tasks; more of them are joined to the words of the texts.
MOST_SENT = 200_000

_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
_DOT = r"(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s)"
_AT = re.compile(r"@|&#64;|\s?[\[({<]\s?at\s?[\])}>]\s?|\sat\s(?=[\w-]+\sdot\s)", re.I)
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_LOCAL = _ALNUM | frozenset("._%+'-")
_DOMAIN = re.compile(rf"{_LABEL}(?:{_DOT}{_LABEL})*{_DOT}[A-Za-z]{{2,}}(?![A-Za-z0-9])", re.I)
#: Forms that are telephone or identity numbers by themselves.
_PHONE = re.compile(r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d(?:[ .-]?\d){6,12}$|\(\d{3}\) ?\d{3}[ .-]\d{4}$")
_IDENTITY = re.compile(r"[A-Z]{5}\d{4}[A-Z]$|[A-Z]{2}\d{2} ?\d{11}$|[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D]$|[A-Z]\d{7}$|\d{3}-\d{2}-\d{4}$|\d{3}\.\d{3}\.\d{3}-\d{2}$", re.I)
_NUMBER = re.compile(
    r"(?<![\w@/\\.:&#-])(?:"
    r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{1,4}\)[ .-]?)?\d+(?:[ .-]\(?\d+\)?){0,6}"
    r"|[A-Za-z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Za-z]|[A-Za-z]{2}\d{2} ?\d{11}|[A-Za-z]{1,5}\d{4,12}[A-Za-z]?"
    r")(?![\w@/\\-]|\.\d)"
)
_STREET = r"(?:Avenue|Ave|Road|Rd|Street|St|Lane|Ln|Court|Ct|Crescent|Cres|Drive|Dr|Way|Place|Pl|Square|Sq|Boulevard|Blvd|Terrace|Close|Parade|Row|Walk)\b\.?"
_WORD1 = r"[^\W\d_][\w'’-]*"
_CODE = r"(?:\d{5}-\d{4}|\d{5,6})(?!\d)"
_UNIT = r"(?:(?:Flat|Apt|Apartment|Unit|Suite|Room|House|Door)\.? ?(?:No\.? ?)?#? ?\d+ ?[A-Z]?, ?)"
_HEAD = re.compile(
    rf"(?<![\w-])(?:(?P<box>P\.? ?O\.? ?Box \d+, )"
    rf"|(?P<hno>H\.? ?No\.? ?\d+(?:[-/]\d+)?, {_WORD1}(?: {_WORD1}){{0,2}} {_STREET}, )"
    rf"|(?P<anglo>{_UNIT}?\d{{1,5}}[A-Z]? {_WORD1}(?: {_WORD1}){{0,2}}? {_STREET}, ?|{_UNIT}?\d{{1,5}}[A-Z]? {_WORD1}(?: {_WORD1}){{0,2}}? {_STREET} (?=[A-Z]))"
    rf"|(?P<before>(?:Calle|Via|Rua|Avenida|Plaza|Rue|Carrera) {_WORD1}(?: {_WORD1}){{0,2}}? \d+[A-Z]?, {_CODE} |\d+, ?rue {_WORD1}(?: {_WORD1}){{0,3}}?, {_CODE} |{_WORD1}(?:weg|stra(?:ß|ss)e|str\.|platz|allee|gasse) \d+ ?[a-z]?, {_CODE} ))",
    re.I,
)
_TOWN = re.compile(r"[A-ZÀ-Þ][\w'’-]+(?: [A-ZÀ-Þ][\w'’-]+){0,2}")
_ANYTOWN = re.compile(r"([^\W\d_][\w'’-]*(?: [^\W\d_][\w'’-]*){0,2}?)(?=(?: - |, | )(?:PIN )?" + _CODE + ")", re.I)
_AFTER = re.compile(rf"(?:(?: - |, ?| )(?:PIN )?{_CODE})?", re.I)
_TOKEN = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*\.?|\d+|\n|[<>]")
_NAMEWORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*\.?")
_CAPS = re.compile(r"(?:[A-ZÀ-Þ](?:[\w'’-]*[^\W\d_])?)\.?(?:(?:,? )(?:(?:van|von|de|der|den|la|le|da|di|del|al|el|bin|ibn|dos|du) ){0,2}[A-ZÀ-Þ](?:[\w'’-]*[^\W\d_])?\.?){1,3}")
_PARTICLES = set("van von de der den la le da di del della al el bin ibn dos das du".split())
_HONORIFIC = re.compile(r"(?:(?:Mr|Mrs|Ms|Miss|Dr|Prof|Sir|Madam|Frau|Herr|Sr|Sra|Mme)\.? )+", re.I)
_TITLE = re.compile(r"\b(?:Mr|Mrs|Ms|Miss|Dr|Prof|Sir|Madam|Frau|Herr|Sr|Sra|Mme)\.? ((?:[A-Z]\. )?[^\W\d_]+(?:['’-][^\W\d_]+)*(?: [^\W\d_]+(?:['’-][^\W\d_]+)*){0,2})", re.I)


def emails(text: str) -> list[tuple[int, int, str]]:
    """(start, end, form) of e-mail addresses, however the at-sign and the dots are spelled; the form is that spelling."""
    out = []
    for m in _AT.finditer(text):
        end = m.start()
        if not end or text[end - 1] not in _ALNUM:
            continue
        start = end
        while start and text[start - 1] in _LOCAL:
            start -= 1
        while text[start] not in _ALNUM:
            start += 1
        if after := _DOMAIN.match(text, m.end()):
            dots = {d.strip().lower() for d in re.findall(_DOT, after[0], re.I)}
            out.append((start, after.end(), f"{m[0].strip().lower()} {'.' if dots == {'.'} else max(dots)}"))
    return out


_TOWN_WORDS = {n: re.compile(rf"{_WORD1}(?: {_WORD1}){{{n - 1}}}(?![\w'’-])") for n in (3, 2, 1)}


def town_runs(text: str, at: int) -> list[re.Match]:
    """The words that may name a town where the head of an address ends: three, two, one."""
    return [w for words in _TOWN_WORDS.values() if (w := words.match(text, at))]


def addresses(text: str, towns: frozenset[str] | set[str]) -> list[tuple[int, int, str, str, bool]]:
    """(start, end, town, form, sure) of postal addresses; sure if the town is delimited by a code or known."""
    out = []
    for m in _HEAD.finditer(text):
        at = m.end()
        known = next((w for w in town_runs(text, at) if w[0].lower() in towns), None) if towns else None
        after_code = None if m["before"] else _ANYTOWN.match(text, at)
        town = known or after_code or _TOWN.match(text, at)
        if town is None:
            continue
        end = town.end() if m["before"] else _AFTER.match(text, town.end()).end()
        code = bool(m["before"] or after_code or end > town.end())
        out.append((m.start(), end, town[0].lower(), f"{m.lastgroup} {'code' if code else 'none'}", bool(known or after_code)))
    return out


def numbers(text: str) -> list[tuple[int, int, str]]:
    """(start, end, form) of candidate numbers: digits as 0, letters as A."""
    out = []
    for m in _NUMBER.finditer(text):
        value = m[0]
        while value.count(")") > value.count("("):
            value = value[: value.rindex(")")]
        digits = sum(c.isdigit() for c in value)
        letters = sum(c.isalpha() for c in value)
        if letters == 0 and 8 <= digits <= 15 or letters and 6 <= digits + letters and digits >= 4:
            out.append((m.start(), m.start() + len(value), re.sub(r"[^\W\d_]", "A", re.sub(r"\d", "0", value))))
    return out


class Words:
    """The words of a text with their places, read once."""

    def __init__(self, text: str):
        self.text = text
        found = list(_NAMEWORD.finditer(text))
        self.word, self.start, self.end = [m[0] for m in found], [m.start() for m in found], [m.end() for m in found]

    def surroundings(self, start: int, end: int) -> tuple[str, str]:
        """The lexical patterns of a span: up to three words before it and two after it, in its line."""
        text, i, j = self.text, bisect_right(self.end, start), bisect_left(self.start, end)
        first = max(0, i - 3)
        low = self.start[first] if i else 0
        left = text[low:start]
        cut = low + max(left.rfind("\n"), left.rfind(">"), left.rfind("|")) + 1
        before = [self.word[k].lower() for k in range(first, i) if self.start[k] >= cut]
        last = min(len(self.word), j + 2)
        right = re.split(r"[\n<|]", text[end : self.end[last - 1] if last > j else self.line_end(end)], maxsplit=1)[0]
        after = [self.word[k].lower() for k in range(j, last) if self.end[k] <= end + len(right)]
        sign = right.strip()[:1]
        return "L:" + " ".join(["^", *before][-3:]), "R:" + (sign if sign and not sign.isalnum() else "") + " " + " ".join([*after, "$"][:2])

    def line_end(self, at: int) -> int:
        found = self.text.find("\n", at)
        return found if found >= 0 else len(self.text)

    def plain(self) -> list[str]:
        """The words as names are known: in lower case and without marks."""
        return [w.translate(_MARKS).lower() for w in self.word]


_MARKS = str.maketrans("", "", "'’.-")


def known_names(words: Words, known: frozenset[str] | set[str]) -> list[tuple[int, int]]:
    """Spans of two or more parts whose words are known, with initials and particles, or last name, comma, first name."""
    text, token, begin, close = words.text, words.word, words.start, words.end
    plain = words.plain()
    out, i, n = [], 0, len(token)
    if len(known.intersection(plain)) < 1:
        return out

    def initial(k: int) -> bool:
        return len(token[k]) == 2 and token[k][1] == "."

    def gap(k: int) -> str:
        return text[close[k] : begin[k + 1]]

    while i < n:
        if plain[i] not in known:
            i += 1
            continue
        start, j, count = i, i, 1
        if i and initial(i - 1) and gap(i - 1) == " ":
            start, count = i - 1, 2
        while j + 1 < n and not (token[j][-1] == "." and not initial(j)):
            if gap(j) == " ":
                k = j + 1
                while k < n - 1 and (plain[k] in _PARTICLES or initial(k)) and plain[k] not in known and gap(k) == " " and k - j < 4:
                    k += 1
                if plain[k] in known:
                    j, count = k, count + 1
                    continue
                if initial(j + 1) and count == 1:
                    j, count = j + 1, count + 1
            elif gap(j) == ", " and count == 1 and plain[j + 1] in known:
                j, count = j + 1, count + 1
                if j + 1 < n and gap(j) == " " and initial(j + 1):
                    j += 1
                while start and plain[start - 1] in _PARTICLES and gap(start - 1) == " ":
                    start -= 1
                break
            break
        if count >= 2:
            out.append((begin[start], close[j] - (token[j][-1] == "." and not initial(j))))
        i = max(j, i) + 1
    return out


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


_MENTION = pa.schema([("src", pa.string()), ("id", pa.int64()), ("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("value", pa.string()), ("items", pa.list_(pa.string())), ("seed", pa.string()), ("l", pa.string()), ("r", pa.string())])
_MENTION_SQL = "src string, id bigint, kind string, start int, stop int, value string, items array<string>, seed string, l string, r string"


def mentions(texts: DataFrame) -> DataFrame:
    """Candidate mentions of (src, id, text): kind email, number, address or name, with items, seed type and patterns; owner and town name words only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for src, i, t in zip(*(batch.column(k).to_pylist() for k in range(3))):
                taken, words = [], Words(t)
                for a, b, form in emails(t):
                    taken.append((a, b))
                    local = re.split(r"@|&#64;|\s?[\[({<]?\s?\bat\b", t[a:b], maxsplit=1)[0]
                    parts = [re.sub(r"\d+$", "", p).lower() for p in re.split(r"[._-]", local)]
                    rows.append((src, i, "email", a, b, t[a:b], [form], "email" if form == "@ ." else "", *words.surroundings(a, b)))
                    if len(parts) == 2 and all(p.isalpha() and len(p) > 2 for p in parts):
                        rows.append((src, i, "owner", a, b, "", parts, "", "", ""))
                for a, b, town, form, sure in addresses(t, frozenset()):
                    taken.append((a, b))
                    rows.append((src, i, "address", a, b, t[a:b], [form], "address" if form.endswith("code") else "", *words.surroundings(a, b)))
                    if sure:
                        rows.append((src, i, "town", a, b, "", [town], "", "", ""))
                for a, b, form in numbers(t):
                    if not any(x < b and a < y for x, y in taken):
                        v = t[a:b]
                        seed = "phone" if _PHONE.match(v) else "id_number" if _IDENTITY.match(v) else ""
                        # the form, and the form with its first digits: an area code or a prefix of a series
                        rows.append((src, i, "number", a, b, v, [form, f"{re.sub(r'\D', '', v)[:3]}|{form}"], seed, *words.surroundings(a, b)))
                titled = {m.start(1) for m in _TITLE.finditer(t)}
                for m in _CAPS.finditer(t):
                    a, b = m.span()
                    if skip := _HONORIFIC.match(m[0]):
                        a += skip.end()
                    v = t[a:b]
                    v = v.rstrip(".") if not re.search(r"(?:^|\s)\w\.$", v) else v
                    b = a + len(v)
                    parts = [re.sub(r"['’.-]", "", p).lower() for p in re.split(r",? ", v)]
                    parts = [p for p in parts if len(p) > 1 and p not in _PARTICLES]
                    if parts and not any(x < b and a < y for x, y in taken):
                        rows.append((src, i, "name", a, b, v, parts, "name" if a in titled else "", *words.surroundings(a, b)))
            yield _batch(rows, _MENTION)

    return spread(texts, 1).mapInArrow(run, _MENTION_SQL)


def score(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Item scores (kind, item, type, s) and pattern scores (kind, pattern, type, s) of the graph (kind, item, pattern, n)."""
    items = seeds.groupBy("kind", "item", "type").agg(F.max("s").alias("s"))
    # a finer form (with first digits) takes a score from its patterns but gives none: it would count a mention twice
    whole = edges.where("instr(item, '|') = 0")
    of_pattern = whole.groupBy("kind", "pattern").agg(F.sum("n").alias("total"))
    of_item = edges.groupBy("kind", "item").agg(F.sum("n").alias("total"))
    patterns = None
    for _ in range(rounds):
        p = whole.join(items, ["kind", "item"]).groupBy("kind", "pattern", "type").agg(F.sum(F.col("n") * F.col("s")).alias("mass"))
        patterns = stored(p.join(of_pattern, ["kind", "pattern"]).select("kind", "pattern", "type", (F.col("mass") / (F.col("total") + DOUBT)).alias("s")).where("s > 0.05"), "patterns")
        q = edges.join(patterns, ["kind", "pattern"]).groupBy("kind", "item", "type").agg(F.sum(F.col("n") * F.col("s")).alias("mass"))
        q = q.join(of_item, ["kind", "item"]).select("kind", "item", "type", (F.col("mass") / (F.col("total") + DOUBT)).alias("s")).where("s > 0.05")
        items = stored(q.unionByName(seeds).groupBy("kind", "item", "type").agg(F.max("s").alias("s")), "items")
    return items, patterns


def find(texts: DataFrame) -> DataFrame:
    """(src, id, pii_type, start, stop, pii_value) of (src, id, text), overlaps resolved."""
    texts = texts.where(F.col("text").isNotNull() & (F.length("text") > 0))
    seen = stored(mentions(texts), "mentions")
    candidates = seen.where("kind in ('email', 'address', 'number', 'name')")
    edges = candidates.select("kind", F.explode("items").alias("item"), "l", "r").select("kind", "item", F.explode(F.array("l", "r")).alias("pattern"))
    edges = stored(edges.groupBy("kind", "item", "pattern").agg(F.count("*").alias("n")), "edges")
    whole = F.col("kind") != "name"
    by_form = candidates.where("seed != ''").select("kind", F.explode(F.when(whole, F.slice("items", 1, 1)).otherwise(F.col("items"))).alias("item"), F.col("seed").alias("type"), F.when(whole, 1.0).otherwise(0.9).alias("s"))
    by_mail = seen.where("kind = 'owner'").select(F.lit("name").alias("kind"), F.explode("items").alias("item"), F.lit("name").alias("type"), F.lit(0.8).alias("s"))
    items, patterns = score(edges, by_form.unionByName(by_mail).distinct())
    # addresses and numbers: one decisive score of form, words before or words after, or two good ones
    formal = candidates.where(whole).select("kind", "src", "id", "start", "stop", "value", "seed", "items", "l", "r")
    key = F.explode(F.array(F.struct(F.lit("i").alias("w"), F.col("items")[0].alias("k")), F.struct(F.lit("i").alias("w"), F.get("items", F.lit(1)).alias("k")), F.struct(F.lit("p").alias("w"), F.col("l").alias("k")), F.struct(F.lit("p").alias("w"), F.col("r").alias("k"))))
    scores = items.where(whole).select("kind", F.lit("i").alias("w"), F.col("item").alias("k"), "type", "s").unionByName(patterns.where(whole).select("kind", F.lit("p").alias("w"), F.col("pattern").alias("k"), "type", "s"))
    scored = formal.select("kind", "src", "id", "start", "stop", "value", "seed", key.alias("x")).select("*", "x.w", "x.k").drop("x").join(scores, ["kind", "w", "k"])
    scored = scored.groupBy("kind", "src", "id", "start", "stop", "value", "seed", "type").agg(F.reverse(F.sort_array(F.collect_list("s"))).alias("s"))
    scored = scored.withColumn("top", F.col("s")[0]).withColumn("two", (F.col("s")[0] + F.coalesce(F.get("s", F.lit(1)), F.lit(0.0))) / 2).withColumn("all", F.aggregate("s", F.lit(0.0), lambda x, y: x + y))
    best = Window.partitionBy("src", "id", "start").orderBy(F.desc(F.col("seed") == F.col("type")), F.desc("all"), "type")
    sure = (F.col("top") >= DECISIVE) | (F.col("two") >= ACCEPT) | (F.col("seed") == F.col("type"))
    formal = scored.where(sure).withColumn("b", F.row_number().over(best)).where("b = 1")
    formal = stored(formal.select("src", "id", F.col("type").alias("pii_type"), "start", "stop", F.col("value").alias("pii_value")), "formal")
    # names in confident patterns whose words nobody has seen
    both = patterns.where("kind = 'name'").select(F.col("pattern"), "s")
    unseen = candidates.where("kind = 'name'").join(both.select(F.col("pattern").alias("l"), F.col("s").alias("sl")), "l").join(both.select(F.col("pattern").alias("r"), F.col("s").alias("sr")), "r")
    unseen = unseen.where("sl >= 0.6 and sr >= 0.3 and 1 - (1 - sl) * (1 - sr) >= 0.85").select("src", "id", F.lit("name").alias("pii_type"), "start", "stop", F.col("value").alias("pii_value"))
    towns = stored(seen.where("kind = 'town'").select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n")).where("n >= 2").select("item"), "towns")
    words = items.where(f"kind = 'name' and s >= {NAME_WORD}").select("item")
    words = stored(words.join(towns.select(F.explode(F.split("item", " ")).alias("item")), "item", "left_anti"), "names")
    places = formal.where("pii_type = 'address'").select("src", "id", F.col("start").alias("at"))
    second = again(texts, words, towns, places)
    return apart(second.unionByName(formal.where("pii_type != 'address'")).unionByName(unseen))


_SPAN = pa.schema([("src", pa.string()), ("id", pa.int64()), ("pii_type", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("pii_value", pa.string())])
_KEYS = pa.schema([("of_src", pa.string()), ("of_id", pa.int64()), ("items", pa.list_(pa.string()))])
_SPAN_SQL = "src string, id bigint, pii_type string, start int, stop int, pii_value string"


def keys_of(texts: DataFrame, find: Callable[[str], list[str]]) -> DataFrame:
    """(of_src, of_id, item): the distinct keys of each text of (src, id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield _batch([(src, i, list(set(find(t)))) for src, i, t in zip(*(part.column(k).to_pylist() for k in range(3)))], _KEYS)

    return spread(texts.select("src", "id", "text"), 1).mapInArrow(run, "of_src string, of_id bigint, items array<string>").select("of_src", "of_id", F.explode("items").alias("item"))


def held_of(keys: DataFrame, known: DataFrame) -> DataFrame:
    """(of_src, of_id, known): the keys of each text that are among the known items."""
    return keys.join(known, "item").groupBy("of_src", "of_id").agg(F.collect_set("item").alias("known"))


def again(texts: DataFrame, names: DataFrame, towns: DataFrame, places: DataFrame) -> DataFrame:
    """Spans of known names in (src, id, text), and of addresses that begin at accepted places, with the towns known now."""
    spark = texts.sparkSession
    addressed = texts.join(places.groupBy("src", "id").agg(F.collect_set("at").alias("at")), ["src", "id"])
    few = names.count() <= MOST_SENT and towns.count() <= MOST_SENT
    if few:
        sent = spark.sparkContext.broadcast((frozenset(r[0] for r in names.collect()), frozenset(r[0] for r in towns.collect())))
        none = F.array().cast("array<string>")
        named, addressed = spread(texts, 1).withColumn("known", none), addressed.withColumn("known", none)
    else:
        sent = None
        # the keys are what known_names and addresses look up themselves, so both ways find the same
        held = held_of(keys_of(texts, lambda t: Words(t).plain()), names)
        same = texts["src"].eqNullSafe(held["of_src"]) & texts["id"].eqNullSafe(held["of_id"])
        named = texts.join(held, same)
        held = held_of(keys_of(addressed, lambda t: [w[0].lower() for m in _HEAD.finditer(t) for w in town_runs(t, m.end())]), towns)
        addressed = addressed.join(held, (addressed["src"] == held["of_src"]) & (addressed["id"] == held["of_id"]), "left")

    def find_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for src, i, t, known in zip(*(batch.column(k).to_pylist() for k in range(4))):
                rows += [(src, i, "name", a, b, t[a:b]) for a, b in known_names(Words(t), sent.value[0] if sent else set(known))]
            yield _batch(rows, _SPAN)

    def find_addresses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for src, i, t, known, at in zip(*(batch.column(k).to_pylist() for k in range(5))):
                rows += [(src, i, "address", a, b, t[a:b]) for a, b, *_ in addresses(t, sent.value[1] if sent else set(known or ())) if a in at]
            yield _batch(rows, _SPAN)

    return named.select("src", "id", "text", "known").mapInArrow(find_names, _SPAN_SQL).unionByName(addressed.select("src", "id", "text", "known", "at").mapInArrow(find_addresses, _SPAN_SQL))


def apart(spans: DataFrame) -> DataFrame:
    """The spans of each record that do not overlap one kept before: names after all others, then by start, the longer one first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for src, i, found in zip(*(batch.column(k).to_pylist() for k in range(3))):
                starts: list[int] = []
                stops: list[int] = []
                for s in sorted(found, key=lambda s: (s["pii_type"] == "name", s["start"], -s["stop"], s["pii_type"])):
                    k = bisect_left(starts, s["stop"])
                    if k == 0 or stops[k - 1] <= s["start"]:
                        starts.insert(k, s["start"])
                        stops.insert(k, s["stop"])
                        rows.append((src, i, s["pii_type"], s["start"], s["stop"], s["pii_value"]))
            yield _batch(rows, _SPAN)

    whole = spans.groupBy("src", "id").agg(F.collect_set(F.struct("pii_type", "start", "stop", "pii_value")).alias("found"))
    return whole.mapInArrow(run, _SPAN_SQL)


def redact(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(src, id, redacted, n_pii) of every record with a text; each span becomes its typed placeholder."""
    marks = spans.groupBy("src", "id").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "pii_type"))).alias("marks"))
    text, empty = F.col("text"), F.lit("")
    # the text is cut from the left, in the JVM: each step adds what lies before a span and its placeholder
    folded = F.aggregate(
        "marks",
        F.struct(empty.alias("out"), F.lit(0).alias("at")),
        lambda acc, m: F.struct(F.concat(acc["out"], F.substr(text, acc["at"] + 1, m["start"] - acc["at"]), F.lit("["), F.upper(m["pii_type"]), F.lit("]")).alias("out"), m["stop"].alias("at")),
    )
    out = texts.where("text is not null").join(marks, ["src", "id"], "left").withColumn("f", folded)
    return out.select("src", "id", F.when(F.col("marks").isNull(), text).otherwise(F.concat("f.out", F.substr(text, F.col("f.at") + 1))).alias("redacted"), F.coalesce(F.size("marks"), F.lit(0)).alias("n_pii"))
