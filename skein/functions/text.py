"""Normalisation, redaction, quality and extraction as column expressions (all in the JVM but for NFC and HTML)."""

from __future__ import annotations

import html
import unicodedata
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions import patterns as P

#: White space of word splitting: the ASCII kinds, the same in every engine.
BLANK = r"[ \t\n\r\f]+"


def _quoted(word: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c not in " _" else c for c in word)


def words(text: Column) -> Column:
    """Runs of characters that are not white space; an empty array for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def platform(name: Column) -> Column:
    """Canonical platform name; unknown ones are trimmed and lower-cased."""
    key = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    table = F.create_map(*[F.lit(x) for kv in P.PLATFORMS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, key), key)


def replace_all(text: Column, rules) -> Column:
    """Apply (pattern, replacement) rules in order."""
    return reduce(lambda t, r: F.regexp_replace(t, r[0], r[1]), rules, text)


def straight_quotes(text: Column) -> Column:
    """Typographic characters as plain ones; marks without meaning removed."""
    return reduce(lambda t, kv: F.replace(t, F.lit(kv[0]), F.lit(kv[1])), P.ENCODING.items(), text)


def strip_markdown(text: Column) -> Column:
    return replace_all(text, P.MARKDOWN)


def strip_emoji(text: Column) -> Column:
    inside = "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in P.EMOJI)
    return F.regexp_replace(text, f"[{inside}]+", "")


def strip_boilerplate(text: Column, canonical_platform: Column) -> Column:
    """Platform rules first, then the general ones."""
    by_platform = text
    for name, rules in P.PLATFORM_BOILERPLATE.items():
        by_platform = F.when(canonical_platform == name, replace_all(text, [(r, "") for r in rules])).otherwise(by_platform)
    return replace_all(by_platform, [(r, "") for r in P.BOILERPLATE])


def squeeze(text: Column) -> Column:
    """Single blanks, at most one empty line, no blanks before line ends, trimmed."""
    rules = ((r"[^\S\n]+", " "), (r"\n{3,}", "\n\n"), (r"\n\s+\n", "\n\n"), (r" +\n", "\n"))
    return F.regexp_replace(replace_all(text, rules), r"^\s+|\s+$", "")


class _Reader(HTMLParser):
    """Text of HTML without page furniture, with line breaks before block elements."""

    SKIP = {"script", "style", "nav", "footer", "header", "aside", "noscript"}
    BREAK = {"p", "div", "br", "h1", "h2", "h3", "h4", "h5", "h6", "li", "tr"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.hidden += 1
        elif tag in self.BREAK and not self.hidden:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in self.SKIP and self.hidden:
            self.hidden -= 1

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def html_to_text(text: str) -> str:
    """Python form of the HTML reader; texts without a tag pass through."""
    if "<" not in text:
        return text
    reader = _Reader()
    reader.feed(text)
    reader.close()
    return "".join(reader.out)


def decode_markup(texts: pd.Series) -> pd.Series:
    """Unescape entities, undo UTF-8 read as Latin-1 where it can be, read HTML, compose to NFC."""

    def one(t):
        if t is None:
            return None
        t = html.unescape(t)
        try:
            t = t.encode("latin-1").decode("utf-8")
        except (UnicodeDecodeError, UnicodeEncodeError):
            pass
        return unicodedata.normalize("NFC", html_to_text(t))

    return texts.map(one, na_action="ignore")


def readable(text: Column) -> Column:
    """Arrow-batched `decode_markup`; texts without anything to decode stay in the JVM's hands until then."""
    return F.pandas_udf(decode_markup, "string")(text)


def normalise(text: Column, source: Column) -> Column:
    """The whole normaliser: encoding, HTML, Markdown, boilerplate, emoji, NFC, white space."""
    t = straight_quotes(readable(text))
    return squeeze(strip_emoji(strip_boilerplate(strip_markdown(t), platform(source))))


def clean_title(title: Column) -> Column:
    """A title decoded, with plain quotes and single blanks, without emoji."""
    return squeeze(strip_emoji(straight_quotes(readable(F.coalesce(title, F.lit(""))))))


def redact(text: Column, rules=P.REDACTION) -> Column:
    """Typed placeholders for everything that a rule matches, in order."""
    return replace_all(text, [(p, f"[{t.upper()}]") for t, p in rules])


def _bind(value: Column, f) -> Column:
    """f(value) with the value computed once, however often f uses it."""
    return F.transform(F.array(value), f)[0]


def redact_and_count(text: Column, rules=P.REDACTION) -> Column:
    """struct<text, counts>: the redacted text and a map of the matches of each type; types without any are left out.

    Every rule runs once, on the text that the rules before it have left.
    """

    def step(i: int, t: Column, counts: list[tuple[str, Column]]) -> Column:
        if i == len(rules):
            seen: dict[str, Column] = {}
            for kind, n in counts:
                seen[kind] = seen[kind] + n if kind in seen else n
            pairs = F.create_map(*[x for k, v in seen.items() for x in (F.lit(k), v)])
            return F.struct(t.alias("text"), F.map_filter(pairs, lambda k, v: v > 0).alias("counts"))
        kind, pattern = rules[i]
        return _bind(t, lambda x: step(i + 1, F.regexp_replace(x, pattern, f"[{kind.upper()}]"), [*counts, (kind, F.regexp_count(x, F.lit(pattern)))]))

    return step(0, text, [])


def redaction_counts(text: Column, rules=P.REDACTION) -> Column:
    """map<type, count> of the matches that `redact` replaces."""
    return redact_and_count(text, rules)["counts"]


# ---- quality -------------------------------------------------------------------------------------------------------


def signal_ratio(text: Column, signal=P.SIGNAL) -> Column:
    """Share of words that are exactly a signal word; 0 for texts without words."""
    w = words(F.lower(text))
    hits = F.size(F.filter(w, lambda x: x.isin(*signal)))
    return F.when(F.size(w) > 0, hits / F.size(w)).otherwise(F.lit(0.0))


def is_error_page(text: Column, rules=P.ERROR_PAGE) -> Column:
    return F.coalesce(F.substring(text, 1, 500).rlike("(?i)(?:" + "|".join(rules) + ")"), F.lit(False))


def quality_score(n_words: Column, ratio: Column) -> Column:
    """Half length, half signal; rounded to three places."""
    length = F.when(n_words < 200, n_words / 200.0).when(n_words <= 2000, F.lit(1.0)).otherwise(F.greatest(F.lit(0.5), 1.0 - (n_words - 2000) / 10000.0))
    return F.round(0.5 * length + 0.5 * F.least(F.lit(1.0), ratio / 0.10), 3)


#: Letters of scripts that stand for one language here: language, pattern of one letter. Kana comes before the ideographs.
SCRIPTS = (("ru", r"[\x{0400}-\x{04FF}]"), ("hi", r"[\x{0900}-\x{097F}]"), ("ja", r"[\x{3040}-\x{30FF}]"), ("zh", r"[\x{4E00}-\x{9FFF}]"), ("ko", r"[\x{AC00}-\x{D7A3}]"), ("ar", r"[\x{0600}-\x{06FF}]"), ("el", r"[\x{0370}-\x{03FF}]"))
#: Function words by which a language in Latin letters is voted for; a parameter of `language`.
STOP_WORDS = {
    "en": "the and of to in that is was for with i my they it on we this at are be",
    "es": "el la los de que y en un una por con se no para es las del al fue lo",
    "fr": "le la les de et un une des est dans que pour il je en au du sur pas avec",
    "de": "der die das und ich ist nicht ein eine zu mit den war im auf für es wir sie von",
    "pt": "o a os de que e um uma em para com não foi se do da no na ao as",
    "it": "il la di che e un una per con non sono del della gli in si le da come anche",
    "nl": "de het een en van ik is niet op te dat met voor zijn was er aan ook als naar",
}


def language(text: Column, lists: dict[str, str] = STOP_WORDS, chars: int = 1000, least: int = 50, keywords=P.SIGNAL) -> Column:
    """The language of the beginning of a text: by script where most letters are of one, else by function words; `en` for short texts.

    Japanese needs a tenth of its letters in kana. A text without letters, from which nothing can be said, counts as `en`,
    and so does one without function words that has an English keyword; other Latin letters are `und`.
    """

    def vote(head: Column) -> Column:
        n = lambda p: F.regexp_count(head, F.lit(p))
        latin = n(r"[A-Za-z\x{00C0}-\x{024F}]")
        script = F.array_max(F.array(*[F.struct((n(p) * (10 if k == "ja" else 1)).alias("n"), F.lit(-i).alias("o"), F.lit(k).alias("l")) for i, (k, p) in enumerate(SCRIPTS)]))
        found = words(F.regexp_replace(F.lower(head), r"[.,;:!?()\"]", " "))
        count = lambda v: F.size(F.filter(found, lambda w: w.isin(*v.split())))
        word = F.array_max(F.array(*[F.struct(count(v).alias("n"), F.lit(-i).alias("o"), F.lit(k).alias("l")) for i, (k, v) in enumerate(lists.items())]))
        return F.when(script["n"] > latin, script["l"]).when(latin == 0, "en").when(word["n"] > 0, word["l"]).when(F.exists(found, lambda w: w.isin(*keywords)), "en").otherwise("und")

    return F.when(F.length(text) < least, F.lit("en")).otherwise(_bind(F.substring(text, 1, chars), vote))


def rejection(text: Column, n_words: Column) -> Column:
    """The first failing quality test, or null."""
    return (
        F.when(n_words < P.MIN_WORDS, F.concat(F.lit("too_short_"), n_words.cast("string"), F.lit("_words")))
        .when(n_words > P.MAX_WORDS, F.concat(F.lit("too_long_"), n_words.cast("string"), F.lit("_words")))
        .when(is_error_page(text), F.lit("error_or_junk_page"))
        .when(signal_ratio(text) < P.MIN_SIGNAL, F.lit("low_interview_signal"))
    )


# ---- extraction ----------------------------------------------------------------------------------------------------


def holds_any(text: Column, keywords: list[str]) -> Column:
    """Whether a keyword stands in the text between word boundaries."""
    return text.rlike(r"\b(?:" + "|".join(_quoted(k) for k in keywords) + r")\b")


def first_match(text: Column, table: dict[str, list[str]], default: str | None = "unknown") -> Column:
    """The first key, in order, one of whose keywords the lower-cased text holds."""
    low = F.lower(text)
    return F.coalesce(*[F.when(holds_any(low, v), F.lit(k)) for k, v in table.items()], F.lit(default))


def all_matches(text: Column, table: dict[str, list[str]], default: str | None = None) -> Column:
    """All keys with a keyword in the lower-cased text, in order; [default] where none has."""
    low = F.lower(text)
    found = F.filter(F.array(*[F.when(holds_any(low, v), F.lit(k)) for k, v in table.items()]), lambda x: x.isNotNull())
    return found if default is None else F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(default)))


def outcome(text: Column) -> Column:
    """The outcome named in the last 30 % of a text, else anywhere."""
    start = F.floor(F.length(text) * 0.7).cast("int")
    return F.coalesce(first_match(F.substr(text, start + 1), P.OUTCOMES, None), first_match(text, P.OUTCOMES))


def num_rounds(text: Column) -> Column:
    """The larger of the largest stated count and the number of distinct round markers; null for none."""
    stated = F.transform(F.regexp_extract_all(text, F.lit(P.ROUND_COUNT), F.lit(1)), lambda x: F.try_to_number(x, F.lit("9999")).cast("int"))
    marks = F.flatten(F.array(*[F.regexp_extract_all(text, F.lit(m), F.lit(1)) for m in P.ROUND_MARKERS]))
    marks = F.array_distinct(F.transform(marks, lambda m: F.trim(F.lower(m))))
    n = F.greatest(F.coalesce(F.array_max(stated), F.lit(0)), F.size(marks))
    return F.when(n > 0, n)


def company_in_title(title: Column) -> Column:
    """The company that a title names: the first pattern whose match has 2 to 50 characters."""
    found = [F.trim(F.regexp_extract(title, p, 1)) for p in P.TITLE_COMPANY]
    return F.coalesce(*[F.when(F.length(f).between(2, 50), f) for f in found])


#: A run of capitalised words after a word or comma.
CAPITALS = r"[a-z,] ([A-Z][\w&]+(?: [A-Z][\w&]+){0,2})"


def company_by_capitals(text: Column, blocked=P.NOT_COMPANIES) -> Column:
    """The first run of capitalised words inside a sentence, of 2 to 50 characters and not blocked: the fallback without a trained tagger."""
    runs = F.regexp_extract_all(text, F.lit(CAPITALS), F.lit(1))
    return F.get(F.filter(runs, lambda r: ~F.lower(r).isin(*blocked) & F.length(r).between(2, 50)), F.lit(0))


def safe_enum(value: Column, allowed: list[str]) -> Column:
    """The trimmed lower-cased value if it is allowed, else null."""
    v = F.lower(F.trim(value))
    return F.when(v.isin(*allowed), v)


def lenient_bool(value: Column) -> Column:
    return F.coalesce(F.lower(F.trim(value.cast("string"))).isin("1", "true", "yes", "y", "on"), F.lit(False))


def lenient_int(value: Column, default: int) -> Column:
    return F.coalesce(F.trim(value.cast("string")).try_cast("int"), F.lit(default))


def parse_grade(response: Column) -> Column:
    """The grade 0, 1 or 2 of a judge's answer: JSON first, else the first such digit, else -1."""
    bare = F.trim(F.regexp_replace(response, r"```(?:json)?", ""))
    parsed = F.try_variant_get(F.try_parse_json(bare), "$.relevance", "int")
    digit = F.regexp_extract(bare, "[012]", 0)
    return F.coalesce(F.when(parsed.isin(0, 1, 2), parsed), F.when(digit != "", digit.try_cast("int")), F.lit(-1))


def clipped(text: Column, chars: int = 1500) -> Column:
    return F.when(F.length(text) > chars, F.concat(F.substring(text, 1, chars), F.lit("..."))).otherwise(text)


def error_category(message: Column) -> Column:
    """Category of a fetch error by the first substring found."""
    low = F.lower(F.coalesce(message, F.lit("")))
    return F.coalesce(*[F.when(reduce(lambda a, b: a | b, [F.contains(low, F.lit(x)) for x in subs]), F.lit(k)) for k, subs in P.FETCH_ERRORS], F.lit("other"))


def document_key(source: Column, url: Column) -> Column:
    """platform_ and six characters of the URL-safe digest of the address."""
    digest = F.base64(F.unhex(F.sha2(url, 256)))
    return F.concat(source, F.lit("_"), F.substring(F.translate(digest, "+/", "-_"), 1, 6))


def content_hash(text: Column) -> Column:
    """Digest of the lower-cased text with single blanks."""
    return F.sha2(F.trim(F.regexp_replace(F.lower(text), BLANK, " ")), 256)


def published(value: Column) -> Column:
    """A timestamp from any of the formats in use; null where none fits."""
    v = F.trim(value)
    forms = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd MMM, yyyy", "d MMM, yyyy", "MMM d, yyyy", "dd/MM/yyyy")
    return F.coalesce(*[F.try_to_timestamp(v, F.lit(f)) for f in forms])


def embedding_column(model: Column) -> Column:
    """Column of a model's vectors: the last part of its name in lower case with underscores."""
    return F.lower(F.concat(F.lit("embeddings_"), F.replace(F.substring_index(model, "/", -1), F.lit("-"), F.lit("_"))))


def run_name(model: Column, dims: Column, mode: Column, vector_weight: Column, lexical_weight: Column, k: Column) -> Column:
    """Name of an evaluation run: model and dimensions, then the mode, with its weights where it is hybrid."""
    base = F.concat(model, F.lit("_dim"), dims.cast("string"))
    hybrid = F.concat(base, F.lit("_hybrid_v"), vector_weight.cast("string"), F.lit("_b"), lexical_weight.cast("string"), F.lit("_rrf"), k.cast("string"))
    return F.when(mode == "hybrid", hybrid).otherwise(F.concat(base, F.lit("_"), mode))


def report_name(completed: Column) -> Column:
    """File name of a load report, from the time it was completed at."""
    return F.concat(F.lit("db_load_"), F.date_format(completed, "yyyyMMdd'T'HHmmss"), F.lit(".json"))
