"""Companies and roles of documents, found by joins of words with a list of names of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import patterns as P
from skein.functions import text as T

#: Words as word boundaries see them: a name between boundaries holds whole ones only.
WORD = r"\w+"
#: Characters of a text in which a company or role is looked for before the rest.
HEAD = 500


def candidates(docs: DataFrame, names: DataFrame) -> DataFrame:
    """(id, alias, canonical) of names (alias, canonical) whose first word stands in one of the texts of docs (id, texts).

    Only words are joined, and texts only meet the names that share one; a name without a word is not found.
    """
    first = names.where("alias is not null and canonical is not null").select(F.lower("alias").alias("alias"), "canonical")
    first = first.groupBy("alias").agg(F.min("canonical").alias("canonical")).withColumn("word", F.regexp_extract("alias", WORD, 0)).where("word != ''")
    said = F.array_distinct(F.flatten(F.transform("texts", lambda t: F.regexp_extract_all(F.lower(F.coalesce(t, F.lit(""))), F.lit(WORD), F.lit(0)))))
    return docs.select("id", F.explode(said).alias("word")).join(first, "word").select("id", "alias", "canonical")


def _bounded(before: str, alias: Column, after: str) -> Column:
    return F.concat(F.lit(before + r"\Q"), alias, F.lit(r"\E" + after))


def first_alias(docs: DataFrame, names: DataFrame, label: str) -> DataFrame:
    """(id, label): for docs (id, texts) the canonical name of the longest alias that stands between word boundaries in the first text with any."""
    met = candidates(docs, names).join(docs, "id")
    low = F.transform("texts", lambda t: F.lower(t))
    place = F.array_position(F.transform(low, lambda t: F.coalesce(F.contains(t, F.col("alias")) & F.regexp(t, _bounded(r"\b", F.col("alias"), r"\b")), F.lit(False))), True)
    found = met.select("id", "canonical", "alias", place.alias("place")).where("place > 0")
    return found.groupBy("id").agg(F.min(F.struct("place", (-F.length("alias")).alias("l"), "alias", "canonical")).alias("f")).select("id", F.col("f.canonical").alias(label))


def companies(docs: DataFrame, names: DataFrame) -> DataFrame:
    """(id, company) of docs (id, title, content): by the form of the title, else listed in title, head or whole text, else by capitals.

    names is (alias, canonical); what is found by form or capitals takes the canonical name of an alias that it equals, else capital initials.
    """
    texts = docs.select("id", F.array("title", F.substring("content", 1, HEAD), "content").alias("texts"))
    raw = docs.select("id", T.company_in_title(F.col("title")).alias("form"), F.coalesce(T.company_by_capitals(F.col("title")), T.company_by_capitals(F.substring("content", 1, HEAD))).alias("capital"))
    own = names.select(F.lower(F.trim("alias")).alias("k"), "canonical").groupBy("k").agg(F.min("canonical").alias("canonical"))

    def named(c: str) -> DataFrame:
        return raw.where(F.col(c).isNotNull()).select("id", F.trim(c).alias("v")).join(own, F.lower("v") == F.col("k"), "left").select("id", F.coalesce("canonical", F.initcap("v")).alias(f"by_{c}"))

    out = docs.select("id").join(named("form"), "id", "left").join(first_alias(texts, names, "listed"), "id", "left").join(named("capital"), "id", "left")
    return out.select("id", F.coalesce("by_form", "listed", "by_capital").alias("company"))


def roles(docs: DataFrame, names: DataFrame) -> DataFrame:
    """(id, role) of docs (id, title, content): alias and level in the title, else after a phrase in the head, else alone in title, head or text.

    names is (alias, canonical); of a place's aliases the longest counts; levels are written in digits.
    """
    level = r"[\s\-]*(\d{1,2}|i{1,3}|iv|vi{0,3}|ix|x)?"
    texts = docs.select("id", F.array("title", "content").alias("texts"))
    met = candidates(texts, names).join(docs.select("id", F.lower("title").alias("title"), F.lower(F.substring("content", 1, HEAD)).alias("head"), F.lower("content").alias("content")), "id")
    alias = F.col("alias")

    def tier(order: int, text: str, pattern: Column, with_level: bool) -> Column:
        hit = F.contains(F.col(text), alias) & F.regexp(F.col(text), pattern)
        n = F.call_function("regexp_extract", F.col(text), pattern, F.lit(1)) if with_level else F.lit("")
        return F.when(hit, F.struct(F.lit(order).alias("o"), F.coalesce(n, F.lit("")).alias("level")))

    tiers = [tier(0, "title", _bounded(r"\b", alias, level + r"\b"), True)]
    tiers += [tier(1 + i, "head", _bounded(t, alias, level), True) for i, t in enumerate(P.ROLE_TRIGGERS)]
    tiers += [tier(20 + i, c, _bounded(r"\b", alias, r"\b"), False) for i, c in enumerate(("title", "head", "content"))]
    found = met.select("id", "alias", "canonical", F.coalesce(*tiers).alias("t")).where("t is not null")
    best = found.groupBy("id").agg(F.min(F.struct("t.o", (-F.length("alias")).alias("l"), "alias", "canonical", "t.level")).alias("f"))
    digits = F.create_map(*[F.lit(x) for kv in P.ROMAN.items() for x in kv])
    n = F.coalesce(F.try_element_at(digits, F.col("f.level")), F.col("f.level"))
    # a level that is part of the canonical name is written in digits as well, where no level follows it
    plain = F.when(F.col("f.o") >= 20, _roman_to_digits(F.col("f.canonical"))).otherwise(F.col("f.canonical"))
    return best.select("id", F.when(n != "", F.concat("f.canonical", F.lit(" "), n)).otherwise(plain).alias("role"))


def _roman_to_digits(name: Column) -> Column:
    """Roman numerals of a name as digits."""
    digits = F.create_map(*[F.lit(x) for kv in P.ROMAN.items() for x in kv])
    word = lambda w: F.when(w.rlike(r"^(?:I{1,3}|IV|VI{0,3}|IX|X)$"), F.try_element_at(digits, F.lower(w))).otherwise(w)
    return F.array_join(F.transform(F.split(name, " "), word), " ")
