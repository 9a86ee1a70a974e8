"""Pages and API answers to rows: article HTML, metadata, paywalls, embedded state, comments."""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The article container of a page, elements left out of it, least lengths of a text.
ARTICLE_CLASS, TAGS_CLASS, SKIPPED, LEAST_CLEAN, LEAST_ARTICLE = "article--viewer", "HeadingAndChipComponent_mainContainer__dataChips", {"script", "style", "nav", "footer", "aside"}, 50, 100
#: Markdown of the paragraph types of an embedded state.
PARAGRAPHS = {"H2": "## ", "H3": "### ", "H4": "#### ", "PQ": "> ", "BQ": "> ", "OLI": "1. ", "ULI": "- "}
#: Signs of a paywall in order: reason, pattern.
PAYWALL = (
    ("paywall_class", r"(?i)class=\"[^\"]*(?:paywall|meteredContent)"),
    ("member_badge", r"(?i)member-only\s+story"),
    ("structured_data", r"\"isAccessibleForFree\"\s*:\s*(?:false|\"False\")"),
    ("locked_state", r"\"isLocked\"\s*:\s*true"),
    ("preview", r"\"isLockedPreviewOnly\"\s*:\s*true"),
    ("call_to_action", r"(?i)(?:create an account|sign up) to read the full story"),
)
VOID = {"br", "img", "hr", "input", "meta", "link", "source", "area", "base", "col", "embed", "param", "track", "wbr"}


class Article(HTMLParser):
    """First heading, text of the article container (or of the body), tags and dates of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.inside, self.body, self.tags = "", [], [], []
        self.meta: dict[str, str] = {}
        self.stack: list[tuple[str, bool, bool, bool]] = []  # name, begins the container, is skipped, begins the tags

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "meta" and (name := a.get("property") or a.get("name")):
            self.meta.setdefault(name.lower(), a.get("content") or "")
        elif tag == "link" and "canonical" in (a.get("rel") or "").lower().split():
            self.meta.setdefault("canonical", a.get("href") or "")
        if tag in VOID:
            return
        classes = a.get("class") or ""
        self.stack.append((tag, tag == "div" and ARTICLE_CLASS in classes, tag in SKIPPED or tag == "header", tag == "div" and TAGS_CLASS in classes))

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                break

    def handle_data(self, data):
        text = data.strip()
        if not text:
            return
        names = [s[0] for s in self.stack]
        if "h1" in names and not self.title:
            self.title = text
        if "a" in names and any(s[3] for s in self.stack) and text not in self.tags:
            self.tags.append(text)
        skipped = [s[0] for s in self.stack if s[2]]
        if any(s[1] for s in self.stack) and not [s for s in skipped if s != "header"]:
            self.inside.append(text)
        if "head" not in names and "title" not in names and not skipped:
            self.body.append(text)


def parse_articles(pages: DataFrame, url: str, page: str) -> DataFrame:
    """(url, title, content, tags, last_updated) of HTML pages; pages without text are left out, a missing heading is `Untitled`."""

    @F.pandas_udf("title string, content string, tags array<string>")
    def read(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            a = Article()
            a.feed(t or "")
            a.close()
            rows.append((a.title or "Untitled", "\n".join(a.inside or a.body), a.tags))
        return pd.DataFrame(rows, columns=["title", "content", "tags"])

    out = pages.select(F.col(url).alias("url"), read(page).alias("a"), F.col(page).alias("html"))
    return out.select("url", "a.title", "a.content", "a.tags", last_updated("html").alias("last_updated")).where("content != ''")


def last_updated(page: str) -> Column:
    return F.nullif(F.regexp_extract(page, r"(?i)Last\s+Updated\s*:\s*(\d{1,2}\s+\w+,?\s*\d{4})", 1), F.lit(""))


def experience_type(tags: Column, title: Column) -> Column:
    """on-campus, off-campus, internship or unknown, from tags and title."""
    t = F.lower(F.concat_ws(" ", F.array_join(tags, " "), title))
    return F.when(t.rlike("on.?campus"), "on-campus").when(t.rlike("off.?campus"), "off-campus").when(F.contains(t, F.lit("intern")), "internship").otherwise("unknown")


def bare_content(text: Column) -> Column:
    """Tags as line breaks, at most one empty line, single blanks."""
    t = F.regexp_replace(F.regexp_replace(text, "<[^>]+>", "\n"), r"\n{3,}", "\n\n")
    return F.trim(F.regexp_replace(t, "[ \t]+", " "))


def company_of_tags(tags: Column, title: Column, known: list[str]) -> Column:
    """The company tag, else a known name among the tags, else the first known name in the title."""
    tagged = F.get(F.transform(F.filter(tags, lambda t: t["tagType"] == "COMPANY"), lambda t: t["name"]), F.lit(0))
    names = F.transform(tags, lambda t: F.lower(t["name"]))
    by_tag = F.coalesce(*[F.when(F.array_contains(names, k.lower()), F.lit(k)) for k in known])
    by_title = F.coalesce(*[F.when(F.contains(F.lower(title), F.lit(k.lower())), F.lit(k)) for k in known])
    return F.coalesce(tagged, by_tag, by_title)


def comments(answers: Column) -> Column:
    """Visible comments of an answer: array<struct<content, hidden>> to array<string>."""
    return F.transform(F.filter(answers, lambda c: ~F.coalesce(c["hidden"], F.lit(False))), lambda c: c["content"])


def paywall(page: Column) -> Column:
    """The first sign of a paywall, or null."""
    return F.coalesce(*[F.when(page.rlike(p), F.lit(reason)) for reason, p in PAYWALL])


def page_metadata(page: Column, state: Column | None = None) -> Column:
    """struct<description, image, canonical, reading_time, reading_minutes, tags> of a page, its attributes in any order; tags come from an embedded JSON state."""

    @F.pandas_udf("description string, image string, canonical string, reading_time string")
    def read(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            a = Article()
            a.feed(t or "")
            a.close()
            m = a.meta
            rows.append((m.get("og:description", m.get("description")) or None, m.get("og:image") or None, m.get("canonical") or None, m.get("twitter:data1") or None))
        return pd.DataFrame(rows, columns=["description", "image", "canonical", "reading_time"])

    m = read(page)
    minutes = F.nullif(F.regexp_extract(page, r"(?i)(\d+)\s+min(?:ute)?s?\s+read", 1), F.lit("")).cast("int")
    tags = F.array().cast("array<string>") if state is None else state_tags(state)
    return F.struct(m["description"].alias("description"), m["image"].alias("image"), m["canonical"].alias("canonical"), m["reading_time"].alias("reading_time"), minutes.alias("reading_minutes"), tags.alias("tags"))


def state_tags(state: Column) -> Column:
    """Distinct titles (else ids) of the `Tag:` entries of an embedded JSON state."""
    entries = F.map_entries(F.from_json(state, "map<string, struct<displayTitle: string, id: string>>"))
    own = F.transform(F.filter(entries, lambda e: e["key"].startswith("Tag:")), lambda e: F.coalesce(F.nullif(e["value"]["displayTitle"], F.lit("")), e["value"]["id"]))
    return F.coalesce(F.array_distinct(F.array_compact(own)), F.array().cast("array<string>"))


#: An answer of the discussion service: an article, what its list says of it, and pages of comments.
ANSWER = (
    "topicId string, slug string, title string, content string, createdAt string, hitCount long, reactions array<struct<reactionType: string, count: long>>, "
    "tags array<struct<name: string, slug: string, tagType: string>>, comments array<struct<id: string, content: string, hidden: boolean>>"
)


def answers(df: DataFrame, body: str, base_url: str, known: list[str], least: int = LEAST_CLEAN, pages: int = 5, per_page: int = 20) -> DataFrame:
    """Documents of JSON answers: address, cleaned text, tags, reactions as a map, company, the visible comments of the first pages.

    Answers that are no JSON, have no content, or fewer than `least` characters after cleaning are left out.
    """
    a = df.select("*", F.from_json(body, ANSWER).alias("_a")).where("_a.content is not null")
    reactions = F.map_from_entries(F.transform(F.coalesce("_a.reactions", F.array().cast("array<struct<reactionType: string, count: long>>")), lambda r: F.struct(F.coalesce(r["reactionType"], F.lit("UNKNOWN")), F.coalesce(r["count"], F.lit(0)))))
    names = F.filter(F.transform("_a.tags", lambda t: t["name"]), lambda n: n != "")
    shown = comments(F.slice(F.coalesce("_a.comments", F.array().cast("array<struct<id: string, content: string, hidden: boolean>>")), 1, pages * per_page))
    out = a.select(
        *[c for c in df.columns if c != body],
        F.concat(F.lit(base_url), F.coalesce("_a.topicId", F.lit("")), F.lit("/"), F.coalesce("_a.slug", F.lit("")), F.lit("/")).alias("source_url"),
        F.coalesce("_a.title", F.lit("Untitled")).alias("title"),
        bare_content(F.col("_a.content")).alias("raw_content"),
        F.col("_a.createdAt").alias("published_at"),
        names.alias("tags"),
        reactions.alias("reactions"),
        company_of_tags(F.col("_a.tags"), F.coalesce("_a.title", F.lit("")), known).alias("company"),
        F.transform(shown, bare_content).alias("comments"),
    )
    return out.where(F.length(F.trim("raw_content")) >= least)


def state_to_markdown(state: Column) -> Column:
    """Paragraphs `Paragraph:<id>_<n>` of an embedded JSON state in order of n, as Markdown by their type."""
    entries = F.map_entries(F.from_json(state, "map<string, struct<text: string, type: string>>"))
    own = F.filter(entries, lambda e: e["key"].startswith("Paragraph:"))
    ordered = F.array_sort(F.transform(own, lambda e: F.struct(F.coalesce(F.element_at(F.split(e["key"], "_"), -1).try_cast("int"), F.lit(0)).alias("n"), e["value"].alias("v"))))
    marks = F.create_map(*[F.lit(x) for kv in PARAGRAPHS.items() for x in kv])
    line = lambda v: F.when(v["type"] == "PRE", F.concat(F.lit("```\n"), v["text"], F.lit("\n```"))).otherwise(F.concat(F.coalesce(F.try_element_at(marks, v["type"]), F.lit("")), v["text"]))
    return F.array_join(F.transform(ordered, lambda x: line(x["v"])), "\n\n")


def html_markdown(text: str) -> str:
    """A small HTML to Markdown writer for article bodies."""
    t = re.sub(r"(?is)<(script|style|nav|footer|aside)\b.*?</\1>", "", text)
    t = re.sub(r"(?is)<h([1-6])[^>]*>(.*?)</h\1>", lambda m: "\n\n" + "#" * int(m[1]) + " " + m[2].strip() + "\n\n", t)
    t = re.sub(r"(?is)<pre[^>]*>(.*?)</pre>", lambda m: "\n\n```\n" + re.sub(r"<[^>]+>", "", m[1]) + "\n```\n\n", t)
    t = re.sub(r"(?i)<li[^>]*>", "\n- ", t)
    t = re.sub(r"(?i)<(?:br|/p|/div)[^>]*>", "\n\n", t)
    return re.sub(r"\n{3,}", "\n\n", html.unescape(re.sub(r"<[^>]+>", "", t))).strip()


def article_fallbacks(pages: DataFrame, page: str, state: str | None = None) -> DataFrame:
    """Add `content`: the embedded state, else <article>, else <main>, else the long paragraphs; texts below the least length are null."""
    pick = lambda p: F.nullif(F.regexp_extract(page, p, 1), F.lit(""))
    long = F.filter(F.regexp_extract_all(page, F.lit(r"(?is)<p[^>]*>(.*?)</p>"), F.lit(1)), lambda x: F.length(x) > 15)
    raw = F.coalesce(pick(r"(?is)<article[^>]*>(.*)</article>"), pick(r"(?is)<div[^>]+class=\"[^\"]*postArticle[^\"]*\"[^>]*>(.*)</div>"), pick(r"(?is)<main[^>]*>(.*)</main>"), F.when(F.size(long) >= 2, F.array_join(long, "\n\n")))
    write = F.pandas_udf(lambda s: s.map(html_markdown, na_action="ignore"), "string")
    text = write(raw)
    if state:
        text = F.coalesce(F.nullif(state_to_markdown(F.col(state)), F.lit("")), text)
    return pages.withColumn("content", text).withColumn("content", F.when(F.length("content") >= LEAST_ARTICLE, F.col("content")))
