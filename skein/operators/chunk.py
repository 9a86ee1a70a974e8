"""Splitting documents into windows and rounds: one row per chunk, with offsets and headers."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import patterns as P
from skein.functions import text as T

#: Any beginning of a round, at the start of a line.
ROUND = r"(?:^|\n)\s*(?:" + "|".join(P.ROUND_START) + ")"
_ROUND = re.compile(ROUND, re.I | re.M)
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
SCHEMA = "document_id string, chunk_index int, total_chunks int, chunk_text string, raw_text string, word_count int, char_start_offset int, char_end_offset int, strategy string, round_label string"


def strategy(text: Column, least: int = P.MIN_CHUNK_DOC) -> Column:
    """single_chunk for short texts, structural where a round begins, else fixed_window."""
    return F.when(T.word_count(text) < least, F.lit("single_chunk")).when(text.rlike("(?im)" + ROUND), F.lit("structural")).otherwise(F.lit("fixed_window"))


def sentences(text: Column) -> Column:
    return F.filter(F.split(text, r"(?<=[.!?])\s+"), lambda s: F.trim(s) != "")


def header(company: Column, role: Column, label: Column, index: Column, total: Column) -> Column:
    """`Company: … | Role: … | Round: … | Part: i of n | ` without the parts that are missing."""
    part = F.when(total > 1, F.concat(F.lit("Part: "), (index + 1).cast("string"), F.lit(" of "), total.cast("string")))
    named = [F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{n}: "), c)) for n, c in (("Company", company), ("Role", role), ("Round", label))]
    text = F.concat_ws(" | ", *named, part)
    return F.when(text != "", F.concat(text, F.lit(" | "))).otherwise(F.lit(""))


def windows(text: str, size: int = P.CHUNK_WORDS, overlap: int = P.OVERLAP_WORDS) -> list[str]:
    """Sentences packed up to `size` words; each window begins with the last sentences before it, up to `overlap` words."""
    parts = [(s, len(s.split())) for s in _SENTENCE.split(text) if s.strip()]
    out: list[str] = []
    held: list[tuple[str, int]] = []
    for s in parts:
        if held and sum(n for _, n in held) + s[1] > size:
            out.append(" ".join(x for x, _ in held))
            keep = 0
            while keep < len(held) and sum(n for _, n in held[-keep - 1 :]) <= overlap:
                keep += 1
            held = held[len(held) - keep :]
        held.append(s)
    return [*out, " ".join(x for x, _ in held)] if held else out


def label_of(text: str, start: int) -> str:
    """The first line from a round's beginning, up to 60 characters."""
    while start < len(text) and text[start].isspace():
        start += 1
    line, found, _ = text[start : start + 81].partition("\n")
    return (line if found else text[start : start + 80]).strip()[:60].strip()


def segments(text: str) -> tuple[str, list[tuple[str | None, str]]]:
    """The strategy of a text and its (label, segment) pairs."""
    n = len(text.split())
    starts = [m.start() for m in _ROUND.finditer(text)]
    if n < P.MIN_CHUNK_DOC:
        return "single_chunk", [(None, text)]
    if not starts:
        return "fixed_window", [(None, w) for w in windows(text)]
    out: list[tuple[str | None, str]] = []
    if before := text[: starts[0]].strip():
        out.append(("Preamble", before))
    for a, b in zip(starts, [*starts[1:], len(text)]):
        if part := text[a:b].strip():
            out.append((label_of(text, a), part))
    wide: list[tuple[str | None, str]] = []
    for label, part in out:
        if len(part.split()) <= P.CHUNK_WORDS:
            wide.append((label, part))
        else:
            wide += [(f"{label} (part {j})" if label else f"part {j}", w) for j, w in enumerate(windows(part), 1)]
    return "structural", wide


def chunk_documents(df: DataFrame, id_col: str = "document_id", text_col: str = "content", company: str = "company", role: str = "role") -> DataFrame:
    """One row per chunk. Packing sentences is sequential inside a document, so it runs in Arrow batches; headers and offsets are expressions.

    Null and blank texts give no chunk; a sentence beyond the window size stays whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                text = r[1].strip().replace("\r\n", "\n").replace("\r", "\n")
                kind, parts = segments(text)
                for i, (label, part) in enumerate(parts):
                    at = text.find(part)
                    rows.append((r[0], r[2], r[3], i, len(parts), part, len(part.split()), at if at >= 0 else 0, at + len(part) if at >= 0 else len(text), kind, label))
            yield pd.DataFrame(rows, columns=["document_id", "c", "r", "chunk_index", "total_chunks", "raw_text", "word_count", "char_start_offset", "char_end_offset", "strategy", "round_label"])

    pick = df.select(F.col(id_col).cast("string"), F.col(text_col), F.col(company).cast("string"), F.col(role).cast("string")).where(F.col(text_col).rlike(r"\S"))
    raw = pick.mapInPandas(run, "document_id string, c string, r string, chunk_index int, total_chunks int, raw_text string, word_count int, char_start_offset int, char_end_offset int, strategy string, round_label string")
    head = header(F.col("c"), F.col("r"), F.col("round_label"), F.col("chunk_index"), F.col("total_chunks"))
    # the id follows from the content, so a repeated run gives the same rows
    out = raw.withColumn("chunk_text", F.concat(head, F.col("raw_text"))).withColumn("chunk_id", F.sha2(F.concat_ws("|", "document_id", "chunk_index", "raw_text"), 256))
    return out.select("chunk_id", "document_id", "chunk_index", "total_chunks", "chunk_text", "raw_text", "word_count", "char_start_offset", "char_end_offset", "strategy", "round_label")


def violations(chunks: DataFrame) -> DataFrame:
    """Counts of chunks without document, above the size limit, and without the header their position needs."""
    limit = int(P.CHUNK_WORDS * 1.1)
    return chunks.agg(
        F.count("*").alias("n_chunks"),
        F.count_if(F.coalesce(F.col("document_id"), F.lit("")) == "").alias("missing_document"),
        F.count_if(F.col("word_count") > limit).alias("too_long"),
        F.count_if((F.col("total_chunks") > 1) & ~F.contains("chunk_text", F.lit("Part: "))).alias("missing_part"),
    )
