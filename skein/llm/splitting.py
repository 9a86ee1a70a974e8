"""Problem 3: splitting oversized items at natural boundaries by structure-tree packing.

A text is read as a tree: sections by heading level, blocks (paragraph, list, fenced code), lines
or list items, sentences, clauses, words. Sibling subtrees are merged in order up to the limit, and
only a node that exceeds the limit is opened. What is left of an opened node is not joined with the
node's own siblings: a piece lies inside one parent. Pieces are verbatim spans, their bodies joined give
the text again; every piece but the first also repeats up to `overlap` words before its body,
starting at a sentence where one starts there, and the repeated part counts towards both limits.

Defined results: null text gives no piece; empty and blank texts and texts within the limits give
one piece, the text itself; a single run longer than the limits is cut between code points, not
before a combining mark; repeated rows give repeated pieces; extra columns are not read.
Only oversized texts reach Python; the test for size runs in the JVM.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm._common import spread

MAX_WORDS, MAX_CHARS, OVERLAP_WORDS, OVERLAP_CHARS = 500, 4000, 50, 400
#: The Unicode White_Space characters, the same for Java and Python.
SPACE = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
WORD_RUN = f"[^{SPACE}]+"
_WORD = re.compile(WORD_RUN)
_LINE = re.compile(r"[^\r\n\u2028\u2029]*(?:\r\n|[\r\n\u2028\u2029]|\Z)")
_SENTENCE = re.compile(rf"[.!?…。！？।]+[\"'”’»)\]]*[{SPACE}]+|[。！？।]")
_CLAUSE = re.compile(rf"[,;:、，；–—][{SPACE}]*")
_HASH = re.compile(r"[ \t]{0,3}(#{1,6})[ \t]")
_WIKI = re.compile(r"[ \t]*(={2,6})[^=].*?\1[ \t]*$")
_HTML = re.compile(r"[ \t]*<h([1-6])\b", re.I)
_TEX = re.compile(r"[ \t]*\\(part|chapter|section|subsection|subsubsection|paragraph)\b")
_LABEL = re.compile(r"[ \t]*(?:round|stage|part|step|phase|day)[ \t]*\d+\b[^.!?]{0,60}$", re.I)
_RULE = re.compile(r"[ \t]{0,3}(=+|-+)[ \t]*$")
_ITEM = re.compile(r"[ \t]*(?:[-*+•]|\d{1,3}[.)])[ \t]+\S")
_FENCE = re.compile(r"[ \t]*(```|~~~)")


class Node:
    """A span of the text with what it can be opened into."""

    __slots__ = ("start", "end", "kind", "children")

    def __init__(self, start: int, end: int, kind: str, children: list[Node] | None = None):
        self.start, self.end, self.kind, self.children = start, end, kind, children or []


def heading_level(line: str, following: str) -> int:
    """0 for an ordinary line, else the level of the heading (1 highest)."""
    body = line.rstrip()
    if not body.strip():
        return 0
    if m := _HASH.match(body):
        return len(m[1])
    if m := _WIKI.match(body):
        return len(m[1])
    if m := _HTML.match(body):
        return int(m[1])
    if m := _TEX.match(body):
        return {"part": 1, "chapter": 1, "section": 2, "subsection": 3}.get(m[1], 4)
    if len(body) <= 100 and (m := _RULE.match(following.rstrip())) and len(m[1]) >= 3:
        return 1 if m[1][0] == "=" else 2
    return 3 if _LABEL.match(body) else 0


def tree(text: str) -> Node:
    """The structure tree down to lines; finer levels are built only when a node is opened."""
    spans = [m.span() for m in _LINE.finditer(text) if m.end() > m.start()]
    root = Node(0, len(text), "section")
    path: list[tuple[int, Node]] = [(0, root)]
    block: Node | None = None
    fenced = ""
    for k, (a, b) in enumerate(spans):
        line = text[a:b]
        if fenced:
            block.children.append(Node(a, b, "line"))
            block.end = b
            if line.strip().startswith(fenced):
                fenced, block = "", None
            continue
        following = text[slice(*spans[k + 1])] if k + 1 < len(spans) else ""
        if level := heading_level(line, following):
            while path[-1][0] >= level:
                path.pop()
            section = Node(a, b, "section", [Node(a, b, "line")])
            path[-1][1].children.append(section)
            path.append((level, section))
            block = None
        elif not line.strip():
            top = path[-1][1].children
            if block is not None:
                block.children[-1].end = block.end = b
                block = None
            elif top and not top[-1].children:
                top[-1].end = b
            else:
                top.append(Node(a, b, "line"))
        elif m := _FENCE.match(line):
            fenced, block = m[1], Node(a, b, "code", [Node(a, b, "line")])
            path[-1][1].children.append(block)
        else:
            kind = "list" if _ITEM.match(line) else "paragraph"
            if block is None or (kind == "list") != (block.kind == "list") and kind == "list":
                block = Node(a, b, kind)
                path[-1][1].children.append(block)
            block.children.append(Node(a, b, "line"))
            block.end = b
    close(root)
    return root


def close(node: Node) -> None:
    """Let a section end where its last child ends (without recursion: depth is at most six)."""
    stack, order = [node], []
    while stack:
        n = stack.pop()
        order.append(n)
        stack += n.children
    for n in reversed(order):
        if n.children:
            n.end = max(n.end, n.children[-1].end)


def parts(text: str, node: Node) -> list[Node]:
    """What an oversized node is opened into: its children, else the next finer level."""
    if len(node.children) > 1:
        return node.children
    if len(node.children) == 1:
        return parts(text, node.children[0])
    finer = {"line": (_SENTENCE, "sentence"), "sentence": (_CLAUSE, "clause")}
    kind = node.kind if node.kind in ("line", "sentence", "clause", "word") else "line"
    while kind in finer:
        pattern, kind = finer[kind]
        ends = [m.end() for m in pattern.finditer(text, node.start, node.end) if m.end() < node.end]
        if ends:
            return [Node(a, b, kind) for a, b in zip([node.start, *ends], [*ends, node.end])]
    if kind != "word":
        ends = [m.start() for m in _WORD.finditer(text, node.start, node.end) if m.start() > node.start]
        if ends:
            return [Node(a, b, "word") for a, b in zip([node.start, *ends], [*ends, node.end])]
    return []


class Splitter:
    """Splits texts under one set of limits."""

    def __init__(self, words: int = MAX_WORDS, chars: int = MAX_CHARS, overlap: int = OVERLAP_WORDS, overlap_chars: int = OVERLAP_CHARS):
        if words <= overlap or chars <= overlap_chars:
            raise ValueError("the overlap must be smaller than the limits")
        self.words, self.chars, self.overlap, self.overlap_chars = words - overlap, chars - overlap_chars, overlap, overlap_chars
        self.limits = words, chars

    @staticmethod
    def headed(text: str, node: Node, inner: list[Node], fits: Callable[[int, int], bool]) -> list[Node]:
        """The parts of a node; the heading of a section goes with the first part of what it heads, also where that is opened."""
        if node.kind != "section" or len(inner) < 2 or inner[0].children or fits(inner[0].start, inner[1].end):
            return inner

        def attach(first: Node) -> Node:
            at = inner[0].start
            below = [] if fits(at, first.end) else parts(text, first)
            return Node(at, first.end, first.kind, [attach(below[0]), *below[1:]] if below else [])

        return [attach(inner[1]), *inner[2:]]

    def split(self, text: str) -> list[tuple[int, int, int]]:
        """(start with overlap, start of the body, end) of every piece."""
        found = [m.span() for m in _WORD.finditer(text)]
        starts, ends = [s for s, _ in found], [e for _, e in found]

        def count(a: int, b: int) -> int:
            return max(0, bisect_left(starts, b) - bisect_right(ends, a))

        def fits(a: int, b: int) -> bool:
            return b - a <= self.chars and count(a, b) <= self.words

        if len(text) <= self.limits[1] and len(starts) <= self.limits[0]:
            return [(0, 0, len(text))]
        bodies: list[list[int]] = []
        owner: Node | None = None  # the parent whose whole children the last body is made of

        def add(a: int, b: int, parent: Node) -> None:
            """Merge with the sibling before where both fit, else begin a new piece."""
            nonlocal owner
            if bodies and owner is parent and fits(bodies[-1][0], b):
                bodies[-1][1] = b
            elif a < b:
                bodies.append([a, b])
            owner = parent

        root = tree(text)
        stack = [(root, root)]
        while stack:
            node, parent = stack.pop()
            if fits(node.start, node.end):
                add(node.start, node.end, parent)
            elif inner := self.headed(text, node, parts(text, node), fits):
                stack += [(n, node) for n in reversed(inner)]
            else:
                a = node.start
                while a < node.end:
                    b = min(node.end, a + self.chars)
                    while a + 1 < b < node.end and unicodedata.combining(text[b]):
                        b -= 1
                    add(a, b, node)
                    a = b
        sentence = {m.end() for m in _SENTENCE.finditer(text)} | {m.end() for m in _LINE.finditer(text)}
        out = [(bodies[0][0], *bodies[0])]
        for before, (a, b) in zip(bodies, bodies[1:]):
            last = bisect_left(starts, a)
            options = [starts[i] for i in range(max(0, last - self.overlap), last) if starts[i] >= max(before[0], a - self.overlap_chars)]
            options = [s for s in options if count(s, b) <= self.limits[0] and count(s, a) <= self.overlap]
            natural = [s for s in options if s in sentence]
            out.append(((natural or options or [a])[0], a, b))
        return out


def is_oversized(text: Column, words: int = MAX_WORDS, chars: int = MAX_CHARS) -> Column:
    """Whether a text exceeds a limit; words are counted only where their number could be too large."""
    n = F.length(text)
    return F.coalesce((n > chars) | ((n > 2 * words) & (F.regexp_count(text, F.lit(WORD_RUN)) > words)), F.lit(False))


def split_items(df: DataFrame, id_col: str, text_col: str, max_words: int = MAX_WORDS, max_chars: int = MAX_CHARS, overlap: int = OVERLAP_WORDS) -> DataFrame:
    """(id, piece, n_pieces, overlap_chars, body_start, body_end, piece_text), for every row with a text."""
    overlap_chars = min(OVERLAP_CHARS, max_chars // 4)
    schema = "item_id string, piece int, n_pieces int, overlap_chars int, body_start int, body_end int, piece_text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(max_words, max_chars, overlap, overlap_chars)
        for batch in batches:
            rows = [
                (i, k, len(cuts), a - o, a, b, t[o:b])
                for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for cuts in [splitter.split(t)]
                for k, (o, a, b) in enumerate(cuts)
            ]
            cols = list(zip(*rows)) or [[]] * 7
            kinds = [pa.string(), *[pa.int32()] * 5, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[x.split()[0] for x in schema.split(", ")])

    pick = df.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    large = is_oversized(F.col("text"), max_words, max_chars)
    length = F.length("text")
    small = pick.where(~large).select("item_id", F.lit(0).alias("piece"), F.lit(1).alias("n_pieces"), F.lit(0).alias("overlap_chars"), F.lit(0).alias("body_start"), length.alias("body_end"), F.col("text").alias("piece_text"))
    return small.unionByName(spread(pick.where(large), 1).mapInArrow(run, schema))
