"""Problem 1: markup residue, read with wrappers inferred per host as union-free regular expressions.

Every text is read as a stream of tokens that may be markup (anything in angle brackets, commands,
marks, line beginnings) and text slots, and cut into groups: an element with what it holds, a run of
list items, a code block, a pair of marks, a formula. A group's shape is its tokens in order, groups
inside it by name, and a slot for every text. The shapes of one host and kind are aligned one after
the other: equal parts stay, parts that only one side has become optional, neighbouring equal parts
become repeated, and texts that differ become slots. The result is one wrapper, a union-free regular
expression, per host and kind, and one per kind over all hosts.

The wrappers decide what is markup: a kind counts on a host if its expression there (or the one over
all hosts) has the structure of a template around data. That is, it is delimited (some text closes
what it opens, so `<li>` and a lone `</p>` count where `<li>` and `<p>` are ever closed, and
`vector<int>` does not), or it repeats (list items, rows, quotes), or its slot takes different texts
(headings, rules between paragraphs, emphasis). Slots are data; what no wrapper of the host has is
plain text and stays as it is. A group whose wrapper rests on many texts and has no slot, option or
repetition is part of the host's template and is left out of the clean text.

Headings, lists, code blocks, tables and formulas keep their place in one plain notation; scripts,
styles, comments and page furniture are left out. Shapes are counted in the tasks and united in
shuffles, by general form first (an operation in which order does not matter); the forms are then
aligned in sorted order, in salted parts, one at a time: no task holds the texts or the forms of a
host, and the result does not depend on the splits of the input. Defined results: null and blank
texts hold no markup and clean to an empty string; a missing host is a host of its own; unbalanced
tags and fences end where their surroundings end; texts of any length are read whole.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm._common import spread, stored

#: Fixed values of HTML: elements without an end tag, elements that begin a line, and elements that hold no content of a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul br syntaxhighlight gallery poem".split())
FURNITURE = set("script style nav header footer aside noscript iframe template head svg button form select".split())
#: Tokens at the beginning of a line; marks that open and close alike.
LINES = {"heading", "underlined", "rule", "row", "bullet", "number", "quote"}
MARKS = {"fence", "strong", "under", "strike", "boldquote"}
#: Tokens that hold a text of their own.
HELD = {"link", "wikilink", "extlink", "image", "em", "tick", "dollar", "dollars", "paren", "entity"}
#: Texts on which a wrapper must rest to be taken for a constant part of its host.
CONSTANT = 20
#: An expression of more parts, or of deeper nesting, is generalised to a repetition of its parts, each optional.
LONGEST, DEEPEST = 64, 6
#: Parts into which the forms of a host and kind are aligned before these are aligned, and forms a task counts before it hands them on.
SALTS, MOST_FORMS = 16, 50_000

_INLINE = r"""
  (?P<comment><!--.*?(?:-->|\Z)|<!doctype[^>]*>|<\?xml[^>]*>)
 |(?P<autolink><(?:https?://|mailto:)[^<>\s]+>)
 |(?P<tag></?(?P<el>[a-zA-Z][a-zA-Z0-9]*)(?P<attr>(?:\s+[^\s"'<>/=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'=<>`]+))?)*)\s*/?>)
 |(?P<entity>&(?:\#\d{1,7}|\#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});)
 |(?P<dollars>\$\$(?P<dm>(?:[^$\\]|\\.)+?)\$\$)
 |(?P<dollar>(?<![\w$\\])\$(?P<m>[^\s$](?:[^$\n]*?[^\s$\\])?)\$(?![\w$]))
 |(?P<paren>\\\((?P<pm>.+?)\\\)|\\\[(?P<bm>.+?)\\\])
 |(?P<begin>\\(?:begin|end)\{[a-zA-Z]+\*?\}(?:\[[^\]\n]*\])?)
 |(?P<command>(?<![\w:\\])\\(?P<cmd>[a-zA-Z]{2,})\*?(?:\[[^\]\n]*\])?(?=[{\\\s]|$)\{?)
 |(?P<image>!\[(?P<alt>[^\]\n]*)\]\([^)\n]*\))
 |(?P<link>(?<![\w\])])\[(?P<lt>[^\]\n]*)\]\((?P<lu>[^()\s][^()\n]*)?\))
 |(?P<wikilink>\[\[(?P<wl>[^\[\]\n]+)\]\])
 |(?P<extlink>\[(?:https?:|ftp:|mailto:)//?[^\s\]]+(?P<el_text>\s[^\]\n]*)?\])
 |(?P<template>\{\{\s*[A-Za-z#:][^{}]*\}\})
 |(?P<refmark>\[\^[\w-]+\]:?)
 |(?P<tick>(?<!`)`(?P<tc>[^`\n]+)`(?!`))
 |(?P<boldquote>'''''|'''|''(?=[^'\s])|(?<=[^'\s])'')
 |(?P<strong>(?<![\w*])\*\*(?=[^\s*])|(?<=[^\s*])\*\*(?![\w*]))
 |(?P<under>(?<!\w)__(?=[A-Za-z])(?!\w+__\s*\()|(?<=[\w.,!?])__(?!\w))
 |(?P<strike>~~(?=[^\s~])|(?<=[^\s~])~~)
 |(?P<em>(?<![\w*])\*(?P<et>[^\s*](?:[^*\n]*?[^\s*])?)\*(?![\w*]))
"""
_LEX = re.compile(_INLINE, re.X | re.S | re.I)
_KINDS = ("comment", "autolink", "tag", "entity", "dollars", "dollar", "paren", "begin", "command", "image", "link", "wikilink", "extlink", "template", "refmark", "tick", "boldquote", "strong", "under", "strike", "em")
_ESCAPED = re.compile(r"/?([a-zA-Z][a-zA-Z0-9]*)[^<>&\n]*?(?:>|&gt;)")
_FIRST = set("#=-*+•>`~|{_0123456789")  # what a line with a token at its beginning can begin with
_START = re.compile(r"[<&$\\!\[{`'*_~]")
_HASH = re.compile(r" {0,3}(#{1,6})[ \t]+(\S.*?)[ \t#]*$")
_WIKIHEAD = re.compile(r"(={2,6})[ \t]*([^=\n]+?)[ \t]*\1[ \t]*$")
_RULE = re.compile(r" {0,3}(?:(?:-[ \t]*){3,}|(?:\*[ \t]*){3,}|(?:_[ \t]*){3,})$")
_UNDER = re.compile(r" {0,3}(?:-{3,}|={3,})[ \t]*$")
_BULLET = re.compile(r"([ \t]*)(?:[-*+•]|\*{2,4})[ \t]+(?=\S)")
_NUMBER = re.compile(r"[ \t]*(\d{1,3})[.)][ \t]+(?=\S)")
_QUOTE = re.compile(r" {0,3}>[ \t]?(?=\S)")
_FENCE = re.compile(r"[ \t]*(```+|~~~+)[ \t]*([\w+#-]*)[ \t]*$")
_ROW = re.compile(r"[ \t]*\|.*\|[ \t]*$")
_WIKITABLE = re.compile(r"[ \t]*(?:\{\||\|\}|\|-)")
_MATH = re.compile(r"\\[a-zA-Z]+|[\^_=+<>]|^[A-Za-z]$|^[A-Za-z]\([^)]*\)$")
_CALL = re.compile(r"(?:#include\s*|[A-Za-z_]\w*)$")
_BRACE = re.compile(r"[{}]")
_HEADS = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 4, "subparagraph": 5, "title": 1}
_VERBATIM = re.compile(r"\\begin\{(verbatim|lstlisting|minted)\}.*?(?:\\end\{\1\}|\Z)|<(pre|syntaxhighlight|script|style)\b[^>]*>.*?(?:</\2\s*>|\Z)", re.S | re.I)

Token = tuple[str, int, int, str]  # name, start, end, what it holds


def _dollar_is_math(body: str, after: str) -> bool:
    return bool(_MATH.search(body)) and not re.match(r"[\d.,]+\s+[a-z]", body)


def lex(text: str) -> list[Token]:
    """Markup tokens of a text in order: name, span, and the content where the token holds one."""
    out: list[Token] = []
    guarded = [(m.start(), m.end()) for m in _VERBATIM.finditer(text)]
    at, fence, g = 0, "", 0
    previous_blank, previous = True, ""
    lines = text.split("\n")
    for k, line in enumerate(lines):
        start, end = at, at + len(line)
        at = end + 1
        while g < len(guarded) and guarded[g][1] <= start:
            g += 1
        inside = g < len(guarded) and guarded[g][0] < start
        body, strip = start, line.strip()
        if not inside:
            if fence:
                if strip.startswith(fence):
                    out.append(("fence", start, end, ""))
                    fence = ""
                continue
            if not strip or strip[0] not in _FIRST:
                pass
            elif m := _FENCE.match(line):
                fence = m[1][:3]
                out.append(("fence", start, end, m[2]))
                continue
            elif m := _HASH.match(line):
                out.append(("heading", start, start + m.start(2), str(len(m[1]))))
                body = start + m.start(2)
            elif m := _WIKIHEAD.match(line):
                out.append(("heading", start, start + m.start(2), str(len(m[1]))))
                out.append(("heading_end", start + m.end(2), end, ""))
                body, end = start + m.start(2), start + m.end(2)
            elif strip and _UNDER.match(line) and not previous_blank:
                out.append(("underlined", start, end, "1" if strip[0] == "=" else "2"))
                body = end
            elif _RULE.match(line) and strip:
                out.append(("rule", start, end, ""))
                body = end
            elif _ROW.match(line) and strip.count("|") >= 2 or _WIKITABLE.match(line):
                out.append(("row", start, end, line))
                body = end
            elif m := _BULLET.match(line):
                out.append(("bullet", start, start + m.end(), ""))
                body = start + m.end()
            elif m := _NUMBER.match(line):
                out.append(("number", start, start + m.end(), m[1]))
                body = start + m.end()
            elif m := _QUOTE.match(line):
                out.append(("quote", start, start + m.end(), ""))
                body = start + m.end()
        previous_blank, previous = not strip, strip
        out.append(("line", body, end, ""))
    tokens = [t for t in out if t[0] != "line"]
    # inline tokens are searched over the whole text, as elements and formulas may cross lines
    edges = sorted((t[1], t[2]) for t in tokens)
    blocked, e = [], 0
    if any(t[0] == "fence" for t in tokens):
        fences = [t for t in tokens if t[0] == "fence"]
        blocked = [(a[2], b[1]) for a, b in zip(fences[::2], [*fences[1::2], ("", len(text), len(text), "")])]
    s = t = 0
    last = {"\\(": text.rfind("\\)"), "\\[": text.rfind("\\]")}
    block = 0
    while start_at := _START.search(text, t):
        t = start_at.start()
        # without a closer further on, the rest of the text need not be searched for one
        m = None if last.get(text[t : t + 2], t) < t else _LEX.match(text, t)
        if m is None:
            t = start_at.end()
            continue
        s, t = m.start(), max(m.end(), m.start() + 1)
        kind = m.lastgroup if m.lastgroup in _KINDS else next(n for n in _KINDS if m[n] is not None)
        while e < len(edges) and edges[e][1] <= s:
            e += 1
        if e < len(edges) and edges[e][0] <= s < edges[e][1]:
            continue
        while block < len(blocked) and blocked[block][1] <= s:
            block += 1
        if block < len(blocked) and blocked[block][0] <= s:
            t = max(t, blocked[block][1])
            continue
        held = ""
        if kind == "tag":
            name = m["el"].lower()
            if m["el"] != name and m["el"] != name.upper():
                continue
            if name in ("map", "time", "data", "s", "q", "var", "a", "i", "b", "u", "p") and not m["attr"] and m[0][1] != "/" and re.search(r"#include\s*$|\b[A-Z]\w*$", text[max(0, s - 12) : s]) and f"</{name}" not in text.lower():
                continue
            kind, held = ("</" if m[0][1] == "/" else "<") + name + ">", m[0]
        elif kind == "entity":
            if not valid_entity(m[0]):
                continue
            held = html.unescape(m[0])
        elif kind == "dollar":
            if not _dollar_is_math(m["m"], text[t : t + 1]):
                continue
            held = m["m"]
        elif kind == "dollars":
            held = m["dm"].strip()
        elif kind == "paren":
            held = (m["pm"] or m["bm"]).strip()
        elif kind == "command":
            held = m["cmd"]
            opened = m[0].endswith("{")
            if not opened and not (held in _PLAIN_COMMANDS):
                continue
            kind = "\\" + held + ("{" if opened else "")
        elif kind == "begin":
            kind, held = m[0].split("}")[0] + "}", m[0]
        elif kind == "image":
            held = m["alt"]
        elif kind == "link":
            held = m["lt"]
        elif kind == "wikilink":
            held = m["wl"].rpartition("|")[2]
        elif kind == "extlink":
            held = (m["el_text"] or "").strip()
        elif kind == "tick":
            held = m["tc"]
        elif kind == "em":
            held = m["et"]
        tokens.append((kind, s, t, held))
    tokens.sort(key=lambda x: (x[1], x[2]))
    return tokens


#: LaTeX commands that stand without an argument in running text.
_PLAIN_COMMANDS = set("item noindent ldots dots maketitle newline par bigskip medskip smallskip centering newpage clearpage hline quad qquad textbackslash LaTeX TeX tableofcontents appendix label toprule midrule bottomrule footnotesize itshape bfseries".split())


@lru_cache(maxsize=4096)
def valid_entity(ref: str) -> bool:
    return ref[1] == "#" or ref[1:] in html.entities.html5


# ---- groups and wrappers -------------------------------------------------------------------------------------------

SLOT = "_"
Shape = tuple  # token names, ("_", text or None), ("?", shape), ("+", shape)
Group = tuple[str, list[int], int, int]  # kind, its tokens, and the range of tokens inside it (empty where it holds none)


def base(name: str) -> str:
    """The kind of group that a token begins or, alone, ends."""
    return "<" + name[2:] if name.startswith("</") else name.replace("\\end", "\\begin", 1) if name.startswith("\\end") else name


def closers(text: str, tokens: list[Token]) -> list[int]:
    """For each token the one that closes it (elements and environments by nesting, marks by their next like in the same paragraph), or -1."""
    out, open_, mark = [-1] * len(tokens), {}, {}
    for k, (name, start, _, _) in enumerate(tokens):
        if name.startswith(("</", "\\end")):
            if stack := open_.get(base(name)):
                out[stack.pop()] = k
        elif name in MARKS:
            before = mark.pop(name, None)
            if before is not None and (name == "fence" or text.find("\n\n", tokens[before][2], start) < 0):
                out[before] = k
            else:
                mark[name] = k
        elif name.startswith(("<", "\\begin")) and name[1:-1] not in VOID:
            open_.setdefault(name, []).append(k)
    return out


def groups(text: str, tokens: list[Token]) -> Iterator[Group]:
    """All groups of a text, those inside others too. Runs at line beginnings come first, whatever stands inside their lines."""
    lines = [k for k, t in enumerate(tokens) if t[0] in LINES]
    at = 0
    while at < len(lines):
        end, name = at + 1, tokens[lines[at]][0]
        if name in ("bullet", "number", "row", "quote"):
            while end < len(lines) and tokens[lines[end]][0] == name and text.count("\n", tokens[lines[end - 1]][2], tokens[lines[end]][1]) <= 2:
                end += 1
        yield name, lines[at:end], 0, 0
        at = end
    close = closers(text, tokens)
    ranges = [(0, len(tokens))]
    while ranges:
        i, stop = ranges.pop()
        while i < stop:
            name, j = tokens[i][0], close[i]
            if name in LINES or name == "heading_end":
                i += 1
            elif i < j < stop:
                yield name, [i, j], i + 1, j
                ranges.append((i + 1, j))
                i = j + 1
            else:
                yield base(name), [i], 0, 0
                i += 1


def shape(text: str, tokens: list[Token], group: Group, close: list[int]) -> Shape:
    """A group's tokens in order, the groups inside it by name, and the texts between them; neighbouring equal parts are folded."""
    name, own, i, stop = group
    parts: list = []

    def slot(held: str) -> None:
        if held := held.strip():
            # long texts are told apart by their digest
            parts.append((SLOT, held if len(held) <= 80 else "#" + xxhash.xxh64_hexdigest(held)))

    if name in LINES:
        for k in own:
            end = text.find("\n", tokens[k][2])
            parts.append(name)
            if name == "underlined":
                slot(text[: tokens[k][1]].rstrip("\n").rpartition("\n")[2])
            elif name == "rule":
                slot(text[tokens[k][2] :].lstrip().partition("\n")[0])
            else:
                slot(tokens[k][3] if name == "row" else text[tokens[k][2] : end if end >= 0 else len(text)])
    elif len(own) == 1:
        parts.append(tokens[own[0]][0])
        if name in HELD:
            slot(tokens[own[0]][3])
    else:
        parts.append(name)
        at = tokens[own[0]][2]
        while i < stop:
            if tokens[i][0] in LINES or tokens[i][0] == "heading_end":
                i += 1
                continue
            slot(text[at : tokens[i][1]])
            parts.append(base(tokens[i][0]))
            i = close[i] if i < close[i] < stop else i
            at = tokens[i][2]
            i += 1
        slot(text[at : tokens[own[1]][1]])
        parts.append(tokens[own[1]][0])
    return fold_repeats(tuple(parts))


def general(node):
    """A node with all its texts turned into slots."""
    if isinstance(node, str):
        return node
    if node[0] == SLOT:
        return (SLOT, None)
    return (node[0], tuple(general(n) for n in node[1]))


def fold_repeats(seq: Shape) -> Shape:
    """Neighbouring parts that are equal but for their texts become one repeated group."""
    seq = list(seq)
    plain = [general(n) for n in seq]
    for period in range(1, 7):
        i = 0
        while i + 2 * period <= len(seq):
            unit = plain[i : i + period]
            n = 1
            while plain[i + n * period : i + (n + 1) * period] == unit:
                n += 1
            if n > 1:
                new = ("+", tuple(unit)) if not (period == 1 and not isinstance(unit[0], str) and unit[0][0] in ("+", SLOT)) else unit[0]
                seq[i : i + n * period] = [new]
                plain[i : i + n * period] = [new]
            i += 1
    return tuple(seq)


def align(a: Shape, b: Shape) -> Shape:
    """The wrapper that covers both: common parts, optional parts, slots where texts differ."""
    if a == b:
        return a
    ka, kb = [_key(n) for n in a], [_key(n) for n in b]
    out: list = []
    for tag, i, j, k, l in SequenceMatcher(None, ka, kb, autojunk=False).get_opcodes():
        if tag == "equal":
            out += [merge(x, y) for x, y in zip(a[i:j], b[k:l])]
        else:
            for part in (a[i:j], b[k:l]):
                if part:
                    out.append(part[0] if len(part) == 1 and not isinstance(part[0], str) and part[0][0] == "?" else ("?", tuple(general(n) for n in part)))
    out = list(fold_repeats(tuple(pruned(n) for n in _once(out))))
    if len(out) > LONGEST:
        inner: dict = {}
        for n in out[1:-1]:
            inner.setdefault(_key(n), general(n))
        out = [out[0], ("+", tuple(n if not isinstance(n, str) and n[0] == "?" else ("?", (n,)) for n in inner.values())), out[-1]]
    return tuple(out)


def pruned(node, depth: int = DEEPEST):
    """A node without idle nesting: a choice in a choice is one. What lies too deep is a repetition of its tokens, each optional, which accepts at least as much."""
    if isinstance(node, str) or node[0] == SLOT:
        return node
    if depth == 0:
        texts = ((SLOT, None),) if slots((node,)) else ()
        return ("+", (*(("?", (n,)) for n in dict.fromkeys(flat((node,)))), *texts))
    inner = node[1]
    while len(inner) == 1 and not isinstance(inner[0], str) and inner[0][0] == node[0]:
        inner = inner[0][1]
    return (node[0], tuple(pruned(n, depth - 1) for n in inner))


def _key(node) -> str:
    """What two nodes must share to be aligned: repeated and optional forms align with the plain one."""
    while not isinstance(node, str):
        if node[0] == SLOT:
            return SLOT
        node = node[1][0]
    return node


def _once(nodes: list) -> list:
    """Neighbouring equal optional groups are one."""
    out: list = []
    for n in nodes:
        if not (out and out[-1] == n and not isinstance(n, str) and n[0] == "?"):
            out.append(n)
    return out


def merge(x, y):
    if x == y:
        return x
    if isinstance(x, str) or isinstance(y, str):
        return next((n for n in (x, y) if not isinstance(n, str)), x)
    if x[0] == SLOT and y[0] == SLOT:
        return (SLOT, None)
    marks = {n[0] for n in (x, y)}
    inner = align(tuple(x[1]) if x[0] in "?+" else (x,), tuple(y[1]) if y[0] in "?+" else (y,))
    return ("?" if "?" in marks else "+", inner)


def constant(shape_: Shape) -> bool:
    """Whether a wrapper has no slot, no choice, and some text."""
    texts = [n for n in shape_ if not isinstance(n, str)]
    return bool(texts) and all(n[0] == SLOT and n[1] is not None for n in texts)


def _freeze(node):
    return node if isinstance(node, str) or node is None else tuple(_freeze(n) for n in node)


def expression(shape_: Shape) -> str:
    """A wrapper in the notation of regular expressions."""
    out = []
    for n in shape_:
        if isinstance(n, str):
            out.append(n)
        elif n[0] == SLOT:
            out.append("#text" if n[1] is None else repr(n[1]))
        else:
            out.append(f"( {expression(n[1])} ){n[0]}")
    return " ".join(out)


def flat(shape_: Shape) -> Iterator[str]:
    """All token names of an expression."""
    for n in shape_:
        if isinstance(n, str):
            yield n
        elif n[0] != SLOT:
            yield from flat(n[1])


def slots(shape_: Shape) -> bool:
    """Whether an expression holds a slot at all."""
    return any(not isinstance(n, str) and (n[0] == SLOT or slots(n[1])) for n in shape_)


def has(shape_: Shape, mark: str) -> bool:
    """Whether an expression holds a repetition (+), or a slot that takes different texts (_)."""
    return any(not isinstance(n, str) and ((n[0] == mark and (mark != SLOT or n[1] is None)) or (n[0] != SLOT and has(n[1], mark))) for n in shape_)


def is_template(kind: str, shape_: Shape) -> bool:
    """Whether a wrapper is a template around data: delimited, repeating, or with a slot for different texts."""
    if kind.startswith("<"):
        return kind[1:-1] in VOID or "</" + kind[1:] in flat(shape_)
    if kind in MARKS:
        return has(shape_, "+") or sum(n == kind for n in flat(shape_)) > 1
    return kind not in LINES | {"em"} or has(shape_, "+") or has(shape_, SLOT)


def united(a: Shape, b: Shape) -> Shape:
    """Two shapes of the same general form: texts that differ become slots. The order does not matter."""
    return tuple(x if x == y or isinstance(x, str) else (SLOT, None) if x[0] == SLOT else (x[0], united(x[1], y[1])) for x, y in zip(a, b))


SCHEMA = "host string, kind string, wrapper string, support bigint"


def _rows(rows: list[tuple], names: str) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, (pa.string(), pa.string(), pa.string(), pa.int64()))], names=names.split())


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)", 1)), F.lit(""))


def forms(df: DataFrame) -> DataFrame:
    """(host, kind, wrapper as JSON, support) of (host, t): one row a task for each general form of a host's groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, list] = {}

        def out() -> pa.RecordBatch:
            got = _rows([(h, k, json.dumps(s), n) for (h, k, _), (s, n) in seen.items()], "host kind wrapper support")
            seen.clear()
            return got

        for batch in batches:
            for h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = lex(t)
                close, met = closers(t, tokens), set()
                for g in groups(t, tokens):
                    form = shape(t, tokens, g, close)
                    key = h, g[0], tuple(general(n) for n in form)
                    old = seen.get(key)
                    seen[key] = [united(old[0], form) if old else form, (old[1] if old else 0) + (g[0] not in met)]
                    met.add(g[0])
            if len(seen) > MOST_FORMS:
                yield out()
        yield out()

    return df.mapInArrow(run, SCHEMA)


def folded(forms: DataFrame, *by: str) -> DataFrame:
    """(host, kind, wrapper, support): the forms of each (host, kind), or of each kind, aligned in sorted order, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, whole, one, general_, n = None, None, None, None, 0
        for batch in batches:
            out = []
            for h, k, s, m in zip(*(batch.column(c).to_pylist() for c in range(4))):
                form = _freeze(json.loads(s))
                plain = tuple(general(x) for x in form)
                if (h, k) != key:
                    if key is not None:
                        out.append((*key, json.dumps(one if whole is None else align(whole, one)), n))
                    key, whole, one, general_, n = (h, k), None, form, plain, m
                    continue
                n += m
                if plain == general_:
                    one = united(one, form)
                else:
                    whole, one, general_ = one if whole is None else align(whole, one), form, plain
            if out:
                yield _rows(out, "host kind wrapper support")
        if key is not None:
            yield _rows([(*key, json.dumps(one if whole is None else align(whole, one)), n)], "host kind wrapper support")

    host = F.col("host") if "host" in by else F.lit(None).cast("string").alias("host")
    rows = forms.select(host, "kind", "wrapper", "support", _form("wrapper").alias("form"))
    part = rows.withColumn("salt", F.pmod(F.xxhash64("form"), F.lit(SALTS)))
    part = part.repartition("host", "kind", "salt").sortWithinPartitions("host", "kind", "salt", "form", "wrapper").select(F.concat_ws("\u0001", "host", "salt").alias("host"), "kind", "wrapper", "support")
    part = part.mapInArrow(run, SCHEMA).select(F.when(F.instr("host", "\u0001") > 0, F.substring_index("host", "\u0001", 1)).alias("host"), "kind", "wrapper", "support")
    return part.repartition("host", "kind").sortWithinPartitions("host", "kind", "wrapper").mapInArrow(run, SCHEMA)


def _form(column: str) -> Column:
    """The general form of a wrapper, from its JSON: the texts of all slots left out."""
    return F.regexp_replace(column, r'\["_", "(?:[^"\\]|\\.)*"\]', '["_", null]')


def infer_wrappers(df: DataFrame, host_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(host, kind, wrapper as JSON, support) of each host, and of all hosts together (host is null)."""
    texts = df.select(F.col(host_col).alias("host"), F.col(text_col).alias("t")).where(F.col("t").rlike(r"\S"))
    own = stored(folded(forms(spread(texts, 1)), "host", "kind"), "wrappers")
    return own, folded(own, "kind")


def readable(wrappers: DataFrame) -> DataFrame:
    """(host, kind, expression, support) with each wrapper in the notation of regular expressions."""
    write = F.udf(lambda s: expression(_freeze(json.loads(s))), "string")
    return wrappers.select("host", "kind", write("wrapper").alias("expression"), "support")


def rules(wrappers: DataFrame, everywhere: DataFrame) -> DataFrame:
    """(host, kinds, fixed): the kinds of a host that its wrapper, or the one over all hosts, shows to be templates, and those that are constant there."""
    test = F.udf(lambda k, s: is_template(k, _freeze(json.loads(s))), "boolean")
    is_constant = F.udf(lambda s: constant(_freeze(json.loads(s))), "boolean")
    here = wrappers.select("host", "kind", "support", test("kind", "wrapper").alias("here"), is_constant("wrapper").alias("same"))
    there = everywhere.select("kind", test("kind", "wrapper").alias("there"))
    both = here.join(there, "kind")
    whole = F.startswith("kind", F.lit("<")) | F.col("kind").isin("link", "image", "heading")
    fixed = F.collect_set(F.when((F.col("support") >= CONSTANT) & F.col("same") & whole, F.col("kind")))
    return both.groupBy("host").agg(F.collect_set(F.when(F.col("here") | F.col("there"), F.col("kind"))).alias("kinds"), fixed.alias("fixed"))


# ---- cleaning ------------------------------------------------------------------------------------------------------

def clean(text: str | None, kinds: set[str], fixed: set[str]) -> tuple[str, int]:
    """The readable text, and the number of its groups of a kind that counts as markup on its host."""
    if not text or not text.strip():
        return "", 0
    found = lex(text)
    n = 0
    data: set[int] = set()  # tokens that are plain text
    drop: dict[int, int] = {}  # constant groups: where they begin and end
    for kind, own, _, _ in groups(text, found):
        if kind not in kinds:
            data.update(own)
            continue
        n += 1
        if kind in fixed:
            drop[found[own[0]][1]] = found[own[-1]][2]
    tokens = [t for k, t in enumerate(found) if k not in data and (t[0] != "heading_end" or "heading" in kinds)]
    out: list[str] = []
    at, pre, listed, braces, pairs = 0, False, [], set(), None

    def between(a: int, b: int) -> str:
        """The text from a to b without the braces that close commands."""
        cuts = sorted(c for c in braces if a <= c < b)
        return "".join(text[x:y] for x, y in zip([a, *(c + 1 for c in cuts)], [*cuts, b]))

    for k, (name, s, e, held) in enumerate(tokens):
        if s < at:
            continue
        out.append(between(at, s))
        at = e
        if s in drop:
            at = drop[s]
            continue
        if name.startswith("<"):
            shut, el = name[1] == "/", name.strip("</>")
            if el in FURNITURE and not shut:
                close = re.compile(rf"</{el}\s*>", re.I).search(text, e)
                at = close.end() if close else e
                out.append("\n")
            elif el in ("pre", "syntaxhighlight"):
                out.append("\n```\n")
                pre = not shut
            elif el == "math":
                close = re.compile(r"</math\s*>", re.I).search(text, e)
                if close and not shut:
                    out.append(f"${text[e : close.start()].strip()}$")
                    at = close.end()
            elif re.fullmatch(r"h[1-6]", el):
                out.append("\n" if shut else "\n\n" + "#" * int(el[1]) + " ")
            elif el == "ul" or el == "ol":
                listed = listed[:-1] if shut else [*listed, [el, 0]]
                out.append("\n")
            elif el == "li":
                if not shut and listed:
                    listed[-1][1] += 1
                out.append("" if shut else "\n" + (f"{listed[-1][1]}. " if listed and listed[-1][0] == "ol" else "- "))
            elif el in ("td", "th"):
                out.append(" | " if not shut else "")
            elif el == "code" and not pre:
                out.append("`")
            elif el == "sup" and not shut:
                out.append("^")
            elif el == "sub" and not shut:
                out.append("_")
            elif el in BLOCK:
                out.append("\n\n" if el in ("p", "div", "section", "article", "blockquote") else "\n")
        elif name == "comment":
            pass
        elif name == "entity":
            # an escaped element goes as a whole
            if held == "<" and (m := _ESCAPED.match(text, e)) and f"<{m[1].lower()}>" in kinds:
                at = m.end()
            else:
                out.append(html.unescape(held))
        elif name in ("dollar", "dollars", "paren"):
            out.append(f"${held}$")
        elif name == "heading":
            out.append("\n" + "#" * min(6, int(held)) + " ")
        elif name == "underlined":
            whole = "".join(out).rstrip("\n")
            head, _, line = whole.rpartition("\n")
            out = [f"{head}\n{'#' * int(held)} {line.strip()}"]
        elif name in ("heading_end", "strong", "under", "strike", "boldquote", "refmark"):
            pass
        elif name == "template":
            shown = text[s + 2 : e - 2].split("|")
            out.append(shown[-1].strip() if len(shown) > 1 and "=" not in shown[-1] else "")
        elif name == "rule":
            out.append("")
        elif name == "bullet":
            out.append("- ")
        elif name == "number":
            out.append(f"{held}. ")
        elif name == "quote":
            out.append("")
        elif name == "row":
            cells = [c.strip() for c in held.strip().strip("|").split("|")]
            out.append("" if all(re.fullmatch(r":?-*:?", c) for c in cells) or held.strip()[:2] in ("{|", "|}", "|-") else " | ".join(cells))
        elif name == "fence":
            out.append("```")
        elif name == "tick":
            out.append(f"`{held}`")
        elif name == "autolink":
            out.append(text[s + 1 : e - 1])
        elif name in ("image", "link", "wikilink", "extlink", "em"):
            if name == "wikilink" and held.lower().startswith(("category:", "file:")):
                continue
            out.append(held)
        elif name.startswith("\\begin") or name.startswith("\\end"):
            if any(x in name for x in ("verbatim", "lstlisting", "minted")):
                out.append("```")
            elif re.match(r"\\begin\{(?:equation|align|gather|displaymath|math)", name):
                close = text.find(name.replace("begin", "end", 1), e)
                if close >= 0:
                    out.append(f"${text[e:close].strip()}$")
                    at = close + len(name)
        elif name.startswith("\\"):
            cmd = name.strip("\\{")
            if cmd == "item":
                out.append("- ")
            elif cmd in _HEADS:
                out.append("\n" + "#" * _HEADS[cmd] + " ")
            elif cmd in ("ldots", "dots"):
                out.append("…")
            elif cmd == "href" and name.endswith("{"):
                m = re.match(r"[^{}]*\}\s*\{", text[e:])
                at = e + (m.end() if m else 0)
            if name.endswith("{"):
                pairs = brace_pairs(text) if pairs is None else pairs
                close = pairs.get(at)
                if close is not None:
                    braces.add(close)
        braces = {c for c in braces if c >= at} if braces else braces
    out.append(between(at, len(text)))
    return tidy("".join(out)), n


def brace_pairs(text: str) -> dict[int, int]:
    """Position after each opening brace -> position of the brace that closes it, in one pass."""
    out, open_ = {}, []
    for m in _BRACE.finditer(text):
        if m[0] == "{":
            open_.append(m.end())
        elif open_:
            out[open_.pop()] = m.start()
    return out


def tidy(text: str) -> str:
    """Single blank lines and no trailing blanks."""
    text = re.sub(r"[^\S\n]+\n", "\n", text)
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def clean_texts(df: DataFrame, id_col: str, url_col: str, text_col: str) -> DataFrame:
    """(id, clean_text, n_markup) of every row: n_markup counts the groups that the wrappers of the host show to be markup."""
    pick = df.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), F.col(text_col).alias("t"))
    known = rules(*infer_wrappers(pick, "host", "t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [clean(t, set(a or ()), set(b or ())) for t, a, b in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)))]
            texts, counts = zip(*got) if got else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int32())], names=["id", "clean_text", "n_markup"])

    kind = pick.schema[0].dataType.simpleString()
    out = spread(pick, 1).join(known, "host", "left").select("id", "t", "kinds", "fixed").mapInArrow(run, f"id {kind}, clean_text string, n_markup int")
    return out.withColumnRenamed("id", id_col)
