"""Problem 10: garbled text from a wrong character encoding, found by a hidden Markov model.

The model has one clean state, one state per encoding pair (the true encoding, and the one it was
read with), and one for replacement characters, from which nothing can be restored. The clean
state emits characters by a bigram model of the corpus; a pair's state emits what a clean text emits
after the pair's inverse transform, and almost nothing where a character has no inverse. Viterbi
labels every character; each labelled span gets its state's inverse. Texts that were garbled twice
are labelled again until nothing changes.

The bigram model counts all texts of the corpus, but only lines without a sequence that some pair
could have made from UTF-8. Pairs of classes rarer than one in MOST_PAIRS take the back-off, so its
table has MOST_PAIRS rows at most.

Defined results: null and empty texts are never affected; a text in a single script that no pair
can explain is left as it is; spans that cannot be restored (replacement characters, lost bytes)
mark the text as affected and stay; texts of any length are labelled whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm._common import spread, stored

#: True encoding and the encoding it was read with.
PAIRS = (
    ("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp1250"), ("utf-8", "cp1251"), ("utf-8", "cp1254"),
    ("utf-8", "iso8859-15"), ("utf-8", "iso8859-2"), ("utf-8", "cp437"), ("utf-8", "cp850"), ("utf-8", "cp866"), ("utf-8", "koi8-r"), ("utf-8", "mac-roman"),
    ("cp1251", "latin-1"), ("cp1251", "cp1252"), ("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("koi8-r", "latin-1"), ("cp866", "cp1251"), ("cp1251", "cp866"),
    ("shift_jis", "latin-1"), ("shift_jis", "cp1252"), ("shift_jis", "mac-roman"), ("euc_jp", "latin-1"), ("euc_jp", "cp1252"),
)
#: Log costs: entering or leaving a garbled state (more inside a word), a character without inverse, the least gain
#: of a character, and reading well-formed UTF-8 as double bytes.
SWITCH, INSIDE, IMPOSSIBLE, LEAST_GAIN, WELL_FORMED = 3.5, 4.0, -14.0, 1.0, 12.0
#: Characters, with padding, that are labelled in one array: bounds the memory of a group of texts.
CELLS = 200_000
#: A pair of classes rarer than one in so many is left to the back-off; this bounds the model.
MOST_PAIRS = 32_000_000
CLASS_END = 0x3000
#: Classes: code points below CLASS_END folded to lower case, then blocks, private use, replacement.
OTHERS = 8
CLASSES = CLASS_END + OTHERS


@lru_cache(maxsize=1)
def fold_table() -> tuple[np.ndarray, np.ndarray]:
    """Compact class of every code point, and whether it is an upper-case letter."""
    raw = np.empty(0x110000, dtype=np.int32)
    raw[:CLASS_END] = [ord(c.lower()) if len(c.lower()) == 1 and ord(c.lower()) < CLASS_END else i for i, c in ((i, chr(i)) for i in range(CLASS_END))]
    raw[CLASS_END:] = CLASS_END
    for k, (a, b) in enumerate(((0x3000, 0x3040), (0x3040, 0x30A0), (0x30A0, 0x3100), (0x3400, 0xA000), (0xAC00, 0xD800), (0xE000, 0xFB00), (0xFF00, 0xFFF0)), 1):
        raw[a:b] = CLASS_END + k
    raw[0x30:0x3A] = 0x30
    raw[0x900:0x980] = 0x915
    raw[0x2600:0x2C00] = 0x2600
    used = np.unique(raw)
    compact = np.searchsorted(used, raw).astype(np.int32)
    upper = np.zeros(0x110000, dtype=bool)
    upper[:CLASS_END] = [chr(i).isupper() for i in range(CLASS_END)]
    return compact, upper


@lru_cache(maxsize=1)
def spread_cost() -> np.ndarray:
    """Log probability of a code point within its class, for classes of many."""
    compact, _ = fold_table()
    members = np.bincount(compact, minlength=n_classes())
    return -np.log(np.clip(members, 1, 3000)) * (members > 8)


def n_classes() -> int:
    return int(fold_table()[0].max()) + 1


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)


@lru_cache(maxsize=1)
def byte_tables() -> dict[str, np.ndarray]:
    """For each reading encoding: code point -> byte, or -1. Bytes it leaves undefined stand as C1 controls."""
    out = {}
    for name in {r for _, r in PAIRS}:
        table = np.full(0x110000, -1, dtype=np.int16)
        for b in range(255, -1, -1):
            try:
                c = bytes([b]).decode(name)
            except UnicodeDecodeError:
                c = chr(b)
            if b < 128 and ord(c) != b:
                continue
            table[ord(c)] = b
        if name == "mac-roman":
            table[0x2126], table[0x3A9], table[0xA4] = 0xBD, 0xBD, 0xDB
        if name == "cp437":
            table[0x3BC], table[0x3B2] = 0xE6, 0xE1
        out[name] = table
    return out


@lru_cache(maxsize=1)
def candidates() -> np.ndarray:
    """Code points above ASCII that some reading encoding can produce."""
    out = np.zeros(0x110000, dtype=bool)
    for t in byte_tables().values():
        out |= t >= 128
    out[0xFFFD] = True
    return out


@lru_cache(maxsize=4)
def single_byte(name: str) -> np.ndarray:
    """Byte -> code point of a one-byte encoding, -1 where undefined."""
    out = np.full(256, -1, dtype=np.int64)
    for b in range(256):
        try:
            out[b] = ord(bytes([b]).decode(name))
        except UnicodeDecodeError:
            pass
    return out


@lru_cache(maxsize=4)
def double_byte(name: str) -> np.ndarray:
    """Two bytes -> code point of a multi-byte encoding, -1 where undefined."""
    out = np.full(65536, -1, dtype=np.int64)
    for a in range(0x81, 0xFF):
        for b in range(0x40, 0xFF):
            try:
                s = bytes([a, b]).decode(name)
            except UnicodeDecodeError:
                continue
            # other scripts in the table (Cyrillic, full-width Latin) would explain accented Latin letters
            if len(s) == 1 and (0x3000 <= ord(s) < 0x3100 or 0x4E00 <= ord(s) < 0xA000):
                out[a << 8 | b] = ord(s)
    return out


def inverse(cp: np.ndarray, pair: tuple[str, str]) -> tuple[np.ndarray, np.ndarray]:
    """(decoded, length): at the first character of each unit its true code point (-1: none) and how many characters it takes; length 0 inside a unit."""
    true, read = pair
    n = len(cp)
    b = byte_tables()[read][cp].astype(np.int64)
    decoded, length = np.where((b >= 0) & (b < 128), cp, -1), np.ones(n, dtype=np.int64)
    if true == "utf-8":
        cont = (b >= 0x80) & (b < 0xC0)
        pad = np.append(b, [-1, -1, -1])
        c1, c2, c3 = (np.append(cont, [False] * 3)[k : k + n] for k in (1, 2, 3))
        n1, n2, n3 = (pad[k : k + n] & 0x3F for k in (1, 2, 3))
        for ok, size, value in (
            ((b >= 0xC2) & (b < 0xE0) & c1, 2, (b & 0x1F) << 6 | n1),
            ((b >= 0xE0) & (b < 0xF0) & c1 & c2, 3, (b & 0xF) << 12 | n1 << 6 | n2),
            ((b >= 0xF0) & (b < 0xF5) & c1 & c2 & c3, 4, (b & 7) << 18 | n1 << 12 | n2 << 6 | n3),
        ):
            ok = ok & (value >= (0, 0, 0x80, 0x800, 0x10000)[size]) & (value < 0x110000) & ~((value >= 0xD800) & (value < 0xE000))
            decoded[ok], length[ok] = value[ok], size
            for k in range(1, size):
                inside = np.flatnonzero(ok) + k
                decoded[inside], length[inside] = -1, 0
    elif true in ("shift_jis", "euc_jp"):
        pad = np.append(b, -1)[1:]
        lead = ((b >= 0x81) & (b <= 0x9F)) | ((b >= 0xE0) & (b <= 0xEA)) if true == "shift_jis" else (b >= 0xA1) & (b <= 0xFE)
        low = 0x40 if true == "shift_jis" else 0xA1
        can = lead & (pad >= low) & (pad < 0xFD)
        value = np.where(can, double_byte(true)[np.where(can, b << 8 | np.maximum(pad, 0), 0)], -1)
        can &= value >= 0
        # units are read from the left: within a run of possible starts every second one counts
        start = np.flatnonzero(can & ~np.append(False, can[:-1]))
        origin = np.zeros(n, dtype=np.int64)
        origin[start] = start
        origin = np.maximum.accumulate(origin) if n else origin
        can &= (np.arange(n) - origin) % 2 == 0
        decoded[can], length[can] = value[can], 2
        inside = np.flatnonzero(can) + 1
        decoded[inside], length[inside] = -1, 0
    else:
        high = b >= 128
        decoded[high] = single_byte(true)[b[high]]
    return decoded, length


def plausible(value: np.ndarray) -> np.ndarray:
    """Code points that texts of the corpus languages use: Latin, Greek, Cyrillic, Devanagari, punctuation, symbols, Japanese, emoji."""
    out = np.zeros(len(value), dtype=bool)
    for a, b in ((0xA0, 0x180), (0x391, 0x3CA), (0x400, 0x460), (0x900, 0x980), (0x2010, 0x2040), (0x20AC, 0x20AD), (0x2122, 0x2123), (0x2500, 0x2580), (0x3000, 0x3100), (0x4E00, 0xA000), (0x1F300, 0x1FB00)):
        out |= (value >= a) & (value < b)
    return out


def suspicious_lines(cp: np.ndarray) -> np.ndarray:
    """Characters of lines that hold a unit which a pair could have made from UTF-8, a C1 control or a replacement character."""
    line = np.cumsum(cp == 10)
    at = np.flatnonzero(near_candidates(cp))
    part = cp[at]
    bad = (part == 0xFFFD) | ((part >= 0x80) & (part < 0xA0))
    for pair in PAIRS:
        # clean Cyrillic forms such units by chance in the two encodings left out
        if pair[0] == "utf-8" and pair[1] not in ("koi8-r", "cp866"):
            decoded, length = inverse(part, pair)
            bad |= (length > 1) & plausible(decoded)
    return np.bincount(line[at], weights=bad, minlength=int(line[-1]) + 1 if len(line) else 1)[line] > 0


def cyrillic(cp: np.ndarray) -> np.ndarray:
    return (cp >= 0x400) & (cp < 0x460)


def near_candidates(cp: np.ndarray) -> np.ndarray:
    """Candidates and the characters next to them: elsewhere no pair can have made a character."""
    odd = candidates()[cp]
    keep = odd.copy()
    keep[1:] |= odd[:-1]
    keep[:-1] |= odd[1:]
    return keep


class Model:
    """Log probabilities of the next character class and case, from counts."""

    def __init__(self, pairs: dict[int, int]):
        c = n_classes()
        key = np.fromiter(pairs.keys(), dtype=np.int64, count=len(pairs))
        val = np.fromiter(pairs.values(), dtype=np.float64, count=len(pairs))
        uni = np.bincount(key % c, weights=val, minlength=c) + 0.05
        self.prior = np.log(uni / uni.sum())
        before = np.bincount(key // c, weights=val, minlength=c)
        order = np.argsort(key)
        self.key, val = key[order], val[order]
        self.weight = 30.0
        self.value = np.log((val + self.weight * np.exp(self.prior[self.key % c])) / (before[self.key // c] + self.weight))
        self.backoff = np.log(self.weight / (before + self.weight))
        self.c = c

    def score(self, cp: np.ndarray) -> np.ndarray:
        """Log probability of each code point after the one before it."""
        if not len(cp):
            return np.zeros(0)
        fold, upper = fold_table()
        cls, up = fold[cp], upper[cp]
        before, b_up = np.append(fold[32], cls[:-1]).astype(np.int64), np.append(False, up[:-1])
        key = before * self.c + cls
        at = np.minimum(np.searchsorted(self.key, key), max(0, len(self.key) - 1))
        seen = self.key[at] == key if len(self.key) else np.zeros(len(key), dtype=bool)
        out = np.where(seen, self.value[at] if len(self.key) else 0.0, self.backoff[before] + self.prior[cls])
        letter_before = np.append(False, (fold[cp] != cp)[:-1] | (cp[:-1] >= 97))
        out = out + spread_cost()[cls]
        # an upper-case letter is rare inside a word, unless the one before is upper-case too
        return out + np.where(up, np.where(b_up, -1.0, np.where(letter_before, -5.0, -2.5)), 0.0)


def count_pairs(texts: list[str]) -> np.ndarray:
    """Keys of neighbouring character classes in the unsuspicious lines of texts, at least one beyond ASCII."""
    cp = code_points("\n".join(texts) + "\n" if texts else "")
    keep = ~suspicious_lines(cp)
    fold, _ = fold_table()
    cls = fold[cp].astype(np.int64)
    use = keep[1:] & keep[:-1] & ((cp[1:] > 127) | (cp[:-1] > 127))
    return (cls[:-1] * n_classes() + cls[1:])[use]


@lru_cache(maxsize=50_000)
def inverted(span: str, pair: int) -> str:
    """A span after the inverse transform of a pair; characters without inverse stay. Short spans repeat, so they are kept."""
    points = code_points(span)
    decoded, length = inverse(points, PAIRS[pair])
    start = np.flatnonzero(length)
    return "".join(map(chr, np.where(decoded[start] >= 0, decoded[start], points[start]).tolist()))


class Labeller:
    """Viterbi over clean, pair and replacement states, for many texts at once."""

    def __init__(self, model: Model):
        self.model = model

    def emissions(self, cp: np.ndarray) -> np.ndarray:
        """(states, characters): gain over the clean state; the last state is for replacement characters."""
        clean = self.model.score(cp)
        total = np.append(0, np.cumsum(clean))
        gains = np.zeros((len(PAIRS) + 1, len(cp)))
        as_utf8: dict[str, np.ndarray] = {}
        for s, pair in enumerate(PAIRS):
            decoded, length = inverse(cp, pair)
            if pair[0] == "utf-8":
                as_utf8[pair[1]] = length != 1
            start = np.flatnonzero(length)
            true = decoded[start]
            valid = true >= 0
            stream = np.where(valid, true, cp[start])
            size = length[start]
            # one unit emits one true character; the gain is over all characters it takes
            gain = np.where(valid, self.model.score(stream) - (total[start + size] - total[start]), IMPOSSIBLE)
            same = valid & (stream == cp[start]) & (size == 1)
            gain = np.where(same & np.append(True, same[:-1]), 0.0, gain)
            if pair[0] in ("shift_jis", "euc_jp"):
                # any two bytes are some ideograph; where the characters are well-formed UTF-8, that explains them
                gain = gain - WELL_FORMED * np.logical_or.reduceat(as_utf8[pair[1]], start) if len(start) else gain
            # shared by the characters of the unit, so that a path gains only by labelling all of them
            gains[s] = np.repeat(gain / size, size)
        gains[-1] = np.where(cp == 0xFFFD, 15.0, np.where(cp > 127, IMPOSSIBLE, -0.5))
        return gains

    def label(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """For each text its code points and states, or None where all are clean (state 0).

        Only candidates and their neighbours are scored: elsewhere all states emit alike, or no pair
        can have made the character. They form islands, which repeat (as the words of a language do):
        each different island is scored once.
        """
        joined = "\n".join(texts) + "\n" if texts else ""
        cp = code_points(joined)
        size = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        ends = np.cumsum(size)
        odd, keep = candidates()[cp], near_candidates(cp)
        keep[ends - 1] = False  # no island reaches from one text into the next
        out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(texts)
        edge = np.flatnonzero(np.diff(keep.astype(np.int8), prepend=0, append=0))
        if not len(edge):
            return out
        begin, end = edge[::2], edge[1::2]
        number: dict[str, int] = {}
        which = np.array([number.setdefault(joined[x:y], len(number)) for x, y in zip(begin.tolist(), end.tolist())], dtype=np.int64)
        first = np.append(0, np.cumsum([len(i) + 1 for i in number]))
        gains = self.emissions(code_points("\n".join(number) + "\n"))
        hit = np.logical_or.reduceat((gains > LEAST_GAIN).any(axis=0), first[:-1])
        moves = (gains != 0).any(axis=0)
        doc = np.searchsorted(ends, begin, side="right")
        live = np.zeros(len(texts), dtype=bool)
        live[doc[hit[which]]] = True
        mine = np.flatnonzero(live[doc])
        long = end[mine] - begin[mine]
        inner = np.arange(int(long.sum())) - np.repeat(np.cumsum(long) - long, long)
        at, col = np.repeat(begin[mine], long) + inner, np.repeat(first[which[mine]], long) + inner
        of = np.repeat(doc[mine], long)
        at, col, of = at[moves[col]], col[moves[col]], of[moves[col]]
        spans = []  # (length, document, first, after the last, states) of the texts in which some state can pay
        docs, lows = np.unique(of, return_index=True)
        for d, x, y in zip(docs.tolist(), lows.tolist(), [*lows[1:].tolist(), len(of)]):
            # a stay in a state gains at most its best stretch, and pays for entering and leaving
            total = np.zeros((len(gains), y - x + 1))
            np.cumsum(gains[:, col[x:y]], axis=1, out=total[:, 1:])
            could = (total - np.minimum.accumulate(total, axis=1)).max(axis=1)
            if could.max() > 2 * SWITCH:
                spans.append((y - x, d, x, y, could > 2 * SWITCH))
        spans.sort(key=lambda s: s[0])
        letter = cyrillic(cp)
        b = 0
        while b < len(spans):
            # texts of about the same length together, at most CELLS characters and padding
            a, b = b, b + 1
            while b < len(spans) and (b + 1 - a) * spans[b][0] <= CELLS:
                b += 1
            some = spans[a:b]
            use = np.flatnonzero(np.logical_or.reduce([s[4] for s in some]))
            inside = [np.append(False, (np.diff(at[x:y]) == 1) & letter[at[x:y]][1:] & letter[at[x:y]][:-1]) for _, _, x, y, _ in some]
            paths = self.viterbi([gains[np.ix_(use, col[x:y])] for _, _, x, y, _ in some], inside)
            for (_, d, x, y, _), path in zip(some, paths):
                if not path.any():
                    continue
                start = int(ends[d] - size[d])
                state = np.zeros(size[d] - 1, dtype=np.int16)
                state[at[x:y] - start] = np.append(0, use + 1)[path]
                points = cp[start : start + len(state)]
                if (odd[start : start + len(state)] & (state > 0)).any():
                    out[d] = points, state
        return out

    def viterbi(self, gains: list[np.ndarray], inside: list[np.ndarray]) -> list[np.ndarray]:
        """Best state sequences of several texts; inside marks characters within a word, where a switch costs more."""
        n, steps = len(gains), max(g.shape[1] for g in gains)
        states = len(gains[0]) + 1
        g = np.full((steps, n, states - 1), IMPOSSIBLE)
        cost = np.full((steps, n), SWITCH)
        for i, x in enumerate(gains):
            g[: x.shape[1], i] = x.T
            cost[: x.shape[1], i] += INSIDE * inside[i]
        best = np.full((n, states), -SWITCH)
        best[:, 0] = 0.0
        back = np.zeros((steps, n, states), dtype=np.int8)
        stay = np.arange(states, dtype=np.int8)[None, :]
        rows = np.arange(n)
        for t in range(steps):
            top = best.argmax(axis=1)
            jump = best[:, :1] - cost[t][:, None]
            back[t] = np.where(best >= jump, stay, 0)
            leave = best[rows, top] - cost[t]
            out = leave > best[:, 0]
            back[t, out, 0] = top[out]
            new = np.maximum(best, jump)
            new[:, 0] = np.maximum(best[:, 0], leave)
            new[:, 1:] += g[t]
            best = new
        best[:, 1:] -= SWITCH
        state = best.argmax(axis=1)
        path = np.empty((steps, n), dtype=np.int16)
        for t in range(steps - 1, -1, -1):
            path[t] = state
            state = back[t, rows, state]
        return [path[: x.shape[1], i] for i, x in enumerate(gains)]

    def invert(self, text: str, points: np.ndarray, state: np.ndarray) -> str:
        """The text with each labelled span replaced by its inverse."""
        parts, edges = [], (np.flatnonzero(np.diff(state)) + 1).tolist()
        for a, b in zip([0, *edges], [*edges, len(state)]):
            s = int(state[a])
            if s == 0 or s == len(PAIRS) + 1:
                parts.append(text[a:b])
                continue
            parts.append(inverted(text[a:b], s - 1))
        return "".join(parts)

    def restore(self, texts: list[str]) -> dict[int, str]:
        """Position -> restored text of the affected texts.

        What was garbled more than once is labelled again until nothing changes, or until a form comes
        back that the text had before (two one-byte pairs can be each other's inverse).
        """
        out: dict[int, str] = {}
        seen: dict[int, set[str]] = {}
        open_ = list(range(len(texts)))
        while open_:
            again = []
            for k, got in zip(open_, self.label([out.get(k, texts[k]) for k in open_])):
                if got is None:
                    continue
                old = out.get(k, texts[k])
                new = self.invert(old, *got)
                forms = seen.setdefault(k, {old})
                if new not in forms:
                    forms.add(new)
                    again.append(k)
                    out[k] = new
                elif (got[1] == len(PAIRS) + 1).any():
                    out.setdefault(k, new)
            open_ = again
        return out


def batched(texts: list[str], chars: int = 4_000_000) -> Iterator[tuple[int, list[str]]]:
    """Stretches of a list with about so many characters, with the position of the first."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= chars:
            yield start, texts[start : i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def beyond_ascii(text: Column) -> Column:
    """Texts that a wrong decoding could have touched: they hold a character beyond ASCII."""
    return F.coalesce(text.rlike(r"[^\x00-\x7F]"), F.lit(False))


def train(df: DataFrame, text_col: str) -> Model:
    """The bigram model of all texts beyond ASCII; at most MOST_PAIRS rows reach the driver, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for _, part in batched(batch.column(0).to_pylist()):
                new, n = np.unique(count_pairs(part), return_counts=True)
                keys, where = np.unique(np.concatenate([keys, new]), return_inverse=True)
                counts = np.bincount(where, weights=np.concatenate([counts, n]), minlength=len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["k", "n"])

    texts = spread(df.select(F.col(text_col).alias("t")).where(beyond_ascii(F.col("t"))), 1)
    counts = stored(texts.mapInArrow(run, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")), "pairs")
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where(F.col("n") >= total / MOST_PAIRS).toArrow()
    return Model(dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())))


def restore_texts(df: DataFrame, id_col: str, text_col: str, model: Model | None = None) -> DataFrame:
    """(id, restored) of every affected row."""
    model = model or train(df, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model)
        for batch in batches:
            ids, texts = [], []
            names, raw = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, part in batched(raw):
                for k, new in labeller.restore(part).items():
                    ids.append(names[start + k])
                    texts.append(new)
            yield pa.RecordBatch.from_arrays([pa.array(ids, type=batch.schema.field(0).type), pa.array(texts, type=pa.string())], names=[id_col, "restored"])

    pick = df.select(F.col(id_col), F.col(text_col).alias("t")).where(beyond_ascii(F.col("t")))
    return spread(pick, 1).mapInArrow(run, f"`{id_col}` {pick.schema[0].dataType.simpleString()}, restored string")
