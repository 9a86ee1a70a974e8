"""Problem 6: near-duplicate records by deletion-variant signatures.

A record is the set of its word sequences, a bit vector over all sequences. If two sets have
Jaccard similarity t or more, they differ in at most d bits, where d follows from the size of the
smaller one. The bits are cut (by hash) into a little more than d / 2 segments, so some of them
differ by at most one bit: such a segment is equal, or one side has one element more. Every record is
indexed under the hash of each whole segment and of each segment without one of its elements; an
equality join of whole segments with both kinds finds every pair, and exact similarity decides. There
is no loss by chance: recall is complete but for collisions of 64-bit hashes. Most signatures have no
partner; filters of the keys, sent along while they are small, drop them before the shuffle.

m depends on the size, so records fall into size classes of ratio 1/t; a record is indexed at its
own level and, as the larger partner, at the level below. Records with equal sets are joined once,
through one representative; the pairs of copies are expanded at the end.

Defined results: null texts count as empty; records whose text has fewer than `least`
sequences take no part; ties need no order as all pairs come out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm._common import cut, drop, jaccard, mix, stored, with_sequences

THRESHOLD, LEAST, RUN = 0.8, 10, 3
#: Largest filter of keys that is sent to the tasks: 2^28 bits, 32 MB.
MOST_BITS = 28


def classes(largest: int, threshold: float) -> np.ndarray:
    """Upper bounds of the size classes: sets in one class, or in neighbouring ones, can be similar."""
    bounds = [1]
    while bounds[-1] < largest:
        bounds.append(int(np.floor((bounds[-1] + 1) / threshold + 1e-9)))
    return np.array(bounds, dtype=np.int64)


def segments(bounds: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Number of segments at each level, and how many of them differ by at most one bit in a similar pair.

    Of m segments at most half of the largest possible difference d differ by two bits or more, so at
    least m - d // 2 differ by one or none. m is d // 2 + 1 and a sixth more: asking for several such
    segments instead of one leaves few pairs that are not similar.
    """
    differ = np.floor(bounds * (1 - threshold) / threshold + 1e-9).astype(np.int64)
    extra = (differ // 2 + 1) // 6
    return differ // 2 + 1 + extra, extra + 1


class Signatures:
    """Keys of the segments of sets, at each set's own level and at the level below; flat holds the elements of all sets in order.

    An empty segment would be one key for all records, so content without elements is not indexed: that
    loses a match only where both sides have at most one element, and the number of a record's segments
    with at most one is taken off what is asked of its pairs. Only records for which nothing would be
    left to ask are indexed under their empty segments as well.
    """

    def __init__(self, flat: np.ndarray, sizes: np.ndarray, threshold: float):
        bounds = classes(int(sizes.max(initial=1)), threshold)
        counts, needs = segments(bounds, threshold)
        own = np.searchsorted(bounds, sizes)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        element = mix(flat.view(np.uint64), 1)
        place = mix(element, 2)
        self.levels = []
        for below in (0, 1):
            level = own - below
            use = (sizes > 0) & (level >= 0)
            m = np.where(use, counts[np.maximum(level, 0)], 0)
            first = np.append(0, np.cumsum(m))
            mine = use[doc]
            d, e = doc[mine], element[mine]
            slot = first[d] + (place[mine] % m[d].astype(np.uint64)).astype(np.int64)
            sums = np.zeros(first[-1], dtype=np.uint64)
            np.add.at(sums, slot, e)
            held = np.bincount(slot, minlength=first[-1])
            owner = np.repeat(np.arange(len(sizes)), m)
            weak = np.bincount(owner, weights=held <= 1, minlength=len(sizes)).astype(np.int64)
            ask = np.where(use, needs[np.maximum(level, 0)], 0) - weak
            salt = mix((level[owner].astype(np.uint64) << np.uint64(40)) | (np.arange(first[-1]) - first[owner]).astype(np.uint64), 3)
            # what a row says of its record and level: how much to ask, whether it is the level below
            info = np.maximum(ask, 0) * 4 + below * 2
            self.levels.append((d, e, slot, sums, held, owner, salt, info, ask <= 0))

    def whole(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, key, info) of every whole segment."""
        out = []
        for _, _, _, sums, held, owner, salt, info, every in self.levels:
            use = (held > 0) | every[owner]
            out.append((owner[use], mix(sums[use], 4) ^ salt[use], info[owner[use]] + 1))
        return tuple(np.concatenate(x) for x in zip(*out))

    def variants(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, key, info) of every segment without one of its elements."""
        out = []
        for d, e, slot, sums, held, owner, salt, info, every in self.levels:
            use = (held[slot] > 1) | every[d]
            d, e, slot = d[use], e[use], slot[use]
            out.append((d, mix(sums[slot] - e, 4) ^ salt[slot], info[d]))
        return tuple(np.concatenate(x) for x in zip(*out))


class KeyFilter:
    """Bloom filters over 64-bit keys, as packed bits: of the keys added, and of those added twice."""

    PROBES = 3

    def __init__(self, bits: int, once: np.ndarray | None = None, twice: np.ndarray | None = None):
        self.bits = bits  # power of two
        self.once = np.zeros(1 << (bits - 3), dtype=np.uint8) if once is None else once
        self.twice = np.zeros_like(self.once) if twice is None else twice

    def _at(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return (mix(keys, 30 + probe) >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(self, keys: np.ndarray) -> None:
        at = np.sort(np.concatenate([self._at(keys, k) for k in range(self.PROBES)]))
        new = np.diff(at, prepend=-1) != 0
        again = at[~new]
        at = at[new]
        self._set(self.twice, again[np.diff(again, prepend=-1) != 0])
        self._set(self.twice, at[(self.once[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0])
        self._set(self.once, at)

    @staticmethod
    def _set(packed: np.ndarray, at: np.ndarray) -> None:
        """Set sorted, different bits."""
        if len(at):
            # the bits of one byte are different ones, so their sum is their union
            first = np.flatnonzero(np.diff(at >> 3, prepend=-1))
            packed[at[first] >> 3] |= np.add.reduceat((1 << (at & 7)).astype(np.uint8), first)

    def unite(self, other: KeyFilter) -> None:
        self.twice |= other.twice | (self.once & other.once)
        self.once |= other.once

    def holds(self, keys: np.ndarray, packed: np.ndarray) -> np.ndarray:
        """Positions of the keys that may be in the filter with these bits."""
        left = np.arange(len(keys))
        for k in range(self.PROBES):
            at = self._at(keys[left], k)
            left = left[(packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0]
        return left


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    lists = batch.column(1)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(lists.offsets.to_numpy()).astype(np.int64)


def filled(sets: DataFrame, bits: int, threshold: float, keys: Callable[[Signatures], np.ndarray]) -> KeyFilter:
    """The filter of the keys of (id, seqs). Each task fills its own; they are united slice by slice in a shuffle, so the driver gets one."""
    piece = 1 << min(bits - 3, 20)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = KeyFilter(bits)
        for batch in batches:
            mine.add(keys(Signatures(*_flat(batch), threshold)))
        once, twice = mine.once.reshape(-1, piece), mine.twice.reshape(-1, piece)
        live = np.flatnonzero(once.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(live.astype(np.int32)), *(pa.array([x[i].tobytes() for i in live], pa.binary()) for x in (once, twice))], names=["part", "once", "twice"])

    def unite(t: pa.Table) -> pa.Table:
        got = KeyFilter(0, np.zeros(piece, dtype=np.uint8))
        for a, b in zip(t.column("once"), t.column("twice")):
            got.unite(KeyFilter(0, *(np.frombuffer(x.as_py(), dtype=np.uint8) for x in (a, b))))
        return pa.table({"part": t.column("part").slice(0, 1), "once": pa.array([got.once.tobytes()], pa.binary()), "twice": pa.array([got.twice.tobytes()], pa.binary())})

    schema = "part int, once binary, twice binary"
    out = KeyFilter(bits)
    for part, once, twice in sets.select("id", "seqs").mapInArrow(run, schema).groupBy("part").applyInArrow(unite, schema).collect():
        at = slice(part * piece, (part + 1) * piece)
        out.once[at], out.twice[at] = np.frombuffer(once, dtype=np.uint8), np.frombuffer(twice, dtype=np.uint8)
    return out


def signature_rows(sets: DataFrame, threshold: float) -> DataFrame:
    """(key, id, n, info) from (id, seqs): whole segments and variants, but for those that cannot have a partner.

    A variant is dropped before any shuffle where no whole segment has its key, and a whole segment where
    neither another one nor a kept variant has. Where the filters would be too large, all rows are
    shuffled; the pairs are the same.
    """
    context = sets.sparkSession.sparkContext
    elements = sets.agg(F.sum(F.size("seqs"))).first()[0] or 0
    # both levels together have at most 0.4 segments an element, and 16 bits for each leave 0.5 % of strangers
    bits = max(16, int(np.ceil(np.log2(max(1, elements * 0.4 * 16)))))
    sent = None
    if bits <= MOST_BITS:
        whole = filled(sets, bits, threshold, lambda s: s.whole()[1])
        known = context.broadcast(whole.once)

        def kept(s: Signatures) -> np.ndarray:
            key = s.variants()[1]
            return key[KeyFilter(bits, known.value).holds(key, known.value)]

        wanted = context.broadcast(filled(sets, bits, threshold, kept).once | whole.twice)
        sent = known, wanted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = _flat(batch)
            signed = Signatures(flat, sizes, threshold)
            for k, (row, key, info) in enumerate((signed.whole(), signed.variants())):
                if sent:
                    packed = sent[1 - k].value
                    at = KeyFilter(bits, packed, packed).holds(key, packed)
                    row, key, info = row[at], key[at], info[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), batch.column(0).take(pa.array(row)), pa.array(sizes[row].astype(np.int32)), pa.array(info.astype(np.int16))],
                    names=["key", "id", "n", "info"],
                )

    return sets.select("id", "seqs").mapInArrow(run, f"key bigint, id {sets.schema['id'].dataType.simpleString()}, n int, info smallint")


class Similar:
    """Record sets of a table, their classes of copies, and the similar pairs between classes."""

    def __init__(self, df: DataFrame, id_col: str, text: Column, lead: Column | None = None, threshold: float = THRESHOLD, least: int = LEAST, run: int = RUN):
        """A record is its text, or lead + space + text; the text alone must have `least` sequences."""
        pick = df.select(F.col(id_col).alias("id"), text.alias("text"), *([] if lead is None else [lead.alias("lead")]))
        sets = with_sequences(pick, "text", run, None if lead is None else "lead", least=max(1, least))
        self.sets = stored(sets.withColumn("copy", F.xxhash64("seqs")), "sets")
        self.threshold = threshold
        self.classes = self.sets.groupBy("copy").agg(F.min("id").alias("class_id"), F.count("*").alias("copies"))
        self.members = stored(self.sets.select("id", "copy").join(self.classes, "copy").select("id", "class_id", "copies"), "members")

    def pairs(self) -> DataFrame:
        """(a, b, similarity) between class representatives, a < b."""
        t = self.threshold
        # the copies are named, not the representatives: they are fewer, and the sets need no shuffle while they are few
        copies = self.members.where("id != class_id").select("id")
        reps = self.sets.join(copies, "id", "left_anti").select("id", "seqs")
        rows = stored(signature_rows(reps, t), "signatures")
        one = rows.where("info % 2 = 1").select("key", F.col("id").alias("x"), F.col("n").alias("nx"), F.col("info").alias("ix"))
        every = rows.select("key", F.col("id").alias("y"), F.col("n").alias("ny"), F.col("info").alias("iy"))
        near = F.least("nx", "ny") >= t * F.greatest("nx", "ny") - 1e-9
        # a pair meets at the level of its smaller side, and once in each segment
        once = F.expr("x != y and (iy % 2 = 0 or x < y) and not (ix % 4 >= 2 and iy % 4 >= 2)")
        found = one.join(every, "key").where(once & near)
        found = found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.greatest("ix", "iy").alias("i"))
        found = found.groupBy("a", "b").agg(F.count("*").alias("met"), F.max("i").alias("i"))
        found = stored(found.where(F.col("met") >= F.greatest(F.lit(1), F.floor(F.col("i") / 4))).select("a", "b"), "candidates")
        drop(rows.sparkSession, rows)
        touched = found.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        asked = reps.join(touched, "id", "left_semi")
        left = asked.select(F.col("id").alias("a"), F.col("seqs").alias("sa"))
        right = asked.select(F.col("id").alias("b"), F.col("seqs").alias("sb"))
        both = found.join(left, "a").join(right, "b")
        return both.select("a", "b", jaccard(F.col("sa"), F.col("sb")).alias("similarity")).where(F.col("similarity") >= t)

    def all_pairs(self) -> DataFrame:
        """(a, b) of all records, copies included, a < b."""
        reps = self.pairs().select("a", "b")
        same = self.classes.where("copies > 1").select(F.col("class_id").alias("a"), F.col("class_id").alias("b"))
        left = self.members.select(F.col("id").alias("x"), F.col("class_id").alias("a"))
        right = self.members.select(F.col("id").alias("y"), F.col("class_id").alias("b"))
        wide = reps.unionByName(same).join(left, "a").join(right, "b")
        wide = wide.where((F.col("a") != F.col("b")) | (F.col("x") < F.col("y")))
        return wide.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, group_id): connected components by alternating large and small stars, smallest id as label.

    The rounds end when nothing changes; their number grows with the logarithm of the edges. Every round works on pairs in shuffles only; lineage is cut by checkpoints in the shared folder.
    """
    e = cut(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
    changed = True
    while changed:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        new = cut(small.where("u != v").distinct())
        changed = not new.exceptAll(e).isEmpty() or not e.exceptAll(new).isEmpty()
        e = new
    label = e.groupBy("u").agg(F.min("v").alias("g"))
    return nodes.join(label, nodes["id"] == label["u"], "left").select("id", F.coalesce("g", "id").alias("group_id"))


def groups(similar: Similar) -> DataFrame:
    """(id, class_id, group_id, n_links): each record's class of copies, group, and links of its class to others."""
    reps = stored(similar.pairs().select("a", "b"), "links")
    nodes = similar.classes.select(F.col("class_id").alias("id"))
    found = components(nodes, reps).withColumnRenamed("id", "class_id")
    ends = reps.select(F.col("a").alias("class_id")).unionByName(reps.select(F.col("b").alias("class_id")))
    degree = ends.groupBy("class_id").agg(F.count("*").alias("n_links"))
    out = similar.members.join(found, "class_id").join(degree, "class_id", "left")
    return out.select("id", "class_id", "group_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
