"""Removal of long repeated strings, by run-length compressed suffix indexes.

A byte goes when a string of ``length`` bytes that covers it also starts anywhere else. The
work is dealt out so that all equal strings of that length meet in one place:

1. Anchors. Of the GRAM-byte substrings inside a window of ``length`` bytes the one with the
   smallest hash is its anchor; equal windows have equal anchors. Consecutive windows with
   the same anchor form a segment, known by its anchor and a 128-bit hash.
2. Segments are counted per (anchor, hash) before anything else moves. A segment that occurs
   twice repeats as a whole. An anchor that occurs once is done.
3. Anchors with several different segments: their distinct segments (of at most ``group``
   per anchor) are fetched and indexed some hundred kilobytes at a time. The index is a
   run-length Burrows-Wheeler transform with the suffix-array samples of the run ends and
   the longest common prefixes there. Within a run a prefix shortens by one per text
   position, so the matching statistics of all positions are streamed from the samples in
   text order; positions matching for ``length`` bytes or more start a repeated string.
4. Anchors with more than ``group`` different segments (a passage in very many documents)
   are too large for one index: there every window is counted by a 128-bit hash, which
   spreads over all tasks.
5. The repeated ranges go back to all copies of a segment and are merged per document.

The same is done over words instead of bytes (``words``): a word is a run of bytes without
ASCII white space, known by a 64-bit hash, so white space between words does not count.

Defined cases: a null text is empty; texts shorter than ``length`` keep all bytes; repeated
rows are repeats of each other; an empty table gives an empty result; a null doc_id is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import (
    SPREAD,
    bounded,
    chunks,
    eq,
    maybe_wanted,
    mix,
    part_of,
    powers,
    start,
    wanted_filter,
)
from tidewater.session import materialize

GRAM = 64
WORD_GRAM = 8
_PIECE = 1 << 20  # windows handled at once
_INDEX_BYTES = 1 << 18  # text of one index
_BASES = (0x100000001B3, 0x9E3779B97F4A7C15)
_POW: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}


def _pow(n: int):
    """Powers for ``n`` symbols at least; those of longer texts serve shorter ones, too."""
    size = 1 << max(n, 2).bit_length()
    if max(_POW, default=0) < size:
        _POW.clear()
        _POW[size] = [(powers(b, size), powers(pow(b, -1, 1 << 64), size)) for b in _BASES]
    return next(iter(_POW.values()))


def _packs(b: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` symbols from each position on as one mixed number. The sums of ``_prefix`` are
    linear: over plain symbols, different strings can be made that agree in all of them."""
    if b.dtype != np.uint8:
        return mix(b)
    padded = np.r_[b, np.zeros(8, np.uint8)]
    eight = np.ndarray((max(len(b) - n + 1, 0),), "<u8", padded, strides=(1,))
    return mix((eight & np.uint64((1 << 8 * n) - 1)) + np.uint64(_BASES[1]))


def _prefix(b: np.ndarray, which: int) -> np.ndarray:
    up = _pow(len(b) + 1)[which][0]
    out = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:len(b)], out=out[1:])
    return out


def _hash(prefix: np.ndarray, which: int, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    down = _pow(len(prefix))[which][1]
    return mix((prefix[e] - prefix[s]) * down[s])


def _window_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values."""
    n = len(v) - w + 1
    pad = np.full(-len(v) % w, np.iinfo(np.uint64).max, np.uint64)
    blocks = np.concatenate([v, pad]).reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1:w - 1 + n])


def _data(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _word_ranges(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end bytes of the words."""
    b = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], ~((b == 32) | ((b >= 9) & (b <= 13))), [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def _word_data(text: str | None) -> bytes:
    """Hashes of the words, 8 bytes each."""
    data = _data(text)
    s, e = _word_ranges(data)
    out = np.empty(len(s), np.uint64)
    b = np.frombuffer(b"\0" * 7 + data, np.uint8)
    for lo, hi in chunks(np.diff(np.r_[s, len(data)]).tolist(), _PIECE):
        if e[lo] - s[lo] > _PIECE:  # alone in its chunk
            one = hashlib.blake2b(data[s[lo]:e[lo]], digest_size=8).digest()
            out[lo] = int.from_bytes(one, "little")
            continue
        # A byte counts with the bytes of its word before it, seven at most.
        x = np.ndarray((e[hi - 1] - s[lo],), "<u8", b, s[lo], (1,))
        back = np.arange(s[lo], e[hi - 1]) - np.repeat(
            s[lo:hi], np.diff(np.r_[s[lo:hi], e[hi - 1]]))
        p = _prefix(mix(x >> (8 * np.maximum(7 - back, 0)).astype(np.uint64)), 0)
        out[lo:hi] = _hash(p, 0, s[lo:hi] - s[lo], e[lo:hi] - s[lo])
    return out.tobytes()


class Unit(NamedTuple):
    """What strings are made of: the symbols of a text as bytes, the type of a symbol, the
    symbols of an anchor, and how many symbols count as one in a hash."""

    data: Callable[[str | None], bytes]
    kind: type
    gram: int
    pack: int

    def size(self, data: bytes) -> int:
        return len(data) // np.dtype(self.kind).itemsize

    def cut(self, data: bytes, begin: int, size: int) -> bytes:
        w = np.dtype(self.kind).itemsize
        return data[begin * w:(begin + size) * w]


BYTES = Unit(_data, np.uint8, GRAM, 8)
WORDS = Unit(_word_data, np.uint64, WORD_GRAM, 1)


def segments(data: bytes, length: int, unit: Unit = BYTES) -> list[np.ndarray]:
    """Anchor hash, two hashes, begin and windows of every segment of a text."""
    out = []
    gram = min(unit.gram, length)
    pack = min(unit.pack, gram)
    total = unit.size(data) - length + 1
    for lo in range(0, total, _PIECE):
        b = np.frombuffer(data, unit.kind)[lo:lo + min(_PIECE, total - lo) + length - 1]
        x = _packs(b, pack)
        one, two = _prefix(x, 0), _prefix(x, 1)
        at = np.arange(len(b) - gram + 1)
        h = _hash(one, 0, at, at + gram - pack + 1)
        # Ties within a window go to its leftmost substring, which its text decides.
        rank = (h >> np.uint64(21) << np.uint64(21)) | at.astype(np.uint64)
        least = _window_min(rank, length - gram + 1)
        place = (least & np.uint64((1 << 21) - 1)).astype(np.int64)
        s = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        n = np.diff(np.r_[s, len(place)])
        e = s + n - 1 + length - pack + 1
        out.append([h[place[s]], _hash(one, 0, s, e), _hash(two, 1, s, e), s + lo, n])
    if not out:
        return [np.empty(0, np.uint64)] * 3 + [np.empty(0, np.int64)] * 2
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def _i64(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def _all_segments(docs: DataFrame, length: int, unit: Unit) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches):
            rows, cols = [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                if t and 4 * len(t) >= length:
                    c = segments(unit.data(t), length, unit)
                    rows.append(np.full(len(c[0]), i))
                    cols.append(c)
            if not cols:
                continue
            at = pa.array(np.concatenate(rows))
            a, h, g, s, n = (np.concatenate(c) for c in zip(*cols, strict=True))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(at), b.column("th").take(at), _i64(a), _i64(h),
                 _i64(g), pa.array(s), pa.array(n.astype(np.int32))],
                ["doc_id", "th", "anchor", "h", "g", "begin", "n"])

    return docs.mapInArrow(run, f"doc_id {kind}, th long, anchor long, h long, g long, "
                                "begin long, n int")


# ---- the index ------------------------------------------------------------------------

def suffix_ranks(text: np.ndarray) -> tuple[int, list[np.ndarray], np.ndarray]:
    """How many symbols the first ranks see, the ranks of all suffixes by that many symbols,
    twice, four times ... as many, until all differ, and the suffixes in order. A rank is the
    first place of its equals. Symbols must be small whole numbers, not negative.

    The first sort takes as many symbols as a 63-bit key holds; each later round sorts only
    suffixes that still have equals, by their rank and that of what follows."""
    n = len(text)
    base = int(text.max(initial=0)) + 2
    wide = 1
    while base ** (2 * wide) < 1 << 63 and wide < n:
        wide *= 2
    key = text.astype(np.int64) + 1
    done = 1
    while done < wide:  # beyond the end: 0
        after = np.zeros(n, np.int64)
        after[:n - done] = key[done:]
        key = key * base ** done + after
        done *= 2
    order = np.argsort(key)
    new = np.r_[True, np.diff(key[order]) != 0]
    at = np.arange(n, dtype=np.int32)
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, at, 0))
    out, step = [rank], wide
    while not new.all():
        places = np.flatnonzero(~(new & np.r_[new[1:], True]))  # those with equals
        own = order[places]
        after = own + step
        follow = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[own].astype(np.int64) * (n + 1) + follow
        by = np.argsort(key)
        order[places] = own = own[by]
        new[places] = np.r_[True, np.diff(key[by]) != 0]
        rank = rank.copy()
        rank[own] = np.maximum.accumulate(np.where(new, at, 0))[places]
        out.append(rank)
        step *= 2
    return wide, out, order


class RunIndex:
    """Run-length Burrows-Wheeler transform of a text, with samples at the run ends: the
    suffix that begins each run's first row and its common prefix with the row above, and
    likewise for the last rows and the rows below."""

    def __init__(self, text: np.ndarray):
        self.size = len(text)
        wide, ranks, array = suffix_ranks(text)
        bwt = text[array - 1]
        head = np.flatnonzero(np.r_[True, bwt[1:] != bwt[:-1]])
        tail = np.r_[head[1:], self.size] - 1
        self.symbols, self.lengths = bwt[head], tail - head + 1
        self.above = array[head], self._common(text, wide, ranks, array[head], array[head - 1])
        self.above[1][0] = 0
        below = np.minimum(tail + 1, self.size - 1)
        self.below = array[tail], self._common(text, wide, ranks, array[tail], array[below])
        self.below[1][-1] = 0

    def _common(self, text: np.ndarray, wide: int, ranks: list[np.ndarray], a: np.ndarray,
                b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes a and b: from the ranks by doubled lengths,
        and what is shorter than the least of these by symbols."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        steps = [(r, wide << k) for k, r in enumerate(ranks)][::-1]
        steps += [(text, 1)] * (wide - 1)
        for values, size in steps:
            ok = (a < self.size) & (b < self.size)
            same = np.zeros(len(a), bool)
            same[ok] = values[a[ok]] == values[b[ok]]
            step = same * size
            out += step
            a += step
            b += step
        return out

    def matching(self) -> np.ndarray:
        """For every position the longest match of its suffix with any other suffix: within
        a run a neighbour's match shortens by one per position, so each position takes over
        from the last sampled position before it."""
        out = np.zeros(self.size, np.int64)
        for at, common in (self.above, self.below):
            order = np.argsort(at)
            at, common = at[order], common[order]
            first = int(at[0])  # no sample lies before it
            k = np.cumsum(np.bincount(at, minlength=self.size)[first:]) - 1
            value = common[k] + at[k] - np.arange(first, self.size)
            out[first:] = np.maximum(out[first:], value)
        return out


def repeated_starts(parts: list[bytes], length: int, unit: Unit = BYTES) -> list[np.ndarray]:
    """For each text, where strings of ``length`` symbols start that also start elsewhere in
    the texts."""
    sizes = np.asarray([unit.size(p) for p in parts])
    ends = np.cumsum(sizes + 1)
    text = np.zeros(int(ends[-1]), np.int64)
    inner = np.ones(len(text), bool)
    inner[ends - 1] = False
    symbols = np.frombuffer(b"".join(parts), unit.kind)
    text[inner] = np.unique(symbols, return_inverse=True)[1] + len(parts)
    text[ends - 1] = np.arange(len(parts))  # a different end for each text
    found = RunIndex(text).matching() >= length
    return [np.flatnonzero(found[e - 1 - s:e - 1]) for s, e in zip(sizes, ends, strict=True)]


# ---- the job --------------------------------------------------------------------------

def _spans(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered ranges of strings of ``length`` at rising ``starts``."""
    new = np.flatnonzero(np.r_[True, starts[1:] > starts[:-1] + length])
    last = np.r_[new[1:], len(starts)] - 1
    return starts[new], starts[last] + length


def _fetch(docs: DataFrame, want: DataFrame, unit: Unit) -> DataFrame:
    """Symbols of the wanted segments (doc_id, th, anchor, h, g, begin, size)."""
    per_doc = want.groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("anchor", "h", "g", "begin", "size")).alias("segs"))
    per_doc = materialize(per_doc, "wanted")
    docs = maybe_wanted(docs, wanted_filter(per_doc, "th"), "th")
    both = per_doc.join(docs, eq(per_doc, docs, ["doc_id", "th"])).select("text", "segs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches):
            texts = b.column("text")
            for i, segs in enumerate(b.column("segs")):
                data = unit.data(texts[i].as_py())
                s = segs.as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[c] for x in s], pa.int64()) for c in ("anchor", "h", "g")]
                    + [pa.array([unit.cut(data, x["begin"], x["size"]) for x in s],
                                pa.binary())], ["anchor", "h", "g", "data"])

    return both.mapInArrow(run, "anchor long, h long, g long, data binary")


_FOUND = "anchor long, h long, g long, lo int, hi int"


def _indexed(parts: DataFrame, length: int, unit: Unit) -> DataFrame:
    """Repeated ranges within the segments of small anchors."""

    def work(keys: list, data: list[bytes]):
        rows = []
        for key, at in zip(keys, repeated_starts(data, length, unit), strict=True):
            if len(at):
                rows += [(*key, int(lo), int(hi))
                         for lo, hi in zip(*_spans(at, length), strict=True)]
        if rows:
            c = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in c[:3]),
                 *(pa.array(x, pa.int32()) for x in c[3:])], ["anchor", "h", "g", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, data, held = [], [], 0
        for b in batches:
            for a, h, g, d in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held >= _INDEX_BYTES and keys[-1][0] != a:  # anchors stay together
                    yield from work(keys, data)
                    keys, data, held = [], [], 0
                keys.append((a, h, g))
                data.append(d)
                held += len(d)
        if keys:
            yield from work(keys, data)

    return (parts.repartition("anchor").sortWithinPartitions("anchor")
            .select("anchor", "h", "g", "data").mapInArrow(run, _FOUND))


def _counted(parts: DataFrame, length: int, unit: Unit) -> DataFrame:
    """Repeated ranges within the segments of large anchors, by hashes of all windows."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, h, g, d in zip(*(c.to_pylist() for c in b.columns), strict=True):
                pack = min(unit.pack, length)
                x = _packs(np.frombuffer(d, unit.kind), pack)
                at = np.arange(unit.size(d) - length + 1)
                m, e = len(at), at + length - pack + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, a)), pa.array(np.full(m, h)), pa.array(np.full(m, g)),
                     pa.array(at.astype(np.int32)), _i64(_hash(_prefix(x, 0), 0, at, e)),
                     _i64(_hash(_prefix(x, 1), 1, at, e))],
                    ["anchor", "h", "g", "at", "x", "y"])

    w = parts.mapInArrow(windows, "anchor long, h long, g long, at int, x long, y long")
    w = materialize(w.withColumn("part", part_of(["h", "at"], SPREAD)), "windows")
    some = w.groupBy("x", "y", "part").agg(F.count(F.lit(1)).alias("c"))
    often = some.groupBy("x", "y").agg(F.sum("c").alias("c")).where("c > 1").select("x", "y")
    back = some.select("x", "y", "part").join(often, ["x", "y"])
    return (w.join(back, ["x", "y", "part"])
            .select("anchor", "h", "g", F.col("at").alias("lo"),
                    (F.col("at") + length).cast("int").alias("hi")))


def repeats(docs: DataFrame, length: int = 400, group: int = 2048,
            unit: Unit = BYTES) -> DataFrame:
    """Repeated ranges: doc_id, th, spans (begin and end, in symbols, not merged), one row per
    document row content that has any. ``docs``: doc_id, text, th (hash of the text)."""
    rows = materialize(_all_segments(docs, length, unit), "segments")
    # Most anchors occur once; their segments go no further.
    twice = materialize(rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"))
                        .where("c > 1").select("anchor"), "anchors")
    rows = materialize(rows.join(twice, "anchor", "left_semi"), "candidates")
    key = ["anchor", "h", "g"]
    rows = rows.withColumn("part", part_of(["doc_id", "th", "begin"], SPREAD))
    some = rows.groupBy(*key, "part").agg(
        F.count(F.lit(1)).alias("c"), F.max("n").alias("n"),
        F.min(F.struct("doc_id", "th", "begin")).alias("one"))
    each = some.groupBy(*key).agg(F.sum("c").alias("c"), F.max("n").alias("n"),
                                  F.min("one").alias("one"))
    each = each.withColumn("part", part_of(["h"], SPREAD))
    kinds = each.groupBy("anchor", "part").agg(F.count(F.lit(1)).alias("k"),
                                               F.sum("c").alias("t"))
    total = kinds.groupBy("anchor").agg(F.sum("k").alias("kinds"), F.sum("t").alias("t"))
    total = total.where("t > 1").select("anchor", "kinds")
    back = kinds.select("anchor", "part").join(total, "anchor")
    each = materialize(each.join(back, ["anchor", "part"]).drop("part"), "kinds")

    size = (F.col("n") + length - 1).cast("long").alias("size")
    whole = each.where("c > 1").select(
        *key, F.lit(0).alias("lo"), (F.col("n") + length - 1).cast("int").alias("hi"))
    parts = materialize(_fetch(docs, each.where("kinds > 1").select(
        *key, "one.*", size), unit), "parts")
    large = each.where(F.col("kinds") > group).select("anchor").distinct()
    found = _indexed(parts.join(large, "anchor", "left_anti"), length, unit)
    if not large.isEmpty():
        found = found.unionByName(_counted(parts.join(large, "anchor", "left_semi"), length, unit))
    # A segment that occurs again repeats as a whole; others as found.
    found = found.join(whole.select(*key), key, "left_anti").unionByName(whole)
    found = materialize(found.groupBy(*key).agg(
        F.collect_set(F.struct("lo", "hi")).alias("spans")), "found")
    mine = some.select(*key, "part").join(found, key)
    hits = rows.join(mine, [*key, "part"]).select(
        "doc_id", "th", F.transform("spans", lambda x: F.struct(
            (F.col("begin") + x["lo"]).alias("lo"), (F.col("begin") + x["hi"]).alias("hi"))
        ).alias("spans"))
    return hits.groupBy("doc_id", "th").agg(
        F.flatten(F.collect_set("spans")).alias("spans"))


def _merged(spans) -> tuple[np.ndarray, np.ndarray]:
    lo = np.asarray([s["lo"] for s in spans], np.int64)
    hi = np.asarray([s["hi"] for s in spans], np.int64)
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.flatnonzero(np.r_[True, lo[1:] > hi[:-1]])
    return lo[new], hi[np.r_[new[1:], len(lo)] - 1]


def _cut(data: bytes, spans) -> tuple[bytes, int]:
    if not spans:
        return data, 0
    lo, hi = _merged(spans)
    edge = [0, *np.stack([lo, hi], axis=1).ravel().tolist(), len(data)]
    return b"".join(data[edge[i]:edge[i + 1]] for i in range(0, len(edge), 2)), len(lo)


def _byte_spans(data: bytes, spans, words) -> list[dict]:
    """Spans in bytes, with those in words: from the first word to the word after the last."""
    out = list(spans or ())
    if words:
        s, e = _word_ranges(data)
        after = np.r_[s, e[-1]]
        out += [{"lo": int(s[x["lo"]]), "hi": int(after[x["hi"]])} for x in words]
    return out


def _with_spans(docs: DataFrame, length: int, group: int,
                words: int | None = None) -> DataFrame:
    start(docs)
    docs = docs.withColumn("th", F.xxhash64("text"))
    own = docs.select("doc_id", "text", "th")
    found = repeats(own, length, group).select(
        F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "spans")
    if words:
        none = F.array().cast(found.schema["spans"].dataType)
        found = found.withColumn("word_spans", none).unionByName(
            repeats(own, words, group, WORDS).select(
                F.col("doc_id").alias("_id"), F.col("th").alias("_th"), none.alias("spans"),
                F.col("spans").alias("word_spans")))
        found = found.groupBy("_id", "_th").agg(  # at most two rows each
            *[F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "word_spans")])
    found = materialize(found, "spans")
    seen = wanted_filter(found, "_th")
    some = maybe_wanted(docs, seen, "th")
    some = some.join(found, some["doc_id"].eqNullSafe(found["_id"])
                     & (some["th"] == found["_th"]), "left").drop("_id", "_th", "th")
    rest = maybe_wanted(docs, seen, "th", wanted=False).drop("th")
    none = F.lit(None).cast(found.schema["spans"].dataType)
    for c in found.columns[2:]:
        rest = rest.withColumn(c, none)
    return some.unionByName(rest)


def report(docs: DataFrame, length: int = 400, group: int = 2048) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and
    kept_sha256 (of the remaining bytes)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches):
            out = []
            for t, s in zip(b.column("text").to_pylist(), b.column("spans"), strict=True):
                data = _data(t)
                kept, runs = _cut(data, s.as_py())
                out.append((len(data), len(data) - len(kept), runs,
                            hashlib.sha256(kept).hexdigest()))
            c = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(x, pa.int64()) for x in c[:3]),
                 pa.array(c[3], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _with_spans(docs.select("doc_id", "text"), length, group).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = 400, group: int = 2048,
                    words: int | None = None) -> DataFrame:
    """``docs``, all columns, with the repeated strings cut out of ``text``: those of
    ``length`` bytes and, if given, those of ``words`` words, both as they occur in the
    given texts. Of a character that a removed range splits, no byte stays."""
    names = docs.columns
    added = ["spans", "word_spans"] if words else ["spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches):
            texts = []
            for t, *s in zip(b.column("text").to_pylist(), *(b.column(c) for c in added),
                             strict=True):
                s = [x.as_py() for x in s]
                if any(s):
                    data = _data(t)
                    spans = _byte_spans(data, s[0], s[1] if words else None)
                    t = _cut(data, spans)[0].decode("utf-8", "ignore")
                texts.append(t)
            cols = [pa.array(texts, pa.string()) if c == "text" else b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(cols, names)

    return _with_spans(docs, length, group, words).select(*names, *added).mapInArrow(
        run, docs.schema)
