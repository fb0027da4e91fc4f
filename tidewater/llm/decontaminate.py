"""Benchmark decontamination by SimHash windows.

A benchmark item is the word shingles of its text; a window is as many words of a document
as the item has. Windows near a shingle of any item get a 64-bit SimHash, maintained over
the sliding window by differences of prefix sums. Fingerprints are looked up in a
multi-index: BLOCKS blocks of 8 bits, each probed within ``radius // BLOCKS`` bits, so by
the pigeonhole principle every item within ``radius`` bits is found. What is found is
verified exactly: the weighted Jaccard similarity of the shingle multisets (sum of minima
over sum of maxima of the counts) must reach ``threshold`` percent.

The radius covers similarity 0.8: the fingerprints of such texts differ in 9.7 bits on
average with a deviation of 2.9, so 24 bits lie five deviations off. A window that shares no
shingle with any item has similarity 0 and is not looked at.

The benchmark is broadcast in blocks of at most ``block_items`` items and
``block_bytes`` bytes of text, one pass over the documents each, so its size is free.

Words are maximal runs of letters, marks and digits, lower-cased, so punctuation and markup
around a copied passage do not hide it. A text with fewer than five words is one shingle.

Defined cases: null, empty or wordless texts and items match nothing; repeated rows are
matched again; items with equal texts are both reported; a null doc_id or item_id is kept;
of equally similar windows the first counts; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded, chunks, mix, start
from tidewater.llm.shingles import WORDS, chain, hash_spans, spans

BLOCKS = 8
RADIUS = 24
CHUNK_CHARS = 1 << 18  # characters hashed at once
_HINT_BITS = 20
_BITS = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_STATE: dict = {}


def _fold() -> np.ndarray:
    """Code point -> lower-case letter, mark or digit, or space."""
    if "fold" not in _STATE:
        fold = np.full(0x110000, 32, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if unicodedata.category(c)[0] in "LMN":
                low = c.lower()
                fold[i] = ord(low) if len(low) == 1 else i
        _STATE["fold"] = fold
    return _STATE["fold"]


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the texts in order, and where each text's begin (one more
    than texts)."""
    fold, out, edges, done = _fold(), [], [0], 0
    for lo, hi in chunks([len(t or "") for t in texts], CHUNK_CHARS):
        part = [t or "" for t in texts[lo:hi]]
        ends = np.cumsum([len(t) + 1 for t in part])
        c = fold[np.frombuffer((" ".join(part) + " ").encode("utf-32-le", "surrogatepass"),
                               "<u4")]
        s, e = spans(c == 32)
        out.append(hash_spans(c, s, e))
        edges += (done + np.searchsorted(s, ends)).tolist()
        done += len(s)
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), np.asarray(edges)


def _signs(h: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each hash."""
    bits = np.unpackbits(mix(h).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints, one byte a block, from signed sums."""
    return np.packbits(sums > 0, axis=1)


class Items:
    """Benchmark items and the multi-index of their fingerprints."""

    def __init__(self, ids: list, texts: list[str | None], k: int, radius: int):
        self.k, self.radius, self.hint = k, radius, {}
        self.ids, self.size, self.counts, prints = [], [], [], []
        every, edge = words(texts)
        for n, i in enumerate(ids):
            w = every[edge[n]:edge[n + 1]]
            if not len(w):
                continue
            s = chain(w, min(k, len(w)))
            self.ids.append(i)
            self.size.append(len(w))
            self.counts.append(np.unique(s, return_counts=True))
            prints.append(_pack(_signs(s).sum(axis=0, keepdims=True))[0])
        self.prints = np.asarray(prints, np.uint8).reshape(-1, BLOCKS)
        self.by_size: dict[int, np.ndarray] = {
            n: np.flatnonzero(np.asarray(self.size) == n) for n in sorted(set(self.size))}
        # known[kk]: shingles of kk words in order, and the items that have them
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for kk in sorted({min(k, n) for n in self.size}):
            own = [j for j, n in enumerate(self.size) if min(k, n) == kk]
            h = np.concatenate([self.counts[j][0] for j in own])
            item = np.repeat(own, [len(self.counts[j][0]) for j in own])
            order = np.argsort(h, kind="stable")
            self.known[kk] = h[order], item[order]
        # near[n][block][value]: items of n words with a block within radius // BLOCKS bits
        step = radius // BLOCKS
        close = _BITS[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= step
        self.near = {n: [[own[close[v][self.prints[own, b]]] for v in range(256)]
                         for b in range(BLOCKS)] for n, own in self.by_size.items()}

    def search(self, prints: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
        """(window, item) with fingerprints within the radius, items of n words."""
        value, place = np.unique(prints, axis=0, return_inverse=True)
        for u, p in enumerate(value):
            found = np.unique(np.concatenate(
                [self.near[n][b][p[b]] for b in range(BLOCKS)]))
            if len(found):
                found = found[_BITS[self.prints[found] ^ p].sum(axis=1) <= self.radius]
            if len(found):
                for at in np.flatnonzero(place.ravel() == u):
                    for j in found:
                        yield int(at), int(j)

    def _hits(self, w: np.ndarray, kk: int) -> tuple[np.ndarray, np.ndarray]:
        """Shingles of ``kk`` words, and the places of those that an item has."""
        s, known = chain(w, kk), self.known[kk][0]
        if kk not in self.hint:
            self.hint[kk] = np.zeros(1 << _HINT_BITS, bool)
            self.hint[kk][(known >> np.uint64(64 - _HINT_BITS)).astype(np.int64)] = True
        at = np.flatnonzero(self.hint[kk][(s >> np.uint64(64 - _HINT_BITS)).astype(np.int64)])
        return s, at[known[np.minimum(np.searchsorted(known, s[at]), len(known) - 1)] == s[at]]

    def matches(self, texts: list[str | None], threshold: int) -> Iterator[tuple]:
        """(text, item, similarity, first word, words, distance) of each item that a window
        of a text matches, by its best window."""
        w, edge = words(texts)
        best: dict[tuple[int, int], tuple] = {}
        for kk in self.known:
            if len(w) < kk:
                continue
            s, hit = self._hits(w, kk)
            owner = np.searchsorted(edge, hit, "right") - 1
            whole = hit + kk <= edge[owner + 1]  # not across two texts
            hit, owner = hit[whole], owner[whole]
            # One row per place and item that has its shingle; an item counts in a text with
            # as many such places as its threshold needs.
            known, item = self.known[kk]
            first = np.searchsorted(known, s[hit], "left")
            many = np.searchsorted(known, s[hit], "right") - first
            which = item[np.repeat(first - np.r_[0, np.cumsum(many)[:-1]], many)
                         + np.arange(many.sum())] if len(hit) else np.empty(0, np.int64)
            place, owner = np.repeat(hit, many), np.repeat(owner, many)
            size = np.diff(edge)[owner]
            n = np.asarray(self.size)[which]
            need = -(-threshold * (np.minimum(n, size) - kk + 1) // 100)
            key = owner * len(self.ids) + which
            _, back, count = np.unique(key, return_inverse=True, return_counts=True)
            fine = count[back.ravel()] >= need
            place, owner, n = place[fine], owner[fine], n[fine]
            for i, m in sorted(set(zip(owner.tolist(), n.tolist(), strict=True))):
                own = np.unique(place[(owner == i) & (n == m)]) - edge[i]
                self._windows(i, int(edge[i + 1] - edge[i]), s[edge[i]:edge[i + 1] - kk + 1],
                              own, m, kk, threshold, best)
        for (i, j), found in sorted(best.items()):
            yield (i, self.ids[j], *found)

    def _windows(self, text, size, s, hit, n, kk, threshold, best) -> None:
        """Windows of n words that hold a known shingle, in a text of ``size`` words."""
        wide = min(n, size) - kk + 1  # shingles of a window
        last = len(s) - wide
        # A window that shares fewer of its shingles cannot reach the threshold.
        need = -(-threshold * wide // 100)
        if len(hit) < need:
            return
        # Starts of windows with at least that many: from the place that brings the need-th
        # known shingle in to the place that loses the first.
        lo = np.maximum(hit[need - 1:] - wide + 1, 0)
        hi = np.minimum(hit[:len(hit) - need + 1], last)
        begin = np.unique(np.concatenate(
            [np.arange(a, b + 1) for a, b in zip(lo, hi, strict=True) if a <= b]
            or [np.empty(0, np.int64)]))
        if not len(begin):
            return
        for lo in range(0, len(begin), 4096):
            b = begin[lo:lo + 4096]
            first, end = int(b[0]), int(b[-1]) + wide
            if end - first > 4 * (len(b) + wide):  # sparse: window by window
                sums = np.stack([_signs(s[i:i + wide]).sum(axis=0) for i in b])
            else:
                run = np.zeros((end - first + 1, 64), np.int32)
                np.cumsum(_signs(s[first:end]), axis=0, out=run[1:])
                sums = run[b - first + wide] - run[b - first]
            prints = _pack(sums)
            for at, j in self.search(prints, n):
                i = int(b[at])
                sim = _similarity(np.unique(s[i:i + wide], return_counts=True),
                                  self.counts[j])
                if sim[0] * 100 >= threshold * sim[1]:
                    value = sim[0] / sim[1]
                    if (text, j) not in best or value > best[text, j][0]:
                        far = int(_BITS[prints[at] ^ self.prints[j]].sum())
                        best[text, j] = (value, i, min(n, size), far)


def _similarity(a, b) -> tuple[int, int]:
    """Sum of minima and sum of maxima of two shingle counts."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(a[1][i], b[1][j]).sum())
    return low, int(a[1].sum() + b[1].sum()) - low


def _blocks(benchmark: DataFrame, items: int, size: int) -> Iterator[tuple[list, list]]:
    ids, texts, held = [], [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        n = len(r.text or "")
        if ids and (len(ids) >= items or held + n > size):
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(r.item_id)
        texts.append(r.text)
        held += n
    if ids:
        yield ids, texts


def find(docs: DataFrame, benchmark: DataFrame, k: int = WORDS, threshold: int = 80,
         radius: int = RADIUS, block_items: int = 10_000,
         block_bytes: int = 16_000_000) -> DataFrame:
    """One row per document row and benchmark item that it contains: doc_id, item_id,
    similarity, first_word, n_words and distance (of the best window). With ``keep``
    columns, see ``mark``."""
    return _run(docs, benchmark, k, threshold, radius, block_items, block_bytes, None)


def clean(docs: DataFrame, benchmark: DataFrame, k: int = WORDS, threshold: int = 80,
          radius: int = RADIUS, block_items: int = 10_000,
          block_bytes: int = 16_000_000) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no benchmark item."""
    return _run(docs, benchmark, k, threshold, radius, block_items, block_bytes, docs.columns)


def _run(docs, benchmark, k, threshold, radius, block_items, block_bytes, keep) -> DataFrame:
    spark = start(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    found = None
    for ids, texts in _blocks(benchmark, block_items, block_bytes):
        shared = spark.sparkContext.broadcast((ids, texts))
        if keep is not None:
            docs = docs.mapInArrow(_filter(shared, k, threshold, radius), docs.schema)
            continue
        part = docs.select("doc_id", "text").mapInArrow(
            _rows(shared, k, threshold, radius),
            f"doc_id {id_type}, item_id {item_type}, similarity double, first_word long, "
            "n_words long, distance int")
        found = part if found is None else found.unionByName(part)
    if keep is not None:
        return docs
    if found is None:
        found = docs.where(F.lit(False)).select(
            "doc_id", F.lit(None).cast(item_type).alias("item_id"),
            F.lit(0.0).alias("similarity"), F.lit(0).cast("long").alias("first_word"),
            F.lit(0).cast("long").alias("n_words"), F.lit(0).alias("distance"))
    return found


def _rows(shared, k, threshold, radius):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*shared.value, k, radius)
        for b in bounded(batches):
            rows = list(items.matches(b.column("text").to_pylist(), threshold))
            if rows:
                at, item, sim, first, n, far = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(at, pa.int64())), pa.array(item),
                     pa.array(sim, pa.float64()), pa.array(first, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(far, pa.int32())],
                    ["doc_id", "item_id", "similarity", "first_word", "n_words", "distance"])
    return run


def _filter(shared, k, threshold, radius):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*shared.value, k, radius)
        for b in bounded(batches):
            keep = np.ones(b.num_rows, bool)
            keep[[m[0] for m in items.matches(b.column("text").to_pylist(), threshold)]] = False
            yield b.filter(pa.array(keep))
    return run
