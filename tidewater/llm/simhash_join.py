"""Near duplicates by SimHash: a segment-popcount embedding and a grid range join.

``fingerprints`` gives every text a 64-bit SimHash of its word shingles; ``classes`` links
fingerprints that differ in at most ``RADIUS`` = 4 bits and gives every row the smallest doc_id
that links reach.

The join. A fingerprint is mapped to its bit counts per segment of two bits (values 0, 1, 2).
The Manhattan distance of two such vectors, over all segments or over some, never exceeds the
number of differing bits. Of two linked fingerprints either the upper halves are within
Manhattan distance 2 or the lower halves are within 1. Per half the vectors are cells of a
grid, joined by range: two vectors at distance 2 have a common neighbour cell at distance 1
from both, so every fingerprint is written to its cell and the neighbours (upper half); two at
distance 1 have sums of different parity, so it suffices that those with an odd sum are also
written to their neighbours (lower half). Fingerprints that meet in a cell are verified by
their differing bits.

Equal fingerprints are one point from the start, however many rows hold them. A cell's points
are linked by a search that compares each with the points not reached yet and writes a spanning
forest, never all pairs of a crowd. A cell with more than ``cell`` points is cut into blocks,
and pairs of blocks become tasks of their own, so no task holds more than two blocks.

Defined cases: a null or empty text and one without words has fingerprint 0, which links like
any other; fewer words than a shingle are one shingle; repeated rows are returned again; a null
doc_id is kept and is never a component's id (null if no row of the component has an id); an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded, start
from tidewater.llm.graph import components
from tidewater.session import materialize

WORDS = 4
RADIUS = 4
SEED = 42
CELL = 1 << 13  # points of a cell that one task links at once
_COUNTED = 1 << 16  # shingles whose bits are counted at once
_ODD = np.uint64(0x5555555555555555)
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def simhash(text: bytes | None) -> int:
    """Fingerprint of a UTF-8 text, unsigned."""
    words = text.lower().split(None) if text else []  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.asarray([len(w) + 1 for w in words])) - 1
    begin = [0, *(ends[:-1] + 1).tolist()]
    last = ends[WORDS - 1:].tolist() if len(words) >= WORDS else [len(joined)]
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for lo in range(0, len(last), _COUNTED):
        part = last[lo:lo + _COUNTED]
        h = np.asarray([digest(joined[s:e], SEED)
                        for s, e in zip(begin[lo:lo + len(part)], part, strict=True)], "<u8")
        octets = h.view(np.uint8).reshape(-1, 8)
        for k in range(8):
            seen = np.bincount(octets[:, k], minlength=256)
            total[8 * k:8 * k + 8] += seen @ _BYTE_BITS
    bits = 2 * total > len(last)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a long) of every row of ``docs``."""
    start(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches):
            texts = b.column("text").cast(pa.binary())
            fp = np.asarray([simhash(t.as_py()) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64))],
                                             ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def segment_counts(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 segments of two bits, two bits each, in place."""
    return (fp & _ODD) + ((fp >> np.uint64(1)) & _ODD)


def cells(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of each fingerprint: (cell, index of the fingerprint). Bit 32 tells the half."""
    counts = segment_counts(fp)
    out, own = [], []
    index = np.arange(len(fp))
    for half, shift in ((0, 32), (1, 0)):
        v = (counts >> np.uint64(shift)) & np.uint64(0xFFFFFFFF)
        tag = np.uint64(half << 32)
        out.append(v | tag)
        own.append(index)
        # The upper bits of a sum of counts: odd sums have an odd number of ones.
        odd = (np.bitwise_count(v & _ODD) & 1).astype(bool)
        moves = np.ones(len(v), bool) if half == 0 else odd
        for k in range(16):
            one = np.uint64(1 << (2 * k))
            value = (v >> np.uint64(2 * k)) & np.uint64(3)
            for ok, moved in ((moves & (value < 2), v + one), (moves & (value > 0), v - one)):
                out.append((moved[ok] | tag))
                own.append(index[ok])
    return np.concatenate(out), np.concatenate(own)


def _forest(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is within ``RADIUS`` among distinct fingerprints: a spanning
    forest. Every point is compared with the points not reached before it."""
    a, b = [], []
    left = fp
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            x = reached.pop()
            near = np.bitwise_count(left ^ x) <= RADIUS
            if near.any():
                new = left[near]
                a.append(np.full(len(new), x))
                b.append(new)
                reached.extend(new)
                left = left[~near]
    if not a:
        return fp[:0], fp[:0]
    return np.concatenate(a), np.concatenate(b)


_SHORT = 24  # cells up to this many points are compared side by side


def _link(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within whole cells, given rows sorted by cell."""
    begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, int)
    size = np.diff(np.r_[begin, len(key)])
    a, b = [], []
    for k in np.flatnonzero(size > _SHORT):
        x, y = _forest(np.unique(fp[begin[k]:begin[k] + size[k]]))
        a.append(x)
        b.append(y)
    # Small cells, all at once: each row with the row s places further on.
    small = np.repeat(size <= _SHORT, size)
    k2, f2 = key[small], fp[small]
    for s in range(1, _SHORT):
        same = np.flatnonzero(k2[:-s] == k2[s:]) if len(k2) > s else np.empty(0, int)
        if not len(same):
            break
        near = np.bitwise_count(f2[same] ^ f2[same + s]) <= RADIUS
        a.append(f2[same[near]])
        b.append(f2[same[near] + s])
    if not a:
        return fp[:0], fp[:0]
    return np.concatenate(a), np.concatenate(b)


def _edges(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distinct links between different fingerprints, as rows."""
    e = np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)
    return np.unique(e[e[:, 0] != e[:, 1]], axis=0)


def _as_long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def links(points: DataFrame, cell: int = CELL) -> DataFrame:
    """a, b: links between the distinct fingerprints ``fp`` of ``points`` that connect all
    those within ``RADIUS`` bits of each other."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 1 << 13):
                fp = batch.column("fp").slice(lo, 1 << 13).to_numpy().view(np.uint64)
                key, own = cells(fp)
                yield pa.RecordBatch.from_arrays([_as_long(key), _as_long(fp[own])],
                                                 ["cell", "fp"])

    def rows(cell_of, a, b, block):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), cell_of, np.int64)), _as_long(a), _as_long(b),
             pa.array([block] * len(a), pa.int32())], ["cell", "a", "b", "block"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell. Cells are linked when they have ended; one beyond ``cell``
        points is passed on in blocks (block not null)."""
        k, f = np.empty(0, np.uint64), np.empty(0, np.uint64)
        big, block = None, 0

        def ended(k, f):
            cut = 0 if big is None else int(np.searchsorted(k, big, "right"))
            if cut:
                yield rows(np.int64(big), f[:cut], f[:cut], block)
            if cut < len(k):
                e = _edges(*_link(k[cut:], f[cut:]))
                yield rows(0, e[:, 0], e[:, 1], None)

        for batch in batches:
            k = np.r_[k, batch.column("cell").to_numpy().view(np.uint64)]
            f = np.r_[f, batch.column("fp").to_numpy().view(np.uint64)]
            if not len(k):
                continue
            last = int(np.searchsorted(k, k[-1]))  # where the cell begins that may go on
            if last:
                yield from ended(k[:last], f[:last])
                k, f, big, block = k[last:], f[last:], None, 0
            while len(k) >= cell:
                big = k[0]
                yield rows(np.int64(big), f[:cell], f[:cell], block)
                k, f, block = k[cell:], f[cell:], block + 1
        if len(k):
            yield from ended(k, f)

    def meet(table: pa.Table) -> pa.Table:
        e = _edges(*_forest(np.unique(table["fp"].to_numpy().view(np.uint64))))
        return pa.table({"a": _as_long(e[:, 0]), "b": _as_long(e[:, 1])})

    by_cell = (points.select("fp").mapInArrow(spread, "cell long, fp long")
               .repartition("cell").sortWithinPartitions("cell"))
    found = materialize(by_cell.mapInArrow(join, "cell long, a long, b long, block int"), "met")
    near = found.where("block is null").select("a", "b")
    crowded = found.where("block is not null").select("cell", "block", F.col("a").alias("fp"))
    count = crowded.groupBy("cell").agg(F.max("block").alias("last"))
    if count.isEmpty():
        return near
    # Every pair of blocks of a cell is a task of its own, a block with itself included.
    pairs = (count.select("cell", "last", F.explode(F.sequence(F.lit(0), "last")).alias("x"))
             .select("cell", "x", F.explode(F.sequence("x", "last")).alias("y")))
    asked = pairs.select("cell", "x", "y",
                         F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    tasks = crowded.join(asked, ["cell", "block"]).select("cell", "x", "y", "fp")
    return near.unionByName(
        tasks.groupBy("cell", "x", "y").applyInArrow(meet, "a long, b long"))


def classes(docs: DataFrame, cell: int = CELL) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id, one row per row of
    ``docs``."""
    rows = materialize(fingerprints(docs), "fingerprints")
    points = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    found = materialize(components(links(points, cell)), "reached")
    # The smallest id of a component; then of each of its fingerprints.
    of = materialize(points.join(found, points["fp"] == found["node"], "left")
                     .select("fp", "least", F.coalesce("root", "fp").alias("root")), "of")
    ids = materialize(of.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    known = materialize(of.join(ids, "root").select("fp", "component_id"), "point-classes")
    return rows.join(known, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
