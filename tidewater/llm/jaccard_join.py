"""N-gram Jaccard self-join by grouped prefixes: links and connected classes of documents.

Two documents link when their sets of word shingles have a Jaccard similarity of at least
``threshold`` percent. The steps:

1. Sets. Documents with the same set form a class (a 64-bit hash of the set and its size).
   A table of SLOTS counters of shingle occurrences gives every shingle a level: 0 unless
   its slot is far above the mean.
2. Grouped prefixes. Shingles are ordered by (level, hash), any shared order being right for
   prefix filtering; linked sets share one of their first n - ceil(t n) + 1 shingles.
   Classes with the same prefix and size form one group, which alone enters the index.
   A shingle of level 0 is bounded by its counter and handled in one stream; others are
   dealt out by group as well, so that a shingle in a third of all rows fills no task.
3. Stars. In a shingle's list each group meets the list's first group; the one met most
   often is its candidate, verified exactly on whole texts, as are the classes of a group
   against its first. Dense copies thus become linked classes at once.
4. The rest. Shingles whose lists still join different components give pairs of centers (a
   class, or that which it links with). Parity signatures, which never differ in more bits than
   the sets in shingles, and the number of shared prefix shingles that a pair needs rule out
   most. First each center meets its few likeliest partners in few lists (those of its least
   shingles by as many hashes, which like sets share), so that crowds become single components
   and their pairs are not made once a shared shingle; then all pairs that are left between components are verified. Jaccard
   distance is a metric, so members x, y of two centers at distance D can link only if
   D - d(x, center) - d(y, center) is at most 1 - t; those are expanded and verified.

Every linking pair of classes is therefore either verified or already in one component.

Defined cases: a null or empty text, or one without words, has an empty set, links with
nothing and is its own component; fewer than five words are one shingle; repeated rows have
the same set and one component; a null doc_id keeps its row and never names a component
unless all ids of it are null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import (
    SPREAD,
    bounded,
    eq,
    maybe_wanted,
    mix,
    part_of,
    start,
    wanted_filter,
    with_group_total,
)
from tidewater.llm.graph import components, forest_roots
from tidewater.llm.shingles import WORDS, shingle_sets
from tidewater.session import materialize

SLOTS = 1 << 20  # counters of shingle occurrences
_BLOCK = 1 << 10  # counters in one row of the exchange
_COLD, _HOT_PARTS = -1, 128  # spread of an entry of level 0; parts of a hot list
_SPREAD, _SIZE = 56, 28  # where spread, n and pos lie in x
_PARTNERS = 3  # others that each center meets first in a list
_LISTS = 4  # lists in which it does
_SQUARE = 512  # entries of a list that meet at once


def _i64(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _sums(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of ``h`` in each range between consecutive ``at``."""
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def _identities(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit identity of each sorted set, not depending on its order."""
    return _i64(mix(_sums(mix(h), at) + np.diff(at).astype(np.uint64)))


def _slot(h: np.ndarray) -> np.ndarray:
    return (mix(h ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(44)).astype(np.int64)


def _signatures(h: np.ndarray, at: np.ndarray) -> list[bytes]:
    """Parity signature of each set: bit i tells whether an odd number of its hashes leave i
    when divided by the number of bits, a power of two of at least the set's size and 64. Two
    sets differ in at least as many shingles as their signatures differ in bits."""
    out = []
    for i in range(len(at) - 1):
        s = h[at[i]:at[i + 1]]
        bits = 64 << max(int(len(s) - 1) >> 6, 0).bit_length()
        odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        out.append(np.packbits(odd.astype(np.uint8)).tobytes())
    return out


def _differing(sigs: list[bytes], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """In how many bits the signatures of pairs differ; of two lengths the longer is
    folded."""
    size = np.asarray([len(x) for x in sigs])
    tables: dict[int, np.ndarray] = {}
    for length in np.unique(size):  # each signature in its own and all shorter lengths
        own = np.flatnonzero(size == length)
        t = np.frombuffer(b"".join(sigs[x] for x in own), np.uint64).reshape(len(own), -1)
        while True:
            words = t.shape[1]
            full = tables.setdefault(words, np.zeros((len(sigs), words), np.uint64))
            full[own] = t
            if words == 1:
                break
            t = t[:, :words // 2] ^ t[:, words // 2:]
    out = np.zeros(len(i), np.int64)
    both = np.minimum(size[i], size[j]) // 8
    for words in np.unique(both):
        m = np.flatnonzero(both == words)
        t = tables[int(words)]
        for lo in range(0, len(m), 1 << 16):
            p = m[lo:lo + (1 << 16)]
            out[p] = np.bitwise_count(t[i[p]] ^ t[j[p]]).sum(axis=1)
    return out


def _nearest(i: np.ndarray, j: np.ndarray, far: np.ndarray, k: int) -> np.ndarray:
    """Which pairs are among the ``k`` with the least ``far`` of either end."""
    keep = np.zeros(len(i), bool)
    for x in (i, j):
        order = np.lexsort((far, x))
        first = np.r_[True, x[order[1:]] != x[order[:-1]]]
        start = np.maximum.accumulate(np.where(first, np.arange(len(x)), 0))
        keep[order[np.arange(len(x)) - start < k]] = True
    return keep


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """One row per document (kind 0: doc_id, th, gid, n, sig) and rows of counters (kind 1)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        names = ["kind", "doc_id", "th", "gid", "n", "sig", "block", "counts"]
        id_type = None
        for b in bounded(batches):
            id_type = b.schema.field("doc_id").type
            h, at = shingle_sets(b.column("text").to_pylist(), k)
            total += np.bincount(_slot(h), minlength=SLOTS)
            m = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(m, np.int32)), b.column("doc_id"), b.column("th"),
                 pa.array(_identities(h, at)), pa.array(np.diff(at).astype(np.int64)),
                 pa.array(_signatures(h, at), pa.binary()),
                 pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
        if id_type is None or not total.any():
            return
        rows = total.reshape(-1, _BLOCK)
        m = len(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(m, np.int32)), pa.nulls(m, id_type), pa.nulls(m, pa.int64()),
             pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()),
             pa.array(np.arange(m, dtype=np.int32)),
             pa.array([r.astype("<u4").tobytes() for r in rows], pa.binary())], names)

    return docs.mapInArrow(run, f"kind int, doc_id {kind}, th long, gid long, n long, "
                                "sig binary, block int, counts binary")


def _levels(sets: DataFrame) -> np.ndarray:
    """Level of every slot: 0 up to what chance makes of evenly spread shingles."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = np.frombuffer(c, "<u4").astype(np.int64)
                total[i] = total[i] + x if i in total else x
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()),
                 pa.array([x.tobytes() for x in total.values()], pa.binary())],
                ["block", "counts"])

    count = np.zeros((SLOTS // _BLOCK, _BLOCK), np.int64)
    rows = (sets.where("kind = 1").select("block", "counts").repartition(16, "block")
            .mapInArrow(add, "block int, counts binary"))
    for r in rows.collect():  # one job, and SLOTS counters in all, whatever the corpus
        count[r.block] += np.frombuffer(r.counts, np.int64)
    count = count.ravel()
    mean = count.mean()
    over = count - (mean + 6 * np.sqrt(mean) + 32)
    return np.where(over > 0, 1 + np.floor(np.log2(np.maximum(over, 1))), 0).astype(np.uint8)


def _postings(docs: DataFrame, levels, k: int, threshold: int) -> DataFrame:
    """Index entries: token, grp and x, which holds spread, n and pos (see ``_SPREAD``); for
    each class a membership row, whose x is the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        groups: set[int] = set()
        classes: set[int] = set()
        for b in bounded(batches):
            h, at = shingle_sets(b.column("text").to_pylist(), k)
            lv = level[_slot(h)]
            size = np.diff(at)
            gids = _identities(h, at)
            tokens, owner = [], []
            members = []
            for i in np.flatnonzero(size):
                if int(gids[i]) in classes:  # a copy within this task
                    continue
                classes.add(int(gids[i]))
                members.append(i)
                n = int(size[i])
                p = n - (threshold * n + 99) // 100 + 1
                s, v = h[at[i]:at[i + 1]], lv[at[i]:at[i + 1]]
                tokens.append(s[np.argsort(v, kind="stable")[:p]] if v.any() else s[:p])
            if not members:
                continue
            token = np.concatenate(tokens)
            count = np.asarray([len(t) for t in tokens])
            cut = np.r_[0, np.cumsum(count)]
            n = size[members]
            grp = _i64(mix(_sums(mix(token), cut) + mix(n.astype(np.uint64))))
            gid = gids[members]
            new = np.zeros(len(members), bool)
            for j, g in enumerate(grp.tolist()):
                if g not in groups:
                    groups.add(g)
                    new[j] = True
            keep = np.repeat(new, count)
            owner = np.repeat(np.arange(len(members)), count)[keep]
            pos = (np.arange(len(token)) - np.repeat(cut[:-1], count))[keep]
            token = token[keep]
            hot = level[_slot(token)] > 0
            spread = np.where(hot, grp[owner] % _HOT_PARTS, _COLD)
            x = (spread << _SPREAD) | (n[owner] << _SIZE) | pos
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([_i64(token), _i64(mix(grp.view(np.uint64)))])),
                 pa.array(np.concatenate([grp[owner], grp])),
                 pa.array(np.concatenate([x, n << _SIZE])),
                 pa.array(np.concatenate([np.zeros(len(x), np.int64), gid]),
                          mask=np.arange(len(x) + len(gid)) < len(x))],
                ["token", "grp", "x", "gid"])

    return docs.select("text").mapInArrow(run, "token long, grp long, x long, gid long")


def _index(docs: DataFrame, levels, k: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Entries of shingles that two groups or more share: token, grp, n, pos and the list's
    first group (first.grp, first.n, first.pos); and the members of groups: grp, gid, n."""
    spread = F.col("spread")
    # Rows of one list: a cold token's, a hot token's in one part, or a membership row.
    lists = Window.partitionBy("token", "spread")
    rows = materialize(
        _postings(docs, levels, k, threshold)
        .withColumn("spread", F.shiftright("x", _SPREAD))
        .withColumn("head", F.min(F.struct("grp", "x")).over(lists))
        .withColumn("last", F.max("grp").over(lists))
        .where(F.col("gid").isNotNull() | (spread != _COLD)
               | (F.col("head.grp") < F.col("last"))).drop("last"), "lists")
    members = rows.where("gid is not null").select("grp", "gid", "x").distinct()
    rows = rows.where("gid is null")

    def parts(x: str) -> list[Column]:
        low = (1 << _SIZE) - 1
        return [F.shiftright(x, _SIZE).bitwiseAND(low).alias("n"),
                F.col(x).bitwiseAND(low).alias("pos")]

    cold = rows.where(spread == _COLD)
    hot = rows.where(spread != _COLD).select("token", "grp", "x").distinct()
    entry = F.struct("grp", "x")
    hot = (with_group_total(hot, ["token"], ["grp"], {"head": (F.min(entry), F.min("head")),
                                                      "last": (F.max("grp"), F.max("last"))})
           .where(F.col("head.grp") < F.col("last")))
    entries = cold.select("token", "grp", "x", "head").unionByName(
        hot.select("token", "grp", "x", "head"))
    return (entries.select("token", "grp", *parts("x"), F.struct(
        F.col("head.grp").alias("grp"), *parts("head.x")).alias("first")),
        members.select("grp", "gid", parts("x")[0]))


def _may_link(n: Column, m: Column, pos: Column, at: Column, threshold: int) -> Column:
    """Length and position filter for sets of sizes n and m that share the shingles at
    these places of their prefixes."""
    most = F.least(pos, at) + F.least(n - pos, m - at)
    return ((100 * F.least(n, m) >= threshold * F.greatest(n, m))
            & ((100 + threshold) * most >= threshold * (n + m)))


def _prefix(n: Column, threshold: int) -> Column:
    return n - F.ceil(n * threshold / 100.0) + 1


def _least_shared(n: Column, m: Column, likeness: Column, threshold: int) -> Column:
    """How many shingles the prefixes of sets of sizes n and m share at least, when their
    similarity is at least ``likeness``: sets with an overlap of o share l shingles of their
    first n - o + l and m - o + l."""
    overlap = F.ceil(likeness / (1 + likeness) * (n + m) - 1e-6)
    return F.least(_prefix(n, threshold) - n, _prefix(m, threshold) - m) + overlap


def _verify(pairs: DataFrame, names: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Exact sizes for pairs of classes a, b: a, b, both (intersection), either (union).
    ``names``: gid, doc_id, th of one document of each class; b may be in very many pairs."""
    p = materialize(pairs.select("a", "b").distinct(), "pairs")
    if p.isEmpty():
        return p.select("a", "b", F.lit(0).cast("long").alias("both"),
                        F.lit(1).cast("long").alias("either"))
    p = p.withColumn("part", part_of(["a"], SPREAD))
    # Each text moves twice: to its document's row, then to the pairs' (b, part).
    sides = (p.select("b", "part", F.col("a").alias("gid"), F.lit(1).alias("side"))
             .unionByName(p.select("b", "part", F.col("b").alias("gid"),
                                   F.lit(0).alias("side")).distinct()))
    want = materialize(sides.join(names.drop("sig"), "gid"), "wanted")
    texts = maybe_wanted(docs, wanted_filter(want, "th"), "th")
    rows = (want.join(texts, eq(want, texts, ["doc_id", "th"]))
            .select("b", "part", "side", "gid", "text").repartition("b", "part")
            .sortWithinPartitions("b", "part", "side", "gid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, of, last = np.empty(0, np.uint64), None, None
        for x in bounded(batches):
            h, at = shingle_sets(x.column("text").to_pylist(), k)
            out = []
            for i, (b, part, side, gid) in enumerate(zip(
                    *(x.column(c).to_pylist() for c in range(4)), strict=True)):
                s = h[at[i]:at[i + 1]]
                if side == 0:
                    own, of = s, (b, part)
                elif (b, part, gid) != last:  # else a repeated row
                    assert of == (b, part)
                    n = len(np.intersect1d(s, own, assume_unique=True))
                    out.append((gid, b, n, len(s) + len(own) - n))
                    last = (b, part, gid)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                    ["a", "b", "both", "either"])

    return materialize(rows.mapInArrow(run, "a long, b long, both long, either long"),
                       "verified")


def _linked(threshold: int) -> Column:
    return 100 * F.col("both") >= threshold * F.col("either")


def _center_pairs(rows: DataFrame, threshold: int, nearest: int | None = None) -> DataFrame:
    """Pairs of centers in different components that may link, or whose members may, from
    entries (token, center, root, n, r, own, sig) of shingles that join several components. ``r``:
    the largest distance of a member from its center; ``own``: 1 if the center itself has the
    shingle in its prefix, 0 if a member has. With ``nearest``, of each list only the pairs of
    each center with so many others that are most alike by their signatures."""
    slack = 1 - threshold / 100

    def meet(c: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
        """Pairs of one list (center, root, n, r, own, sig): a, b, their sizes, the sum of
        their members' distances, and 1 if both have the shingle themselves."""
        center, root, n, r, own, sig = c
        for lo in range(0, len(center) - 1, _SQUARE):
            for at in range(lo, len(center), _SQUARE):  # by squares of the triangle
                i = np.arange(lo, min(lo + _SQUARE, len(center)))[:, None]
                j = np.arange(at, min(at + _SQUARE, len(center)))[None, :]
                less, more = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
                i, j = np.nonzero((i < j) & (root[i] != root[j])
                                  & (less >= (1 - slack - r[i] - r[j]) * more - 1e-6))
                i, j = i + lo, j + at
                if not len(i):
                    continue
                least = np.maximum(1 - slack - r[i] - r[j], 0)
                most = (1 - least) / (1 + least) * (n[i] + n[j]) + 1e-6
                bits = _differing(sig, i, j)
                near = bits <= most
                i, j, bits = i[near], j[near], (bits / most)[near]
                if nearest is not None and len(i):
                    near = _nearest(i, j, bits, nearest)
                    i, j = i[near], j[near]
                i, j = np.where(center[i] < center[j], i, j), np.where(center[i] < center[j], j, i)
                yield [center[i], center[j], n[i], n[j], r[i] + r[j], own[i] * own[j]]

    def batch(found: list[list[np.ndarray]]) -> pa.RecordBatch:
        c = [np.concatenate(x) for x in zip(*found, strict=True)]
        order = np.lexsort((c[1], c[0]))
        c = [x[order] for x in c]
        new = np.flatnonzero(np.r_[True, (c[0][1:] != c[0][:-1]) | (c[1][1:] != c[1][:-1])])
        sums = np.add.reduceat(c[5], new) if len(new) else c[5]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x[new], pa.int64()) for x in c[:4]), pa.array(c[4][new], pa.float64()),
             pa.array(sums, pa.int64())], ["a", "b", "n", "m", "r", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        found: list[list[np.ndarray]] = []
        held = 0
        for b in _then_none(batches):
            if b is not None:
                c = [x.to_numpy(zero_copy_only=False) for x in b.columns]
                c = c if rest is None else [np.concatenate(x) for x in zip(rest, c, strict=True)]
                cut = int(np.searchsorted(c[0], c[0][-1])) if len(c[0]) else 0
                rest, c = [x[cut:] for x in c], [x[:cut] for x in c]
            elif rest is not None:
                c, rest = rest, None
            else:
                break
            if not len(c[0]):
                continue
            new = np.flatnonzero(np.r_[True, c[0][1:] != c[0][:-1]])
            for lo, hi in zip(new, np.r_[new[1:], len(c[0])], strict=True):
                for part in meet([x[lo:hi] for x in c[1:]]):
                    if len(part[0]):
                        found.append(part)
                        held += len(part[0])
                    if held > 500_000:
                        yield batch(found)
                        found, held = [], 0
        if found:
            yield batch(found)

    counted = (rows.repartition("token").sortWithinPartitions("token")
               .mapInArrow(run, "a long, b long, n long, m long, r double, c long")
               .groupBy("a", "b", "n", "m", "r").agg(F.sum("c").alias("c")))
    if nearest is not None:
        return counted.select("a", "b")
    need = _least_shared(F.col("n"), F.col("m"),
                         F.greatest(1 - slack - F.col("r"), F.lit(0.0)), threshold)
    return counted.where(F.col("c") >= need).select("a", "b")


def _then_none(batches):
    yield from batches
    yield None


def classes(docs: DataFrame, k: int = WORDS, threshold: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, th (hash of the text), n_shingles,
    component_id (the smallest doc_id that links reach) and root (a number of the component;
    null without words). ``threshold`` in percent, 52 to 100."""
    spark = start(docs)
    docs = docs.select("doc_id", "text").withColumn("th", F.xxhash64("text"))
    sets = materialize(_sets(docs, k), "sets")
    levels = spark.sparkContext.broadcast(_levels(sets))
    own = sets.where("kind = 0").select("doc_id", "th", "gid", "n", "sig")

    entries, members = _index(docs, levels, k, threshold)
    entries, members = materialize(entries, "entries"), materialize(members, "members")
    heads = (members.groupBy("grp").agg(F.min("gid").alias("head"),
                                        F.max("gid").alias("tail")))
    heads = materialize(heads, "heads")
    names = (own.where("n > 0").groupBy("gid")
             .agg(F.min(F.struct("doc_id", "th")).alias("d"), F.any_value("sig").alias("sig"))
             .select("gid", "d.*", "sig"))
    names = materialize(names, "names")

    # Stars: each group's best candidate, and the classes of a group against its head.
    near = (entries.where(F.col("grp") != F.col("first.grp"))
            .where(_may_link(F.col("n"), F.col("first.n"), F.col("pos"), F.col("first.pos"),
                             threshold))
            .groupBy("grp", F.col("first.grp").alias("to"), "n", F.col("first.n").alias("m"))
            .agg(F.count(F.lit(1)).alias("c"))
            .where(2 * F.col("c") >= _least_shared(
                F.col("n"), F.col("m"), F.lit(threshold / 100), threshold))
            .groupBy("grp").agg(F.max_by("to", F.struct("c", "to")).alias("to")))
    h1, h2 = heads.select("grp", "head"), heads.select(F.col("grp").alias("to"),
                                                      F.col("head").alias("b"))
    outer = near.join(h1, "grp").join(h2, "to").select(F.col("head").alias("a"), "b")
    inner = (members.join(heads.where("head < tail"), "grp").where("gid <> head")
             .select(F.col("gid").alias("a"), F.col("head").alias("b")))
    stars = _verify(outer.unionByName(inner), names, docs, k)
    # A class points to one other at most, of a lesser group or at its own group's head.
    links = stars.where(_linked(threshold)).select("a", "b")
    roots = materialize(forest_roots(links), "roots")

    # Centers: what a class links with in its star, nearest first, or itself.
    far = 1 - F.col("both") / F.col("either")
    star_of = (stars.where(_linked(threshold)).groupBy("a")
               .agg(F.min(F.struct(far.alias("r"), F.col("b").alias("center"))).alias("s"))
               .select(F.col("a").alias("gid"), "s.center", "s.r"))
    # A center may have a center of its own; it also stands for itself.
    itself = star_of.select(F.col("center").alias("gid")).distinct().select(
        "gid", F.col("gid").alias("center"), F.lit(0.0).alias("r"))
    star_of = materialize(star_of.unionByName(itself), "centers")

    def meeting(roots: DataFrame, nearest: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Nodes and widest distances of centers, and verified pairs of centers."""
        node = (members.join(star_of, "gid", "left")
                .join(roots.withColumnRenamed("node", "gid"), "gid", "left")
                .select("grp", "gid", "n", F.coalesce("center", "gid").alias("center"),
                        F.coalesce("r", F.lit(0.0)).alias("r"),
                        F.coalesce("root", "gid").alias("root")))
        node = materialize(node, "nodes")
        widest = node.groupBy("center").agg(F.max("r").alias("r"))
        about = (widest.join(members.select(F.col("gid").alias("center"), "n"), "center")
                 .join(names.select(F.col("gid").alias("center"), "sig"), "center"))
        spots = (node.groupBy("grp", "center", "root")
                 .agg(F.max((F.col("gid") == F.col("center")).cast("int")).alias("own")))
        ends = node.groupBy("grp").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        rows = entries.select("token", "grp")
        if nearest is None:
            mixed = (entries.select("token", "grp", F.col("first.grp").alias("to"))
                     .join(ends, "grp")
                     .join(ends.select(F.col("grp").alias("to"), F.col("lo").alias("lo2"),
                                       F.col("hi").alias("hi2")), "to")
                     .where("lo <> hi or lo2 <> hi2 or lo <> lo2")
                     .select("token").distinct())
            rows = (rows.join(mixed, "token").join(spots, "grp")
                    .groupBy("token", "center", "root").agg(F.max("own").alias("own")))
        else:
            least = [F.min_by("token", F.xxhash64(F.lit(i), "token")) for i in range(_LISTS)]
            rows = (rows.join(spots, "grp").groupBy("center", "root")
                    .agg(F.array_distinct(F.array(*least)).alias("tokens"))
                    .select(F.explode("tokens").alias("token"), "center", "root",
                            F.lit(0).alias("own")))
        rows = (rows.join(about, "center")
                .select("token", "center", "root", F.col("n").cast("long").alias("n"),
                        F.col("r").cast("double").alias("r"), "own", "sig"))
        pairs = _center_pairs(rows, threshold, nearest)
        if nearest is None:
            # Classes of one group that did not link with its head meet as well.
            split = (spots.join(ends.where("lo <> hi").select("grp"), "grp")
                     .select("center", "root", "grp"))
            pairs = pairs.unionByName(split.alias("p").join(split.alias("q"), F.expr(
                "p.grp = q.grp and p.center < q.center and p.root <> q.root"))
                .select(F.col("p.center").alias("a"), F.col("q.center").alias("b")))
        return node, widest, _verify(pairs, names, docs, k)

    def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
        if links.isEmpty():
            return roots
        return materialize(components(
            roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            .unionByName(links)), "roots")

    # Each center with its likeliest partners first: dense crowds become one component, and
    # what is left between components is little. Pairs that this misses come up below.
    near = meeting(roots, _PARTNERS)[2].where(_linked(threshold)).select("a", "b")
    roots = joined(roots, near)
    node, widest, centers = meeting(roots, None)
    more = centers.where(_linked(threshold)).select("a", "b")

    # Members whose centers lie near enough.
    wa = widest.select(F.col("center").alias("a"), F.col("r").alias("ra"))
    wb = widest.select(F.col("center").alias("b"), F.col("r").alias("rb"))
    limit = F.lit(1 - threshold / 100 + 1e-9)
    apart = (centers.where(~_linked(threshold)).withColumn("dist", far)
             .join(wa, "a").join(wb, "b")
             .where((F.col("ra") + F.col("rb") > 0)
                    & (F.col("dist") - F.col("ra") - F.col("rb") <= limit))
             .select("a", "b", "dist"))
    near_a = node.select(F.col("center").alias("a"), F.col("gid").alias("x"),
                         F.col("r").alias("rx"), "root").distinct()
    near_b = near_a.select(F.col("a").alias("b"), F.col("x").alias("y"),
                           F.col("rx").alias("ry"), F.col("root").alias("root2"))
    expand = (apart.join(near_a, "a").join(near_b, "b")
              .where((F.col("dist") - F.col("rx") - F.col("ry") <= limit)
                     & (F.col("rx") + F.col("ry") > 0) & (F.col("root") != F.col("root2")))
              .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    last = _verify(expand, names, docs, k).where(_linked(threshold)).select("a", "b")

    return _named(own, joined(roots, more.unionByName(last)))


def _named(own: DataFrame, roots: DataFrame) -> DataFrame:
    """The smallest doc_id of each row's component. A class of very many rows is spread."""
    empty = own.where("n = 0").select("doc_id", "th", F.col("n").alias("n_shingles"),
                                      F.col("doc_id").alias("component_id"),
                                      F.lit(None).cast("long").alias("root"))
    d = own.where("n > 0").withColumn("part", part_of(["doc_id", "th"], SPREAD))
    small = d.groupBy("gid", "part").agg(F.min("doc_id").alias("least"))
    per_class = small.groupBy("gid").agg(F.min("least").alias("least"))
    to_root = (per_class.join(roots.withColumnRenamed("node", "gid"), "gid", "left")
               .select("gid", "least", F.coalesce("root", "gid").alias("root")))
    per_root = with_group_total(to_root, ["root"], ["gid"],
                                {"component_id": (F.min("least"), F.min("component_id"))})
    back = small.select("gid", "part").join(
        per_root.select("gid", "component_id", "root"), "gid")
    return (d.join(back, ["gid", "part"])
            .select("doc_id", "th", F.col("n").alias("n_shingles"), "component_id", "root")
            .unionByName(empty))
