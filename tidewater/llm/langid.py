"""Language identification by character language models.

Per language an interpolated Kneser-Ney model over character n-grams (order 4), trained on
all labelled documents. N-grams are known by 64-bit hashes; counts, continuation counts,
discounts, probabilities and back-off weights are groupings and joins in Spark, so the model
grows with the corpus and nothing of it is cut. It is a table in the shared folder, sorted
by hash: for each n-gram the log probability, for each context the back-off weight, in every
language. A text takes the language with the lowest cross-entropy per character.

Scoring looks n-grams up in sorted hash arrays. A model of at most ``broadcast_bytes`` goes
to all tasks; of a larger one, batches of different texts are joined with the entries that
occur in them. Both give the same results.

The temperature of the score and the limits of rejection are fitted on the cross-entropies
of all labelled documents: losses and deviations are sums, medians are found in sorted parts.

Defined cases: a null text, or one without a letter, gives ``und`` with score 0 and is
rejected; with no labelled text at all every document is ``und``; equal cross-entropies go
to the language first in order; repeated rows count again in training and are predicted
again; a null id never counts as held out.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import bounded, mix, start
from tidewater.session import materialize

ORDER = 4
CHUNK_CHARS = 1 << 17  # characters that a task works on at once
SLICE_BYTES = 1 << 20  # text that a task takes from Arrow at once
HELD_GRAMS = 1 << 18  # n-grams that a task counts before it hands them on
BROADCAST_BYTES = 1 << 26  # arrays of a model that may go to all tasks
BATCH_BYTES = 1 << 22  # text of a batch that meets its entries of a larger model
UNKNOWN = "und"
_PAD, _SPACE = 1, 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STATE: dict = {}


def _fold() -> tuple[np.ndarray, np.ndarray]:
    """Code point -> lower-case letter, mark, or space; code point -> is a letter."""
    if "fold" not in _STATE:
        fold = np.full(0x110000, _SPACE, np.uint32)
        letter = np.zeros(0x110000, bool)
        for i in range(0x110000):
            kind = unicodedata.category(chr(i))[0]
            if kind in "LM":
                low = chr(i).lower()
                fold[i] = ord(low) if len(low) == 1 else i
                letter[i] = kind == "L"
        _STATE["fold"] = fold, letter
    return _STATE["fold"]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Folded characters of consecutive texts, with the text each belongs to (-1: padding).
    Every text begins with ORDER - 1 pads, which only serve as context; a long text comes
    in several pieces, each with the characters before it as context."""
    fold, _ = _fold()
    pad = np.full(ORDER - 1, _PAD, np.uint32)
    parts: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    held = 0
    for i, t in enumerate(texts):
        a = fold[_points(t or "")]
        if len(a):
            a = a[~((a == _SPACE) & (np.r_[_SPACE, a[:-1]] == _SPACE))]
        if len(a) and a[-1] != _SPACE:
            a = np.append(a, np.uint32(_SPACE))
        if parts and held + len(a) > CHUNK_CHARS:
            yield np.concatenate(parts), np.concatenate(owners)
            parts, owners, held = [], [], 0
        if len(a) > CHUNK_CHARS:
            a = np.concatenate([pad, a])
            for at in range(0, len(a) - len(pad), CHUNK_CHARS):
                part = a[at:at + CHUNK_CHARS + ORDER - 1]
                owner = np.full(len(part), i)
                owner[:ORDER - 1] = -1
                yield part, owner
            continue
        parts += [pad, a]
        owners += [np.full(ORDER - 1, -1), np.full(len(a), i)]
        held += len(a)
    if parts:
        yield np.concatenate(parts), np.concatenate(owners)


def _hashes(chars: np.ndarray) -> list[np.ndarray]:
    """For each order, the hash of the n-gram that ends at each character."""
    c = chars.astype(np.uint64)
    poly, out = c, []
    for n in range(1, ORDER + 1):
        if n > 1:
            poly = np.concatenate([c[:1], poly[:-1] * _BASE + c[1:]])
        out.append(mix(poly + np.uint64(n)).view(np.int64))
    return out


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Chains (see ``_count``) of several chunks, each once, with the sum of their counts."""
    chain = np.concatenate([c for c, _ in parts])
    n = np.concatenate([n for _, n in parts])
    _, first, which = np.unique(chain[:, ORDER - 1], return_index=True, return_inverse=True)
    return chain[first], np.bincount(which, n, len(first)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams of every order (k, from 0) with the hashes of their context and their suffix.
    ``n`` counts occurrences of the highest order; lower ones need only be there."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, (chain, n) in held.items():
            for k in range(ORDER):
                h, first = np.unique(chain[:, k], return_index=True)
                none = np.zeros(len(h), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(h), pa.string()),
                     pa.array(np.full(len(h), k, np.int32)), pa.array(h),
                     pa.array(chain[first, ORDER + k - 1] if k else none),
                     pa.array(chain[first, k - 1] if k else none),
                     pa.array(n[first] if k == ORDER - 1 else none + 1)],
                    ["lang", "k", "h", "ctx", "suf", "n"])
        held.clear()

    for b in bounded(batches, most=SLICE_BYTES):
        langs = np.asarray(b.column("lang").to_pylist(), dtype=object)
        texts = b.column("text").to_pylist()
        for lang in sorted(set(langs)):
            parts = [held[lang]] if lang in held else []
            merged = fresh = 0
            for chars, owner in _pieces([texts[i] for i in np.flatnonzero(langs == lang)]):
                at = np.flatnonzero(owner >= 0)
                h = _hashes(chars)
                _, first, n = np.unique(h[-1][at], return_index=True, return_counts=True)
                at = at[first]
                # A chain: the n-grams of all orders that end here, then all contexts.
                chain = np.stack([h[k][at] for k in range(ORDER)]
                                 + [h[k][at - 1] for k in range(ORDER - 1)], axis=1)
                parts.append((chain, n))
                fresh += len(n)
                if fresh > max(merged, HELD_GRAMS >> 1):  # a long text is many pieces
                    held[lang] = _merged(parts)
                    if sum(len(n) for _, n in held.values()) > HELD_GRAMS:
                        yield from rows()
                    parts = [held[lang]] if lang in held else []
                    merged, fresh = sum(len(n) for _, n in parts), 0
            if parts:
                held[lang] = _merged(parts)
        if sum(len(n) for _, n in held.values()) > HELD_GRAMS:
            yield from rows()
    yield from rows()


class Arrays:
    """Sorted hashes by order, with log probabilities of n-grams and back-off weights of
    contexts in every language: a whole model, or the part of it that a batch needs."""

    def __init__(self, rows: pa.Table, unseen: np.ndarray):
        k, h = (rows.column(c).to_numpy() for c in ("k", "h"))
        weight = np.asarray(rows.column("weight").to_pylist(), bool)
        v = rows.column("v").combine_chunks()
        v = np.asarray(v.flatten() if len(v) else [], np.float32).reshape(-1, len(unseen))
        self.unseen = unseen.astype(np.float32)
        self.parts = {}
        for order in range(ORDER):
            for w in (False, True):
                at = np.flatnonzero((k == order) & (weight == w))
                at = at[np.argsort(h[at])]
                self.parts[order, w] = h[at], v[at]

    def _find(self, k: int, weight: bool, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the hashes, and which of them are there."""
        keys, v = self.parts[k, weight]
        if not len(keys):
            return np.zeros((len(want), len(self.unseen)), np.float32), np.zeros(len(want), bool)
        row = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        return v[row], keys[row] == want

    def _logp(self, k: int, at: np.ndarray, hashes: list[np.ndarray]) -> np.ndarray:
        out, there = self._find(k, False, hashes[k][at])
        gone = np.flatnonzero(~there)
        if len(gone):
            if k:
                w, known = self._find(k - 1, True, hashes[k - 1][at[gone] - 1])
                w[~known] = 0
                out[gone] = w + self._logp(k - 1, at[gone], hashes)
            else:
                out[gone] = self.unseen
        return out

    def entropy(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character in each language, and the characters of each text
        (0 for a text without a letter)."""
        total = np.zeros((len(texts), len(self.unseen)))
        size = np.zeros(len(texts), np.int64)
        for chars, owner in _pieces(texts):
            at = np.flatnonzero(owner >= 0)
            if not len(at):
                continue
            lp = self._logp(ORDER - 1, at, _hashes(chars))
            who = owner[at]
            first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
            total[who[first]] -= np.add.reduceat(lp, first, axis=0, dtype=np.float64)
            size[who[first]] += np.diff(np.r_[first, len(who)])
        _, letter = _fold()
        has = np.asarray([bool(t) and bool(letter[_points(t)].any()) for t in texts], bool)
        size[~has] = 0
        return total / np.maximum(size, 1)[:, None], size


class Model:
    """A trained model: the table of its entries, its arrays where they are small enough to go
    to all tasks, and what calibration found."""

    def __init__(self, langs: list[str], table: DataFrame, unseen: np.ndarray,
                 arrays: Arrays | None):
        self.langs, self.table, self.unseen, self.arrays = langs, table, unseen, arrays
        self.temperature = 1.0
        self.mean = np.zeros(len(langs))
        self.spread = np.full(len(langs), np.inf)  # between long documents
        self.noise = np.zeros(len(langs))  # variance of one character

    def calibrate(self, seen: DataFrame) -> None:
        """From the cross-entropies (_ce) and sizes (_size) of labelled documents (lang)."""
        names = F.array(*[F.lit(x) for x in self.langs])
        rows = (seen.withColumn("j", F.array_position(names, F.col("lang")).cast("int") - 1)
                .where("_size > 0 and j >= 0")
                .select("j", F.col("_size").alias("size"), F.col("_ce").alias("ce"),
                        F.col("_ce")[F.col("j")].alias("own")))
        rows = materialize(rows, "langid-calibration")
        tried = np.geomspace(0.05, 50, 40)
        n = rows.count()
        if not n:
            return

        def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(tried))
            for b in batches:
                if not b.num_rows:
                    continue
                j, size = (b.column(c).to_numpy() for c in ("j", "size"))
                ce = b.column("ce").flatten().to_numpy().reshape(len(j), -1)
                for i, t in enumerate(tried):
                    z = -ce * t * np.sqrt(size)[:, None]
                    z -= z.max(axis=1, keepdims=True)
                    total[i] -= (z[np.arange(len(z)), j] - np.log(np.exp(z).sum(axis=1))).sum()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(tried), dtype=np.int32)), pa.array(total)], ["i", "loss"])

        loss = {r.i: r.loss / n for r in rows.select("j", "size", "ce").mapInArrow(
            losses, "i int, loss double").groupBy("i").agg(F.sum("loss").alias("loss")).collect()}
        best = np.inf
        for i, t in enumerate(tried):
            if loss[i] < best - 1e-9:
                best, self.temperature = loss[i], float(t)
        middle, half = _medians(rows, "own"), _medians(rows, "size")
        for j, x in middle.items():
            self.mean[j] = x

        def of(values) -> Column:
            return F.array(*[F.lit(float(x)) for x in values])[F.col("j")]

        rows = rows.select("j", "size", (F.col("own") - of(self.mean)).alias("off"),
                           of([half.get(j, 0) for j in range(len(self.langs))]).alias("half"))
        for r in rows.where("size >= half").groupBy("j").agg(
                F.avg(F.col("off") * F.col("off")).alias("v")).collect():
            self.spread[r.j] = max(float(np.sqrt(r.v)), 0.02)
        # What the spread between documents explains is no noise of characters.
        rest = F.greatest(F.col("off") * F.col("off") - of(self.spread ** 2), F.lit(0.0))
        for r in rows.where("size <= half").groupBy("j").agg(
                F.avg(rest * F.col("size")).alias("v")).collect():
            self.noise[r.j] = float(r.v)


def _medians(rows: DataFrame, column: str) -> dict[int, float]:
    """The exact median of a column for each ``j``. Different values are counted and sorted in
    parts; only the parts that hold a middle row are looked into."""
    counts = (rows.groupBy("j", F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
              .repartitionByRange("j", "v").withColumn("part", F.spark_partition_id()))
    counts = materialize(counts, "langid-medians")
    parts: dict[int, list[tuple[int, int]]] = {}
    for r in counts.groupBy("j", "part").agg(F.sum("n").alias("n")).orderBy("j", "part").collect():
        parts.setdefault(r.j, []).append((r.part, r.n))
    wanted = []  # j, part, which row of the part
    for j, own in parts.items():
        total, before = sum(n for _, n in own), 0
        ranks = {(total - 1) // 2, total // 2}
        for part, n in own:
            wanted += [(j, part, r - before) for r in sorted(ranks) if before <= r < before + n]
            before += n
    if not wanted:
        return {}
    j, part, n, v = (F.col(c) for c in ("j", "part", "n", "v"))
    here = F.lit(False)
    for x, p in sorted({w[:2] for w in wanted}):
        here = here | ((j == x) & (part == p))
    end = F.sum("n").over(Window.partitionBy("j", "part").orderBy("v"))
    hit = F.lit(False)
    for x, p, r in wanted:
        hit = hit | ((j == x) & (part == p) & (F.col("end") - n <= r) & (F.col("end") > r))
    found: dict[int, list[float]] = {}
    for r in counts.where(here).withColumn("end", end).where(hit).select(j, v).collect():
        found.setdefault(r.j, []).append(float(r.v))
    return {x: sum(vs) / len(vs) for x, vs in found.items()}


def _entries(seen: DataFrame, langs: list[str]) -> tuple[DataFrame, list[str], np.ndarray] | None:
    """Table of all entries (k, weight, h, v), the languages that have n-grams, and the log
    probability of an unseen character in each. ``seen``: k, h, ctx, suf and n0, n1, ..."""
    def each(name: str, of, keep=range(len(langs))) -> list[Column]:
        return [of(j).alias(f"{name}{j}") for j in keep]

    def count_if(cond: Column) -> Column:
        return F.sum(cond.cast("long"))

    parts = []
    for k in range(ORDER):
        own = seen.where(F.col("k") == k)
        if k < ORDER - 1:  # in how many contexts it occurs, for all but the highest
            kinds = (seen.where(F.col("k") == k + 1).groupBy(F.col("suf").alias("h"))
                     .agg(*each("c", lambda j: count_if(F.col(f"n{j}") > 0))))
            own = own.select("k", "h", "ctx", "suf").join(kinds, "h")
        else:
            own = own.withColumnsRenamed({f"n{j}": f"c{j}" for j in range(len(langs))})
        parts.append(own.select("k", "h", "ctx", "suf", *each("c", lambda j: F.col(f"c{j}"))))
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    counts = materialize(counts, "langid-counts")
    stats = {r.k: r for r in counts.groupBy("k").agg(
        F.count(F.lit(1)).alias("size"), *each("all", lambda j: F.sum(f"c{j}")),
        *each("kinds", lambda j: count_if(F.col(f"c{j}") > 0)),
        *each("once", lambda j: count_if(F.col(f"c{j}") == 1)),
        *each("twice", lambda j: count_if(F.col(f"c{j}") == 2))).collect()}
    if not stats:
        return None
    keep = [j for j in range(len(langs)) if stats[0][f"all{j}"]]
    vocabulary = stats[0]["size"] + 1
    unseen, lower, tables = np.zeros(len(keep)), None, []
    for k in range(ORDER):
        r = stats[k]
        cut = {j: min(max(r[f"once{j}"] / max(r[f"once{j}"] + 2 * r[f"twice{j}"], 1), 0.1), 0.95)
               for j in keep}
        own = counts.where(F.col("k") == k)
        if k == 0:
            share = {j: cut[j] * r[f"kinds{j}"] / r[f"all{j}"] for j in keep}
            unseen[:] = [np.log(max(share[j], 1e-6) / vocabulary) for j in keep]
            got = [F.when(F.col(f"c{j}") > 0, F.log(F.greatest(
                (F.col(f"c{j}") - cut[j]) / r[f"all{j}"] + share[j] / vocabulary, F.lit(1e-12))))
                .otherwise(float(unseen[i])) for i, j in enumerate(keep)]
        else:
            contexts = own.groupBy("ctx").agg(
                *each("t", lambda j: F.sum(f"c{j}"), keep),
                *each("d", lambda j: count_if(F.col(f"c{j}") > 0), keep)).select(
                "ctx", *each("t", lambda j: F.col(f"t{j}"), keep),
                *each("w", lambda j, cut=cut: F.when(F.col(f"d{j}") > 0, F.log(
                    cut[j] * F.col(f"d{j}") / F.col(f"t{j}"))).otherwise(0.0), keep))
            tables.append(contexts.select(
                F.lit(k - 1).alias("k"), F.lit(True).alias("weight"), F.col("ctx").alias("h"),
                F.array(*[F.col(f"w{j}") for j in keep]).alias("v")))
            own = (own.join(contexts, "ctx")
                   .join(lower.select(F.col("h").alias("suf"), F.col("v").alias("q")), "suf"))
            # What only another language has seen backs off here.
            got = [F.when(F.col(f"c{j}") > 0, F.log(F.greatest(
                F.greatest(F.col(f"c{j}") - cut[j], F.lit(0.0)) / F.col(f"t{j}")
                + F.exp(F.col(f"w{j}") + F.col("q")[i]), F.lit(1e-12))))
                .otherwise(F.col(f"w{j}") + F.col("q")[i]) for i, j in enumerate(keep)]
        lower = materialize(own.select("k", F.lit(False).alias("weight"), "h",
                                       F.array(*got).alias("v")), f"langid-order-{k}")
        tables.append(lower)
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    out = out.withColumn("v", F.col("v").cast("array<float>"))
    out = out.repartitionByRange("h").sortWithinPartitions("h")
    return materialize(out, "langid-model"), [langs[j] for j in keep], unseen


def train(labelled: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> Model | None:
    """Model of all rows of ``labelled`` (text, lang) that have text and lang, calibrated on
    all of them."""
    start(labelled)
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    grams = (rows.select("lang", "text")
             .mapInArrow(_count, "lang string, k int, h long, ctx long, suf long, n long")
             .groupBy("lang", "k", "h").agg(F.max("ctx").alias("ctx"), F.max("suf").alias("suf"),
                                            F.sum("n").alias("n")))
    grams = materialize(grams, "langid-grams")
    langs = sorted(r.lang for r in grams.where("k = 0").select("lang").distinct().collect())
    if not langs:
        return None
    found = _entries(grams.groupBy("k", "h").agg(
        F.max("ctx").alias("ctx"), F.max("suf").alias("suf"),
        *[F.coalesce(F.sum(F.when(F.col("lang") == g, F.col("n"))), F.lit(0)).alias(f"n{j}")
          for j, g in enumerate(langs)]), langs)
    if found is None:
        return None
    table, langs, unseen = found
    small = table.count() * (8 + 4 * len(langs)) <= broadcast_bytes
    model = Model(langs, table, unseen, Arrays(table.toArrow(), unseen) if small else None)
    model.calibrate(_entropies(rows.select("lang", "text"), model)
                    .select("lang", "_ce", "_size"))
    return model


_CE = T.StructType([T.StructField("_ce", T.ArrayType(T.DoubleType())),
                    T.StructField("_size", T.LongType())])


def _measured(arrays: Arrays, texts: list[str | None]) -> list[pa.Array]:
    ce, size = arrays.entropy(texts)
    at = np.arange(0, ce.size + 1, ce.shape[1], dtype=np.int32)
    return [pa.ListArray.from_arrays(pa.array(at), pa.array(ce.ravel())), pa.array(size)]


def _entropies(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with the cross-entropy in each language (_ce) and the characters (_size)."""
    if model.arrays is None:
        return _entropies_by_join(docs, model)
    shared = docs.sparkSession.sparkContext.broadcast(model.arrays)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, most=SLICE_BYTES):
            got = _measured(shared.value, b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, *got],
                                             [*b.schema.names, *_CE.names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *_CE.fields]))


def _entropies_by_join(docs: DataFrame, model: Model) -> DataFrame:
    """The same with a model of any size: different texts are dealt to batches, a batch asks
    for its different n-grams, and meets the entries found."""
    key = [F.xxhash64("text").alias("_a"), F.xxhash64(F.lit(1), F.col("text")).alias("_b")]
    texts = docs.select(*key, "text").dropDuplicates(["_a", "_b"])
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = F.lit(size // BATCH_BYTES + 1)
    texts = materialize(texts.withColumn("_batch", F.pmod("_a", batches)), "langid-texts")
    unseen = model.unseen

    def ask(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(parts):
            batch = b.column("_batch").to_numpy()
            body = b.column("text").to_pylist()
            for x in np.unique(batch):
                for chars, owner in _pieces([body[i] for i in np.flatnonzero(batch == x)]):
                    at = np.flatnonzero(owner >= 0)
                    hashes = _hashes(chars)
                    for k in range(ORDER):
                        for w in (False, True)[:1 + (k < ORDER - 1)]:
                            h = np.unique(hashes[k][at - 1 if w else at])
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(h), x)),
                                 pa.array(np.full(len(h), k, np.int32)),
                                 pa.array([w] * len(h), pa.bool_()), pa.array(h)],
                                ["_batch", "k", "weight", "h"])

    asked = (texts.repartition("_batch")
             .mapInArrow(ask, "_batch long, k int, weight boolean, h long").distinct())
    entries = asked.join(model.table, ["k", "weight", "h"])

    def score(own: pa.Table, entry: pa.Table) -> pa.Table:
        got = _measured(Arrays(entry, unseen), own.column("text").to_pylist())
        return pa.table([own.column("_a"), own.column("_b"), *got], ["_a", "_b", *_CE.names])

    scored = (texts.groupBy("_batch").cogroup(entries.groupBy("_batch"))
              .applyInArrow(score, T.StructType([T.StructField("_a", T.LongType()),
                                                 T.StructField("_b", T.LongType()),
                                                 *_CE.fields])))
    return docs.select("*", *key).join(scored, ["_a", "_b"]).drop("_a", "_b")


def identify(docs: DataFrame, model: Model | None, reject_z: float = 8.0,
             reject_nats: float = 1.5) -> DataFrame:
    """The columns of ``docs`` and lang_pred, score (0 to 1), cross_entropy and rejected
    (which replace columns of these names). A text is rejected when its cross-entropy lies
    ``reject_z`` deviations and ``reject_nats`` a character above its language's mean: text
    in two known languages stays, text in none goes."""
    start(docs)
    docs = docs.drop("lang_pred", "score", "cross_entropy", "rejected", "_ce", "_size")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0),
                                 "cross_entropy": F.lit(None).cast("double"),
                                 "rejected": F.lit(True)})

    def of(values) -> Column:  # the value of the language found
        return F.array(*[F.lit(x if isinstance(x, str) else float(x)) for x in values])[best - 1]

    ce, size = F.col("_ce"), F.col("_size")
    low = F.array_min(ce)
    best = F.array_position(ce, low).cast("int")
    none = size == 0
    apart = F.transform(ce, lambda x: F.exp((low - x) * model.temperature * F.sqrt(size)))
    limit = F.greatest(F.lit(float(reject_nats)), reject_z * F.sqrt(
        of(model.spread ** 2) + of(model.noise) / F.greatest(size, F.lit(1))))
    return _entropies(docs, model).withColumns({
        "lang_pred": F.when(none, UNKNOWN).otherwise(of(model.langs)),
        "score": F.when(none, 0.0).otherwise(
            1 / F.aggregate(apart, F.lit(0.0), lambda total, x: total + x)),
        "cross_entropy": F.when(~none, low),
        "rejected": none | (low - of(model.mean) > limit)}).drop("_ce", "_size")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(3)) == 1
