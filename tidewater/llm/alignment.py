"""Alignment of the tokens of two tokenizers by diagonal run skipping.

Both tokenizers encode a space and the text; the byte offsets where tokens of both end cut the
tokens into groups. Per text the two sorted arrays of end offsets are walked together: at a
common end with index shift d = j - i, ends i.. of A are compared with ends i + d.. of B in
blocks of 16, 32, 64 ... entries while they agree, which
jumps a whole one-to-one stretch in few comparisons. Where the ends disagree, the group is
resolved locally: the side that is behind advances until both end together, which gives the
next shift. The last tokens of a group end together and form a link (A id, B id).

How it spreads: texts are encoded where they lie; a task writes per text its figures and its
links (4 bytes each). Links are counted per batch before one exchange by id pair. The counts
of the most frequent pairs (at most ``FREQUENT``) go to all tasks, which look up the links of
their texts; a pair beyond these is rare by construction, so its links meet their count in an
ordinary join.

Long texts are encoded in blocks cut between a letter, comma or full stop and a space with a
letter behind it: neither tokenizer has tokens across such a place, so the result is the same.

Defined cases: a null or empty text, and one that the tokens of either side do not spell, has
no tokens: zeros and an empty digest. A repeated row counts and is returned again; a null
doc_id is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded, start
from tidewater.session import materialize

FREQUENT = 1_000_000  # id pairs whose counts every task gets
BLOCK = 1 << 16  # characters encoded at once
LONG_GAP = 1000  # characters of white space in a row that the fast encoder is not given
_CUT = re.compile(r"[A-Za-z,.](?= [A-Za-z])")
_GAP = re.compile(r"\s{%d}" % LONG_GAP)
_PLAIN = re.compile(r"[\t\n\r -~\u00c0-\u00ff]*")
_SPACE = "▁".encode()
_PROBE = 64  # bytes of end offsets compared first
_PLACES: dict = {}


# Code points that stand for themselves among the characters of a byte-level
# vocabulary; the other bytes are, in order, U+0100 onwards.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_values() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte."""
    rest = [b for b in range(256) if b not in set(_PRINTABLE)]
    return ({chr(b): b for b in _PRINTABLE}
            | {chr(256 + k): b for k, b in enumerate(rest)})


class ByteLevel:
    """Ids of a byte-level BPE given as a tokenizers file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        value = byte_values()
        self.pieces = [b""] * (max(model["vocab"].values()) + 1)
        for entry, i in model["vocab"].items():
            if all(c in value for c in entry):
                self.pieces[i] = bytes(value[c] for c in entry)
        # Ids of the vocabulary rise in the order of the merges, so they serve as ranks.
        merged = {"".join(m) if isinstance(m, list) else m.replace(" ", "")
                  for m in model["merges"]}
        ranks = {bytes(value[c] for c in e): i for e, i in model["vocab"].items()
                 if len(e) == 1 or e in merged}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens={})
        self.stable: dict[str, bool] = {}

    def _known(self, c: str) -> bool:
        """Whether the class of a character is the same in all versions of Unicode, so that
        both encoders split it alike."""
        if c not in self.stable:
            old, new = unicodedata.ucd_3_2_0.category(c), unicodedata.category(c)
            self.stable[c] = (old != "Cn" and old[0] == new[0] and (old == "Zs") == (new == "Zs")
                              and (old[0] != "C" or c in "\t\n\r"))
        return self.stable[c]

    def ids(self, text: str) -> list[int]:
        plain = _PLAIN.fullmatch(text) or all(map(self._known, set(text)))
        if plain and not _GAP.search(text):
            return self.fast.encode_ordinary(text)
        return self.exact.encode(text, add_special_tokens=False).ids


class Pieces:
    """Ids of a sentencepiece model; it puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces, known = [], 0
        for i in range(self.model.get_piece_size()):
            p = self.model.id_to_piece(i)
            known += self.model.is_byte(i)
            self.pieces.append(bytes([int(p[3:-1], 16)]) if self.model.is_byte(i)
                               else p.replace("▁", " ").encode())
        rule = sentencepiece_model_pb2.ModelProto.FromString(
            self.model.serialized_model_proto()).normalizer_spec
        self.literal = (known == 256 and rule.name == "identity" and rule.add_dummy_prefix
                        and not rule.remove_extra_whitespaces)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def spells(self, ids: list[int], text: bytes) -> bool:
        """Whether the pieces, joined, are ``text``, given that their lengths add up to its
        length. A model that leaves texts as they are and knows all bytes only changes the
        character which stands for a space in pieces."""
        if self.literal:
            return _SPACE not in text
        return b"".join(map(self.pieces.__getitem__, ids)) == text


def _both(a: str, b: str) -> tuple[ByteLevel, Pieces]:
    if (a, b) not in _PLACES:
        _PLACES[a, b] = ByteLevel(a), Pieces(b)
    return _PLACES[a, b]


def blocks(text: str, most: int = BLOCK) -> list[str]:
    """``text`` cut into blocks of about ``most`` characters at places where no token can
    cross; the space at a cut goes, as every block gets one in front."""
    out, at = [], 0
    while len(text) - at > most:
        m = _CUT.search(text, at + most)
        if m is None:
            break
        out.append(text[at:m.end()])
        at = m.end() + 1
    out.append(text[at:])
    return out


def diagonal_runs(ea: np.ndarray, eb: np.ndarray) -> list[tuple[int, int, int]]:
    """Walks two rising arrays (int32, equal last entries). Gives (i, n, shift): entries i to
    i + n - 1 of the first are equal to those ``shift`` places further on in the second. With
    n > 1 it is a one-to-one stretch; what lies between two results belongs to the group that
    the second of them ends. Stretches are compared as bytes in growing blocks, and the lowest
    differing bit tells where one ends."""
    xs, ys = ea.tolist(), eb.tolist()
    xb, yb = ea.tobytes(), eb.tobytes()
    end, i, shift, out = len(xs), 0, 0, []
    whole = int.from_bytes
    while i < end:
        k, d, step = 4 * i, 4 * shift, _PROBE
        while k < 4 * end:
            x, y = xb[k:k + step], yb[k + d:k + d + step]
            if x != y:
                differ = whole(x, "little") ^ whole(y, "little")
                k += ((differ & -differ).bit_length() - 1) // 32 * 4
                break
            k += step
            step *= 2
        k = min(k // 4, end)
        if k > i:
            out.append((i, k - i, shift))
            i = k
            if k == end:
                break
        j = i + shift
        x, y = xs[i], ys[j]
        while x != y:
            if x < y:
                i += 1
                x = xs[i]
            else:
                j += 1
                y = ys[j]
        shift = j - i
        out.append((i, 1, shift))
        i += 1
    return out


class _Aligner:
    """Aligns texts and holds what that needs of the two vocabularies."""

    def __init__(self, a: str, b: str):
        self.a, self.b = _both(a, b)
        self.len_a = np.asarray([len(p) for p in self.a.pieces], np.int32)
        self.len_b = np.asarray([len(p) for p in self.b.pieces], np.int32)
        self.base = len(self.len_b)
        ids = [range(len(self.len_a)), range(self.base)]
        # Texts of A's ids inside a group and at its end, then of B's, padded with zero bytes.
        self.says = np.asarray([f"{i}{mark}".encode()
                                for n, marks in zip(ids, (",|", ",;"), strict=True)
                                for mark in marks for i in n])
        small = len(self.len_a) * self.base <= 1 << 32
        self.kind = np.dtype("<u4" if small else "<u8")

    def tokens(self, block: str, b: list[int]) -> tuple[np.ndarray, ...] | None:
        """Ids of A and B and the offsets where they end, or None if they do not spell the
        block. Tokens of A are slices of it, so their length tells."""
        spelled = f" {block}"
        want = spelled.encode("utf-8")
        if not self.b.spells(b, want):
            return None
        a, b = np.asarray(self.a.ids(spelled), np.int32), np.asarray(b, np.int32)
        ea, eb = np.cumsum(self.len_a[a], dtype=np.int32), np.cumsum(self.len_b[b], dtype=np.int32)
        return (a, b, ea, eb) if ea[-1] == len(want) == eb[-1] else None

    def groups(self, a, b, ea, eb) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Text of the groups, and the places of A's and B's tokens that end them."""
        first, n, shift = np.asarray(diagonal_runs(ea, eb)).T
        at = np.cumsum(n)
        last_a = np.repeat(first - (at - n), n) + np.arange(at[-1])
        last_b = last_a + np.repeat(shift, n)
        in_a = np.diff(last_a, prepend=-1)  # tokens of each group
        in_b = np.diff(last_b, prepend=-1)
        # In the text, a token of A stands behind B's tokens of all groups before, one of B
        # behind A's tokens of its own group as well.
        say = np.empty(len(a) + len(b), np.int32)
        say_a, say_b = a.copy(), b + np.int32(2 * len(self.len_a))
        say_a[last_a] += len(self.len_a)
        say_b[last_b] += self.base
        say[np.arange(len(a)) + np.repeat(last_b + 1 - in_b, in_a)] = say_a
        say[np.arange(len(b)) + np.repeat(last_a + 1, in_b)] = say_b
        return self.says[say].tobytes().replace(b"\0", b"")[:-1], last_a, last_b


def align(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, groups_sha256 and links,
    the id pairs of the groups' last tokens in order (A id times the size of B's vocabulary
    plus B id). ``a``: a byte-level tokenizers file, ``b``: a sentencepiece model, both at a
    path that every executor can read."""
    start(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, "
              "links binary")

    def one(al: _Aligner, cut: list[str], ids: list[list[int]]) -> tuple:
        digest, links, n_a, n_b, n = hashlib.sha256(), [], 0, 0, 0
        for block, b_ids in zip(cut, ids, strict=True):
            found = al.tokens(block, b_ids)
            if found is None:
                n_a = 0
                break
            said, last_a, last_b = al.groups(*found)
            digest.update(b";" + said if n else said)
            pair = (found[0][last_a].astype(np.uint64) * np.uint64(al.base)
                    + found[1][last_b].astype(np.uint64))
            links.append(np.sort(pair.astype(al.kind)).tobytes())
            n_a, n_b, n = n_a + len(found[0]), n_b + len(found[1]), n + len(last_a)
        if not n_a:
            return 0, 0, 0, "", b""
        return n_a, n_b, n, digest.hexdigest(), b"".join(links)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = _Aligner(a, b)
        for batch in bounded(batches, most=1 << 20):
            texts = [blocks(t) if t else [] for t in batch.column("text").to_pylist()]
            ids = iter(al.b.ids([block for cut in texts for block in cut]))
            rows = [one(al, cut, [next(ids) for _ in cut]) for cut in texts]
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]],
                 pa.array(cols[3], pa.string()), pa.array(cols[4], pa.binary())],
                ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _sizes(a: str, b: str) -> tuple[int, str]:
    """Size of B's vocabulary and the type in which links are written."""
    al = _Aligner(a, b)
    return al.base, al.kind.str


def _links_of(batch: pa.RecordBatch, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All links of a batch, and the row of each."""
    col = batch.column("links")
    flat = np.frombuffer(b"".join(col.to_pylist()), kind)
    size = pc.binary_length(col).to_numpy(zero_copy_only=False) // flat.itemsize
    return flat, np.repeat(np.arange(len(col)), size)


def count_links(aligned: DataFrame, base: int, kind: str) -> DataFrame:
    """Every id pair of ``aligned``: pair, n (links of it in all texts), best (whether no other
    pair of its B id has more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "links", 1 << 24):
            pair, n = np.unique(_links_of(batch, kind)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair.astype(np.int64)), pa.array(n.astype(np.int64))], ["pair", "n"])

    counts = materialize(aligned.select("links").mapInArrow(run, "pair long, n long")
                         .groupBy("pair").agg(F.sum("n").alias("n"))
                         .withColumn("b", F.col("pair") % base), "link-counts")
    top = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(top, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _frequent_from(counts: DataFrame, most: int) -> int:
    """The smallest power of two from which on at most ``most`` pairs have that count."""
    level = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    total, least = 0, 64
    for r in sorted(counts.groupBy(level.alias("k")).count().collect(), reverse=True):
        total += r["count"]  # at most 64 rows
        if total > most:
            break
        least = r.k
    return 1 << min(least, 62)


def score(aligned: DataFrame, base: int, kind: str, frequent: int = FREQUENT) -> DataFrame:
    """Adds n_links, n_best (links whose count is the highest of their B id) and count_sum
    (their counts) to the rows of ``align``, a written table with a number ``_row`` for each
    row; ``links`` and ``_row`` go."""
    counts = materialize(count_links(aligned, base, kind), "link-best")
    least = _frequent_from(counts, frequent)
    top = counts.where(F.col("n") >= least).toArrow()  # at most ``frequent`` rows
    keys = top["pair"].to_numpy()
    order = np.argsort(keys)
    table = aligned.sparkSession.sparkContext.broadcast(
        (keys[order], top["n"].to_numpy()[order], top["best"].to_numpy()[order]))
    kept = [f for f in aligned.schema.fields if f.name not in ("links", "_row")]
    names = [f.name for f in kept]
    schema = (", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
              + ", _row long, n_links long, n_best long, count_sum long")

    def find(batch: pa.RecordBatch):
        known, n, best = table.value
        pair, row = _links_of(batch, kind)
        pair = pair.astype(np.int64)
        at = np.searchsorted(known, pair)
        hit = np.zeros(len(pair), bool)
        inside = at < len(known)
        hit[inside] = known[at[inside]] == pair[inside]
        return pair, row, hit, n[at[hit]], best[at[hit]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "links", 1 << 23):
            _, row, hit, n, best = find(batch)
            total, good = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            np.add.at(total, row[hit], n)
            np.add.at(good, row[hit], best.astype(np.int64))
            links = np.bincount(row, minlength=len(batch)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in [*names, "_row"]], pa.array(links),
                 pa.array(good), pa.array(total)],
                [*names, "_row", "n_links", "n_best", "count_sum"])

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "links", 1 << 23):
            pair, row, hit, _, _ = find(batch)
            ids = batch.column("_row").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[row[~hit]]), pa.array(pair[~hit])], ["_row", "pair"])

    out = aligned.mapInArrow(run, schema)
    rare = counts.where(F.col("n") < least)
    if not rare.isEmpty():
        more = (aligned.select("_row", "links").mapInArrow(rest, "_row long, pair long")
                .join(rare, "pair").groupBy("_row")
                .agg(F.sum("n").alias("_n"), F.sum(F.col("best").cast("long")).alias("_best")))
        out = (out.join(more, "_row", "left")
               .withColumn("count_sum", F.col("count_sum") + F.coalesce("_n", F.lit(0)))
               .withColumn("n_best", F.col("n_best") + F.coalesce("_best", F.lit(0))))
    return out.select(*names, "n_links", "n_best", "count_sum")


def align_and_score(docs: DataFrame, a: str, b: str, frequent: int = FREQUENT) -> DataFrame:
    """``score`` over ``align``; the aligned texts are written to the shared folder once."""
    base, kind = _sizes(a, b)
    rows = align(docs, a, b).withColumn("_row", F.monotonically_increasing_id())
    return score(materialize(rows, "aligned"), base, kind, frequent)
