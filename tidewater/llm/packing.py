"""Best-two-fit packing of tokenised documents into fixed-length sequences.

``tokenize`` cuts documents into pieces; ``pack`` places pieces in sequences. A piece's
place depends on its length alone, so the plan is made from the table of lengths (at most
``capacity`` counts, whatever the corpus): bins are filled greedily with the largest length
that fits, then the smallest length of the bin is exchanged for two unpacked lengths that
fill the widened gap better, and the finished bin is repeated as often as the counts allow.
Pieces of one length are interchangeable; the n-th piece of a length takes the n-th place
that the plan has for it.

Defined cases: a null text is empty (one piece holding the end id); a repeated row is packed
again; a null doc_id is kept; an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded, group_rank, start
from tidewater.session import materialize

CACHE_BYTES = 64 << 20  # encoded words that a Python worker keeps, about
_ENTRY = 160  # bytes that a kept word takes besides its letters
CHUNK_BYTES = 1 << 20  # text that a worker encodes at once
# White space of str.split() that the tokenizer's \s does not hold.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
# Marks that part from the letters before them: no apostrophe, which may begin "'s", and none
# that the names of special tokens hold.
_TAIL = "!\"#$%&()*+,-./:;=?@[\\]^`{}~"
_STATE: dict = {}


def _letters_alone(word: str) -> bool:
    """Whether the tokenizer, too, sees letters alone in a word of letters. Lower case may bring marks
    ("İ"), and beyond these scripts versions of Unicode differ."""
    return word.isascii() or max(word) < "\u0530" and word.lower().isalpha()


class _Encoder:
    """Token ids of texts as little-endian uint32 bytes.

    The tokenizer drops white space and never merges across it, so a text's ids are the
    ids of its words in order; words are encoded once and remembered.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.seen: dict[str, bytes] = {}
        self.held = 0
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)  # tokens that end a word
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        out = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in out]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Words of letters alone, each one word to the tokenizer too: encoded as one text
        and parted after the tokens that end a word."""
        ids = np.asarray(self.tok.encode_batch_fast([" ".join(words)],
                                                    add_special_tokens=False)[0].ids, "<u4")
        end = np.flatnonzero(self.ends[ids]) + 1
        if len(end) != len(words):
            return self._encode(words)
        data, cut = ids.tobytes(), [0, *(4 * end).tolist()]
        return [data[a:b] for a, b in zip(cut, cut[1:], strict=False)]

    def texts(self, texts: list[str]) -> list[bytes]:
        split = [None if _ODD_SPACE.search(t) else t.split() for t in texts]
        need: set[str] = set()
        for words in split:
            if words:
                need.update(words)
        if self.held > CACHE_BYTES:
            self.seen, self.held = {}, 0
        seen = self.seen
        new = [w for w in need if w not in seen]
        # "Word," is "word" and ",": letters and a run of marks behind them always part.
        core, tails = {}, {}
        for w in new:
            c = w.rstrip(_TAIL)
            if len(c) < len(w):
                if c.isalpha() and _letters_alone(c):
                    tails[w] = w[len(c):]
                else:
                    c = w
            core[w] = c.lower() if c.isascii() else c
        todo = {*core.values(), *tails.values()}.difference(seen)
        plain = [c for c in todo if c.isalpha() and (c.isascii() or _letters_alone(c))]
        other = list(todo.difference(plain))
        seen.update(zip(plain, self._letters(plain), strict=True))
        seen.update(zip(other, self._encode(other), strict=True))
        for w, c in core.items():
            if w in tails:
                seen[w] = seen[c] + seen[tails[w]]
            elif c != w:
                seen[w] = seen[c]
        self.held += sum(map(len, core)) * 2 + len(core) * _ENTRY
        get = seen.__getitem__
        return [self._encode([t])[0] if words is None else b"".join(map(get, words))
                for t, words in zip(texts, split, strict=True)]


def _encoder(path: str) -> _Encoder:
    if path not in _STATE:
        _STATE[path] = _Encoder(path)
    return _STATE[path]


def tokenize(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
             keep_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 and, with
    ``keep_ids``, ids (little-endian uint32 bytes). A document is its ids and ``end_id``;
    only documents longer than ``capacity`` are cut, each piece but the last full.
    ``tokenizer`` is a tokenizers file that every executor can read."""
    start(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
              + (", ids binary" if keep_ids else ""))
    end = np.asarray([end_id], "<u4").tobytes()
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(tokenizer)
        for b in bounded(batches, most=CHUNK_BYTES):
            texts = [t or "" for t in b.column("text").to_pylist()]
            owner, piece, begin, length, crc, ids = [], [], [], [], [], []
            for i, data in enumerate(enc.texts(texts)):
                data += end
                for k, at in enumerate(range(0, len(data), width)):
                    part = data[at:at + width]
                    owner.append(i)
                    piece.append(k)
                    begin.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(part)
            cols = [b.column("doc_id").take(pa.array(owner, pa.int64())),
                    pa.array(piece, pa.int32()), pa.array(begin, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                cols.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def plan_bins(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Places for every length. ``counts[n]``: pieces of length n. Rows of the result:
    length, first rank, first sequence, offset: ranks from the first rank on (to the next
    row's of that length) go to consecutive sequences at that offset."""
    left = np.zeros(capacity + 1, np.int64)
    left[:len(counts)] = counts
    sizes = np.arange(capacity + 1)
    used = np.zeros(capacity + 1, np.int64)
    rows, next_seq = [], 0

    def floors(avail):  # floors[x]: the largest available length up to x, or 0
        return np.maximum.accumulate(np.where(avail > 0, sizes, 0))

    while True:
        avail = left.copy()
        floor = floors(avail)
        if not floor[capacity]:
            break
        held, gap = [], capacity
        while gap and floor[gap]:
            n = int(floor[gap])
            held.append(n)
            gap -= n
            avail[n] -= 1
            if not avail[n]:
                floor = floors(avail)
        if len(held) > 1 and gap:
            small = held[-1]  # lengths were taken in falling order
            room = gap + small
            avail[small] += 1
            floor = floors(avail)
            a = sizes[1:room][avail[1:room] > 0]
            b = floor[np.minimum(room - a, a)]
            lone = (b == a) & (avail[a] < 2)
            b = np.where(lone, floor[a - 1], b)
            both = np.where(b > 0, a + b, 0)
            if len(a) and both.max() > small:
                k = int(both.argmax())
                held[-1:] = [int(a[k]), int(b[k])]
        kinds, each = np.unique(held, return_counts=True)
        times = int((left[kinds] // each).min())
        offset = 0
        for n in held:
            rows.append((n, int(used[n]), next_seq, offset))
            used[n] += times
            offset += n
        left[kinds] -= each * times
        next_seq += times
    return np.asarray(sorted(rows), np.int64).reshape(-1, 4)


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds sequence_id and offset to ``pieces`` (doc_id, piece, length from 1 to
    ``capacity``). ``pieces`` is read three times: give a written table."""
    counts = np.zeros(capacity + 1, np.int64)
    # At most ``capacity`` rows, whatever the corpus.
    for n, k in pieces.groupBy("length").agg(F.count(F.lit(1))).collect():
        counts[n] = k
    plan = plan_bins(counts, capacity)
    # The places of each length, at most ``capacity`` rows. Token ids stay in the JVM: a batch
    # of whole pieces takes 8 KB a row on its way to Python and back.
    cut = np.r_[0, np.cumsum(np.bincount(plan[:, 0], minlength=capacity + 1))]
    spark = pieces.sparkSession
    places = spark.createDataFrame(pa.table({
        "_length": pa.array(np.arange(1, capacity + 1), pa.int64()),
        **{name: pa.ListArray.from_arrays(pa.array(cut[1:], pa.int32()),
                                          pa.array(plan[:, col], pa.int64()))
           for name, col in (("_first", 1), ("_seq", 2), ("_offset", 3))}}))
    ranked = group_rank(pieces, ["length"], ["doc_id", "piece", *[
        c for c in ("start", "ids_crc32") if c in pieces.columns]], "_rank")
    # The last place whose first rank is not beyond the piece's; ranks of a length start at 0.
    at = F.size(F.filter("_first", lambda x: x <= F.col("_rank"))) - 1
    return (ranked.join(F.broadcast(places), F.col("length") == F.col("_length"))
            .withColumn("_at", at)
            .select(*pieces.columns, (F.get("_seq", F.col("_at")) + F.col("_rank")
                                      - F.get("_first", F.col("_at"))).alias("sequence_id"),
                    F.get("_offset", F.col("_at")).alias("offset")))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048,
                   end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Documents to packed pieces; the pieces are written to the shared folder once."""
    return pack(materialize(tokenize(docs, tokenizer, capacity, end_id, keep_ids),
                            "pieces"), capacity)
