"""Spelling variants of the words of a corpus, found with asymmetric q-chunks.

``vocabulary`` counts the words, ``near_words`` joins those that differ by exactly one
inserted, deleted or replaced code point, and ``forms`` gives every word its form and root.

The join. Of two near words the chunk side is the shorter one (or either, if they are equally
long). With length L and q = ceil(L / 2) it contributes two disjoint chunks, its first q code
points and the rest. The gram side would contribute its grams of q code points at every
position; one edit leaves one of the chunks whole, and moves it by the difference in length,
zero or one, at most. So a gram joins a chunk only within shift one: the first chunk with the
gram at position 0 (an edit before it is an edit outside the second chunk, which then joins),
the second with the gram that ends the longer word. Only these grams are written, under the
length of the chunk side; candidates are verified by their edit distance.

A key that very many words share (say, a third of all words begin alike) is split further:
its words agree in the shared chunk, so the edit lies in what is left of them, which gets
chunks and grams of its own in the same way, down to single code points. After that no key
holds more words than the alphabet allows, whatever the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded, start
from tidewater.session import materialize

LEAST_LENGTH = 7
LEAST_COUNT = 2
SLIP = 31  # a word of a document is misspelt where this divides its checksum
RATIO = 10  # a form is this many times as frequent as its variant
CROWDED = 1000  # words of one key from which on it is split further
_CACHED = 200_000  # different words counted before a task passes them on


def slip(doc_id, run: str) -> str:
    """The run, without one code point where ``SLIP`` divides the crc32 of id and run."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % SLIP:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH,
               least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the words of at least ``least_length`` code points that occur ``least_count``
    times or more. Words are maximal runs of Latin letters (A-Z lower-cased) after ``slip``.
    A null text has none, a null doc_id is written as empty text, a repeated row counts again.
    Words are counted within a batch first, so a frequent one moves a few times only."""
    start(docs)
    # Shorter runs cannot give a word that counts.
    runs = re.compile(r"[a-zÀ-ÿ]{%d,}" % least_length)

    def flush(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
            ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in bounded(batches):
            ids = batch.column("doc_id").to_pylist()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc_id, text in zip(ids, texts, strict=True):
                if not text:
                    continue
                # bytes.lower() leaves what is not ASCII alone.
                found = Counter(runs.findall(text.lower().decode("utf-8", "replace")))
                for w, n in found.items():
                    w = slip(doc_id, w)
                    if len(w) >= least_length:
                        total[w] += n
            if len(total) > _CACHED:
                yield flush(total)
                total = Counter()
        yield flush(total)

    return (docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def _signatures(rows: DataFrame) -> DataFrame:
    """Rows key, size, rest, word, role -> rows of the next level: the same with the first
    chunk, and with the second chunk, moved from rest to key. ``size`` is the length of the
    chunk side's rest, ``role`` 1 where the word's rest is one longer, 0 where it is equal."""
    q = F.ceil(F.col("size") / 2).cast("int")
    first = F.struct(F.concat_ws("\u0001", "key", F.concat(F.lit("<"), F.substring("rest", F.lit(1), q)))
                     .alias("key"),
                     (F.col("size") - q).alias("size"),
                     F.substring("rest", q + 1, F.length("rest")).alias("rest"))
    tail = F.col("size") - q
    head = F.length("rest") - tail
    second = F.struct(F.concat_ws("\u0001", "key", F.concat(F.lit(">"), F.substring("rest", head + 1, tail)))
                      .alias("key"),
                      q.alias("size"),
                      F.substring("rest", F.lit(1), head).alias("rest"))
    return (rows.select("word", "role", F.explode(F.array(first, second)).alias("s"))
            .select("s.key", "s.size", "s.rest", "word", "role"))


def near_words(words: DataFrame, column: str = "word", crowded: int = CROWDED) -> DataFrame:
    """a, b: all pairs of different words whose edit distance is one, a before b by length
    and code points. ``words`` holds each word once, of two code points or more."""
    w = words.select(F.col(column).alias("word"))
    size = F.length("word")
    roles = F.array(F.struct(size.alias("size"), F.lit(0).alias("role")),
                    F.struct((size - 1).alias("size"), F.lit(1).alias("role")))
    rows = (w.select("word", F.explode(roles).alias("r"))
            .select(F.col("r.size").cast("string").alias("key"), F.col("r.size").alias("size"),
                    F.col("word").alias("rest"), "word", "r.role"))
    found = None
    while True:
        rows = materialize(_signatures(rows), "chunks")
        per_key = rows.groupBy("key").agg(
            F.count(F.lit(1)).alias("m"), F.min("role").alias("low"), F.max("size").alias("size"))
        # Keys with words of the longer side alone hold no pair, nor do single words.
        per_key = per_key.where((F.col("m") > 1) & (F.col("low") == 0))
        per_key = materialize(per_key.select(
            "key", ((F.col("m") > crowded) & (F.col("size") > 1)).alias("crowd")), "chunk-keys")
        live = rows.join(per_key, "key")
        now = live.where(~F.col("crowd"))
        chunk = now.where("role = 0").select("key", F.col("word").alias("a"))
        gram = now.select("key", F.col("word").alias("b"), "role")
        pairs = (chunk.join(gram, "key")
                 .where(((F.col("role") == 1) | (F.col("a") < F.col("b")))
                        & (F.levenshtein("a", "b", 1) == 1)).select("a", "b"))
        found = pairs if found is None else found.unionByName(pairs)
        if per_key.where("crowd").isEmpty():
            return found.distinct()
        rows = live.where("crowd").drop("crowd")


def _points(word: Column) -> Column:
    """Sorts as the word's code points do; bytes of UTF-8 have that order."""
    return F.encode(word, "UTF-8")


def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root. ``words``: word, n; ``pairs``: ``near_words``. A
    word's form is its near word of largest n (ties: the first in code-point order), if that n
    is at least ``ratio`` times its own; the root is where following forms ends."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    n = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    best = F.min(F.struct((-F.col("b_n")).alias("less"), _points(F.col("b")).alias("p"),
                          F.col("b").alias("form")))
    near = (both.join(n, "b").groupBy(F.col("a").alias("word"))
            .agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
            .select("word", "n_near", F.col("best.form").alias("form"),
                    (-F.col("best.less")).alias("form_n")))
    fits = F.col("form_n") >= ratio * F.col("n")
    out = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("form")).alias("form"),
        F.when(fits, F.col("form_n")).alias("form_n")), "word-forms")
    # Counts grow from form to form, so there are no cycles; steps double in every round.
    step = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialize(step.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "word-roots")
        moved = not step.where("moved").isEmpty()
        step = step.select("word", "root")
        if not moved:
            break
    return (out.join(step, "word", "left")
            .withColumn("root", F.coalesce("root", "word")))


def group(docs: DataFrame) -> DataFrame:
    """Words of ``docs`` (doc_id, text) with their variants: word, n, n_near, form, form_n,
    root. No word or an empty table: no row. Other columns are ignored."""
    words = materialize(vocabulary(docs), "words")
    return forms(words, near_words(words))
