"""Segmentation of unspaced text by a word list.

Words of scripts that put no spaces between words are found with a trie of the list; all
other words are what ``text.tokenize`` gives. Two modes:

* ``best``: the split with the fewest characters outside the list, then the fewest words; of
  equal ones, that whose first difference is a longer word. Characters outside the list are
  words of one character.
* ``all``: every word of the list wherever it occurs, overlaps included, by start and then the
  longest first; characters that no such word covers are words of one character.

The function is an iterator of pandas batches: the trie is built once a task, and a text costs
its length times the longest word. The list goes to every task, so it is held to MAX_WORDS.
A null text gives null, a text without words an empty array.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.text import tokenize
from tidewater.session import ship_package

MAX_WORDS = 1_000_000
# Fixed value: characters (as a regular expression class) of the scripts without spaces.
UNSPACED = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003134f"
_END = ""


def trie(words: Iterable[str]) -> dict:
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        if w:
            node[_END] = True
    return root


def ends(root: dict, run: str, start: int) -> list[int]:
    """Ends of the list's words that start at ``start``, shortest first."""
    out, node = [], root
    for i in range(start, len(run)):
        node = node.get(run[i])
        if node is None:
            break
        if _END in node:
            out.append(i + 1)
    return out


def best_path(root: dict, run: str) -> list[str]:
    n = len(run)
    cost: list[tuple[int, int]] = [(0, 0)] * (n + 1)  # characters outside the list, words
    step = [0] * n
    for i in range(n - 1, -1, -1):
        unknown, count = cost[i + 1]
        best, step[i] = (unknown + 1, count + 1), i + 1
        for e in ends(root, run, i):
            found = (cost[e][0], cost[e][1] + 1)
            if found <= best:  # equal: the longer word
                best, step[i] = found, e
        cost[i] = best
    out, i = [], 0
    while i < n:
        out.append(run[i:step[i]])
        i = step[i]
    return out


def all_words(root: dict, run: str) -> list[str]:
    out, covered = [], 0
    for i, c in enumerate(run):
        found = ends(root, run, i)
        if found:
            covered = max(covered, found[-1])
            out += [run[i:e] for e in reversed(found)]
        elif i >= covered:
            out.append(c)
    return out


def word_list(df: DataFrame, column: str, most: int = MAX_WORDS) -> list[str]:
    """The distinct lower-cased words of a table, sorted; more than ``most`` are refused."""
    w = F.lower(F.col(column))
    rows = df.where(F.length(w) > 0).select(w.alias("w")).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the word list has more than {most} words")
    return sorted(r.w for r in rows)


def segmenter(spark: SparkSession, words: list[str], mode: str = "best",
              unspaced: str = UNSPACED) -> Callable[[Column | str], Column]:
    """A function of a text column that gives its words. ``unspaced`` is the class of
    characters whose runs are split by ``words`` (lower case)."""
    if mode not in ("best", "all"):
        raise ValueError(f"mode {mode!r}")
    if len(words) > MAX_WORDS:
        raise ValueError(f"the word list has more than {MAX_WORDS} words")
    ship_package(spark)
    held = spark.sparkContext.broadcast(words)
    split = best_path if mode == "best" else all_words
    pieces = re.compile(f"([{unspaced}]+)")

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        root = trie(held.value)

        def cut(tokens):
            if tokens is None:
                return None
            out = []
            for token in tokens:
                # Split by a pattern with one group: every second piece is a match.
                for i, piece in enumerate(pieces.split(token)):
                    if piece:
                        out += split(root, piece) if i % 2 else [piece]
            return out
        for batch in batches:
            yield batch.map(cut)

    # Types for Spark, which cannot resolve the postponed ones of a nested function.
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    cut_words = F.pandas_udf(run, T.ArrayType(T.StringType()))
    return lambda text: cut_words(tokenize(text))
