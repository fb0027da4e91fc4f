"""Segmentation by a word list against brute force over all splits."""

import random

import pytest
from pyspark.sql import functions as F

from tidewater.functions import segment as sg

WORDS = ["数据", "大数据", "数据仓库", "仓库", "实时", "项目", "时数"]


def splits(run):
    if not run:
        yield []
    for i in range(1, len(run) + 1):
        for rest in splits(run[i:]):
            yield [run[:i], *rest]


def brute(words, run):
    """Least split: characters outside the list, words, then longer words first."""
    fine = [s for s in splits(run) if all(w in words or len(w) == 1 for w in s)]
    return min(fine, key=lambda s: (sum(w not in words for w in s), len(s),
                                    [-len(w) for w in s]))


def test_best_path_is_the_least_of_all_splits():
    rng = random.Random(5)
    for _ in range(300):
        words = {"".join(rng.choices("ab数c", k=rng.randint(1, 4))) for _ in range(6)}
        run = "".join(rng.choices("ab数c", k=rng.randint(0, 9)))
        assert sg.best_path(sg.trie(words), run) == brute(words, run), (words, run)


def test_all_words_are_every_occurrence():
    rng = random.Random(6)
    for _ in range(300):
        words = {"".join(rng.choices("ab数", k=rng.randint(1, 3))) for _ in range(4)}
        run = "".join(rng.choices("ab数", k=rng.randint(0, 9)))
        spans = [(i, j) for i in range(len(run)) for j in range(len(run), i, -1)
                 if run[i:j] in words]
        alone = [(i, i + 1) for i in range(len(run))
                 if not any(a <= i < b for a, b in spans)]
        want = [run[i:j] for i, j in sorted(spans + alone, key=lambda x: (x[0], -x[1]))]
        assert sg.all_words(sg.trie(words), run) == want


def test_texts_with_several_scripts(spark):
    df = spark.createDataFrame([(0, "Spark大数据仓库 实时X数"), (1, None), (2, ""), (3, "!?"),
                                (4, "数" * 5000)], "id int, t string")
    cut = sg.segmenter(spark, WORDS)
    got = dict(df.select("id", cut(F.col("t"))).collect())
    assert got[0] == ["spark", *brute(set(WORDS), "大数据仓库"), "实时", "x", "数"]
    assert got[1] is None and got[2] == [] and got[3] == [] and got[4] == ["数"] * 5000
    every = sg.segmenter(spark, WORDS, mode="all")
    rows = df.where("id = 0").select(F.explode(every("t"))).collect()
    assert [r[0] for r in rows] == ["spark", "大数据", "数据仓库", "数据", "仓库", "实时", "x", "数"]


def test_word_lists_are_bounded(spark):
    df = spark.createDataFrame([("B",), ("a",), ("b",), ("",), (None,)], "w string")
    assert sg.word_list(df, "w") == ["a", "b"]
    with pytest.raises(ValueError):
        sg.word_list(df, "w", most=1)
    with pytest.raises(ValueError):
        sg.segmenter(spark, ["a"], mode="some")
