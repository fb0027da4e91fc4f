import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidewater.llm import repeats


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k:k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        mark = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                mark[k:k + length] = True
        kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        runs = int((np.diff(np.r_[0, mark.astype(int)]) == 1).sum())
        out.append((i, len(b), int(mark.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(60) for _ in range(4)]
    rows = [(None, None), (1, ""), (2, "short"), (3, "a" * 1000), (4, "ab" * 700)]
    for i in range(5, 60):
        parts = [text(rng.randint(1, 120))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(shared), text(rng.randint(0, 40))]
        rows.append((i, " ".join(parts)))
    rows += [rows[10], (100, rows[11][1]), (101, rows[12][1] + " tail"),
             (102, rows[13][1].replace("a", "e", 1)), (103, shared[0] + shared[0])]
    return rows


@pytest.mark.parametrize("group", [1, 512])  # all by hashes of windows, all by index
def test_against_brute_force(spark, group):
    rows = corpus(group)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "doc_id long, text string, th int, spans string")
    got = [tuple(r) for r in repeats.report(df, 100, group).collect()]
    assert sorted(got, key=str) == brute(rows, 100)


def test_texts_without_repeats(spark):
    a, b = "x" * 50 + "é" * 120, "y" * 30 + "é" * 120
    df = spark.createDataFrame([(1, a, "k"), (2, b, None), (3, None, "k")],
                               "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in repeats.without_repeats(df, 100).collect()}
    assert got[1].text == "x" * 50 and got[2].text == "y" * 30 and got[3].text is None
    assert df.columns == list(got[1].__fields__)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.report(df).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_matching_statistics_of_the_run_index(seed):
    rng = np.random.default_rng(seed)
    parts = ["".join(rng.choice(list("ab"), int(rng.integers(1, 40)))).encode()
             for _ in range(8)]
    parts.append(parts[0])
    for length in (1, 3, 7):
        got = repeats.repeated_starts(parts, length)
        seen = Counter(p[k:k + length] for p in parts for k in range(len(p) - length + 1))
        for p, g in zip(parts, got, strict=True):
            want = [k for k in range(len(p) - length + 1) if seen[p[k:k + length]] > 1]
            assert g.tolist() == want


def test_run_index_is_compressed():
    text = np.asarray(list(b"abracadabra" * 50) + [0]) + 1
    index = repeats.RunIndex(text)
    assert index.lengths.sum() == len(text) and len(index.symbols) < len(text) / 10


@pytest.mark.parametrize("group", [2048, 1])
def test_runs_of_words_against_brute_force(spark, group):
    rows = corpus(3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    n = 12
    data = [(i, (t or "").split()) for i, t in rows]
    seen = Counter(tuple(w[k:k + n]) for _, w in data for k in range(len(w) - n + 1))
    want = []
    for i, w in data:
        gone = {k + j for k in range(len(w) - n + 1) if seen[tuple(w[k:k + n])] > 1
                for j in range(n)}
        want.append((i, [x for k, x in enumerate(w) if k not in gone]))
    got = repeats.without_repeats(df, 100_000, group, words=n).collect()
    assert sorted(((r.doc_id, (r.text or "").split()) for r in got), key=str) \
        == sorted(want, key=str)


def test_strings_made_to_share_sums_differ(spark):
    """(x^32 - 1)^8 (x^64 - 1) is 0 modulo 2^64 for every odd x, so the two strings agree in
    every sum of their bytes times powers."""
    d = np.array([1])
    for n in [32] * 8 + [64]:
        d = np.convolve(d, np.r_[-1, np.zeros(n - 1, int), 1])
    a, b = ("".join(chr(60 + x) for x in np.maximum(v, 0)) for v in (d, -d))
    rng = random.Random(3)
    p, q = ("".join(rng.choice("abcdef ") for _ in range(300)) for _ in range(2))
    rows = [(1, p + a + q), (2, p + b + q), (3, a + " " + q), (4, b + "/" + q)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for group in (1, 512):
        got = [tuple(r) for r in repeats.report(df, 400, group).collect()]
        assert sorted(got, key=str) == brute(rows, 400)
    words = [repeats._word_data(f"{w} x {w[:9]}") for w in (a, b)]
    assert words[0][:8] != words[1][:8] and words[0][8:16] == words[1][8:16]
