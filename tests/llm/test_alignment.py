import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidewater.llm import alignment

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def brute(rows):
    """The same figures from sets of end offsets, encoded whole by the libraries."""
    ta = Tokenizer.from_file(A)
    ta.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    value = alignment.byte_values()

    def spell_b(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    found = []
    for doc_id, text in rows:
        want = b" " + (text or "").encode()
        a = ta.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        ab = [bytes(value[c] for c in ta.id_to_token(i)) for i in a]
        bb = [spell_b(i) for i in b]
        if not text or b"".join(ab) != want or b"".join(bb) != want:
            found.append((doc_id, 0, 0, [], ""))
            continue
        ea = {sum(map(len, ab[:k + 1])): k for k in range(len(a))}
        eb = {sum(map(len, bb[:k + 1])): k for k in range(len(b))}
        i = j = 0
        said, links = [], []
        for e in sorted(set(ea) & set(eb)):
            said.append(",".join(map(str, a[i:ea[e] + 1])) + "|"
                        + ",".join(map(str, b[j:eb[e] + 1])))
            links.append((a[ea[e]], b[eb[e]]))
            i, j = ea[e] + 1, eb[e] + 1
        found.append((doc_id, len(a), len(b), links,
                      hashlib.sha256(";".join(said).encode()).hexdigest()))
    count = Counter(x for f in found for x in f[3])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    return sorted(((d, na, nb, len(links), len(links),
                    sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), h)
                   for d, na, nb, links, h in found), key=str)


def got(df, **more):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
                    r.groups_sha256) for r in alignment.align_and_score(df, A, B, **more)
                   .collect()), key=str)


ODD = [None, "", " ", "a", "  two  spaces ", "tab\tand\nline\n\n", "naïve façade Ωmega 中文字 🙂🙂",
       "▁looks like a space", "<|endoftext|> <s> </s> <unk> <0x41>", "it's we'll 'S 123 4567",
       "\x00\x1c\x1d\x85\xa0 x", "é‍﻿ ", "a" * 3000, " " * 1500 + "x",
       "\U0001fae8 \U0001e030 Ᲊx", "ﬁ ﬀ ①②"]


def test_whole_table(spark):
    rows = [(r.doc_id, (r.text or "")[:1500]) for r in
            spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows)


@pytest.mark.parametrize("frequent", [1_000_000, 20, 0])
def test_odd_texts_and_rare_pairs_by_join(spark, frequent):
    rows = [(i if i != 3 else None, t) for i, t in enumerate([*ODD, "a", "some more words here"])]
    df = spark.createDataFrame([(*r, "clash", 9) for r in rows],
                               "doc_id long, text string, links string, _row int")
    assert got(df, frequent=frequent) == brute(rows)


def test_random_texts_against_whole_encoding(spark):
    rng = random.Random(5)
    alphabet = [*"abcdefgh ABC  ,.'\n\t0123é", "ß", "я", "中", "🙂", "́", "\xa0", "▁", "ll", "'s"]
    rows = [(k, "".join(rng.choice(alphabet) for _ in range(rng.randrange(60))))
            for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows)


def test_long_texts_in_blocks(spark, monkeypatch):
    rng = random.Random(7)
    words = ["the", "retitioning,", "ouen", "Über", "x.", "中文", "12", "\n", "  "]
    text = " ".join(rng.choice(words) for _ in range(4000))
    assert "".join(" " + b for b in alignment.blocks(text, 50)) == " " + text
    assert len(alignment.blocks(text, 50)) > 100
    al = alignment._Aligner(A, B)
    cut = alignment.blocks(text, 50)
    parts = [al.tokens(t, b) for t, b in zip(cut, al.b.ids(cut), strict=True)]
    assert [np.concatenate([p[k] for p in parts]).tolist() for k in (0, 1)] == [
        al.a.exact.encode(f" {text}", add_special_tokens=False).ids, al.b.ids([text])[0]]


def test_runs_against_sets():
    rng = random.Random(3)
    for _ in range(500):
        n = rng.randrange(1, 400)
        p = rng.choice([0.05, 0.5, 0.95])
        ea = [k for k in range(1, n) if rng.random() < p] + [n]
        eb = [k for k in range(1, n) if rng.random() < p or (p > 0.9 and k in ea)] + [n]
        ends = []
        for i, m, d in alignment.diagonal_runs(np.asarray(ea, np.int32), np.asarray(eb, np.int32)):
            assert ea[i:i + m] == eb[i + d:i + d + m] and len(ea[i:i + m]) == m
            ends += ea[i:i + m]
        assert ends == sorted(set(ea) & set(eb))


def test_long_stretches_take_few_comparisons():
    same = np.arange(1, 100_001, dtype=np.int32)
    assert alignment.diagonal_runs(same, same) == [(0, 100_000, 0)]
    missing = np.delete(same, 70_000)
    assert alignment.diagonal_runs(same, missing) == [
        (0, 70_000, 0), (70_001, 1, -1), (70_002, 29_998, -1)]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert got(df) == []
