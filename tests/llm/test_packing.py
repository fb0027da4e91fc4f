import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewater.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def brute(rows, capacity):
    tok = Tokenizer.from_file(PATH)
    out = set()
    for doc_id, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            out.add((doc_id, k, at, len(part),
                     zlib.crc32(np.asarray(part, "<u4").tobytes())))
    return out


def check(got, rows, capacity):
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == brute(
        rows, capacity)
    by_seq = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq)


def test_whole_table_against_direct_encoding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = packing.pack_documents(docs, PATH).collect()
    n = check(got, rows, 2048)
    assert n <= 1 + -(-sum(r.length for r in got) // 2048)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x, y. don't"),
            (4, "w " * 500), (5, "İstanbul\x1cΣΑΣ é é <|endoftext|> a,,b c.d 3.14")]
    df = spark.createDataFrame([(*r, "clash", 9) for r in rows],
                               "doc_id long, text string, piece string, length int")
    got = packing.pack_documents(df, PATH, 64).collect()
    check(got, rows, 64)
    assert sum(r.doc_id == 3 for r in got) == 2


def test_random_texts_give_the_ids_of_the_tokenizer(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_BYTES", 20_000)  # forgets words now and then
    rng = random.Random(2)
    alphabet = ["a", "B", "c", "İ", "ı", "ß", "é", "É", "ǰ", "ŉ", "Σ", "ς", "я", "ა", "中", "́", "ˈ", "ª",
                "1", "²", ",", ".", ".", "'", "'s", "-", " ", " ", " ", "\n", "\x1c", "\xa0", "🙂"]
    enc, tok = packing._Encoder(PATH), Tokenizer.from_file(PATH)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(20_000)]
    texts += ["İ.", "İİ,", "dž. İ", "a" * 5000 + "."]
    for lo in range(0, len(texts), 500):
        want = tok.encode_batch(texts[lo:lo + 500], add_special_tokens=False)
        got = enc.texts(texts[lo:lo + 500])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [w.ids for w in want]


def test_kept_ids(spark):
    df = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    r = packing.pack_documents(df, PATH, 2, keep_ids=True).collect()
    assert all(zlib.crc32(bytes(x.ids)) == x.ids_crc32 and len(x.ids) == 4 * x.length for x in r)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(df, PATH).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_length_once(seed):
    rng = np.random.default_rng(seed)
    cap = int(rng.integers(8, 200))
    counts = rng.integers(0, 40, cap + 1) * (rng.random(cap + 1) < 0.4)
    counts[0] = 0
    plan = packing.plan_bins(counts, cap)
    fill = {}
    for n in range(1, cap + 1):
        own = plan[plan[:, 0] == n]
        edges = [*own[:, 1].tolist(), int(counts[n])]
        assert not counts[n] or edges[0] == 0
        for (_, lo, seq, off), hi in zip(own.tolist(), edges[1:], strict=True):
            for i in range(hi - lo):
                fill.setdefault(seq + i, []).append((off, n))
    for places in fill.values():
        at = 0
        for off, n in sorted(places):
            assert off == at
            at += n
        assert at <= cap
    assert sum(map(len, fill.values())) == counts.sum()


def test_exchange_of_the_smallest_for_two():
    # 6 + 3 leaves 1; 6 + 2 + 2 fills the bin
    plan = packing.plan_bins(np.bincount([6, 3, 2, 2], minlength=11), 10)
    seq = {(int(r[0]), int(r[1])): int(r[2]) for r in plan}
    assert seq[6, 0] == seq[2, 0] == seq[2, 1] != seq[3, 0]


def test_marks_behind_letters_do_not_make_new_words(monkeypatch):
    enc, tok = packing._Encoder(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(3)
    marks = "!\"#$%&()*+,-./:;=?@[\\]^`{}~'<|>_1"
    words = ["stre", "Été", "İ", "don't", "x's", "<|endoftext|>", "中", "ǰ"]
    texts = [" ".join(rng.choice(words) + "".join(rng.choices(marks, k=rng.randrange(4)))
                      for _ in range(200)) for _ in range(40)]
    want = tok.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(g, "<u4").tolist() for g in enc.texts(texts)] == [w.ids for w in want]
    alone, encode = [], enc._encode
    monkeypatch.setattr(enc, "_encode", lambda texts: alone.extend(texts) or encode(texts))
    enc.texts(["brand*** newly&&& coined.!! wörds%%%"])
    assert not any(c.isalpha() for t in alone for c in t)


def test_token_ids_do_not_pass_through_python_when_packed(spark):
    rows = [(i, 0, 1 + i % 7, bytes(4)) for i in range(300)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, length long, ids binary")
    got = packing.pack(pieces, 10)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in plan and "Python" not in plan
    places = {(r.sequence_id, r.offset + i) for r in got.collect() for i in range(r.length)}
    assert len(places) == sum(r[2] for r in rows)
