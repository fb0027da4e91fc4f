import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewater.llm import jaccard_join

SF = "/root/testdata/sf0.01"


def test_stages_on_the_table(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "ngram_jaccard_join", "suffix_array_dedup",
                     "benchmark_decontamination", "best_fit_packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, steps = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.materialize(stage(spark, steps[-1], SF), name)
        assert name == names[-1] or out.columns == columns
        steps.append(out)
    kept = [{r.doc_id for r in s.collect()} for s in steps]
    assert kept[1] == kept[0]  # all of the table's languages are known
    first = {r.doc_id for r in jaccard_join.classes(steps[1]).collect()
             if r.component_id == r.doc_id}
    assert kept[2] == first
    assert kept[3] == kept[2] and kept[5] == kept[4] < kept[3]
    assert steps[3].where(F.length("text") != F.col("n_chars")).count() == 0
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    n = sum(len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1
            for r in steps[4].collect())
    assert steps[5].agg(F.sum("length")).first()[0] == n


def test_near_duplicates_with_odd_ids(spark):
    text = " ".join(f"w{i}" for i in range(100))
    other = " ".join(f"v{i}" for i in range(100))
    rows = [(2, text), (2, text), (2, text + " x"), (5, text + " y"), (None, other),
            (None, other + " z"), (None, "a text alone without an id"), (9, None)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.ngram_jaccard_join(spark, df, SF).collect()
    assert sorted(str(r.doc_id) for r in got) == ["2", "9", "None", "None"]


def test_language_stage_drops_what_it_rejects(spark):
    rows = [(i, "the cat sat on the mat with the hat", "en") for i in range(20)]
    rows += [(50, None, "en"), (51, "123 ...", "en"), (52, "ქართული ენა " * 40, None),
             (53, "the hat and the cat", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, df, SF).collect()}
    assert set(got) == {*range(20), 53} and got[53] == "en"


def test_passages_of_51_words_are_cut_whatever_their_bytes(spark):
    def words(tag, n):
        return " ".join(f"{tag}{i}" for i in range(n))

    planted, short, long = words("p", 51), words("q", 50), "ab" * 250
    assert len(planted) < 400
    rows = [(k, f"{words(f'a{k}x', 70)} {planted}{' ' * k}\n{words(f'b{k}x', 40)} {short} "
                f"{words(f'c{k}x', 9)} z{k} {long}", "en", "s", 1) for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                     "n_chars long")
    got = corpus_pipeline.suffix_array_dedup(spark, df, SF).collect()
    assert len(got) == 3
    for r in got:
        k = r.doc_id
        assert r.text.split() == (f"{words(f'a{k}x', 70)} {words(f'b{k}x', 40)} {short} "
                                  f"{words(f'c{k}x', 9)} z{k}").split()
        assert r.n_chars == len(r.text)


CLASHES = ["score", "rejected", "lang_pred", "cross_entropy", "_ce", "_size", "th", "_th", "_id",
           "_kth", "spans", "word_spans", "root", "n", "grp", "gid", "k", "h", "_rank", "length",
           "piece", "there", "_row", "c0", "a.b"]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_extra_columns_of_the_stages_own_names(spark, name, stage):
    """Columns of the caller keep their values, whatever their names; results do not change."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60 + i)), "en", "s", 1) for i in range(6)]
    rows += [(7, rows[0][1], None, "s", 1), (8, None, "en", "s", 1), (9, "", "en", "s", 1)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                        "n_chars long")
    extra = plain.select("*", *[(F.col("doc_id") + i / 100).alias(c)
                                for i, c in enumerate(CLASHES)])
    want = stage(spark, plain, SF)
    got = stage(spark, extra, SF)
    if name == "best_fit_packing":
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        return
    assert got.columns == extra.columns
    kept = got.collect()
    assert sorted(map(str, want.collect())) == sorted(
        str(r) for r in spark.createDataFrame([tuple(r)[:5] for r in kept], want.schema).collect())
    for r in kept:
        assert list(r[5:]) == [r.doc_id + i / 100 for i in range(len(CLASHES))]
