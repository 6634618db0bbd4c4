import math
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gridframe.llm import langid, queries

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def all_segmentations(word, probabilities):
    """Sum over every way to cut the word, by recursion."""
    if not word:
        return 1.0
    total = 0.0
    for stop in range(1, len(word) + 1):
        p = probabilities.get(word[:stop], langid.UNKNOWN_LETTER if stop == 1 else 0.0)
        total += p * all_segmentations(word[stop:], probabilities) if p else 0.0
    return total


def test_forward_sums_all_segmentations():
    names = ["a", "ab", "abc", "b", "bc", "c", "▁", "▁a", "漢"]
    rng = np.random.default_rng(1)
    p = np.vstack([rng.random((len(names), 2)), np.full((1, 2), langid.UNKNOWN_LETTER)])
    words = ["▁abcab", "▁xxa", "c", "▁漢b", "ab", "abcabcabc"]
    got = langid.log_likelihoods(words, langid.Pieces(names), p)
    for word, row in zip(words, got):
        for k in range(2):
            assert row[k] == pytest.approx(math.log(all_segmentations(word, {n: p[i, k] for i, n in enumerate(names)})))


def test_expected_uses_by_enumeration():
    names, words, counts = ["a", "aa", "b"], ["aab", "aa"], np.array([2.0, 3.0])
    p = np.array([0.5, 0.2, 0.3, langid.UNKNOWN_LETTER])
    got = langid.expectation(words, counts, langid.Pieces(names), p)
    both = [0.25 * 0.3, 0.2 * 0.3]  # a+a+b, aa+b
    plain = [0.25, 0.2]
    assert got[0] == pytest.approx(2 * 2 * both[0] / sum(both) + 3 * 2 * plain[0] / sum(plain))
    assert got[1] == pytest.approx(2 * both[1] / sum(both) + 3 * plain[1] / sum(plain))
    assert got[2] == pytest.approx(2.0)


def by_recursion(word, probabilities):
    """The same sum for words of any length, from the end, in exact fractions."""
    sums = [Fraction(0)] * len(word) + [Fraction(1)]
    for start in reversed(range(len(word))):
        for stop in range(start + 1, min(len(word), start + 8) + 1):
            p = probabilities.get(word[start:stop], langid.UNKNOWN_LETTER if stop == start + 1 else 0.0)
            sums[start] += Fraction(p) * sums[stop]
    value = sums[0]
    return math.log(value.numerator) - math.log(value.denominator)


@pytest.mark.parametrize("length", [15, 16, 17, 23, 24, 25, 60, 63, 64, 65, 66, 300])
def test_words_of_any_length_are_summed_whole(length):
    names = ["a", "ab", "abc", "b", "bc", "c", "▁", "▁a", "漢", "漢漢漢", "cabca"]
    rng = np.random.default_rng(length)
    p = np.vstack([rng.random((len(names), 2)) ** 3, np.full((1, 2), langid.UNKNOWN_LETTER)])
    words = ["▁" + "".join(rng.choice(list(letters), length - 1)) for letters in ("abc", "abc漢x", "xyz", "漢")]
    assert [len(langid.words_of("x" * length + " y1z")[0])] == [length + 1]
    for word, row in zip(words, langid.log_likelihoods(words, langid.Pieces(names), p)):
        for k in range(2):
            assert row[k] == pytest.approx(by_recursion(word, {n: p[i, k] for i, n in enumerate(names)}), rel=1e-10)


def test_letters_and_their_marks():
    assert langid.words_of("½ ② Ⅷ 7 _ \u0301") == []
    assert langid.words_of("हिन्दी Ab1c") == ["▁हिन्दी", "▁ab", "▁c"]


@pytest.fixture(scope="module")
def model(spark):
    rows = [("the house and the tree", "en"), ("das Haus und der Baum", "de"), (None, "en"), ("x", None)] * 3
    return langid.fit(spark.createDataFrame(rows, "text string, lang string"), VOCABULARY)


def test_defined_results(spark, model):
    assert model.languages == ["de", "en"]
    rows = [(1, None, "kept"), (2, "", "kept"), (3, "12 ½②Ⅷ !! 3", "kept"), (4, "the tree", "kept"), (4, "the tree", "kept"), (5, "und der " * 20_000, "kept")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string").withColumn("__scored_3", F.lit("kept"))
    got = {r.doc_id: r for r in langid.predict(df, model).collect()}
    assert langid.predict(df, model).count() == 6
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5)] == ["und", "und", "und", "en", "de"]
    assert [got[i].score for i in (1, 2, 3)] == [0.0, 0.0, 0.0]
    assert all(0 < got[i].score <= 1 and got[i]["__scored_3"] == "kept" for i in (4, 5))
    assert langid.predict(df.limit(0), model).count() == 0


def test_copies_neither_hide_a_language_nor_outweigh_it(spark):
    hot = "alle meine Entchen schwimmen auf dem See"
    rows = [(hot, "de")] * 4000 + [(f"das Haus und der Baum {chr(97 + i % 26)}{chr(97 + i // 26)}", "de") for i in range(40)]
    rows += [(f"the house and the tree {i}", "en") for i in range(3000)] + [("1234 !!", "fr")] * 3000 + [(f"{i} 5", "fr") for i in range(3000)] + [("la maison", "fr")]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    model = langid.fit(df, VOCABULARY, sample_docs=4)
    assert model.languages == ["de", "en", "fr"]
    everything = langid.fit(df, VOCABULARY, sample_docs=10_000)
    once = langid.fit(df.distinct(), VOCABULARY, sample_docs=10_000)
    assert (everything.probabilities == once.probabilities).all()
    got = langid.predict(spark.createDataFrame([("der Baum und das Haus",)], "text string"), everything).first()
    assert got.lang_pred == "de"


def test_no_labels(spark):
    empty = langid.fit(spark.createDataFrame([("a b", None)], "text string, lang string"), VOCABULARY)
    got = langid.predict(spark.createDataFrame([("a b",)], "text string"), empty).first()
    assert (got.lang_pred, got.score) == ("und", 0.0)


def test_query_equals_plain_recursion_with_its_own_model(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))), VOCABULARY)
    chances = [{piece: model.probabilities[i, k] for i, piece in enumerate(model.pieces)} for k in range(len(model.languages))]
    longest, known = max(map(len, model.pieces)), {}

    def log_sum(word, k):
        if (word, k) not in known:
            sums = [0.0] * len(word) + [1.0]
            for start in reversed(range(len(word))):
                for stop in range(start + 1, min(len(word), start + longest) + 1):
                    sums[start] += chances[k].get(word[start:stop], langid.UNKNOWN_LETTER if stop == start + 1 else 0.0) * sums[stop]
            known[word, k] = math.log(sums[0])
        return known[word, k]

    predicted = {r.doc_id: r for r in queries.op2_language_id(spark, path).collect()}
    for row in docs.collect()[:60]:
        words = [w for w in langid.words_of(row.text) if len(w) < 30]
        if not words or len(words) < len(langid.words_of(row.text)):
            continue
        totals = [sum(log_sum(word, k) for word in words) for k in range(len(model.languages))]
        assert predicted[row.doc_id].lang_pred == model.languages[totals.index(max(totals))]


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang")
    judged = queries.op2_language_id(spark, path).join(truth, "doc_id").filter("held_out")
    right, total = judged.select(F.sum(F.expr("int(lang = lang_pred)")), F.count("*")).first()
    assert total > 200 and right / total >= 0.98
