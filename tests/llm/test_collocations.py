import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gridframe.llm import collocations
from gridframe.llm.shipping import ship

SCHEMA = "doc_id long, text string, lang string, phrase int, f string, n int"


def brute(rows, top, least, percent):
    counts, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            counts.update((lang, tuple(words[i : i + m])) for m in range(1, 6) for i in range(len(words) - m + 1))
    candidates = {key: f for key, f in counts.items() if len(key[1]) > 1 and f >= least}

    def goes(lang, words, a):
        inner = lambda other: any(other[i : i + len(words)] == words for i in range(len(other) - len(words) + 1))
        return any(x == lang and len(other) > len(words) and 100 * f >= percent * a and inner(other) for (x, other), f in candidates.items())

    found = {}
    for (lang, words), a in candidates.items():
        if not goes(lang, words, a):
            cuts = [(1000 * a * n[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return {
        (lang, rank): (phrase.decode(), -a, l, r, n[lang], -score)
        for lang, best in found.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1)
    }


def answer(spark, rows, **options):
    ship(spark)
    found = collocations.collocations(spark.createDataFrame(rows, SCHEMA), **options).collect()
    return {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found}


def corpus(docs=120):
    rng = random.Random(11)
    rows = [(1, None, "en", 0, "", 0), (2, "", None, 0, "", 0), (None, " \t\n.", "de", 0, "", 0), (3, "solo", "xx", 0, "", 0)]
    for i in range(docs):
        words = [rng.choice(["New York City", "san\tfrancisco  bay", "a a a a a a", "Été 🙂", "the", "of", "X", "y", f"w{int(rng.paretovariate(0.7))}"]) for _ in range(40)]
        text = "".join(word + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n", " ", " "]) for word in words)
        rows.append((i, text, rng.choice(["en", "en", "de", None, "und"]), 0, "", 0))
    return rows + rows[:20]


@pytest.mark.parametrize(("top", "percent"), [(2000, 100), (7, 80), (1, 100)])
def test_equal_to_brute_force(spark, top, percent):
    rows = corpus()
    expected = brute(rows, top, 5, percent)
    assert len(expected) > 2 and answer(spark, rows, top=top, least=5, percent=percent) == expected


def test_full_filters_and_long_texts_change_nothing(spark, monkeypatch):
    long = "new york city, the of. " * 100_000  # more than a chunk
    rows = corpus(40) + [(9, long, "en", 0, "", 0), (10, "x y " * 300, "de", 0, "", 0)]
    monkeypatch.setattr(collocations, "MOST_BITS", 64)
    assert answer(spark, rows, top=50, least=4) == brute(rows, 50, 4, 100)


def test_chunks_are_cut_between_pieces_and_lose_nothing(monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 50)
    texts = [b"a b. " * 40, b"", b"no mark " * 30, b"x\n" * 10]
    batch = pa.record_batch([pa.array(texts, pa.binary()), pa.array(["en", "de", "fr", "en"])], names=["text", "lang"])
    parts = [part for chunk in collocations._chunks(batch) for part in zip(*chunk)]
    assert b"".join(text for text, _ in parts) == b"".join(texts)
    assert (texts[2], "fr") in parts and {text[-1:] for text, lang in parts if lang == "en"} <= {b".", b" ", b"\n"}
    assert len(parts) > 5 and all(len(text) < 60 for text, lang in parts if lang == "en")


def test_no_documents_and_no_frequent_phrase(spark):
    assert answer(spark, []) == {}
    assert answer(spark, corpus(3)) == {}


def test_words_and_hashes_do_not_depend_on_the_place():
    texts = [b"One  two\tthree. four", b"", b"\n", b"two three", b"x" * 5000 + b" two"]
    words = collocations.words_of(texts)
    cut = [bytes(words.data[a : a + b]) for a, b in zip(words.start, words.size)]
    assert cut == [b"one", b"two", b"three", b"four", b"two", b"three", b"x" * 5000, b"two"]
    assert words.row.tolist() == [0, 0, 0, 0, 3, 3, 4, 4] and words.linked.tolist() == [True, True, False, False, True, False, True, False]
    one, two = words.hashes(1), words.hashes(2)
    assert one[1] == one[4] == one[7] and two[1] == two[4] != two[0]
    assert len({*one.tolist()}) == 5
