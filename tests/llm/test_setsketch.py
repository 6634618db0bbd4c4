import itertools
import random

import numpy as np
import pytest

from gridframe.llm import queries, setsketch
from gridframe.llm.components import connected_components


def words_of(text):
    blanks = " \t\n\x0b\x0c\r"
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return "".join(" " if c in blanks else c for c in lowered).split(" ")


def shingles(text, width):
    words = [w for w in words_of(text) if w]
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute(rows, width, percent):
    """Components by comparing all pairs of full sets."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, s), (j, t) in itertools.combinations(sets, 2):
        if s and t and 100 * len(s & t) >= percent * len(s | t):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets}


def results(found):
    return {r[0]: tuple(r)[1:4] for r in found.collect()}


def altered(rng, words, share):
    return " ".join(w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in words)


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_same_components_as_all_pairs(spark, width, percent):
    rng = random.Random(width)
    rows = []
    for _ in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([40, 150, 600]))]
        rows += [altered(rng, base, rng.choice([0, 0.004, 0.01, 0.02, 0.05])) for _ in range(rng.choice([1, 4, 25]))]
    rows += ["a b", "A  b", "a b c", "", None, " \t ", "\x1cone\x85two", "one"]
    rng.shuffle(rows)
    rows = list(enumerate(rows, start=5))
    got = results(setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=width, percent=percent))
    assert got == brute(rows, width, percent)


def test_large_bucket_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", 7)
    monkeypatch.setattr(setsketch, "GROUP_SHINGLES", 500)
    monkeypatch.setattr(setsketch, "FAMILY_SHINGLES", 900)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(90)]
    rows = list(enumerate(altered(rng, base, 0.03) for _ in range(80)))
    got = results(setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=3, percent=85))
    assert got == brute(rows, 3, 85)


def test_defined_results(spark):
    rows = [(1, "p q r s t u v", "k"), (1, "p q r s t u v", "k"), (3, "P q r s t u v", "k"), (None, "p q r s t u v", "k"), (None, "only here now", "k"), (4, None, "k"), (5, "", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(map(tuple, setsketch.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 3, 1, True), (1, 3, 1, True), (3, 3, 1, False), (None, 3, 1, False), (None, 1, None, True), (4, 0, 4, True), (5, 0, 5, True)], key=str)
    assert setsketch.near_duplicates(df.limit(0)).count() == 0


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 1 << 62, 4000, dtype=np.uint64)
    one, two = pool[:3000], pool[400:]
    rows = setsketch.registers([one, two, pool])
    assert (setsketch.merge(rows[:2]) == rows[2]).all()
    value = setsketch.similarity(np.array([(rows[0] == rows[1]).sum()]), np.array([(rows[0] > rows[1]).sum()]), np.array([3000.0]), np.array([3600.0]))
    assert abs(value[0] - 2600 / 4000) < 0.1


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    rows = spark.createDataFrame(chain + star + [(7, 7), (500, 500), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected_components(rows).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 500: 500}
    assert connected_components(rows.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [50, 60, 70, 80, 85, 100])
def test_sets_at_any_limit_share_a_bucket(percent):
    rows = setsketch.rows_for(percent)
    assert (1 - (percent / 100) ** rows) ** (252 // rows) < 4e-6 and (rows == 6 or percent < 80)
    rng, share = np.random.default_rng(percent), percent / 100
    missed = 0
    for _ in range(60):
        pool = rng.integers(0, 1 << 62, 2000, dtype=np.uint64)
        each = int(2000 * (1 - share) / 2)
        sketches = setsketch.registers([pool[: 2000 - each], pool[each:]])
        keys = setsketch.band_keys(sketches, rows)
        missed += not (keys[0] == keys[1]).any()
    assert missed == 0


def test_query(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    assert results(queries.op10_setsketch(spark, path)) == brute(rows, 3, 85)
