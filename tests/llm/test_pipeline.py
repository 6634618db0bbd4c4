import itertools

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridframe.llm import mixing, pii

PATH = "/root/testdata/sf0.001"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before and after each stage."""
    folder, out = tmp_path_factory.mktemp("stages"), {}
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    extra = [(9001, None, "en", "src0", None), (9002, "", None, None, 0), (9003, "12 34 !!", "en", "src1", 8), (9004, "mail a@b.org", None, None, 12)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    docs = docs.union(docs.filter("doc_id = 9004"))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, PATH).write.parquet(str(folder / name))
        after = spark.read.parquet(str(folder / name))
        out[name] = docs.collect(), after.collect()
        docs = after
    return out


def test_every_stage_takes_effect(stages, spark):
    columns = list(corpus_pipeline.COLUMNS)
    for name in list(stages)[:-1]:
        assert stages[name][1][0].asDict().keys() == set(columns)
    before, after = stages["language_id"]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {9001, 9002, 9003}
    assert all(r.lang for r in after)

    before, after = stages["near_duplicates"]
    rows = sorted({(r.doc_id, r.text) for r in before})
    sets, root = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        return x if root[x] == x else find(root[x])

    for (i, s), (j, t) in itertools.combinations(sets.items(), 2):
        if 100 * len(s & t) >= 80 * len(s | t):
            root[max(find(i), find(j))] = min(find(i), find(j))
    assert sorted(r.doc_id for r in after) == sorted(i for i in root if find(i) == i)

    before, after = stages["surrogates"]
    old = {r.doc_id: r for r in before}
    assert len(after) == len(before)
    for r in after:
        assert r.text == pii.replaced(old[r.doc_id].text, pii.KEY)[0] and r.n_chars == len(r.text)

    before, after = stages["mixture"]
    taken = {r.doc_id: r.copies for r in mixing.mix(spark.createDataFrame(before)).collect()}
    counts = {i: 0 for i in taken}
    for r in after:
        counts[r.doc_id] += 1
    assert counts == taken

    before, after = stages["token_ids"]
    assert sorted(r.doc_id for r in before) == sorted(r.doc_id for r in after) and all(len(r.ids) == 4 * r.n_tokens for r in after)


def test_equal_rows_keep_their_copies(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3)] * 3 + [(None, "c", "en", "s", 1)], ", ".join(["doc_id long", "text string", "lang string", "source string", "n_chars long"]))
    assert corpus_pipeline.mix_sources(spark, docs, PATH).count() == 4
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), PATH).count() == 0


def test_near_duplicates_without_an_id_or_with_one_id_for_two_texts(spark):
    def text(name, changed=""):
        return " ".join([*(f"{name}{i}" for i in range(100)), changed])

    rows = [(1, text("a")), (None, text("a")), (None, text("b", "x")), (None, text("b", "y")), (None, text("b", "y")), (None, text("c"))]
    rows += [(7, text("d")), (7, text("a", "z")), (9, text("d", "w")), (5, text("e", "u")), (5, text("e", "v")), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, (r.text or "-")[0]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, PATH).collect()]
    assert sorted(got, key=str) == sorted([(1, "a"), (None, "b"), (None, "c"), (7, "d"), (5, "e"), (None, "-")], key=str)


def test_run_is_the_stages_in_turn(spark):
    got = corpus_pipeline.run(spark, PATH)
    assert got.columns == ["doc_id", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert got.filter(F.col("n_tokens") * 4 != F.octet_length("ids")).count() == 0 and got.count() > 100
