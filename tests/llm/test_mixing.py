import re

import pytest

from gridframe.llm import mixing, queries


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    """Water filling by repeated sharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, full, left = {}, set(), float(sum(sizes.values()))
    while True:
        free = [s for s in names if s not in full]
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 3 * sizes[s] + 1e-9]
        if not over:
            return {**target, **{s: left * weight[s] / total for s in free}}
        for s in over:
            full.add(s)
            target[s] = 3.0 * sizes[s]
        left = sum(sizes.values()) - sum(target.values())


def check(rows, texts, sources):
    sizes, taken, longest = {}, {}, {}
    for i, text in texts.items():
        s = sources[i]
        sizes[s] = sizes.get(s, 0) + words(text)
        longest[s] = max(longest.get(s, 0), words(text))
    targets = brute_targets(sizes)
    assert len(rows) == len(texts)
    for r in rows:
        s = sources[r.doc_id]
        assert r["size"] == words(texts[r.doc_id]) and r.source_size == sizes[s] and r.target == pytest.approx(targets[s])
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"] and len(r.positions) == r.copies
        assert all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)
        taken[s] = taken.get(s, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= longest[s] / 2 + 1e-6


@pytest.fixture(scope="module")
def documents():
    texts = {i: " ".join(["w"] * (i * 7 % 60)) for i in range(400)} | {400: None, 401: "", 402: "a\x1cb\x0bc\xa0d", 403: "z " * 4000}
    names = ["src0", "src1", "src10", "src2", None, "é", "", "Z"]
    sources = {i: names[i % 8] if i % 3 else "src0" for i in texts}
    return texts, sources


def frame(spark, documents):
    texts, sources = documents
    return spark.createDataFrame([(i, texts[i], sources[i], "k") for i in texts], "doc_id long, text string, source string, target string")


@pytest.mark.parametrize("bucket_rows,sent", [(1_000, 100_000), (15, 0)])
def test_targets_and_what_is_taken(spark, documents, bucket_rows, sent, monkeypatch):
    monkeypatch.setattr(mixing, "SENT_ROWS", sent)
    check(mixing.mix(frame(spark, documents), bucket_rows=bucket_rows).collect(), *documents)


def test_reruns_and_partitions_agree(spark, documents):
    df = frame(spark, documents)
    one, two = (sorted(map(tuple, mixing.mix(d, bucket_rows=40).collect()), key=str) for d in (df.repartition(1), df.repartition(7)))
    assert one == two


def test_positions_follow_the_schedule(spark):
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(2000)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1,), schedules=((2.0, 0.0), (0.0, 2.0)))
    order = mixing.in_training_order(mixed).collect()
    assert len(order) == 2000 and [r.position for r in order] == sorted(r.position for r in order)
    # With rates 2-2t and 2t, a source has asked for 75 and 25 per cent by half time.
    half = [r for r in order if r.position <= 0.5]
    assert abs(sum(r.source == "a" for r in half) - 750) <= 2 and abs(sum(r.source == "b" for r in half) - 250) <= 2


def test_defined_results(spark):
    rows = [(1, "a b", None), (1, "a b", None), (None, "c", None), (2, None, "x"), (3, " ", "x")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == 5 and sum(r.taken for r in got if r.source is None) == 5
    assert all(r.taken == 0 and r.copies == 1 and r.target == 0 for r in got if r.source == "x")
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(empty).count() == 0
    blank = mixing.mix(spark.createDataFrame([(1, "", "s")], empty.schema)).first()
    assert (blank.target, blank.taken, blank.copies) == (0.0, 0, 1)


def test_query(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet").collect()
    rows = queries.op5_curriculum_mix(spark, path).collect()
    check(rows, {r.doc_id: r.text for r in docs}, {r.doc_id: r.source for r in docs})
