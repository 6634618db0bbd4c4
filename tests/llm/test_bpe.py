import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from gridframe.llm import bpe, queries

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {token: i for i, token in enumerate(bpe.read_ranks(RANKS))}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.perfect_hash(RANKS), public_tokenizers.PATTERN)


def unpack(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_perfect_hash_is_minimal_and_exact():
    table = bpe.perfect_hash(RANKS)
    assert sorted(table.slots) == list(range(len(table.keys)))
    assert all(table.get(key) == i for i, key in enumerate(table.keys))
    assert table.get(b"not a token at all") is None


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(blacklist_categories=["Cs"]), max_size=60) | st.text("ab 1'\n\t\x1c\x85é漢🙂s", max_size=80))
def test_same_ids_as_the_public_library(reference, encoder, text):
    assert unpack(encoder.encode(text)) == reference.encode_ordinary(text)


def test_long_runs_and_a_small_cache(reference, encoder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_TOKENS", 3)
    monkeypatch.setattr(bpe, "RUN_TOKENS", 50)
    text = "zq" * 3000 + " wordy " * 40 + "\n" * 500 + " 12345678901234567890" * 9
    assert unpack(encoder.encode(text)) == reference.encode_ordinary(text)


def test_columns_of_every_kind(spark, reference):
    texts = [None, "", " ", "the the <|endoftext|> x", "Größe 漢字 🙂", "a" * 5000, "a" * 5000]
    rows = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    coded = bpe.decode(bpe.encode(rows.withColumn("extra", rows.ids), RANKS, public_tokenizers.PATTERN), RANKS)
    got = {r.doc_id: r for r in coded.collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert unpack(got[i].ids) == reference.encode_ordinary(text or "")
        assert bytes(got[i].decoded) == (text or "").encode()
        assert got[i].extra == "kept"
    assert bpe.encode(rows.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_decoding_what_is_not_in_the_vocabulary(spark):
    rows = spark.createDataFrame([(None,), (b"",), (b"\x01",), (struct.pack("<I", 60000),)], "ids binary")
    assert [r.decoded for r in bpe.decode(rows, RANKS).collect()] == [None, b"", None, None]


def test_query(spark, reference):
    path = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op1_byte_bpe(spark, path).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = reference.encode_ordinary(text)
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_one_pass_gives_what_two_give_and_holds_one_python_worker(spark, reference):
    rows = [(1, "s", "Hello world, héllo 漢🙂"), (1, "s", "Hello world, héllo 漢🙂"), (None, None, None), (3, "t", ""), (4, "t", "a  b\n\tc")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    one = bpe.encode_decode(df, RANKS, public_tokenizers.PATTERN)
    two = bpe.decode(bpe.encode(df, RANKS, public_tokenizers.PATTERN), RANKS).drop("text")
    assert one.columns == ["doc_id", "source", "ids", "decoded"]
    assert sorted(one.collect(), key=str) == sorted(two.collect(), key=str)
    assert all(unpack(r.ids) == reference.encode_ordinary(r.text or "") for r in df.join(one, ["doc_id", "source"]).collect() if r.doc_id)
    # Chained UDFs each start a worker in a task; the one pass starts one.
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan
