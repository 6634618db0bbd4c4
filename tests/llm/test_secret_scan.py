import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from gridframe.llm import queries, secret_scan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
BASE = [("assign", ASSIGN, 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16)]


def brute(text):
    found = [(m.start(), i, kind, m.end()) for i, (kind, p, g, least) in enumerate(BASE) for m in p.finditer(text or "") if len(m.group(g)) >= least]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def base_of(spans):
    return [s for s in spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")]


def all_spans(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "path long, text string")
    ledger, paths = secret_scan.scan(df)
    found = secret_scan.findings(paths, ledger).withColumn("spans", secret_scan.span_text(F.col("spans")))
    return {r.path: r.spans for r in found.collect()}


def test_spans_of_awkward_texts(spark):
    rng = random.Random(4)
    bits = ["password", "Token", "API_KEY", "apikey", '"', "'", ":", "=", " ", "AKIA", "A1B2C3D4E5F6G7H8", "deadbeef", "0123456789", "🙂", "é", "\n", "secret=", "x", "-----", "AKIAAKIA"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 40))) for _ in range(400)]
    texts += [None, "", "token=secret= abcdefghijklmnop", "deadbeef" * 20_000, "a1" * 8 + "g" + "f" * 15, " secret : 'abcdefghijkl'" * 3000]
    got = all_spans(spark, texts)
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert base_of(got[i]) == brute(text), text and text[:200]


def test_more_kinds(spark):
    texts = ["ghp_" + "a1B2" * 9, "xoxb-1234567890-abcdefghij", "-----BEGIN RSA PRIVATE KEY-----\n" + "Zz9\n" * 20 + "-----END RSA PRIVATE KEY-----", "eyJhbGci.eyJzdWIiOiJ4In0.abcdefghijklmnopqr"]
    got = all_spans(spark, texts)
    assert [[s.split(":")[0] for s in got[i].split(",")] for i in range(4)] == [["github"], ["slack"], ["private_key"], ["jwt"]]


def test_ledger_scans_only_what_is_new(spark):
    old = [("a", "secret=abcdefghijklmn"), ("b", "secret=abcdefghijklmn"), ("c", None)]
    ledger, _ = secret_scan.scan(spark.createDataFrame(old, "path string, text string"), rules=secret_scan.BASE_RULES)
    assert ledger.count() == 2
    new = spark.createDataFrame([*old, ("d", "AKIA" + "Z" * 16), ("d", "AKIA" + "Z" * 16), (None, "AKIA" + "Z" * 16)], "path string, text string")
    added, paths = secret_scan.scan(new, ledger=ledger, rules=secret_scan.BASE_RULES)
    assert [r.spans[0].kind for r in added.collect()] == ["access"]
    found = secret_scan.findings(paths, ledger.union(added), secret_scan.BASE_RULES)
    assert sorted((str(r.path), len(r.spans)) for r in found.collect()) == [("None", 1), ("a", 1), ("b", 1), ("c", 0), ("d", 1), ("d", 1)]
    again, _ = secret_scan.scan(new, ledger=ledger.union(added), rules=secret_scan.BASE_RULES)
    assert again.count() == 0
    more, _ = secret_scan.scan(new, ledger=ledger.union(added))
    assert more.count() == 3 and all("github@1" in r.rules and "hex@1" not in r.rules for r in more.collect())
    assert secret_scan.scan(new.limit(0))[0].count() == 0


def test_query(spark):
    path = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = queries.op7_blob_ledger(spark, path).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert base_of(r.spans) == want
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex")]
    assert any(r.n_assign for r in rows) and any(r.n_hex for r in rows)


def test_long_hostile_texts_take_linear_time(spark):
    size = 10**6
    worst = ["eyJ", "eyJa.", "eyJa.eyJ", "password ", "token" + " " * 5000, "AKIA", "gh", "ghp_", "xoxb-", "a1", "-----BEGIN ", "-----BEGIN PRIVATE KEY-----", "-----BEGIN" + "A" * 5000, "secret='", "api_key:", "PRIVATE KEY-----"]
    texts = [(bit * (size // len(bit))) for bit in worst]
    start = time.time()
    got = all_spans(spark, texts)
    assert time.time() - start < 2 * len(texts)
    assert all(base_of(got[i]) == brute(text) for i, text in enumerate(texts) if not got[i].count(",") > 1000)


def test_tokens_of_three_parts(spark):
    texts = ["x eyJabc.eyJdef.0123456789abcdefg y", "eyJab.eyJcd no third", "eyJaeyJbcd.eyJ0123456789.0123456789-", "eyJa.b.eyJccc.eyJddddddddd.eeeeeeeeeeee"]
    got = all_spans(spark, texts)
    spans = [[s for s in got[i].split(",") if s.startswith("jwt")] for i in range(4)]
    assert spans == [["jwt:2:33"], [], ["jwt:0:36"], ["jwt:7:39"]]
