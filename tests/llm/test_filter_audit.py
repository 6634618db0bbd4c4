import random
import re
from collections import Counter, defaultdict
from itertools import permutations

from gridframe.llm import filter_audit
from gridframe.llm.shipping import ship

DOCS = "doc_id long, text string, lang string, part int, words string"
LABELS = "doc_id long, quality int, toxic int, mask int"


def failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    rules = {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": re.search(r"[#$%&*|]", text) is not None,
    }
    return {name for name, fails in rules.items() if fails}


def brute(docs, labels):
    good = {i for i, q, t, *_ in labels if i is not None and q == 1}
    toxic = {i for i, q, t, *_ in labels if i is not None and t == 1}
    least = {}
    for i, text, *_ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    rows = [(lang or "", i, failed(text or "") | ({"E"} if i is not None and i > least[text or ""] else set())) for i, text, lang, *_ in docs]
    result, shapley = {}, Counter()
    for order in permutations("ABCDE"):
        for step, own in enumerate(order):
            seen = defaultdict(Counter)
            for part, i, fails in rows:
                earlier = fails & set(order[:step])
                here = own in fails and not earlier
                seen[part].update(
                    kept=not earlier and own not in fails, removed=here, redundant=own in fails and bool(earlier), unique=fails == {own}, good=here and i in good, toxic=here and i in toxic
                )
                shapley[part, own] += here
            for part, c in seen.items():
                result[part, "".join(order), step + 1] = [c[k] for k in ("kept", "removed", "redundant", "unique", "good", "toxic")]
    return {key: (*values, shapley[key[0], key[1][key[2] - 1]]) for key, values in result.items()}


def answer(spark, docs, labels, **options):
    ship(spark)
    counts = filter_audit.mask_counts(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), **options)
    rows = filter_audit.audit(counts).collect()
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}


def corpus():
    rng = random.Random(3)
    many = " ".join(f"w{i}" for i in range(120))
    texts = [None, "", " \t\n", many, many.upper(), many + " #", "a " * 150, "é🙂 " * 100, many + "\x00", "x" * 300_000, "Kurz und gut", *(f"{many} {i}" for i in range(40))]
    docs = [(rng.randrange(60) if rng.random() < 0.9 else None, rng.choice(texts), rng.choice(["en", "de", "", None]), 1, "x") for _ in range(300)]
    docs += docs[:20]  # repeated rows
    labels = [(rng.choice([None, *range(60)]), rng.choice([0, 1, None]), rng.choice([0, 1, None]), 9) for _ in range(80)]
    return docs, labels


def test_audit_equals_brute_force_with_a_roomy_and_with_a_full_sketch(spark):
    docs, labels = corpus()
    expected = brute(docs, labels)
    assert answer(spark, docs, labels) == expected


def test_a_full_sketch_only_shuffles_more(spark, monkeypatch):
    docs, labels = corpus()
    expected = brute(docs, labels)
    # One block of eight cells: every text is a possible repeat.
    monkeypatch.setattr(filter_audit, "_cells", lambda: [filter_audit.F.col("h2").bitwiseAND(7).cast("int")] * 3)
    assert answer(spark, docs, labels, most_cells=1 << filter_audit.BLOCK_BITS) == expected


def test_sketch_clears_most_unique_texts_and_no_repeat(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "concat('text ', if(id % 10 = 0, id div 20, id + 100000)) as text")
    keys = docs.select("doc_id", *filter_audit.digests(filter_audit.F.col("text"))).repartition(5)
    ship(spark)
    merged, blocks = filter_audit.sketch(keys, 20_000)
    left = {r.doc_id for r in filter_audit.possible_repeats(keys, merged, blocks).collect()}
    repeats = {r.doc_id for r in keys.collect() if r.doc_id % 10 == 0}
    assert repeats <= left and len(left - repeats) < 0.1 * 18_000


def test_empty_tables(spark):
    assert answer(spark, [], []) == {}
    assert len(answer(spark, [(None, None, None, 1, "")], [])) == 600
