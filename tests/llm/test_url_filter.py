import re

from gridframe.llm import queries, url_filter

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fit, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


def check(rows):
    for r in rows:
        host, path, rule, verdict = brute(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def test_urls_of_every_kind(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/x?y#z", "x://y://z/p", "http://example.com", "http://com/", "http://xcom/", "https://www.example.com/en/1", "https://a.www.example.com/en/1"]
    urls += ["http://ÀB.net/fr/", "http://b.net/es", "http://b.net?/es/", "http://b.net#x", "http://b.net/es/\nq", "ftp://u:p@c.org:80/a//b/", "http://d.org/" + "a/" * 3000, "http://d.org/x", "http://d.org/x"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").selectExpr("*", "'x' as host", "'y' as template")
    got = url_filter.judge(df, queries.URL_RULES)
    rows = got.collect()
    assert sorted(r.page_id for r in rows) == list(range(len(urls))) and got.columns == ["page_id", "url", "host", "path", "rule", "template", "verdict"]
    check(rows)
    assert url_filter.judge(df.limit(0), queries.URL_RULES).count() == 0


def test_templates(spark):
    urls = [f"http://s.net/fr/{i}.html" for i in range(30)] + [f"http://s.net/en/{i}" for i in range(30)]
    urls += [f"http://t.org/u/name{chr(97 + i)}x/about" for i in range(26)] + [f"http://t.org/v/{chr(97 + i)}word/about" for i in range(26)]
    got = {r.url: r for r in url_filter.judge(spark.createDataFrame([(u,) for u in urls], "url string"), queries.URL_RULES).collect()}
    assert got["http://s.net/fr/3.html"].template == "/fr/*.html" and got["http://s.net/en/3"].verdict == "allow"
    assert got["http://t.org/v/aword/about"].template == "/v/*/about"


def test_labels_reject_a_template(spark):
    urls = [f"http://t.org/bad/{i}" for i in range(20)] + [f"http://t.org/good/{i}" for i in range(20)]
    labels = [("t.org", f"/bad/{i}", True) for i in range(100, 140)] + [("t.org", f"/good/{i}", False) for i in range(100, 140)] + [("t.org", "/good/1", None)]
    df, labels = spark.createDataFrame([(u,) for u in urls], "url string"), spark.createDataFrame(labels, "host string, path string, blocked boolean")
    got = {r.url: r.verdict for r in url_filter.judge(df, [], labels=labels).collect()}
    assert all(v == ("block" if "/bad/" in u else "allow") for u, v in got.items())


def test_similar_branches_merge(spark):
    urls = [f"http://m.org/p{s}/{i}" for s in ("a", "b", "c") for i in range(5)]
    labels = [("m.org", f"/p{s}/{i}", i % 2 == 0) for s in ("a", "b") for i in range(100, 120)] + [("m.org", f"/pc/{i}", True) for i in range(100, 160)]
    labels = spark.createDataFrame(labels, "host string, path string, blocked boolean")
    got = {r.url: r.template for r in url_filter.judge(spark.createDataFrame([(u,) for u in urls], "url string"), [], labels=labels).collect()}
    assert got["http://m.org/pc/1"] == "/pc/*"


def test_branches_below_the_fourth_segment_and_words_with_digits(spark):
    deep = "/a/b/c/d/e/f"
    urls = [f"http://t.org{deep}/{kind}/{i}" for kind in ("bad", "good") for i in range(5)] + [f"http://u.org/{kind}/{i}" for kind in ("casino777", "mp3") for i in range(5)]
    urls += [f"http://v.org/item{i}.html" for i in range(30)] + ["http://v.org/about"] * 90 + ["http://w.org" + "/a" * i for i in range(40)]
    labels = [(host, f"{path}/{i}", blocked) for host, path, blocked in (("t.org", f"{deep}/bad", True), ("t.org", f"{deep}/good", False), ("u.org", "/casino777", True), ("u.org", "/mp3", False)) for i in range(100, 140)]
    df, labels = spark.createDataFrame([(u,) for u in urls], "url string"), spark.createDataFrame(labels, "host string, path string, blocked boolean")
    got = {r.url: r for r in url_filter.judge(df, [], labels=labels).collect()}
    assert got["http://t.org/a/b/c/d/e/f/bad/1"].template == "/a/b/c/d/e/f/bad/*" and got["http://v.org/item3.html"].template == "/*.html"
    assert got["http://v.org/about"].template == "/about" and got["http://w.org/a/a/a"].template == "/a/a/a"
    assert {u for u, r in got.items() if r.verdict == "block"} == {u for u in urls if "/bad/" in u or "casino" in u}


def test_query_and_no_python(spark):
    path = "/root/testdata/sf0.01"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{path}/pages.parquet").collect()}
    got = queries.op9_path_templates(spark, path)
    rows = got.collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, route, rule, verdict = brute(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, route, rule) and (not rule or r.verdict == verdict)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_templates(rows):
    """Verdict of each (host, path) by the template tree, with dictionaries; ``rows`` are (host, path, verdict by rule)."""

    def form(path):
        parts = [re.sub(r"^(?:\d+|(?=[^.]*\d)[0-9a-fA-F-]{8,}|(?=[^.]*\d)[\w-]+)(\.\w{1,5})?$", r"*\1", s, flags=re.A) for s in path.split("/")[1:]]
        return tuple(parts[:4] + ["**"] if len(parts) > 4 else parts)

    pages = [(host, form(path), verdict) for host, path, verdict in rows]
    template = {(h, f): "" for h, f, _ in pages}
    for level in range(5):
        counts, parents = {}, {}
        for h, f, verdict in pages:
            if level < len(f):
                for into, key in ((counts, (h, template[h, f], f[level])), (parents, (h, template[h, f]))):
                    n = into.setdefault(key, [0, 0, 0, set()])
                    n[0], n[1], n[2] = n[0] + 1, n[1] + bool(verdict), n[2] + (verdict == "block")
                    n[3].add(f[level])
        after = {}
        for (h, f), t in template.items():
            if level >= len(f):
                after[h, f] = t
                continue
            (n, known, bad, _), (all_n, all_known, all_bad, values) = counts[h, t, f[level]], parents[h, t]
            name = f[level]
            if len(values) > 12 and all_n < len(values) * 3:
                name = "*"
            elif 0 < known < all_known:
                share = all_bad / all_known
                if abs(bad / known - share) <= 1.96 * (share * (1 - share) / known) ** 0.5:
                    name = "*"
            after[h, f] = f"{t}/{name}"
        template = after
    known, bad = {}, {}
    for h, f, verdict in pages:
        key = h, template[h, f]
        known[key], bad[key] = known.get(key, 0) + bool(verdict), bad.get(key, 0) + (verdict == "block")
    share = sum(bad.values()) / max(1, sum(known.values()))
    return {(h, p): v or ("block" if known[k] and (bad[k] + 4 * share) / (known[k] + 4) >= 0.5 else "allow") for (h, p, v), (_, f, _) in zip(rows, pages) for k in [(h, template[h, f])]}


def test_query_against_dictionaries(spark):
    path = "/root/testdata/sf0.1"
    rows = queries.op9_path_templates(spark, path).collect()
    by_rule = {text: verdict for verdict, text in ((r[0], r[1] + r[2]) for r in RULES)}
    want = brute_templates([(r.host, r.path, by_rule.get(r.rule)) for r in rows])
    assert all(r.verdict == want[r.host, r.path] for r in rows)
    assert {r.verdict for r in rows if not r.rule} >= {"allow"}
