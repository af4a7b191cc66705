import random

from noteledger.llm import url_filter as U
from noteledger.llm.queries import URL_RULES


def naive(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        tail = rest[end:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(r.text), len(r.host), r) for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda f: f[:2])[2] if fits else None
    return host, path, best.text if best else None, best.verdict if best else default


def urls(rng, n):
    hosts = ["example.net", "EXAMPLE.net", "a.example.com", "example.com", "net", "x.org", "org", "notexample.net", "example.net.evil.com", "", "é.net", "a..net", "u:p@h.net:80"]
    paths = ["", "/", "/en/", "/en", "/de/x", "/fr/y?z=1", "?q=/en/", "#/de/", "/en/a#b", "/EN/"]
    out = [rng.choice(["http://", "https://", "", "ftp://", "x://y://"]) + rng.choice(hosts) + rng.choice(paths) for _ in range(n)]
    return out + [None, "", "://", "no scheme", "http://" + "a." * 3000 + "net/en/", "http://h.net/" + "p" * 50_000, "http://a.net/\nb"]


def test_matches_naive(spark):
    rng = random.Random(4)
    more = [U.Rule(v, t) for v, t in (("block", "com/"), ("allow", "evil.com/en"), ("block", "a.example.com/de/x"), ("allow", "x.org"))]
    for rules in (URL_RULES, URL_RULES + more, [], more[:1]):
        found = urls(rng, 300)
        pages = spark.createDataFrame([(i, u, "c") for i, u in enumerate(found)], "page_id long, url string, key string")
        got = U.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict").collect()
        assert {r.page_id: tuple(r)[1:] for r in got} == {i: naive(u, rules) for i, u in enumerate(found)}


def test_clashing_columns(spark):
    found = urls(random.Random(9), 60)
    pages = spark.createDataFrame([(i, u, "h", 1, "r", True, "b", "k") for i, u in enumerate(found)], "page_id long, url string, host string, path int, rule string, verdict boolean, _best string, _r0 string")
    got = U.judge_urls(pages, URL_RULES)
    assert got.columns == pages.columns  # results take the place of columns of their names
    rows = got.collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows} == {i: naive(u, URL_RULES) for i, u in enumerate(found)}
    assert all((r["_best"], r["_r0"]) == ("b", "k") for r in rows)


def test_join_beyond_the_bound(spark):
    found = urls(random.Random(6), 200)
    pages = spark.createDataFrame(list(enumerate(found)), "page_id long, url string")
    got = U.judge_urls(pages, URL_RULES, max_listed=1).select("page_id", "host", "path", "rule", "verdict").collect()
    assert {r.page_id: tuple(r)[1:] for r in got} == {i: naive(u, URL_RULES) for i, u in enumerate(found)}


def test_cascade_is_exact_on_its_universe(spark):
    universe = [f"key{i}" for i in range(5000)]
    listed = set(random.Random(1).sample(universe, 300))
    frame = spark.createDataFrame([(k,) for k in universe + universe[:50]], "key string")
    levels = U.cascade(frame, sorted(listed))
    assert len(levels) > 1
    got = frame.where(U.is_listed(frame.key, levels)).distinct().collect()
    assert {r.key for r in got} == listed
    plan = frame.where(U.is_listed(frame.key, levels))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_conflict_and_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert U.judge_urls(pages, URL_RULES).count() == 0
    try:
        U.judge_urls(pages, [U.Rule("block", "a/"), U.Rule("allow", "a/")])
        raise AssertionError("two verdicts were taken")
    except ValueError:
        pass
