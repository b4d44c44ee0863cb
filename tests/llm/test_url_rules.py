"""URL filters against a brute-force miner, through the registered query."""

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from gableboard.llm import queries, url_rules

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return host.translate(LOW), re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]


def listed(host, path):
    fit = [(len(h + p), h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def tokens(url):
    host, path = parts(url)
    query = re.match(r"[^?#]*\?([^#]*)", url or "", re.S)
    found = ["host:" + host, *["label:" + x for x in host.split(".")],
             *["path:" + x for x in re.sub("[0-9]+", "0", path.translate(LOW)).split("/")],
             *["name:" + x.split("=")[0] for x in (query.group(1).split("&") if query else [])]]
    return frozenset(t for t in found if not t.endswith(":") or t.count(":") > 1)


def brute(rows, support, confidence):
    said = [(tokens(u), listed(*parts(u))[1]) for u in rows]
    said = [(t, v) for t, v in said if v]
    where = defaultdict(set)
    for i, (t, _) in enumerate(said):
        for x in t:
            where[x].add(i)
    least = {}
    for x in sorted(where):
        if len(where[x]) >= support * len(said):
            least.setdefault(frozenset(where[x]), x)
    kept = set(least.values())
    alone, both = Counter(), Counter()
    for t, v in said:
        mine = sorted(t & kept)
        for k in range(1, len(mine) + 1):
            for s in combinations(mine, k):
                alone[s] += 1
                both[s, v] += 1
    rules = {(s, v): (n / alone[s], n) for (s, v), n in both.items() if n >= support * len(said) and n / alone[s] >= confidence}
    rules = {(s, v): x for (s, v), x in rules.items()
             if not any(w == v and set(o) < set(s) and y[0] >= x[0] for (o, w), y in rules.items())}
    out = []
    for u in rows:
        rule, v = listed(*parts(u))
        if v is None:
            t = tokens(u)
            fit = [(-c, -n, len(s), s, w) for (s, w), (c, n) in rules.items() if set(s) <= t]
            v = min(fit)[4] if fit else "allow"
        out.append((*parts(u), rule, v))
    return out


@pytest.fixture(scope="module")
def urls():
    pick = random.Random(5).choice
    some = ["%s://%s%s.%s/%s/%d%s" % (pick(["http", "https"]), pick(["", "www.", "m.", "Blog."]), pick(["a.example", "b.example", "example", "spam", "c"]),
                                      pick(["com", "net", "org"]), pick(["en", "fr", "es", "de", "EN"]), pick(range(99)), pick(["", "?page=2&ref=x", "#top", "/", ".html"]))
            for _ in range(300)]
    hot = ["http://hot.example.org/en/%d" % i for i in range(150)]
    return [*some, *hot, None, None, "", "no url", "://", "http://", "x://com", "x://com/", "http://a.net/es/" * 3000, "http://x.com?a=1&a=2&b", "a\nb://c.net\n/fr/"]


def test_query_equals_brute_force(spark, urls, tmp_path):
    table = spark.createDataFrame([(i, u, "clash", 1) for i, u in enumerate(urls)], "page_id long, url string, verdict string, host int")
    table.write.parquet(str(tmp_path / "pages.parquet"))
    got = url_rules.filtered(spark.read.parquet(str(tmp_path / "pages.parquet")), queries.URL_RULES, support=0.02)
    want = [(i, *r) for i, r in enumerate(brute(urls, 0.02, url_rules.CONFIDENCE))]
    assert sorted(tuple(r)[:5] for r in got.collect()) == want
    got = queries.op13_url_rules(spark, str(tmp_path))
    assert got.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    want = [(i, *r) for i, r in enumerate(brute(urls, 0.005, url_rules.CONFIDENCE))]
    assert sorted(tuple(r)[:5] for r in got.collect()) == want


def test_longest_rule_wins(spark):
    rows = [("http://www.example.com/en/1", "www.example.com/en/", "allow"), ("http://x.www.example.com/en/", "www.example.com/en/", "allow"),
            ("http://wwww.example.com/en/1", "example.com/en/", "block"), ("http://notexample.com/en/1", "com/", "allow"),
            ("http://example.com/en", "com/", "allow"), ("http://net/es/", "net/es/", "block"), ("http://NET/ES/", None, "allow")]
    got = url_rules.filtered(spark.createDataFrame([(u,) for u, *_ in rows], "u string"), queries.URL_RULES, key="u", url="u")
    assert {r.u: (r.rule, r.verdict) for r in got.collect() if r.rule} == {u: (r, v) for u, r, v in rows if r}


def test_empty_and_unlabelled(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.filtered(none, queries.URL_RULES).collect() == []
    some = spark.createDataFrame([(1, "http://a.org/"), (None, None), (1, "http://a.org/")], "page_id long, url string")
    assert sorted((r.page_id or 0, r.rule, r.verdict) for r in url_rules.filtered(some, [], default="block").collect()) == [
        (0, None, "block"), (1, None, "block"), (1, None, "block")]
