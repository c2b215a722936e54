"""Rules and character models against plain Python."""

import math
import re
from collections import Counter, defaultdict

from tickloom.llm.queries import URL_RULES, op2_url_filter
from tickloom.llm.url_filter import HostRule, judge_urls

ORDER = 4


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(url, rules):
    host, path = parts(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def brute(urls, rules):
    """url -> score less threshold, or None."""
    distinct = sorted({u for u in urls if u is not None})
    body = {u: "\u0002" * ORDER + "".join(c.lower() if "A" <= c <= "Z" else c for c in re.sub(r"(?s)^.*?://", "", u)) + "\u0003" for u in distinct}
    grams = {u: [b[i : i + ORDER + 1] for i in range(len(b) - ORDER)] for u, b in body.items()}
    letters = len({g[-1] for gs in grams.values() for g in gs})
    counts = {c: [Counter() for _ in range(ORDER + 1)] for c in ("allow", "block")}
    for u, gs in grams.items():
        if r := rule_of(u, rules):
            for g in gs:
                for k in range(ORDER + 1):
                    counts[r.verdict][k][g[ORDER - k :]] += 1
    around = {c: [defaultdict(lambda: [0, 0]) for _ in range(ORDER + 1)] for c in counts}
    for c in counts:
        for k in range(ORDER + 1):
            for g, n in counts[c][k].items():
                around[c][k][g[:-1]][0] += n
                around[c][k][g[:-1]][1] += 1

    def p(c, gram):
        out = 1 / letters
        for k in range(ORDER + 1):
            g = gram[ORDER - k :]
            n, kinds = around[c][k].get(g[:-1], (0, 0))
            if n:
                out = (counts[c][k][g] + kinds * out) / (n + kinds)
        return out

    mean = {u: sum(math.log(p("allow", g)) - math.log(p("block", g)) for g in gs) / len(gs) for u, gs in grams.items()}
    found = defaultdict(list)
    for u in distinct:
        if r := rule_of(u, rules):
            found[r.verdict].append(mean[u])
    if len(found) < 2:
        return dict.fromkeys(distinct)
    stats = {c: (sum(v) / len(v), math.sqrt(sum((x - sum(v) / len(v)) ** 2 for x in v) / len(v))) for c, v in found.items()}
    (ma, sa), (mb, sb) = stats["allow"], stats["block"]
    cut = (ma * sb + mb * sa) / (sa + sb) if sa + sb else (ma + mb) / 2
    return {u: mean[u] - cut for u in distinct}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    scores = brute(pages.values(), URL_RULES)
    rows = op2_url_filter(spark, sf).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        url = pages[r.page_id]
        rule = rule_of(url, URL_RULES)
        assert (r.host, r.path, r.rule) == (*parts(url), rule and rule.name)
        assert abs(r.llr - scores[url]) < 1e-5
        assert r.verdict == (rule.verdict if rule else "block" if scores[url] <= 0 else "allow")


def test_hosts_paths_and_rules(spark):
    urls = [
        "http://EXAMPLE.com", "http://example.com/", "http://example.com/en", "http://example.com/en/x", "http://www.example.com/en/",
        "http://a.www.Example.com/en/y", "http://notexample.com/en/", "http://x.net/es/", "http://net/fr/1", "http://x.net/EN/", "ftp://com/",
        "http://com", "no scheme", "://x.com/a?b=/en/", "http://x.com?/en/", "http://x.com#/", "http://u@h.com:80/p#f", "a\nb://x.net/es/\nz", "", None, None,
        "http://example.com/en/?q", "http://x.com.evil.org/", "é://é.com/É",
    ]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string").selectExpr("*", "1 AS uid", "2 AS gram")
    out = judge_urls(df, URL_RULES)
    assert out.columns == ["page_id", "url", "uid", "gram", "host", "path", "rule", "verdict", "llr"]
    rows = sorted(out.collect())
    scores = brute(urls, URL_RULES)
    for r, url in zip(rows, urls, strict=True):
        rule = rule_of(url, URL_RULES)
        assert (r.url, r.host, r.path, r.rule) == (url, *parts(url), rule and rule.name)
        assert r.verdict in ("allow", "block") and (not rule or r.verdict == rule.verdict)
        if url is not None:
            assert abs(r.llr - scores[url]) < 1e-9
    assert rows[11].rule is None and rows[1].rule == "com/" and rows[17].rule == "net/es/"


def test_without_labels_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    (row,) = judge_urls(df, URL_RULES).collect()
    assert (row.verdict, row.llr, row.rule) == ("allow", None, None)
    assert judge_urls(df.limit(0), (HostRule("com", "/", "allow"),)).count() == 0
    plan = judge_urls(df, URL_RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
