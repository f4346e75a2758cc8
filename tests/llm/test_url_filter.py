import re
from urllib.parse import unquote

from postalspark.llm import url_filter as u

URLS = ["http://a.example.org/es/1", "http://example.org/es", "https://x.example.org/en/12?q", "https://www.example.com/de/3", "http://com/fr/", "HTTP://WWW.Example.COM/fr/9#t",
        "http://b.net/xxx", "http://b.net/xxxl", "http://spam-farm.net/a", "http://b.net/free-poker", "http://b.net/free", "http://b.net/poker", "http://b.net/p%6Frn", None, "", "nourl",
        "http://", "http://org", "http://org/", "://x.org/y", "http://h.net?x=casino", "http://h.net/free/bet/click", "http://notexample.org/es/2", "a://b://c.org/d", "http://u.net/a\nb?c"]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    rule = verdict = None
    for v, r in u.RULES:
        h, p = r.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (rule is None or len(r) > len(rule)):
            rule, verdict = r, v
    text = unquote(url or "").lower()
    hits = [t for t in {*u.STRICT_TERMS, *u.SOFT_TERMS} if re.search(rf"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", text)]
    strict, soft = [t for t in hits if t in u.STRICT_TERMS], [t for t in hits if t not in u.STRICT_TERMS]
    bad = strict or len(soft) >= 2 and sum(u.SOFT_TERMS[t] for t in soft) >= 1.5
    return host, path, rule, verdict or ("block" if bad else "allow"), len(strict), len(soft)


def pages(spark, urls):
    return spark.createDataFrame([(i, x, "<p>", "rule", "v") for i, x in enumerate(urls)], "page_id long, url string, html string, rule string, _v string")


def test_matches_a_plain_version(spark):
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.n_strict, r.n_soft) for r in u.filter_urls(pages(spark, URLS * 2)).collect()}
    assert got == {i: plain(x) for i, x in enumerate(URLS * 2)}


def test_whole_pages_table(spark, sf_small):
    p = spark.read.parquet(f"{sf_small}/pages.parquet")
    urls = {r.page_id: r.url for r in p.collect()}
    for r in u.filter_urls(p).collect():
        assert (r.host, r.path, r.rule, r.verdict) == plain(urls[r.page_id])[:4]


def test_no_rules_no_terms_empty_table(spark):
    got = u.filter_urls(pages(spark, URLS), rules=(), strict=(), soft={}).collect()
    assert all(r.verdict == "allow" and r.rule is None for r in got)
    assert u.filter_urls(pages(spark, [])).count() == 0
