import random
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pytest

from postalspark.functions import html as H
from postalspark.functions.links import is_area_link, resolve_url, resolves_to_host, same_host
from postalspark.operators import graph as og
from postalspark.operators import pages as op
from postalspark.sinks.files import write_codes_csv

BASE = "https://codigo-postal.org/pt-br/brasil/sp/sao-paulo/"

TABLE_PAGE = """<!DOCTYPE html><title>t</title>
<table class=wide id='ul_list'><thead><tr><th>x</th></tr></thead>
<tbody id=tbody_results>
<tr><td><b><a class=k href='/pt-br/cep/04001-010/'>see</a></b><td>05001-001
<tr><td><a href=/pt-br/cep/04001-020/>04001-021</a></td><td>06001-001</td></tr>
<tr><td>04001-030</td></tr>
<tr><td><a href="/x">code 04001&#45;040</a></td></tr>
<tr><td><a href="&sol;cep&#x2f;04001-050/">y</a>
</tbody></table>
<!-- <a href="/cep/07001-001/">gone</a> -->
<script>document.write('<a href="/cep/07001-002/">gone</a>');</script>"""
TABLE_CODES = ["04001-010", "04001-020", "04001-021", "04001-040", "04001-050"]

TEXT_PAGE = """<style>.c01001-001{}</style><h1>Area </h1><p>02002-010, 02002020</p>
<div>02002&#45;030</div><template>02002-040</template><!-- 02002-050 --><script>"02002-060"</script>
<p>12002-070</p><p>902002-080</p>"""


def pages(spark, *htmls):
    return spark.createDataFrame([(i, "u", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")


def test_table_page_codes(spark):
    df = pages(spark, TABLE_PAGE)
    assert sorted(r.cep for r in op.table_codes(df).collect()) == TABLE_CODES
    assert sorted(r.cep for r in op.link_codes(df).collect()) == ["04001-010", "04001-020", "04001-050"]
    assert sorted(r.cep for r in op.page_codes(df).collect()) == TABLE_CODES


def test_text_fallback_reads_only_what_is_shown(spark):
    got = sorted(r.cep for r in op.page_codes(pages(spark, TEXT_PAGE)).collect())
    assert got == ["02002-010", "02002-020", "02002-030"]


class _Links(HTMLParser):
    def __init__(self, text):
        super().__init__()
        self.found = []
        self.feed(text)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.found += [v or "" for k, v in attrs if k == "href"]


@pytest.mark.parametrize("html", [
    TABLE_PAGE, TEXT_PAGE, "<a href='/one'>1</a><A HREF=/two>2</A><a\nhref = \"/three\">3", "<abbr href=/no></abbr><a name=x>n</a>",
    "<!-- <a href=/no> --><a href='/a&amp;b&#x41;&#66;'>", "<a data-href=/no href=/yes>", "<style><a href=/no></style><a href=''>", "<a href=/p?x=1&y=2>",
])
def test_links_match_a_parser(spark, html):
    assert [r.href for r in op.page_links(pages(spark, html)).collect()] == _Links(html).found


def test_links_of_the_given_pages_match_a_parser(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/pages.parquet")
    want = sorted((r.page_id, h) for r in rows.collect() for h in _Links(r.html or "").found)
    assert sorted((r.page_id, r.href) for r in op.page_links(rows).collect()) == want


@pytest.mark.parametrize("text,want", [
    ("a&#45;b", "a-b"), ("&#x2D;&#X2d", "--"), ("&#8364;", "€"), ("&#x1F642;", "🙂"), ("&amp;#45;", "&#45;"), ("&#;&#x;&#zz", "&#;&#x;&#zz"),
    ("&#0;", "&#0;"), ("&lt;&gt;&quot;&apos;&sol;&colon;", "<>\"'/:"), ("", ""), (None, None), ("&#12345678901;", "&#12345678901;"),
])
def test_character_references(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(H.decode_entities("t")).first()[0] == want


def test_page_operators_do_not_shuffle(spark):
    df = pages(spark, TABLE_PAGE)
    for out in (op.table_codes(df), op.link_codes(df), op.text_codes(df), op.page_codes(df), op.area_links(df, BASE)):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_text_is_joined_without_separator(spark):
    df = pages(spark, "<p>01310</p><p>-100</p>")
    assert [r.cep for r in op.text_codes(df).collect()] == ["01310-100"]


# Links put together from parts, so that the answer is known when they are made.
AREAS = ["centro", "vila-nova", "x", "sao-paulo-2", "spx"]
ENTRIES = ["/pt-br", "/brasil", "/pt-br/brasil", "/a/brasil/b", "https://h.example/brasil/sp", "//h/pt-br"]
DEAD_ENDS = ["cep", "logradouro", "blog", "sobre", "contato", "meu-cep"]


def accepted_links():
    for entry in ENTRIES:
        for area in AREAS:
            yield f"{entry}/sao-paulo/{area}"
            yield f"{entry}//sao-paulo//{area}/"
            yield f"{entry}/sao-paulo/{area}/sp/"
    yield "/sao-paulo/centro/brasil"
    yield "pt-br/sao-paulo/centro"


def refused_links():
    yield from (None, "", "/", "/pt-br/brasil/", "sao-paulo", "/brasil/Sao-Paulo/centro/", "/PT-BR/BRASIL/sao-paulo/centro/", "/es/sao-paulo/centro/")
    for entry in ENTRIES:
        yield from (f"{entry}/sao-paulo", f"{entry}/sao-paulo/", f"{entry}/sao-paulo/sp", f"{entry}/sao-paulo/sp/centro/", f"{entry}/rio/centro/")
        for word in DEAD_ENDS:
            yield f"{entry}/sao-paulo/centro/{word}/1"


@pytest.mark.parametrize("links,want", [(accepted_links, True), (refused_links, False)])
def test_area_link_by_construction(spark, links, want):
    df = spark.createDataFrame([(h,) for h in links()], "h string")
    assert [r.h for r in df.select("h", is_area_link("h").alias("ok")).collect() if r.ok is not want] == []


def test_area_link_of_many_segments(spark):
    long = "/brasil" + "/a" * 50_000
    df = spark.createDataFrame([(long + "/sao-paulo/centro",), (long,)], "h string")
    assert [r[0] for r in df.select(is_area_link("h")).collect()] == [True, False]


def test_same_host(spark):
    df = spark.createDataFrame([("https://codigo-postal.org/pt-br/brasil/sp/sao-paulo/aclimacao/",),
                                ("https://example.com/pt-br/brasil/sp/sao-paulo/",), ("/relative",)], "u string")
    assert [r[0] for r in df.select(same_host("u", BASE)).collect()] == [True, False, False]


def test_area_links_of_a_page(spark):
    page = """<a href='centro/'>a</a><a href=./centro/>b</a><a href="//other.example/brasil/sao-paulo/centro/">c</a>
    <a href="/pt-br/brasil/sp/sao-paulo/moema/">d</a><a href="/pt-br/brasil/sp/sao-paulo/moema/">e</a><a href="/brasil/sao-paulo/../sao-paulo/lapa">f</a>"""
    got = sorted(r.url for r in op.area_links(pages(spark, page), BASE).collect())
    assert got == ["https://codigo-postal.org/brasil/sao-paulo/lapa", "https://codigo-postal.org/pt-br/brasil/sp/sao-paulo/moema/"]


def test_resolve_url_matches_urljoin(spark):
    rnd = random.Random(7)
    parts = ["a", "b", "..", ".", "", "sao-paulo", "x y", "q?x=1", "f#top"]
    hrefs = ["", "/", "//other.host/p", "?q=1", "#frag", "http://h/x", "https://codigo-postal.org/a/../b",
             "../up", "./here", "a/b/../../c", "/abs/./x/../y", "..", ".", "../../../../z", "/a//b/../c/",
             "https:x", "HTTPS:../y", "https:", "https:?q=1", "http:x", "https:///z", "x?", "x#", "?", "#",
             "?#a", "?q#", "https://h/x?", "HTTPS://H/x", "//h/x?", "/a?", "https:#z", "x?y#z", "https:?"]
    for _ in range(300):
        n = rnd.randint(1, 5)
        h = "/".join(rnd.choice(parts) for _ in range(n))
        if rnd.random() < 0.3:
            h = "/" + h
        hrefs.append(h)
    for base in [BASE, "https://codigo-postal.org/pt-br/page.html?x=1#f"]:
        df = spark.createDataFrame([(h,) for h in hrefs], "h string")
        got = [r[0] for r in df.select(resolve_url("h", base)).collect()]
        want = [urljoin(base, h) for h in hrefs]
        bad = [(h, g, w) for h, g, w in zip(hrefs, got, want) if g != w]
        assert not bad, bad[:5]


def test_netloc_matches_urlparse(spark):
    urls = ["https://a.b:8080/x", "http://user:pw@h/x", "//h/x", "/x", "mailto:x@y", "https://h?x", "ftp://h#f"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r[0] for r in df.select(same_host("u", "https://a.b:8080/")).collect()]
    assert got == [urlparse(u).netloc == "a.b:8080" for u in urls]


def test_reach_pages_with_cycle(spark):
    links = spark.createDataFrame([("base", "a"), ("a", "b"), ("b", "base"), ("b", "c"), ("c", "a"), ("x", "y")],
                                  "src string, dst string")
    got = {r.node: r.depth for r in og.reach_pages(links).collect()}
    assert got == {"base": 0, "a": 1, "b": 2, "c": 3}


def test_collection_stops_at_target(spark):
    links = spark.createDataFrame([("base", "p1"), ("base", "p2"), ("p1", "p3")], "src string, dst string")
    pg = spark.createDataFrame([
        (1, "p1", "<a href='x'></a><p>CEP: 01000-001 e 01000-002</p>"),
        (2, "p2", "<p>01000-003</p>"),
        (3, "p3", "<p>01000-004</p>"),
    ], "page_id long, node string, html string")
    got = [r.cep for r in og.collect_codes(links, pg, max_codes=3).collect()]
    assert got == ["01000-001", "01000-002", "01000-003"]


def test_write_codes_csv(spark):
    df = spark.createDataFrame([("01312-300",), ("01310-100",), ("01311-200",)], "cep string")
    path = write_codes_csv(df, single_file=True)
    back = spark.read.text(path).collect()
    lines = [r.value for r in back]
    assert lines[0] == "cep"
    assert lines[1:] == ["01310100", "01311200", "01312300"]


def test_link_extraction_decodes_entities(spark):
    df = pages(spark, '<a class="x" href="/p?a=1&amp;b=2">t</a><A HREF="/Q">u</A>')
    assert [r.href for r in op.page_links(df).collect()] == ["/p?a=1&b=2", "/Q"]
    assert H is not None


def test_host_check_before_resolution(spark):
    hrefs = ["", "/a", "//codigo-postal.org/x", "//other/x", "///x", "https://codigo-postal.org/y",
             "http://codigo-postal.org/y", "https://evil.org/y", "mailto:a@b", "rel/x", "?q", "#f", "https:x",
             "HTTPS:/a", "https:", "http:x"]
    df = spark.createDataFrame([(h,) for h in hrefs], "h string")
    got = [tuple(r) for r in df.select(resolves_to_host("h", BASE), same_host(resolve_url("h", BASE), BASE)).collect()]
    assert all(a == b for a, b in got), list(zip(hrefs, got))


def test_reach_pages_with_a_hub(spark):
    edges = [("base", "hub")] + [("hub", f"p{i}") for i in range(500)] + [(f"p{i}", f"q{i % 7}") for i in range(500)]
    links = spark.createDataFrame(edges, "src string, dst string")
    got = {r.node: r.depth for r in og.reach_pages(links).collect()}
    assert got["hub"] == 1 and got["p499"] == 2 and got["q6"] == 3 and len(got) == 1 + 1 + 500 + 7


def levels(edges, start):
    """Plain breadth-first depths."""
    out, now, depth = {start: 0}, {start}, 0
    while now:
        depth += 1
        now = {b for a, b in edges if a in now and b not in out}
        out |= dict.fromkeys(now, depth)
    return out


def test_reach_pages_of_a_chain_of_two_thousand_levels(spark):
    edges = [("base", "n0")] + [(f"n{i}", f"n{i + 1}") for i in range(1999)]
    edges += [("n700", "side"), ("side", "n1500"), ("n3", "base"), ("n9", "n9"), ("r1", "r2"), ("r2", "r1"), ("r2", "r3"), ("lost", "n50")]
    reached = og.reach_pages(spark.createDataFrame(edges, "src string, dst string"))
    plan = reached._jdf.queryExecution().toString()
    got = {r.node: r.depth for r in reached.collect()}
    assert got == levels(edges, "base") and got["n1999"] == 1202 and "r3" not in got
    assert plan.count("Scan ExistingRDD") < 60


def test_crawl_searches_pages_only_and_by_number(spark, monkeypatch):
    site, seen = "https://x.example/pt-br/sao-paulo/", []
    page = lambda *to: "".join(f'<a href="/pt-br/sao-paulo/{t}/">n</a>' for t in to)
    rows = [(1, f"{site}a/", page("b", "c", "nowhere")), (2, f"{site}b/", page("a", "d")), (3, f"{site}c/", page("gone")),
            (4, f"{site}d/", page("d")), (5, f"{site}d/", page("e")), (6, f"{site}e/", ""), (7, None, page("a")),
            (8, f"{site}far/", page("a")), (None, f"{site}c/", page("far"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    reach = og.reach_pages
    monkeypatch.setattr(og, "reach_pages", lambda links, *a: seen.append(links) or reach(links, *a))
    got = sorted((r.page_id or 0, r.depth) for r in og.crawl(pages, f"{site}a/").collect())
    assert got == [(0, 1), (1, 0), (2, 1), (3, 1), (4, 2), (5, 2), (6, 3)]
    assert [t for _, t in seen[0].dtypes] == ["bigint", "bigint"] and seen[0].count() == 7
    assert og.crawl(pages, f"{site}none/").collect() == []


def test_reach_pages_against_plain_search(spark):
    import random
    rng = random.Random(11)
    for n, m in ((12, 14), (40, 60), (60, 50), (30, 200)):
        names = ["base"] + [f"p{i}" for i in range(n)]
        edges = [(rng.choice(names), rng.choice(names)) for _ in range(m)] + [("base", "p0"), (None, "p1"), ("p1", None)]
        links = spark.createDataFrame(edges, "src string, dst string")
        want = levels([e for e in edges if None not in e], "base")
        assert {r.node: r.depth for r in og.reach_pages(links).collect()} == want
        few = {r.node: r.depth for r in og.reach_pages(links, max_depth=2).collect()}
        assert few == {k: d for k, d in want.items() if d <= 2}
    assert [tuple(r) for r in og.reach_pages(spark.createDataFrame([], "src string, dst string")).collect()] == [("base", 0)]


def test_reach_pages_of_a_ladder(spark):
    edges = [("base", "a0"), ("base", "b0")]
    edges += [("base", "s"), ("s", "t"), ("t", "x"), ("base", "x"), ("x", "y")]  # x is below its root on a long and a short way
    edges += [(f"{x}{i}", f"{y}{i + 1}") for i in range(9) for x in "ab" for y in "ab"]
    links = spark.createDataFrame(edges, "src string, dst string")
    assert {r.node: r.depth for r in og.reach_pages(links).collect()} == levels(edges, "base")
