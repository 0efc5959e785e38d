"""Main text of pages: single ones as they read, sites against counting in plain Python, the test pages whole."""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pytest

from tallybrook.llm.article import Article, extract_text, host_of
from tallybrook.llm.markup import Page
from tallybrook.llm.queries import op13_article, table
from tallybrook.sources.tables import shared_folder


def text(page):
    return Article(page).text(set())


@pytest.mark.parametrize(
    "page, expected",
    [
        ("", ""),
        ("no markup &amp; more", "no markup & more"),
        ("<p>one<p>two<br>lines<b>bold", "one\ntwo linesbold"),
        ("<p>a&nbsp;&nbsp;b\n\tc</p>  <p> </p>d", "a b c\nd"),
        ("<p>1 < 2 &lt; 3 & 4 &eacute;&#233;&#xe9;</p>", "1 < 2 < 3 & 4 ééé"),
        ("<script>var t='</p><p>no';</script><style>p{}</style><p>yes</p><script>open", "yes"),
        ("<p>yes</p><!-- no <p>no</p>", "yes"),
        ("<p>yes<!-- no --> too</p><img alt='no", "yes too"),
        ('<p title="a > b">yes</p><a href=it\'s>link</a>', "yes\nlink"),
        ("<title>no</title><body><h1>Head</h1><ul><li>one<li>two<ul><li>in</ul><li>three</ul>", "Head\none\ntwo\nin\nthree"),
        ("<table><tr><td>a<td>b<tr><td><table><tr><td>c</table>d</table>", "a\nb\nc\nd"),
        ("<nav><a>x</a></nav><article><h1>T</h1><p>body</p></article><footer>f</footer>", "T\nbody"),
        ("<div class=content><article><header><h1>T</h1></header><p>body</p><aside>no</aside></article></div><p>out", "T\nbody"),
        ("<body class='has-sidebar'><main><div id=text><p>body</p></div><form>no<input></form></main>", "body"),
        ("<article><p>long enough to be the text<section class='post-comments'><p>no</section></article>", "long enough to be the text"),
        ("<article><p>long enough to be the text<article><p>a reader</article></article>", "long enough to be the text"),
        ("<article class=teaser><a href=1>more</a></article><article><p>the text</article>", "the text"),
        ("<div class='no-ads page'><p>text</p></div><div id='cookieNotice'>no</div><div class='ad-slot-3'>no</div>", "text"),
        ("<div class=promo><article><p>all there is</article></div>", "all there is"),
        ("<div class='left-sidebar-inner'>no</div><div role=navigation>no</div><p>text, text and text</p>", "text, text and text"),
        ("<div><a>one</a> <a>two</a> | <a>three</a></div><p>text with <a>a link</a> in it</p>", "text with a link in it"),
        ("<article><p>text</p></div></article></article><p>more</p>", "text"),
        ("<article><p>cut off in the mid", "cut off in the mid"),
        ("<HTML><BODY><ARTICLE><P>Loud</P></ARTICLE></BODY></HTML>", "Loud"),
        ("<b><p>mis</b>nested</p><i>x", "misnested\nx"),
        ("<article></article><p>text", "text"),
        ("<aside>only</aside>", ""),
    ],
)
def test_one_page(page, expected):
    assert text(page) == expected


def test_subtrees_are_told_by_tag_and_text():
    digest = lambda page: Page(page).elements[1].digest
    assert digest("<div class=a><p>x  y</div>") == digest("<div id=b> <p>x y</p></div>")
    assert digest("<div><p>x y</div>") != digest("<div><p>x</p>y</div>") != digest("<div>x y</div>")
    assert digest("<div><p>ab</p>c</div>") != digest("<div><p>a</p>bc</div>")


def test_deep_and_long_pages():
    assert text("<div>" * 20_000 + "<p>deep" + "</div>" * 20_000) == "deep"
    words = "word " * 400_000
    assert text(f"<article><p>{words}</p></article>") == words.strip()
    assert text("<p>x" * 50_000).count("\n") == 49_999


def test_hosts():
    assert host_of("https://User:pw@Www.Example.ORG:80/a?b") == "www.example.org"
    assert host_of(None) == host_of("/a/b") == host_of("") == ""


def site(host, n, least=0):
    """Pages that mark no article, with a menu of their site and a line in it that names nothing."""
    menu = f"<div><p>All about {host}</p><span>Home of it</span></div>"
    return [(least + i, f"http://{host}/{i}", f"<body>{menu}<p>Story {i} of its own, long enough.</p><p>Told by {host}</p></body>") for i in range(n)]


def brute(rows, many=4):
    """Template by comparing whole lists of hashes."""
    seen = defaultdict(set)
    for _, url, page in rows:
        article = Article(page or "")
        for d in article.subtrees:
            if host_of(url):
                seen[host_of(url), d].add(article.text(set()))
    out = []
    for i, url, page in rows:
        article = Article(page or "")
        gone = {d for d in article.subtrees if len(seen[host_of(url), d]) >= many}
        t = article.text(gone)
        out.append((i, url, t, len(t), len(gone)))
    return sorted(out, key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, template int")
    got = extract_text(df.repartition(3), shared_folder(spark), **options)
    assert got.columns == ["page_id", "url", "text", "n_chars", "n_template"]
    return sorted(map(tuple, got.collect()), key=str)


def test_template_of_a_site(spark):
    rows = site("large.org", 30) + site("small.org", 3, 100)
    rows += [(200 + i, "http://copies.org/", rows[0][2]) for i in range(9)]
    rows += [(300, None, rows[0][2]), (301, "http://large.org/x", None), (302, "http://large.org/y", ""), (None, "http://large.org/1", rows[1][2]), (1, *rows[1][1:])]
    got = found(spark, rows)
    assert got == brute(rows)
    texts = {r[0]: r[2] for r in got}
    assert texts[5] == "Story 5 of its own, long enough."
    assert texts[101].startswith("All about small.org") and texts[204] == texts[300] and "All about" in texts[300]
    assert texts[301] == texts[302] == ""
    assert found(spark, rows, many=40) == brute(rows, 40)


def test_what_articles_share_stays(spark):
    page = "<article><h1>Story {0}</h1><p>{0} happened here, and more.</p><p>We all say so.</p><div><p>Buy</p>it</div></article>"
    rows = [(i, "http://a.org", page.format(i)) for i in range(12)]
    got = found(spark, rows)
    assert got == brute(rows)
    assert got[0][2] == "Story 0\n0 happened here, and more.\nWe all say so."


def test_empty_table(spark):
    assert found(spark, []) == []


def test_pages_of_the_test_tables(spark):
    root = "/root/testdata/sf0.001"
    got = {r["page_id"]: r for r in op13_article(spark, root).collect()}
    pages = table(spark, root, "pages").collect()
    assert len(got) == len(pages)
    for page in pages:
        article = re.search("<article>(.*?)</article>", page["html"] or "", re.S)
        parts = re.split("</?(?:p|h1)>", article[1].replace("<br>", " ")) if article else []
        lines = [" ".join(html.unescape(re.sub("<[a-z/][^>]*>", "", x)).split()) for x in parts]
        expected = "\n".join(x for x in lines if x)
        assert (got[page["page_id"]]["text"], got[page["page_id"]]["n_chars"]) == (expected, len(expected))
