"""Addresses and pages as Column expressions against the standard library's parsers."""

import re
from html.parser import HTMLParser
from pathlib import PurePosixPath
from urllib.parse import quote, unquote, urljoin, urlparse, urlunparse

from pyspark.sql import functions as F

from carrel.functions import web

PAGES = [
    ("http://a.org/b/c/d?q#f", "<p>x &amp; y&nbsp;z &#233;&#x1F600; &bogus; a < b<br/>c</p><a href='../e/./f'>one <b>two</b></a><a href=\"?k=1&amp;m=2\">q</a><a href=g>\n three </a><a name=x>no</a><a href=''>empty</a><a href='//h/i'>h</a><a href='mailto:x@y'>m</a><a href='#z'>frag</a><a href='/../../r//s/'>r</a><a href='x/..'>up</a><A HREF=\"HTTPS://Big.org/%7Eu\">big</A>"),
    ("http://a.org", "<html><head><style>p{}</style><script>if(a<b){'</p>'}</script></head><body><h1>A  B</h1><p>C<!-- c --></p>\n\n\n<p><p>D<ul><li>e<li>f</ul><a href='x'>x</a><a href='..'>lost <a href='./'>y</a> tail"),
    ("http://a.org/x/", ""),
    ("", "<a href='x/y'>x</a>"),
    ("http://a.org/b/c/", None),
]


class Reader(HTMLParser):
    def __init__(self):
        super().__init__()
        self.lines, self.found, self.target, self.inside = [], [], None, []

    def handle_starttag(self, tag, attrs):
        self.lines += ["\n"] * (tag in web.LINE_TAGS)
        if tag == "a":
            self.target, self.inside = dict(attrs).get("href"), []

    def handle_data(self, data):
        said = re.sub(r"\s+", " ", data).strip()
        self.lines += [said] * bool(said)
        if self.target is not None and said:
            self.inside.append(said)

    def handle_endtag(self, tag):
        if tag == "a" and self.target is not None:
            self.found.append((self.target, " ".join(self.inside)))
            self.target = None


def test_pages(spark):
    rows = spark.createDataFrame([(k, *p) for k, p in enumerate(PAGES)], "k int, u string, h string").select("k", web.html_text(F.col("h")).alias("t"), web.links(F.col("h"), F.col("u")).alias("l")).collect()
    for r in rows:
        base, html = PAGES[r["k"]]
        reader = Reader()
        reader.feed(html or "")
        assert r["t"] == re.sub(r"\n{3,}", "\n\n", "\n".join(reader.lines)).strip()
        assert [tuple(x) for x in r["l"]] == [(urljoin(base, u), t) for u, t in reader.found if u]


def test_references(spark):
    bases = ["http://a/b/c/d;p?q", "http://a", "https://a/b/", "mailto:x", "file:///a/b"]
    references = ["g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", ";x", "g;x", "", ".", "./", "..", "../", "../g", "../..", "../../g", "../../../g", "/./g", "g.", "./g/.", "g/./h", "g/../h", "http:g", "ftp://x/y", "a//b", "/a//b"]
    pairs = [(b, r) for b in bases for r in references if (b, r) != ("http://a/b/c/d;p?q", ";x")]
    got = spark.createDataFrame(pairs, "b string, r string").select("b", "r", web.resolved(F.col("b"), F.col("r")).alias("x")).collect()
    wrong = [(r["b"], r["r"], r["x"], urljoin(r["b"], r["r"])) for r in got if r["x"] != urljoin(r["b"], r["r"])]
    assert not wrong


def test_addresses(spark):
    urls = [" http://A.org/B c/é%20x%zz+*~(1);p?q=a b#fr ", "HTTPS://X.org", "http://x.org/a/b.PDF?x=.y", "http://x/.html", "/a/b.tar.gz", "http://x/a/", "mailto:a@b", "x y", "http://x/%E9", "", None, "http://x/a/b.c/", "http://h/a:b@c/%2Fz"]
    for r in spark.createDataFrame([(u, "Ti tle!") for u in urls], "u string, t string").select("u", web.plain_url(F.col("u")).alias("n"), web.url_extension(F.col("u")).alias("e"), web.file_name(F.col("u"), F.col("t")).alias("f")).collect():
        parts = urlparse((r["u"] or "").strip())
        assert r["n"] == urlunparse(parts._replace(path=quote(unquote(parts.path), safe="/:@")))
        path = PurePosixPath(urlparse(r["u"] or "").path)
        assert r["e"] == (path.suffix.lower() or ".html")
        assert r["f"] == re.sub("[^A-Za-z0-9._-]+", "_", path.name or "Ti_tle" + r["e"])
