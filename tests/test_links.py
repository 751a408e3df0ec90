"""Archive link discovery (H13, H14)."""

import contextlib
import io
import random
import time
from html.parser import HTMLParser
from urllib.parse import urljoin

from cliqueflow.functions.columns import resolve_href
from cliqueflow.operators import links
from cliqueflow.sources import files
from conftest import rows


def pages(spark, url, hrefs):
    html = "<html><body>" + "".join(f'<p><a class="x" href="{h}">{h}</a></p>' for h in hrefs) + "</body></html>"
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def test_h13_archive_kinds_and_resolution(spark):
    p = pages(spark, "http://h/", ["./x.zst", "y.tar", "z.html", "x.ZST", "./x.zst"])
    assert rows(links.page_links(p, kinds=links.ARCHIVE_KINDS)) == [("http://h//x.zst",), ("http://h/y.tar",)]


def test_general_resolution(spark):
    p = pages(spark, "https://a.example.com/dir/page.html?q=1", ["/root", "rel", "http://o.example.org/x"])
    assert rows(links.page_links(p)) == [
        ("http://o.example.org/x",), ("https://a.example.com/dir/rel",), ("https://a.example.com/root",)]


def test_h14_pending_archives(spark):
    found = spark.createDataFrame([("a/f1.zst",), ("a/f2.zst",)], "link string")
    stored = links.stored_listing(spark.createDataFrame([("input/f1",)], "path string"))
    assert rows(links.pending_archives(found, stored), "link") == [("a/f2.zst",)]


def test_listing_of_stored_objects_reads_no_content(spark, tmp_path):
    for name in ("in/f1", "in/deep/f2.x", "in/f 3"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    listed = files.list_objects(spark, str(tmp_path / "in"))
    assert rows(links.stored_listing(listed)) == [("f 3",), ("f1",), ("f2.x",)]
    found = spark.createDataFrame([(f"http://h/{n}",) for n in ("f1.zst", "f2.x.tar", "f4.zst", "f 3.tar")], "link string")
    pending = links.pending_archives(found, links.stored_listing(listed))
    assert rows(pending, "link") == [("http://h/f4.zst",)]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        pending.explain()
    assert "content" not in buf.getvalue()


def test_anchors_as_a_parser_sees_them(spark):
    html = """<A HREF='./a.zst'>x</A> <a class="y>" id=3 href=./b.zst>x</a> <abbr data-href="./c.zst">x</abbr>
    <!-- <a href="./d.zst">x</a> --> <script>"<a href='s'>"</script> <a data-href="n" href="./e.zst">x</a>
    <a title="href=f" name='g'>x</a> <a href="x?a=1&amp;b=.tar">x</a> <area href="h">"""
    p = spark.createDataFrame([(1, "http://h/", html)], "page_id long, url string, html string")
    got = [r["href"] for r in links.page_hrefs(p).collect()]
    assert got == ["./a.zst", "./b.zst", "./e.zst", "x?a=1&b=.tar"]


def test_resolution_of_every_kind_of_reference(spark):
    cases = [
        ("https://h.example", "rel"), ("https://h.example/a/b", "//cdn.x/y"), ("https://h.example/a/b?k=v#z", "#f"),
        ("https://h.example/a/b", "../c"), ("https://h.example/a/b?k=v", "?q=1"), ("https://h.example/a/b", "./d/./e/../f?x=/../y"),
        ("https://h.example/a/b", "/g/../../h"), ("https://h.example/a/b/c", ".."), ("https://h.example/a/b#z", ""),
        ("https://h.example/a/b", "mailto:x@y.example"), ("https://h.example?q=a/b", "c"),
    ]
    df = spark.createDataFrame(cases, "url string, href string")
    got = [r["link"] for r in df.select(resolve_href("url", "href").alias("link")).collect()]
    assert got == [urljoin(url.split("#")[0] if not href else url, href) for url, href in cases]


def found(spark, *pages):
    df = spark.createDataFrame([(i, "http://h.x/p", h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    out = [[] for _ in pages]
    for r in links.page_hrefs(df).collect():
        out[r.page_id].append(r.href)
    return out


def test_hostile_pages_take_linear_time(spark):
    found(spark, "<a href=x>")  # plan and compile first
    pages = [
        "<a " + 'b="c" ' * 100_000 + "href=x>", "<a x " * 100_000, '<a x="' * 100_001 + "y", "<!--" * 100_000, "<script>" * 100_000,
        "<a " + "x=" * 100_000, "<a" + " " * 200_000 + "b" + " " * 200_000 + "href=q>", "</" * 100_000, "<a href='" + "y" * 500_000 + "'>",
    ]
    for page in pages:
        began = time.perf_counter()
        found(spark, page)
        assert time.perf_counter() - began < 1.5, page[:20]
    assert found(spark, pages[0], pages[6], pages[1]) == [["x"], ["q"], []]


class Anchors(HTMLParser):
    def __init__(self, page):
        super().__init__()
        self.hrefs = []
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        first = dict(reversed(attrs))
        if tag == "a" and first.get("href"):
            self.hrefs.append(first["href"])


def test_anchors_equal_a_parser(spark):
    rng = random.Random(4)
    parts = ["<a ", "<a\n", "<A ", "<b ", "href=", "HREF = ", "x", "'q w'", '"r>s"', '"t"href=', ">", "/>", " ", "data-href='n'", "title", "text", "</a>", "<abbr href=z>", "&amp;"]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) + " end>" for _ in range(400)]
    pages += ["<!-- <a href=c> --><a href=d>", "<script>'<a href=s>'</script><a href=t>", "<style><a href=u></style>", "<img alt='<a href=v>'><a href=w>", "<a href=1 href=2>", "<p <a href=k>"]
    for page, got in zip(pages, found(spark, *pages)):
        assert got == Anchors(page).hrefs, page
