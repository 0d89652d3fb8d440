"""Main text of pages, and archives."""

import gzip
import re
from html import unescape

import pytest
from pyspark.sql import functions as F

from panelkit.llm import style_tree, warc
from panelkit.llm.common import table
from panelkit.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(html):
    article = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)\b[^>]*>", article)]
    return "\n".join(b for b in blocks if b)


def test_articles_of_all_pages(llm):
    pages = {r.page_id: r for r in table(llm, SF, "pages").collect()}
    got = QUERIES["op4_html_extraction"](llm, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, plain(pages[r.page_id].html), len(r.text))


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("text  only", "text only"),
        ("<p>a<p>b<br>c", "a\nb c"),
        ("<div class=ad>x</div><div>y &amp; z &eacute;&#233;</div>", "y & z éé"),
        ("<article><header><h1>T</h1></header><p>a <b>b</b></p><aside>no</aside><div id='comments'>q</div></article><p>out", "T\na b"),
        ("<header>menu</header><main><p>m</p><form><input>f</form></main><footer>f</footer>", "m"),
        ("<script>if(a<b){}</script>ok<style>p{}</style><!-- c > d --> <a href='x>y'>l</a>", "ok l"),
        ("<ul><li>x<li>y</ul><table><tr><td>a<td>b</table>", "x\ny\na\nb"),
        ("<title>t</title><p>x<b", "x"),
        ("<p>x<a href=\"open>y</p>z", "xy\nz"),
        ("<!-- open", ""),
        ("<article>a</article><div role=navigation>n</div><article>b</article>", "a\nb"),
        ("<p>1 < 2 & 3", "1 < 2 & 3"),
    ],
)
def test_one_page(llm, html, text):
    pages = llm.createDataFrame([(1, None, html, "x")], "page_id long, url string, html string, main_text string")
    assert style_tree.extract(pages, ["page_id"]).first().main_text == text


@pytest.mark.parametrize("limit", [style_tree.BROADCAST_BYTES, -1])
def test_branches_that_all_pages_share_are_removed(llm, monkeypatch, limit):
    monkeypatch.setattr(style_tree, "BROADCAST_BYTES", limit)
    note = '<div class="box7"><p>Read more of our <a href="/">pages</a> here.</p></div>'
    page = "<body><div class='text'><p>{0} own words {0}</p></div>" + note + "</body>"
    rows = [(i, "http://h.example/%d" % i, page.format(f"text{i}")) for i in range(8)]
    rows += [(8, "http://other.example/", page.format("alone")), (9, "http://h.example/0", page.format("text0"))]
    pages = llm.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.main_text for r in style_tree.extract(pages, ["page_id"]).collect()}
    assert all(got[i] == f"text{i} own words text{i}" for i in range(8)) and got[9] == got[0]
    assert got[8] == "alone own words alone\nRead more of our pages here."  # one page tells nothing
    tree = {r.path: r for r in style_tree.importance(pages.where("page_id != 8")).collect()}
    assert tree[">div.text"].pages == tree[">div.box0"].pages == 8  # a page that repeats counts once
    assert tree[">div.text"].content == pytest.approx(1) and tree[">div.box0"].content == pytest.approx(0, abs=1e-9)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article class='has-sidebar'><p>a</p></article>", "a"),
        ("<article class='menu'><p>a</p></article>", "a"),
        ("<div class='site no-banner'><article><p>a</p></article></div>", "a"),
        ("<div class='sidebar'><div><main>m</main></div></div>", "m"),
        ("<div class='layout has-sidebar'><p>a</p></div>", "a"),
        ("<article><h2 id='social-media-in-schools'>S</h2><section id='related-work'>r</section><section id='notice'>n</section></article>", "S\nr\nn"),
        ("<article><h2 class='notice'>S</h2><header class='banner'><h1>T</h1></header><div class='sidebar'>no</div></article>", "S\nT"),
        ("<article><p>x <math><mi>y</mi><mo>=</mo><mn>2</mn><annotation>y=2</annotation></math></p></article>", "x y=2"),
    ],
)
def test_names_do_not_remove_articles_headings_and_sections(html, text):
    assert style_tree._main_text(html, frozenset()) == text


@pytest.mark.parametrize(
    "aside",
    [
        "<div class='cookie-banner'>x</div>", "<div class='comment-list'>x</div>", "<div id='comments-area'>x</div>", "<div class='left-sidebar'>x</div>",
        "<ol class='commentlist'><li>x</ol>", "<div class='ad-slot'>x</div>", "<div class='site-footer'>x</div>", "<div class='top-nav'>x</div>",
        "<div class='comment-thread'>x</div>", "<div class='newsletter-box'>x</div>", "<section id='comments'><p>x</section>", "<article class='comment'>x</article>",
        "<p hidden>x</p>", "<div style='color:red; display: none'>x</div>", "<article><p>x</p></article>", "<div itemprop='comment'><p>x</div>",
        "<div id='comments'><article><p>x</article><article>x x x x x x x x x x x x x x x x x x</article></div>",
        "<div itemscope itemtype='https://schema.org/Comment'>x</div>", "<div class='related-posts'>x</div>", "<div class='adslot'>x</div>",
    ],
)
def test_asides_and_reader_comments_go_by_their_names(aside):
    """In an article, in a page without one, and beside an article."""
    main = "<p>The words of the page itself.</p>"
    assert style_tree._main_text(f"<article>{main}{aside}</article>", frozenset()) == "The words of the page itself."
    assert style_tree._main_text(f"<body><article>{main}</article>{aside.replace('<article>', '<article class=comment>')}", frozenset()) == "The words of the page itself."
    if "<article" not in aside:
        assert style_tree._main_text(f"<body>{main}{aside}", frozenset()) == "The words of the page itself."


@pytest.mark.parametrize(
    "kept",
    [
        "<div class='no-banner'>x</div>", "<div class='menu-open'>x</div>", "<ul class='menu'><li>x</ul>", "<p class='notice'>x</p>", "<div class='with-nav'>x</div>",
        "<section id='related-work'>x</section>", "<p class='hidden-gem' title='not hidden'>x</p>", "<section id='comments-on-the-law'>x</section>",
        "<div class='checklist'>x</div>", "<div class='shareholder'>x</div>", "<div class='cookie-recipe'>x</div>", "<div data-x=' hidden '>x</div>",
    ],
)
def test_other_names_in_an_article_stay(kept):
    assert style_tree._main_text(f"<article><p>The words.</p>{kept}</article>", frozenset()) == "The words.\nx"


def test_what_holds_most_of_a_page_stays():
    long = "<p>" + "words of the page " * 9 + "</p>"
    text = ("words of the page " * 9).strip()
    assert style_tree._main_text(f"<p>T</p><div class='layout-sidebar'>{long}</div>", frozenset()) == "T\n" + text
    assert style_tree._main_text(f"<article><article>{long}</article><article>{long}</article></article>", frozenset()) == f"{text}\n{text}"
    assert style_tree._main_text(f"<div class='comments'><article>{long}</article></div>", frozenset()) == text


def test_pages_are_read_once_for_the_tree_and_once_for_the_result(llm):
    pages = table(llm, SF, "pages")
    plan = style_tree.extract(pages, ["page_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_names_lower_what_the_tree_counts(llm):
    """On a host with pages enough, one named like an aside stays if its texts and styles differ."""
    page = "<body><div class='promo'>{0}</div><div class='ad'><p>advert {1}</p></div><p>text {1}</p></body>"
    rows = [(i, f"http://h.example/{i}", page.format("<p>p<ul><li>l</ul>" * i + f"<table><tr><td>own {i}</table>" * (i % 3), i)) for i in range(1, 9)]
    rows = [(i, u, h.replace("<p>p", f"<{'dl dl div ol section table ul menu'.split()[i - 1]}>p", 1)) for i, u, h in rows]
    pages = llm.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.main_text for r in style_tree.extract(pages, ["page_id"]).collect()}
    assert all(f"text {i}" in got[i] and "advert" not in got[i] for i in got)
    assert any("p\nl" in got[i] for i in got)


def test_blocks_that_repeat_are_removed(llm):
    """A template paragraph in body, in an article; on few pages; not that of copies, of near copies, nor short ones."""
    note = "<p>Please read our other pages too.</p>"

    def host(name, pages, form):
        return [(f"http://{name}/{i}", form.format(i=i, note=note, own=f"These are the words of page number {i} alone and of no other page.")) for i in range(pages)]

    rows = host("body", 8, "<body><p>{own}</p>{note}<p>Short one</p>") + host("art", 8, "<article><p>{own}</p><div>{note}</div></article>")
    rows += host("four", 4, "<p>{own}</p>{note}") + host("two", 2, "<p>{own}</p>{note}")
    rows += host("copy", 6, "<article>{note}<p>always the same text</p></article><p>{i}") + host("near", 6, "<article>{note}<p>always the same text</p><p>{i}</p></article>")
    pages = llm.createDataFrame(rows, "url string, html string")
    got = {r.url: r.main_text for r in style_tree.extract(pages, ["url"]).collect()}
    left = {u: t.count("Please read our") for u, t in got.items()}
    assert all(n == (u.split("/")[2] in ("two", "copy", "near")) for u, n in left.items())
    assert all("of page number" in t for u, t in got.items() if u.split("/")[2] in ("body", "art", "four", "two"))
    assert all("Short one" in t for u, t in got.items() if "/body/" in u)


def test_elements_at_any_depth(llm):
    """What is no text below 60 elements, an article that begins there, signs with '>' in them, and a page of unclosed elements."""
    deep = "<div>" * 60
    pages = [
        (deep + "<p>a<nav>n</nav><footer>f</footer><form>g</form>b", "a\nb"),
        (deep + "<p>out</p><article><p>in</p></article>", "in"),
        ("<div class='[&>p]:mt-4 [&>a]:x [&>b]:y'>" * 15 + "<p>a<nav>n</nav>", "a"),
        ("<div><p>x" * 4000 + "<nav>n</nav>", "\n".join("x" * 4000)),
    ]
    rows = [(i, "http://h.example/", html) for i, (html, _) in enumerate(pages)]
    got = {r.page_id: r.main_text for r in style_tree.extract(llm.createDataFrame(rows, "page_id long, url string, html string"), ["page_id"]).collect()}
    assert [got[i] for i in range(len(pages))] == [text for _, text in pages]


def test_copies_of_an_article_stay(llm):
    rows = [(i, f"http://h.example/{i}", f"<title>{i}</title><article class='post'><p>The same article.</p></article><p>{i}") for i in range(9)]
    pages = llm.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.main_text for r in style_tree.extract(pages, ["page_id"]).collect()} == {"The same article."}


def test_no_pages(llm, tmp_path):
    pages = llm.createDataFrame([], "page_id long, url string, html string")
    assert style_tree.extract(pages, ["page_id"]).count() == 0
    warc.write(pages, str(tmp_path / "none"))
    assert warc.assemble(warc.read(llm, str(tmp_path / "none"))).count() == 0


def test_archives_give_back_odd_pages(llm, tmp_path):
    long = "é" * 300 + "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nno record"
    rows = [(1, "http://a/\r\nX: y", long), (0, "http://b/", long), (2, None, None), (3, "c", ""), (3, "c", ""), (None, "d", long), (4, "e", "short"), (5, "e", "short")]
    pages = llm.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string")
    warc.write(pages.repartition(2), str(tmp_path / "w"))
    captures = warc.assemble(warc.read(llm, str(tmp_path / "w"), with_payload=True)).collect()
    assert len(captures) == len(rows) and all(c.n_records == 3 for c in captures)
    ids = {c.capture_id: c for c in captures}
    seen = sorted((c.metadata.fields.get("page-id") or "", c.response.type, c.response.payload_bytes) for c in captures)
    size = len(long.encode())
    assert seen == sorted([("0", "response", size), ("1", "revisit", None), ("", "revisit", None), ("2", "response", 0), ("3", "response", 0), ("3", "response", 0), ("4", "response", 5), ("5", "response", 5)])
    for c in captures:
        if c.response.type == "revisit":
            first = ids[c.response.refers_to].response
            assert bytes(first.payload).decode() == long and c.response.declared_digest == "sha256:" + first.payload_digest
        assert c.response.uri is None or "\n" not in c.response.uri


def test_revisits_name_a_response_however_the_pages_are_dealt(llm, tmp_path):
    """The pages are shuffled anew each time they are read, and rows repeat."""
    rows = [(i % 40, f"http://h/{i % 7}", f"page {i % 5} " + "x" * 200) for i in range(200)] + [(i, None, "few") for i in (1, 1, 2)]
    pages = llm.createDataFrame(rows, "page_id long, url string, html string").repartition(5, F.rand())
    warc.write(pages, str(tmp_path / "w"))
    captures = warc.assemble(warc.read(llm, str(tmp_path / "w"), with_payload=True)).collect()
    assert len(captures) == len(rows) and all(c.n_records == 3 for c in captures)
    responses = {c.capture_id: c for c in captures if c.response.type == "response"}
    big = [c for c in responses.values() if c.response.payload_bytes >= 100]
    assert len(big) == 5 and len(responses) == 8 and {int(c.metadata.fields["page-id"]) for c in big} == {0, 1, 2, 3, 4}
    for c in captures:
        if c.response.type == "revisit":
            assert "sha256:" + responses[c.response.refers_to].response.payload_digest == c.response.declared_digest


def test_payloads_are_not_shuffled_by_digest(llm, tmp_path):
    seen = []
    write = warc.written
    pages = table(llm, SF, "pages")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(warc, "written", lambda df, name: seen.append(df) or write(df, name))
        warc.write(pages, str(tmp_path / "w"))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.split("== Initial Plan")[0].split("\n") if "Exchange" in x]
    assert lines and not any("payload" in x or "html" in x for x in lines)


def test_transactions_are_assembled_either_way(llm, tmp_path):
    def record(kind, own, to=None, block=b"", more=()):
        lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {own}", *([f"WARC-Concurrent-To: {to}"] if to else []), *more]
        return "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    data = b"".join(
        [
            record("warcinfo", "<i>", block=b"x"),
            record("request", "<q1>", block=b"GET"),
            record("response", "<r1>", "<q1>", b"HTTP/1.1 200 OK\r\n\r\nbody"),  # names its request
            record("metadata", "<m1>", "<q1>", b"a: b\r\n"),
            record("response", "<r2>", None, b"HTTP/1.1 200 OK\r\n\r\n"),
            record("request", "<q2>", "<r2>"),
            record("metadata", "<m2>", "<q2>"),  # names the request that names its response
            record("metadata", "<m3>", "<gone>"),
        ]
    )
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record("resource", "<r3>", block=b"plain")))
    got = {c.capture_id: c for c in warc.assemble(warc.read(llm, str(tmp_path))).collect()}
    assert (got["<r1>"].request.record_id, got["<r1>"].metadata.record_id, got["<r1>"].response.payload_bytes) == ("<q1>", "<m1>", 4)
    assert (got["<r2>"].request.record_id, got["<r2>"].metadata.record_id) == ("<q2>", "<m2>")
    assert got["<r3>"].response.payload_bytes == 5 and got["<gone>"].response is None


def test_repeated_pages_refer_to_the_smallest_id(llm):
    got = QUERIES["op10_warc"](llm, SF).collect()
    assert len(got) == table(llm, SF, "pages").count()
    by_id = {r.page_id: r for r in got}
    for r in got:
        if r.record_type == "revisit":
            first = by_id[r.refers_to]
            assert first.record_type == "response" and first.page_id < r.page_id and first.payload_digest == r.payload_digest
