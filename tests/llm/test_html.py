"""HTML extraction: regions, malformed markup, tree matching, templates."""

import html
import random
import re
import time

import pytest

from tidepool.llm import html_extract as H

SF = "/root/testdata/sf0.001"


def text_of(page, ref=None):
    return " ".join(b[4] for b in H.blocks_of(page, H.reference(ref or page or "")) if b[0] == "content")


@pytest.mark.parametrize("page, want", [
    ("<article><h1>T &amp; x</h1><p>a  b\n<b>c</b>d<br>e<p>f</article>", "T & x a b cd e f"),
    ("<nav>menu</nav><article><p>a<aside>side</aside></p><p>b</p><div class='comments'><p>no</p></div></article><footer>x</footer>", "a b"),
    ("<main><p>1 < 2 &lt; 3</p><script>var a='<p>x</p>';</script><form><p>mail</p></form><p>c</main>", "1 < 2 < 3 c"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a b c d"),
    ("<article><p>cut off &am", "cut off &am"),
    ("<article><p>tag cut<a href='x", "tag cut"),
    ("<article><header><h2>in</h2></header><p class=ad>buy</p><p>t</p></article><header>out</header>", "in t"),
    ("", ""), (None, ""), ("<article></article>", ""),
])
def test_pages(page, want):
    assert text_of(page) == want


def test_tree_matching_names_nodes_alike():
    ref = H.reference("<body><nav><a>x</a></nav><div class=a><p>1<p>2</div><div class=b><p>3</div></body>")
    blocks = H.blocks_of("<body><div class=n>new</div><div class=a><p>9</div><div class=b><h3>z</h3><p>3</div></body>", ref)
    again = H.blocks_of("<body><nav></nav><div class=a><p>7<p>8</div><div class=b><p>4</div></body>", ref)
    assert {b[1] for b in again} <= {b[1] for b in blocks}


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, blocks int")


def test_wrapper_without_semantic_regions(spark):
    """Constant nodes are template, the most varying region is the content."""
    page = "<body><div class=top><p>The Site</p></div><div class=box><p>Welcome to the site</p><p>{}</p><p>{}</p></div><div class=low><p>imprint</p></div></body>"
    rows = [(i, f"http://h.example/{i}", page.format(f"story {i} has some length to it", f"and story {i} goes on and on for long"), "x", 0) for i in range(30)]
    got = {r.page_id: r.text for r in H.report(pages(spark, rows)).collect()}
    assert got[3] == "story 3 has some length to it and story 3 goes on and on for long"


def test_edges(spark):
    rows = [(1, None, None, "x", 0), (2, "odd url", "", "x", 0), (None, "http://h/1", "<article><p>n</article>", "x", 0),
            (4, "http://h/2", "<article><p>" + "long " * 50_000 + "</article>", "x", 0),
            (5, "http://h/3", "<div>" * 3000 + "deep", "x", 0), (6, "http://h/4", "no markup at all", "x", 0),
            (7, "http://h/5", "<article><p>copy</article>", "x", 0), (7, "http://h/5", "<article><p>copy</article>", "x", 0)]
    got = H.report(pages(spark, rows)).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 1), (1, 0), (2, 0), (4, 249_999), (5, 4), (6, 16), (7, 4), (7, 4)]
    assert H.report(pages(spark, rows).limit(0)).count() == 0


def test_copies_of_a_page_keep_their_text(spark):
    rows = [(i, f"http://h.example/{i}", "<article><p>the same story on every page</p></article>", "x", 0) for i in range(40)]
    assert {r.text for r in H.report(pages(spark, rows)).collect()} == {"the same story on every page"}


def test_given_pages(spark):
    given = spark.read.parquet(f"{SF}/pages.parquet")
    want = {}
    for r in given.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", p))).strip() for p in re.split(r"<(?:/?p|/?h1|br)>", body))
        want[r.page_id] = " ".join(p for p in parts if p)
    assert {r.page_id: r.text for r in H.report(given).collect()} == want


@pytest.mark.parametrize("depth", [100, 3000])
@pytest.mark.parametrize("tag", ["div", "blockquote", "span"])
def test_deep_elements_end_where_they_end(depth, tag):
    """No depth at which elements are read as something else: their end tags close them, boilerplate in them stays out."""
    page = (f"<body><div><article><p>a</p>{f'<{tag}>' * depth}in<nav>menu</nav><div class=comments>no</div>{f'</{tag}>' * depth}"
            "<p>b</p></article></div><p>out</p></body>")
    assert text_of(page) == text_of(page, "<article><p>x</article>") == "a in b"


def test_many_unclosed_tags_take_linear_time():
    page = "<article>" + "<b>" * 50_000 + "x<hr></i>" * 50_000 + "<p>y"
    assert text_of(page).endswith("x y")


def texts_of(spark, htmls, **params):
    rows = [(i, f"http://h.example/{i}", page, "x", 0) for i, page in enumerate(htmls)]
    return [r.text for r in sorted(H.report(pages(spark, rows), **params).collect(), key=lambda r: r.page_id)]


def test_all_slots_stay_where_no_region_is_semantic(spark):
    """Runs of siblings below body, and several top-level elements, are all content; one page with <main> decides for itself only."""
    flat = "<body><h1>T {0}</h1><p>a {0}</p><p>b {0}</p><h2>S {0}</h2><p>c {0}</p><div><p>d {0}</p></div><div class=x><p>e {0}</p></div><div class=low>imprint</div></body>"
    got = texts_of(spark, [flat.format(i) for i in range(30)] + ["<body><p>out 30</p><main><p>own 30</p></main></body>"])
    assert got == [f"T {i} a {i} b {i} S {i} c {i} d {i} e {i}" for i in range(30)] + ["own 30"]


@pytest.mark.parametrize("words", ["content has-sidebar", "no-sidebar", "with-comments", "share-enabled", "header-fixed"])
def test_a_class_word_drops_no_page(spark, words):
    """Neither what holds the article nor what holds most of the varying text is boilerplate; real boilerplate in it is."""
    deep = "<body><div class='" + words + "'><article><h1>T {0}</h1><p>a {0}</p><div class=comments><article class=comment>no {0}</article></div></article></div></body>"
    flat = "<body><div class='" + words + "'><h1>T {0}</h1><p>a long story {0}</p><div class=ad>no {0}</div></div><p>z {0}</p></body>"
    for page, want in ((deep, "T {0} a {0}"), (flat, "T {0} a long story {0} z {0}")):
        assert texts_of(spark, [page.format(i) for i in range(12)]) == [want.format(i) for i in range(12)]


def test_marked_elements(spark):
    """Headers in a region stay; readers' comments go, however long; marked inline elements leave no gap."""
    story = "<article><header class=entry-header><h1>T</h1></header><div class=article-header><p>by x</p></div><p>a<span class=share>no</span>b <i class=ad>no</i> c.</p></article>"
    got = texts_of(spark, [story + "<div id=comments><article class='comment even'>" + "long " * 99 + "</article></div>"])
    assert got == ["T by x ab c."]


@pytest.mark.parametrize("n", [2, 3, 9])
def test_small_hosts_have_template_nodes_too(spark, n):
    page = "<body><article><h1>T {0}</h1><p>story {0} is a little longer than that</p><p>All rights reserved</p></article></body>"
    assert texts_of(spark, [page.format(i) for i in range(n)]) == [f"T {i} story {i} is a little longer than that" for i in range(n)]
    assert texts_of(spark, [page.format(1)] * n) == ["T 1 story 1 is a little longer than that All rights reserved"] * n


@pytest.mark.parametrize("runs", [10, 100, 1500])
def test_long_sibling_lists_are_aligned_like_short_ones(runs):
    page = lambda k, end="": "<body>" + "<h2>s</h2><p>t</p>" * k + f"<div class=x><p>notice</div>{end}</body>"
    ref = H.reference(page(runs))
    names = lambda text: [b[1] for b in H.blocks_of(text, ref) if b[4] == "notice"]
    assert names(page(runs)) == names(page(runs // 3)) == names(page(2 * runs, "<h3>new</h3>"))


def best(a, b):
    """Simple tree matching in its plain form."""
    if a.label != b.label:
        return 0
    rows = [[0] * (len(b.children) + 1)]
    for x in a.children:
        rows.append([0])
        for j, y in enumerate(b.children):
            rows[-1].append(max(rows[-1][-1], rows[-2][j + 1], rows[-2][j] + best(x, y)))
    return 1 + rows[-1][-1]


def test_matching_is_simple_tree_matching():
    rng = random.Random(5)
    grow = lambda d: "".join(f"<{t}>{grow(d - 1)}</{t}>" for t in rng.choices(["div", "ul", "section"], k=rng.randint(0, 4))) if d else ""
    for _ in range(150):
        a, b = H.reference(grow(4)), H.reference(grow(4))
        assert H.match(a, b, {}) == best(a, b)
        H.align(a, b, {})
        todo, kept, named = [b], 0, {a.name: a}
        for x in (up := [a]):
            up += x.children
            named[x.name] = x
        for x in todo:
            todo += x.children
            kept += x.name in named and named[x.name].label == x.label
        assert kept == best(a, b)


def test_batches_of_500_pages(spark):
    rows = [(i, "http://h.example/", f"<article><p>story {i}", "x", 0) for i in range(500)]
    assert H.report(pages(spark, rows).coalesce(1)).count() == 500


def test_all_sibling_runs_stay_without_any_semantic_region(spark):
    flat = "<body><h1>T {0}</h1><p>a {0}</p><h2>S {0}</h2><p>c {0}</p><div><p>d {0}</p></div></body>"
    assert texts_of(spark, [flat.format(i) for i in range(12)]) == [f"T {i} a {i} S {i} c {i} d {i}" for i in range(12)]


def said(page):
    _, blocks, marks = H.parse(page)
    mine = H.picked([b.node.region for b in blocks], [len(b.text) for b in blocks], [False] * len(blocks),
                               [(m.first, m.last, m.comments) for m in marks])
    return [blocks[i].text for i in mine]


@pytest.mark.parametrize("page, text", [
    ("<body><form id=aspnetForm><label>Name</label><div>menu</div><article><p>Its <b>text</b></p></article></form></body>", ["Its text"]),
    ("<body><form><label>Name</label><button>Go</button><p>All the text of the page is in a form.</p></form><aside>beside</aside></body>",
     ["All the text of the page is in a form."]),
    ("<div hidden><main><p>shown by a script</p></main></div><div hidden>never</div>", ["shown by a script"]),
    ("<div aria-hidden=true><p>most of the page's text, shown later</p></div><p>little</p>", ["most of the page's text, shown later", "little"]),
    ("<p>Text of the page</p><form>find <label>x</label></form><dialog>a cookie</dialog><div hidden>no</div><div role=alert>no</div>"
     "<aside>beside the text, and far longer than the text is, but beside it</aside>", ["Text of the page"]),
    ("<aside><article><p>inside an aside</p></article></aside>", ["inside an aside"]),
    ("<p title=it's>a &lt; b < c</p><p a='x>y'>q</p><p b=\"open>r</p>", ["a < b < c", "q", "r"]),
    ("<p>one</p><p x=\">\" y='<i>'>two</p><a href=\"x", ["one", "two"]),
])
def test_wrapped_pages_and_odd_tags(page, text):
    assert said(page) == text


@pytest.mark.parametrize("unit", ["<a ", "<a '", "<a b='", "<a b=\"", "<a b=\">\"", "<!", "<?", "</", "<!--", "<", "&", "</script ", "<a\""])
@pytest.mark.parametrize("tail", ["", ">"])
def test_odd_pages_take_linear_time(unit, tail):
    began = time.process_time()
    H.parse(unit * (1_000_000 // len(unit)) + tail)
    assert time.process_time() - began < 5
