import pytest

from tallyhawk.llm.pages import Page, extract_pages, host_of, match_trees, merge_trees, tree_of


def texts(spark, pages):
    rows = [(i, url, html) for i, (url, html) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r for r in extract_pages(df).collect()}
    assert all(r["n_chars"] == len(r["text"]) and r["url"] == pages[i][0] for i, r in got.items())
    return [got[i]["text"] for i in range(len(rows))]


SITE = (
    '<!DOCTYPE html><html><head><title>no</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body>'
    "<header>no <h1>no</h1></header><nav><ul><li><a href=/>no</a><li><a href=/b>no</a></ul></nav>"
    '<div class="cookie-notice">no</div><!-- <p>no</p> --><article><header><h1>Title &amp; {n}</h1></header>'
    '<p>First <b>bold</b>\n  words&nbsp;{n}.<br>after</p><div class="ad-box">no</div><ul><li>one<li>two</ul>'
    '<table><tr><td>c1<td>c2</table><p>Always the same.</article><section class="comments"><p>no, reader</section>'
    '<aside>no</aside><form><p>no<input></form><footer><p>no &copy; {n}</footer>'
)


def test_articles_without_the_rest(spark):
    want = [f"Title & {n}\nFirst bold words {n}. after\none\ntwo\nc1\nc2\nAlways the same." for n in range(6)]
    pages = [(f"https://User@Site.Example:80/{n}?q", SITE.format(n=n)) for n in range(6)]
    assert texts(spark, pages) == want


def test_constant_nodes_are_template_where_no_element_says_article(spark):
    def page(n, extra=""):
        return (
            '<html><body><div id="top"><p>Welcome to our site</p></div><div id="w"><div class="body">'
            f"<p>Story number {n} starts here and it is long enough.</p>{extra}<p>It goes on for {n} more lines of text.</p></div>"
            '<div class="box"><p>Same box on every page</p></div></div><div id="low"><a href=x>link one</a></div></body></html>'
        )

    pages = [(f"http://plain.example/{n}", page(n, "<h2>Half way</h2>" if n % 2 else "")) for n in range(8)]
    got = texts(spark, pages)
    for n, text in enumerate(got):
        lines = text.split("\n")
        assert f"Story number {n} starts here and it is long enough." in lines
        assert f"It goes on for {n} more lines of text." in lines
        assert "Welcome to our site" not in lines and "Same box on every page" not in lines and "link one" not in lines


def test_shared_blocks_inside_articles_are_template(spark):
    def page(n, extra=""):
        own = "".join(f"<p>Paragraph {k} of story {n}.</p>" for k in range(1 + n % 3))
        return (
            f"<article><h1>Story {n}</h1><p>This story is part of our spring offer.</p>{own}{extra}<div>Buy one, get two</div>"
            f"<div><p>Told by reader {n}</p></div></article>"
        )

    pages = [(f"http://shared.example/{n}", page(n, "<p>Two pages say this.</p>" if n < 2 else "")) for n in range(12)]
    # Copies of one page, and few pages, do not tell what is template.
    pages += [("http://copies.example/", page(1))] * 12 + [(f"http://few.example/{n}", page(n)) for n in range(5)]
    got = texts(spark, pages)
    for n, text in enumerate(got[:12]):
        own = [f"Paragraph {k} of story {n}." for k in range(1 + n % 3)] + ["Two pages say this."] * (n < 2)
        assert text.split("\n") == [f"Story {n}", *own, f"Told by reader {n}"]
    assert all("spring offer" in text and "Buy one" in text for text in got[12:])


def test_ids_compound_classes_and_formulas_stay_in_the_article(spark):
    page = (
        '<article><h2 id="search">Search trees</h2><section class="related-work"><p>Others did this.</p></section>'
        '<p id="notice">We notice it.</p><p>So <math><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation>no</annotation></math>'
        ' holds.</p><div class="related-posts">no</div><div id="comments">no</div><ul class="share_buttons-2"><li>no</ul>'
        '<div class="side-bar">no</div><p class="advert">no</article><div class="related-work">no</div>'
    )
    assert texts(spark, [("http://i.example/1", page)]) == ["Search trees\nOthers did this.\nWe notice it.\nSo x=1 holds."]


def test_noise_and_articles_are_found_at_any_depth(spark):
    deep = "<div>" * 70
    pages = [
        ("http://n.example/1", deep + '<p>Text</p><nav>no</nav><div class="ad">no <div>no</div></div><p>end'),
        ("http://n.example/2", "<p>no</p>" + deep + "<article><p>Text</p><aside><div>no</div></aside><p>end</p></article><p>no"),
    ]
    assert texts(spark, pages) == ["Text\nend"] * 2


def test_nulls_odd_markup_repeats_and_empty_tables(spark):
    pages = [
        (None, None), ("x", ""), ("http://a.example", "plain text only"), ("http://a.example", "<p>unclosed <b>tags <i>here"),
        ("http://b.example", "<article><p>a &lt; b &#233; &bogus; &#x1F600;</p><script>if (a<b) x('</p>')"),
        ("http://b.example", "<article><p>a < b and 3<4</p></ARTICLE><FOOTER>no"),
        ("http://c.example", '<main><p title="a > b">quoted</p><!-- open comment <p>no'),
        ("http://d.example", "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000), ("http://e.example", "<article><p>" + "w " * 60_000),
        ("http://a.example", "plain text only"),
    ]
    got = texts(spark, pages)
    assert got[:2] == ["", ""] and got[2] == got[9] == "plain text only" and got[3] == "unclosed tags here"
    assert got[4] == "a < b é &bogus; 😀" and got[5] == "a < b and 3<4" and got[6] == "quoted"
    assert got[7] == "deep" and len(got[8]) == 119_999
    df = spark.createDataFrame([], "page_id long, url string, html string, host string")
    assert extract_pages(df).collect() == []
    clash = spark.createDataFrame([(1, "http://a.b/", "<p>t</p>", "h", "s")], "page_id long, url string, html string, host string, shape string")
    assert extract_pages(clash).collect()[0]["text"] == "t"


@pytest.mark.parametrize(("url", "host"), [
    ("https://A.B.example:8080/x?y#z", "a.b.example"), ("//c.example", "c.example"), ("mailto:x", ""), (None, ""),
    ("http://user:pw@d.example/", "d.example"), ("http://", ""),
])
def test_hosts(url, host):
    assert host_of(url) == host


def test_trees_are_matched_in_order():
    def tree(html):
        page = Page(html)
        return tree_of(page.nodes, [(1, s["chars"], s["links"], s["h"], s["h"]) for s in page.stats()])

    a, b = tree("<div><h1>x</h1><p>y</p><ul><li>z</ul></div>"), tree("<div><h1>x</h1><h2>n</h2><p>q</p></div><div id=k>e</div>")
    size, pairs = match_trees(a, b)
    assert size == len(pairs) == 4  # root, div, h1, p
    merged = merge_trees(a, b)
    assert [c[0] for c in merged[7]] == ["div", "div.k"] and [c[0] for c in merged[7][0][7]] == ["h1", "p", "ul", "h2"]
    heading, paragraph = merged[7][0][7][:2]
    assert heading[2] == 2 and heading[5] == heading[6] and paragraph[5] != paragraph[6]
