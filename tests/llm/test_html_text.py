from __future__ import annotations

import pytest

from uidloom.llm.html_text import Page, extract, host_of

SCHEMA = "page_id bigint, url string, html string, key string, blocks string, host string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(2)


def text(html):
    return "\n".join(t for t, _ in Page(html).kept())


@pytest.mark.parametrize(
    "html, expected",
    [
        ("", ""),
        ("plain  text", "plain text"),
        ("<article><h1>A &amp; B</h1><p> x\n y<br>z <b>w</b></article><p>out", "A & B\nx y z w"),
        ("<body><nav><a>menu</a></nav><p>one<p>two &lt;b&gt;</body>", "one\ntwo <b>"),
        ("<main><header>top</header><p>in</p></main><footer>f</footer>", "top\nin"),
        ("<header>top</header><p>in</p><aside>s</aside><form><p>q</form>", "in"),
        ("<p>a</p><script>if (a < b) '</p>'</script><style>p{}</style><p>b", "a\nb"),
        ("<p>a<!-- no > here --><p>b<!-- never ends <p>c", "a\nb"),
        ("<p>a<p class='x' title='1 > 2'>b</p>5 < 6 <q", "a\nb\n5 < 6"),
        ('<article><p>a</p><div class="comments"><article>c</article></div><div class="ad">d</div>e</article>', "a\ne"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\nb\nc\nd"),
        ("<article><p>x&nbsp;&nbsp;y &am", "x y &am"),
        ("<div id=cookie-notice>c</div><div role=navigation>n</div><div>t</div>", "t"),
        ("<title>t</title><p>&#233;&eacute;&notanentity;", "éé¬anentity;"),
        ("<script>never ends <p>x", ""),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ],
)
def test_blocks(html, expected):
    assert text(html) == expected


def test_templates_of_a_host_are_deleted(spark):
    rows = []
    for k in range(10):
        body = f"<div><span>Site name</span> since 1999</div><p>text {k}</p><p>again</p><div>Imprint <i>here</i></div>"
        rows.append((k, f"http://a.example/{k}", body))
        rows.append((100 + k, f"http://b{k}.example/", body))
        rows.append((200 + k, None if k % 2 else "http://[bad", body))
        rows.append((300 + k, f"http://a.example/x{k}", f"<div><span>Site name</span> since 1999</div><article><p>again</p>{k}</article>"))
    found = {r["page_id"]: r["text"] for r in extract(pages(spark, rows)).collect()}
    whole = "Site name since 1999\ntext {}\nagain\nImprint here"
    for k in range(10):
        assert found[k] == f"text {k}"  # the paragraph recurs as well
        assert found[100 + k] == found[200 + k] == whole.format(k)
        assert found[300 + k] == f"again\n{k}"  # marked content stays


def test_odd_rows(spark):
    rows = [(1, "http://a.example", None), (2, None, ""), (None, None, "<p>x</p>"), (3, "u", "<p>y</p>"), (3, "u", "<p>y</p>"),
            (4, "http://a.example", "<div>" * 3000 + "deep" + "</div>" * 3000), (5, "http://a.example", "<p>w</p>" * 20000)]
    found = extract(pages(spark, rows)).collect()
    got = sorted(((r["page_id"] or 0, r["url"] or "", r["text"], r["n_chars"]) for r in found))
    long = "\n".join(["w"] * 20000)
    assert got == [(0, "", "x", 1), (1, "http://a.example", "", 0), (2, "", "", 0), (3, "u", "y", 1), (3, "u", "y", 1),
                   (4, "http://a.example", "deep", 4), (5, "http://a.example", long, len(long))]
    assert extract(pages(spark, rows).where("page_id = 99")).collect() == []


def test_hosts():
    assert host_of("https://WWW.Example.com:80/x") == "www.example.com"
    assert host_of(None) is host_of("") is host_of("no host") is host_of("http://[bad") is None


@pytest.mark.parametrize(
    "html, expected",
    [
        ('<html class="no-banner"><body class="has-sidebar"><p>story</p><div class="sidebar">s</div>', "story"),
        ('<body class="right-sidebar ad"><p>story</p></body>', "story"),
        ('<article class="post category-social"><p>story</p></article>', "story"),
        ('<main id="menu-main" class="widget"><p>story</p></main>', "story"),
        ('<div class="content with-sidebar"><p>story</p><div class="sidebar">s</div></div>', "story"),
        ('<div class="content-sidebar"><p>a long story</p></div><div class="right-sidebar">s</div>', "a long story"),
        ('<div class="left-sidebar"><main><p>story</p></main></div><p>text outside of it', "story"),
        ('<article><p>story</p></article><div class="related-posts"><article>next</article></div>', "story"),
        ('<div data-id="ad" data-role=banner data-class="menu" title="x class=ad">story</div>', "story"),
        ('<p>story</p><div class="top"id="ad">ad</div><p CLASS=promo>b</p>', "story"),
    ],
)
def test_names_do_not_drop_the_content(html, expected):
    assert text(html) == expected


MAIN = '<main><h1>Title</h1><p>a long story of the page</p><article class="card">Read next</article></main>'


@pytest.mark.parametrize(
    "html, expected",
    [
        (MAIN, "Title\na long story of the page\nRead next"),
        (f"<p>out</p>{MAIN}<p>out</p>", "Title\na long story of the page\nRead next"),
        ("<main><p>note</p><h1>Title</h1><article>a long story</article></main>", "Title\na long story"),
        ("<main><p>story</p></main><article>card</article><p>out", "story\ncard"),
        ("<div>a long story</div><article>card 1</article><article>card 2</article>", "a long story\ncard 1\ncard 2"),
        ("<p>short</p><article>a long story</article>", "a long story"),
        ('<div class="left-sidebar"><article>story</article></div><p>text outside of it', "story"),
        ("<main><p>intro</p><article>story</article><article>other</article></main>", "intro\nstory\nother"),
    ],
)
def test_text_beside_articles(html, expected):
    assert text(html) == expected


def test_templates_go_before_the_article_is_chosen(spark):
    row = "<div>Site name, known in town since 1999</div><article>story {}</article>"
    rows = [(k, "http://a.example/", row.format(k)) for k in range(6)] + [(9, "http://b.example/", row.format(9)), (10, None, MAIN)]
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in extract(pages(spark, rows)).collect()}
    assert found[3] == ("story 3", 7)
    assert found[9] == ("story 9", 7)  # its only article
    assert found[10] == ("Title\na long story of the page\nRead next", 40)


def test_counts_decide_inside_the_content_too(spark):
    offer = '<section><p>Offer of the week</p></section>'
    row = "<article><p>a rather long story, number {}</p><p>again</p>{}<div id=post-{}>Read {} too</div></article>"
    rows = [(k, "http://a.example/", row.format(k, offer, k, "ABC"[k % 3])) for k in range(30)]
    rows += [(50 + k, "http://b.example/", row.format(k, offer, k, k)) for k in range(4)]
    rows += [(60 + k, "http://c.example/", f"<article><div id=x>the same {'long ' * 9}story</div></article>") for k in range(30)]
    found = {r["page_id"]: r["text"] for r in extract(pages(spark, rows)).collect()}
    for k in range(30):
        assert found[k] == f"a rather long story, number {k}\nagain"
        assert found[60 + k] == f"the same {'long ' * 9}story"  # copies of a page keep their text
    for k in range(4):  # too few pages to know
        assert found[50 + k] == f"a rather long story, number {k}\nagain\nOffer of the week\nRead {k} too"


def test_shapes_and_many_pages(spark):
    rows = []
    for k in range(300):
        turn = f"<div class=turn-{k}><b>Menu</b> {k % 50}</div>"  # each text is on 6 of 300 pages
        story = f"<div class=text><p>the whole story of this page has number {k}</p></div>"
        few = "<div class=note>In the north</div>" if k < 55 else "<p>In the north</p>" if k > 240 else ""
        rows.append((k, "http://a.example/", turn + story + few))
    found = {r["page_id"]: r["text"] for r in extract(pages(spark, rows)).collect()}
    for k in range(300):
        rest = "\nIn the north" if k > 240 else ""  # a plain paragraph needs the share, 60 pages
        assert found[k] == f"the whole story of this page has number {k}" + rest


@pytest.mark.parametrize("page, text", [
    ('<article><p>Short story</p><div class="comment-list"><p>%s</p></div></article>' % ("long " * 200), "Short story"),
    ('<body><div class="cookie-banner"><p>%s</p></div><article><p>Short story</p></article></body>' % ("long " * 200), "Short story"),
    ('<body><div><p>%s</p></div><article><p>Short story</p></article></body>' % ("long " * 200), "Short story"),
    ('<div class="user-comments"><p>%s</p></div><p>Story</p>' % ("long " * 99), "Story"),
    ('<article><h1>Title</h1><div class="content-sidebar-wrap"><p>Story</p></div></article>', "Title\nStory"),
    ('<article><h1>Title</h1><div class="reader-comments"><p>Nice</p></div></article>', "Title"),
    ('<article><p>Story</p><div class="newsletter-box"><p>%s</p></div></article>' % ("join " * 99), "Story"),
    ('<div class="layout-sidebar"><article><p>Story</p></article><p>beside</p></div>', "Story"),
])
def test_names_decide_by_place_and_not_by_length(page, text):
    assert "\n".join(t for t, _ in Page(page).kept()) == text


def test_a_long_template_goes_and_the_content_of_copies_stays(spark):
    notice = "<div class='box'><p>%s</p></div>" % ("fixed words of every page " * 20)
    rows = [(k, f"http://a.org/{k}", f"<article><p>Story {k}</p>{notice}</article>") for k in range(60)]
    copy = "<article><h1>Same</h1><section>One</section><section class='x'>Two</section></article>"
    rows += [(100 + k, f"http://b.org/{k}", copy) for k in range(60)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r["page_id"]: r["text"] for r in extract(df).collect()}
    assert all(found[k] == f"Story {k}" for k in range(60))
    assert all(found[100 + k] == "Same\nOne\nTwo" for k in range(60))
