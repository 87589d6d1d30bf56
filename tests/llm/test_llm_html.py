import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from statquarry.llm.html_text import Page, main_texts

CASES = [
    ("<article><h1>A  b</h1><p>x<b>y</b>z<p>q&amp;r<br>s</article>", "A b xyz q&r s"),
    ('<body><header>H</header><div id="content"><p>one</p><div class="ad-box">ad</div><ul><li>a<li>b</ul></div><footer>f', "one a b"),
    ('<article><p>a <script>var x="</p>"</script>b</p><aside>z</aside><form>q</form><section class="comments">'
     '<article class="comment">c</article></section>t</article>', "a b t"),
    ("", ""), ("just text & more <3", "just text & more <3"), ('<article><p>cut <a href="x', "cut"),
    ("<article>a<!-- b", "a"), ("<article>a<script>b", "a"), ("<main><p>m</p></main><div>out</div>", "m"),
    ('<article><header class="x"><h1>T</h1><p>by</p></header><p>b</p></article>', "T b"),
    ('<article><header class="entry-header"><h1>T</h1></header>t<ol class="commentlist"><li>c</ol></article>', "T t"),
    ("<article>&#233;&nbsp;&lt;b&gt;\n\t&copy;</article>", "é <b> ©"), ("<article><p hidden>no</p><p>yes</p></article>", "yes"),
    ('<div role="navigation">n</div><article>x</div>y</article>z', "x y"),
    ("<p>no article</p><nav>n</nav><p>but text</p>", "no article but text"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1 2 3"), ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
    ('<article title="a > b"><p>q</p></article>', "q"), ("<article><textarea>no</textarea>t<style>p{}</style></article>", "t"),
    ('<div class="cookie-notice">c</div><div class="sidebar">s</div><div>kept</div>', "kept"), ("<article>" + "<div>" * 2000 + "deep", "deep"),
]
KEPT = [
    ('<article><p>H<span class="subscript">2</span>O</p></article>', "H2O"),
    ('<article><div class="commentary"><p>c</p></div>d</article>', "c d"),
    ('<article><section id="discussion"><h2>Discussion</h2><p>d</p></section></article>', "Discussion d"),
    ('<article><h2 id="related-work">Related work</h2><p>r</p></article>', "Related work r"),
    ('<article><div class="entry-header"><h1>T</h1></div>t</article>', "T t"),
    ('<article><p class="ad">p</p><b class="promo">b</b><div id="comments">i</div></article>', "b i"),  # an advert goes
    ('<div class="post has-comments"><p>b</p></div><div class="social">s</div><article-x class="no-ads">k</article-x>', "b s k"),
    ('<article><h2 class="ad">About an ad</h2><span class="adage">a</span></article>', "About an ad a"),
    ('<article><div class="menu">soup</div><div class="alert alert-info">note</div></article>', "soup note"),
    ('<main><section id="discussion">d</section><div class="ad-hoc">a</div></main>', "d a"),
    ('<div class="content-sidebar has-sidebar"><p>b</p></div><div id="cookie-recipe">c</div>', "b c"),
]
GONE = [
    ('<article>a<div class="x left-sidebar">s</div><ul class="breadcrumbs"><li>b</ul><section class="post-ads ads">x</section></article>', "a"),
    ('<div id="sidebar">s</div><ul class="menu"><li>m</ul><div id="comments">c</div><p>kept</p>', "kept"),
]
GONE += [
    ('<article>a<div class="comment-body">c</div><ol class="reader-comments"><li>r</ol><div class="userComments">u</div></article>', "a"),
    ('<article>a<span class="ad">s</span><p class="advert">p</p><div class="social-links">x</div></article>', "a"),
    ('<div id="header"><p>site</p></div><div class="site-header">s</div><p>kept</p>', "kept"),
]
# attributes as HTML reads them
ATTRIBUTES = [
    ("<article><p title=it's>First block</p><p>Second block</p><p>That isn't lost</p></article>", "First block Second block That isn't lost"),
    ('<article><p title=a"b>one</p><p title="x > y">two</p><p title=\'"\'>three</p></article>', "one two three"),
    ('<article><p title="a""b">one</p><p title = "q" class= ad>gone</p><p a=b/>two</p></article>', "one two"),
    ('<article><p title="never closed>one</p><p>two</p></article>', "one two"),
    ("<article><p class=>one</p><p =x \"y>two</p><p class='ad'>gone</p></article>", "one two"), ("<article>a<p class=\"x", "a"),
    ("<article><a href=http://x/y?z='>l</a> m</article>", "l m"),
]
PAGES = "page_id long, url string, html string, text string, host string, key long, templates string"


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "t", "h", 1, "x") for i, u, h in rows], PAGES).repartition(3)


@pytest.mark.parametrize("source, text", CASES)
def test_main_text(source, text):
    assert Page(source).main_text() == text


@pytest.mark.parametrize("source, text", KEPT + GONE + ATTRIBUTES)
def test_only_whole_names_on_containers_mark_furniture(source, text):
    assert Page(source).main_text() == text


def test_templates_of_a_host_go(spark):
    box = "<div><span>Follow us</span><p>every day</p></div>"
    rows = [(k, f"http://a.org/{k}", f"<body>{box}<p>text {k}</p><p>The end.</p></body>") for k in range(20)]
    rows += [(100 + k, f"http://b.org/{k}", f"<body><p>b {k}</p>{box if k == 0 else ''}</body>") for k in range(20)]
    got = {r.page_id: r.text for r in main_texts(table(spark, rows)).collect()}
    assert got[3] == "text 3" and got[101] == "b 1" and got[100] == "b 0 Follow us every day"


def test_article_paragraphs_and_copies_are_no_templates(spark):
    line, share = "<p>The same line.</p>", "<div>Share this text</div>"
    rows = [(k, "http://a.org/", f"<article><p>own {k}</p>{line}{share}</article>") for k in range(20)]
    rows += [(50 + k, "http://c.org/", f"<body><div>copy</div>{line}</body>") for k in range(30)]
    got = {r.page_id: r.text for r in main_texts(table(spark, rows)).collect()}
    assert got[7] == "own 7 The same line." and got[60] == "copy The same line."


def test_templates_of_a_host_of_many_sections_go(spark):
    promo, menu = "<div><b>Try our weekly letter today</b></div>", "<div><p>In section {} : all the {}</p></div>"
    sign, short = "<p>Sign up for more of this.</p>", "<div>Thanks!</div>"
    rows = []
    for k in range(1200):  # 40 sections of 30 pages; the promo is on 20 % of all pages and in no section on 25 % of them
        box = f"{promo if k % 30 < 6 else ''}{menu.format(k // 30, k // 30)}{short if k % 9 == 0 and k % 30 else ''}"
        rows.append((k, f"http://a.org/s{k // 30}/{k}", f"<article><h2>Sources</h2><p>own {k}</p>{box}{sign}</article>"))
    got = {r.page_id: r.text for r in main_texts(table(spark, rows)).collect()}
    wanted = {k: f"Sources own {k}" + (" Thanks!" if k % 9 == 0 and k % 30 else "") for k in range(1200)}
    assert got == wanted


def test_a_page_saved_often_is_no_template(spark):
    body = "<div><p>a long text that stays the same</p></div>"
    rows = [(k, "http://a.org/one/page", f"<article><p>seen {k} times</p>{body}</article>") for k in range(110)]
    rows += [(200 + k, f"http://a.org/s{k}/x", f"<article><p>own {k}</p></article>") for k in range(400)]
    rows += [(700 + k, f"http://a.org/one/{k}", f"<article><p>other {k}</p></article>") for k in range(400)]
    got = {r.page_id: r.text for r in main_texts(table(spark, rows)).collect()}
    assert got[7] == "seen 7 times a long text that stays the same" and got[207] == "own 7"


def test_nulls_repeated_rows_and_empty_tables(spark):
    rows = [(1, None, None), (None, "http://a.org", "<p>x</p>"), (2, "not a url", ""), (3, "http://a.org", "<p>y</p>"), (3, "http://a.org", "<p>y</p>")]
    got = sorted(((r.page_id, r.text) for r in main_texts(table(spark, rows)).collect()), key=str)
    assert got == sorted([(1, ""), (None, "x"), (2, ""), (3, "y"), (3, "y")], key=str)
    assert main_texts(table(spark, rows).limit(0)).collect() == []


def test_deep_pages_take_time_in_proportion():
    took = []
    for deep in (4_000, 16_000):
        source = "<article>" + "<div><li>" * deep + "deep<p>x</section></p>" * 2
        began = time.perf_counter()
        assert Page(source).main_text().split()[0] == "deep"
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0] and took[1] < 5
    began = time.perf_counter()
    Page("<p " + "a='b\" " * 200_000)
    Page("<a " * 100_000)
    assert time.perf_counter() - began < 10


def test_templates_against_plain_counts(spark):
    """Which subtrees go, by counting the different main texts and addresses of every host and section in plain Python."""
    draw = random.Random(5)
    boxes = [f"<div><b>box {k} of the site here</b></div>" for k in range(12)] + [f"<p>line {k}</p>" for k in range(4)] + ["<div>Hi!</div>"]
    rows = []
    for k in range(700):
        host, section = f"h{k % 3}.org", f"s{k % 7}"
        own = [b for n, b in enumerate(boxes) if draw.random() < (n + 1) / 40 or n in (13, 14) and draw.random() < 0.97]
        rows.append((k, f"http://{host}/{section}/{k if k % 5 else 0}", f"<article><p>own {k if k % 11 else 0}</p>{''.join(own)}</article>"))
    settings = dict(share=0.25, least=8, most=30, nearly=0.9, many=50)
    pages = [(r, Page(r[2])) for r in rows]
    seen, total = defaultdict(dict), defaultdict(set)
    for (_, url, _), page in pages:
        host, section = url.split("/")[2:4]
        main = page.main_text()
        for place in ((host,), (host, section)):
            total[place].add(main)
            for h, kind in page.removable():
                at = seen[place, h, kind].setdefault(main, url)
                seen[place, h, kind][main] = min(at, url, key=lambda u: address(spark, u))
    gone = defaultdict(set)
    for (place, h, kind), texts in seen.items():
        n, pages_, addresses = len(texts), len(total[place]), len(set(texts.values()))
        if n >= 8 and (n >= 50 and n >= 0.9 * pages_ if kind == 2 else n >= 0.25 * pages_ or kind == 0 and addresses >= 30):
            gone[place].add(~h if kind == 2 else h)
    expected = {}
    for (i, url, _), page in pages:
        host, section = url.split("/")[2:4]
        own = {~h if kind == 2 else h for h, kind in page.removable()}
        expected[i] = page.main_text(frozenset((gone[host,] | gone[host, section]) & own))
    got = {r.page_id: r.text for r in main_texts(table(spark, rows), **settings).collect()}
    assert got == expected and sum(page.main_text() != expected[r[0]] for r, page in pages) > 300


_ADDRESSES: dict[str, int] = {}


def address(spark, url):
    """The number by which the operator tells addresses apart."""
    if not _ADDRESSES:
        urls = [f"http://h{a}.org/s{b}/{k}" for a in range(3) for b in range(7) for k in range(700)]
        frame = spark.createDataFrame([(u,) for u in urls], "u string").select("u", F.xxhash64("u"))
        _ADDRESSES.update((r[0], r[1]) for r in frame.collect())
    return _ADDRESSES[url]
