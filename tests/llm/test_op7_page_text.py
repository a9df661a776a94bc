import html
import random
import re
import time
from collections import defaultdict

import pytest

from tallyloom.llm import page_text as p
from tallyloom.llm.queries import QUERIES


def text(source):
    return "\n\n".join(t for t, _ in p.Reader().read(source).content())


PAGE = (
    '<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head>'
    '<body class="has-sidebar"><nav><ul><li><a href="/a">a</a></ul></nav><!-- <article>no</article> --><div class="ad">Buy</div>'
    "%s<aside>side</aside><footer>&copy; x</footer></body></html>"
)


@pytest.mark.parametrize(
    "body, want",
    [
        ("<article><h1>A &amp; B</h1><p><b>one\n two<br><p>three&nbsp;&lt;p&gt;</article>", "A & B\n\none two\n\nthree <p>"),
        ("<article>a<p>b</p>c<div>d</div></article>", "a\n\nb\n\nc\n\nd"),
        ("<article><p>x</p><section class='comments'><p>me too</p></section><form><p>f</p></form></article>", "x"),
        ("<article><p>x</p><div id=cookieNotice>ok?</div><div class='no-sidebar'>y</div></article>", "x\n\ny"),
        ("<article><p>x</p></article><article class='comment'><p>first!</p></article>", "x"),
        ("<main><p>m</p></main><p>outside</p>", "m"),
        ("<div>only <i>div</i>s</div>", "only divs"),
        ("<article></article><p>outside</p>", "outside"),
        ("<article><p>a < b &am &notanentity; 1<2</p></article>", "a < b &am ¬anentity; 1<2"),
        ("<article><p title='>'>q</p></article>", "q"),
        ("<article><ul><li>1<li>2</ul><table><tr><td>c<td>d<tr><td>e</table></article>", "1\n\n2\n\nc d\n\ne"),
        ("<nav><ul><li>menu<article><p>x</article>", "x"),
        ("<ARTICLE><P>u</P><SCRIPT>a</SCRIPT ><P>v</ARTICLE>", "u\n\nv"),
        ("<article><p hidden>h</p><p style='display: none'>h</p><p>x</p></article>", "x"),
        ("", ""),
    ],
)
def test_pages(body, want):
    assert text(PAGE % body) == want


def test_odd_input():
    assert text("") == "" and text("plain & simple") == "plain & simple" and text("<") == "<" and text("<!-- never ends") == ""
    assert text("<article><p>q</p><p>cut off <b") == "q\n\ncut off"
    assert text("<script>never ends <article>x</article>") == ""
    assert text("<p>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert text("<article>" + "<p>word</p>" * 20_000 + "</article>").count("word") == 20_000
    text("<a '" * 2000)


def test_given_pages_against_a_plain_pattern(spark):
    """The test tables' pages have one layout, which a few patterns can read."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r.page_id: r for r in QUERIES["op7_html_extraction"](spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(rows)
    for row in rows:
        article = re.search(r"(?s)<article>(.*?)(</article>|$)", row.html)[1]
        blocks = [html.unescape(re.sub(r"</?b>|<br>", " ", x)).split() for x in re.split(r"</?(?:h1|p)>", article)]
        want = "\n\n".join(" ".join(x) for x in blocks if x)
        assert got[row.page_id].text == want and got[row.page_id].n_chars == len(want)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_templates_go_per_host(spark):
    box = "<div><p>Join our <b>list</b>!</p></div>"
    body = lambda i: f"<html><body>{box}<p>own text {i}</p><p>shared line</p></body></html>"
    rows = [(i, f"https://a.org/{i}", body(i)) for i in range(8)]
    rows += [(100 + i, f"https://b.org/{i}", body(0)) for i in range(8)]  # copies of one page are no template
    rows += [(200, "https://c.org/", body(1))]
    got = {r.page_id: r.text for r in p.extract_text(pages(spark, rows)).collect()}
    assert all(got[i] == f"own text {i}" for i in range(8))
    assert all(got[100 + i] == "Join our list!\n\nown text 0\n\nshared line" for i in range(8))
    assert got[200] == "Join our list!\n\nown text 1\n\nshared line"


def test_articles_keep_shared_paragraphs_but_lose_boxes(spark):
    body = lambda i: f"<article><p>quote</p><div><p>Follow us</p></div><p>own {i}</p><li>quoted item</article>"
    got = p.extract_text(pages(spark, [(i, "https://a.org/", body(i)) for i in range(8)])).collect()
    assert sorted(r.text for r in got) == [f"quote\n\nown {i}\n\nquoted item" for i in range(8)]
    assert {r.n_deleted for r in got} == {1}


def test_a_subtree_on_few_of_many_pages_stays(spark):
    rows = [(i, "https://a.org/", f"<p>own {i}</p>" + "<p>rare</p>" * (i < 6)) for i in range(40)]
    got = p.extract_text(pages(spark, rows)).collect()
    assert sum("rare" in r.text for r in got) == 6


def test_a_subtree_on_many_pages_of_a_hot_host_goes(spark):
    rows = [(i, "https://a.org/", f"<p>own {i}</p>" + "<p>promo</p>" * (i < 24) + "<p>rare</p>" * (i < 19)) for i in range(600)]
    got = p.extract_text(pages(spark, rows)).collect()
    assert sum("promo" in r.text for r in got) == 0 and sum("rare" in r.text for r in got) == 19
    assert all(f"own {r.page_id}" in r.text for r in got)


LONG = "The long text of a page that has no article of its own. " * 3


@pytest.mark.parametrize(
    "body, want",
    [
        (f"<main><h1>Title</h1><p>{LONG}</p><article class='card'>teaser</article></main>", f"Title\n\n{LONG.strip()}\n\nteaser"),
        (f"<main><article><p>{LONG}</p></article><p>below</p></main><p>outside</p>", LONG.strip()),
        (f"<article></article><p>{LONG}</p>", LONG.strip()),
        (f"<article><p>t1</p></article><p>{LONG}</p><article>t2</article>", f"t1\n\n{LONG.strip()}\n\nt2"),
        (f"<main><h1>Blog</h1></main><article>{LONG}</article>", LONG.strip()),
        (f"<main> </main><div>{LONG}</div>", LONG.strip()),
    ],
)
def test_the_region_is_chosen_by_its_text(spark, body, want):
    assert text(PAGE % body) == want
    assert [r.text for r in p.extract_text(pages(spark, [(1, "https://a.org/", PAGE % body)])).collect()] == [want]


@pytest.mark.parametrize(
    "body, want",
    [
        ("<article><h2 id='related-work'>R</h2><section id='social-security'>S</section><p id='share'>P</p></article>", "R\n\nS\n\nP"),
        ("<article><p title='the hidden cost'>a</p><div class='x hidden md:block'>b</div><p aria-hidden=false>c</p></article>", "a\n\nb\n\nc"),
        ("<article><p>x</p><p hidden>h</p><p HIDDEN=''>h</p><p aria-hidden=true>h</p></article>", "x"),
        ("<article><p>x</p><div class='search-engines'>y</div><div class='left-sidebar'>z</div><div role=navigation>z</div></article>", "x\n\ny"),
        (f"<div class='page-with-sidebar'><p>{LONG}</p></div>", LONG.strip()),
        (f"<div class='site-banner'><div id='widget'><p>{LONG}</p><div class='sidebar'>side</div></div></div>", LONG.strip()),
        (f"<div class='site-banner'><p>short</p><p hidden>{LONG}</p></div><p>{LONG}</p>", LONG.strip()),
    ],
)
def test_names_of_furniture_and_wrappers(body, want):
    assert text(PAGE % body) == want


def test_the_region_is_chosen_after_templates_are_gone(spark):
    body = lambda i: f"<body><div><p>{LONG}</p></div><article><p>own {i}</p></article><p>x{i}</p></body>"
    got = p.extract_text(pages(spark, [(i, "https://a.org/", body(i)) for i in range(8)])).collect()
    assert sorted(r.text for r in got) == [f"own {i}" for i in range(8)]


def test_query_edges(spark, as_tables):
    rows = [(1, None, None), (2, "x", ""), (None, "https://a.org", "<p>a</p>"), (3, "https://a.org", "<p>b</p>"), (3, "https://a.org", "<p>b</p>")]
    df = spark.createDataFrame([(*r, "e", "e", "e") for r in rows], "page_id long, url string, html string, text string, host string, blocks string")
    got = QUERIES["op7_html_extraction"](spark, as_tables(pages=df)).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got) == [("1", "", 0), ("2", "", 0), ("3", "b", 1), ("3", "b", 1), ("None", "a", 1)]
    assert QUERIES["op7_html_extraction"](spark, as_tables(pages=df.where("false"))).count() == 0


FURNITURE = (
    "comment-list commentlist comments-area comment-body comment-content ad-slot ad-container cookie-bar sidebar-left nav-links "
    "newsletter-signup related-posts share-buttons social-links commentBody comment_author adbox reader-comments"
).split()
TOPICS = (
    "social-security search-engines page-with-sidebar content main-content post-body article-body entry-content address "
    "shareholders notice-of-motion menu-history advertising-law commentary header-files no-sidebar-content section-list"
).split()


@pytest.mark.parametrize("name", FURNITURE)
def test_names_that_are_furniture(name):
    for inside in (f"<div class='x {name}'>gone</div>", f"<ul id='{name}'><li>gone</ul>", f"<section class='{name}'><p>gone</p></section>"):
        assert text(PAGE % f"<article><p>{LONG}</p>{inside}</article>") == LONG.strip()
    if "comment" in name and not name.startswith("reader"):
        assert text(PAGE % f"<article><p>{LONG}</p></article><article class='{name}'>{LONG * 3}</article>") == LONG.strip()


@pytest.mark.parametrize("name", TOPICS)
def test_names_that_are_none(name):
    assert text(PAGE % f"<article><p>x</p><div class='{name}'>y</div></article>") == "x\n\ny"


def test_changing_comments_and_adverts_go(spark):
    body = lambda i: (
        f"<article><h1>Title {i}</h1><p>{LONG}{i}</p><ol class='comment-list'><li><p>I liked part {i} a lot</p></ol>"
        f"<div class='ad-slot'>Buy {i} now</div></article>"
    )
    got = p.extract_text(pages(spark, [(i, "https://a.org/", body(i)) for i in range(30)])).collect()
    assert sorted(r.text for r in got) == sorted(f"Title {i}\n\n{LONG}{i}" for i in range(30))


@pytest.mark.parametrize(
    "source, blocks",
    [("<div>x" * 50_000, 50_000), ("<b>" * 50_000 + "<p>a</p>" * 50_000, 50_000), ("<span>x<hr>" * 50_000, 50_000), ("<a " * 300_000, 0), ("<ul><li>x" * 30_000, 30_000)],
)
def test_depth_takes_time_by_length(source, blocks):
    began = time.process_time()
    page = p.Reader().read(source)
    assert len(page.texts) == blocks and time.process_time() - began < 10
    assert len(page.hashes) == len(page.parents) <= 50_000 * 2
    assert len(page.without({page.hashes[0]} if page.hashes else set()).texts) == 0 and len(page.without({1}).texts) == blocks


def test_a_box_that_begins_with_inline_text_is_told_by_its_text():
    one, other = (p.Reader().read(f"<div><b>{x}</b> and more</div>").hashes for x in ("this", "that"))
    assert len(one) == 2 and not (set(one) & set(other)) - {0}  # 0 stands for no text of its own
    again = p.Reader().read("<div><b>this</b> and more</div>").hashes
    assert one == again


def test_templates_against_a_plain_tree(spark):
    rnd = random.Random(7)

    def leaf(words):
        return (rnd.choice(["p", "h2"]), [f"{rnd.choice(['few', 'some'])} {rnd.randrange(words)}"])

    def tree(depth, words):
        inside = [tree(depth - 1, words) if depth and rnd.random() < 0.5 else leaf(words) for _ in range(rnd.randint(1, 3))]
        return (rnd.choice(["div", "section", "div"]), inside)

    def markup(node):
        return node if isinstance(node, str) else f"<{node[0]}>{''.join(map(markup, node[1]))}</{node[0]}>"

    def texts(node):
        return [node] if isinstance(node, str) else [x for child in node[1] for x in texts(child)]

    def subtrees(node):
        return set() if isinstance(node, str) else {repr(node)}.union(*map(subtrees, node[1]))

    def without(node, gone):
        if isinstance(node, str):
            return [node]
        return [] if repr(node) in gone else [x for child in node[1] for x in without(child, gone)]

    boxes = [tree(2, 50) for _ in range(4)]
    made = []
    for i in range(150):
        parts = [tree(2, 12) for _ in range(3)] + [x for x in boxes if rnd.random() < 0.4]
        rnd.shuffle(parts)
        made.append((f"h{i % 5 % 2}.org", parts))
    made += made[:20]
    holders, contents = defaultdict(set), defaultdict(set)
    for host, parts in made:
        content = tuple(x for part in parts for x in texts(part))
        contents[host].add(content)
        for part in parts:
            for subtree in subtrees(part):
                holders[host, subtree].add(content)
    gone = defaultdict(set)
    for (host, subtree), found in holders.items():
        if len(found) >= 4 and len(found) >= min(0.25 * len(contents[host]), 20):
            gone[host].add(subtree)
    want = [(i, "\n\n".join(x for part in parts for x in without(part, gone[host]))) for i, (host, parts) in enumerate(made)]
    rows = [(i, f"https://{host}/{i}", f"<html><body>{''.join(map(markup, parts))}</body></html>") for i, (host, parts) in enumerate(made)]
    got = [(r.page_id, r.text) for r in p.extract_text(pages(spark, rows)).collect()]
    assert sorted(got) == sorted(want) and any(gone.values()) and any(x != "" for _, x in want)
