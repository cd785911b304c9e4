"""HTML extraction: mark-up cases, matching, wrappers over a host."""

import pytest

from logbeam.llm import dom
from logbeam.llm import op10_html as op10

PAGES = "page_id long, url string, html string, host string, template string"


def page(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], PAGES)


@pytest.mark.parametrize(("html", "want"), [
    ("<html><body><nav>m</nav><article><h1>T &amp; U</h1><p><b>a\n b<br><p>c<i>d</i></article><footer>f</footer>", "T & U a b cd"),
    ("<article>a<script>var x='</p>';</script><style>p{}</style><div class='comments'><p>me too</p></div> b &lt;x&gt;&eacute;&#8364;</article>", "a b <x>é€"),
    ("<body><div id=sidebar>s</div><main><header>h</header><p>one</p><aside>q</aside><p>two<form>x</form></main>", "one two"),
    ("<p>x<p>y<!-- c --><ul><li>1<li>2</ul><table><tr><td>a<td>b</table>", "x y 1 2 a b"),
    ("<article><article class=comment>no</article><p title='a>b'>yes &nbsp; no</p></article>", "yes no"),
    ("<div class='cookie-notice'>c</div><div class=content>body <a href=x>link</a>, end</div><div>other</div>", "body link, end"),
    ("<article>one</article><p>between</p><article>two</article>", "one two"),
    ("a < b and c > d <p>e", "a < b and c > d e"),
    ("<article><p hidden>h</p><p style='display: none'>n</p><textarea>t</textarea>ok<template>z</template></article>", "ok"),
    ("<title>t</title><body>unclosed <b>bold", "unclosed bold"),
    ("", ""), ("<article></article>", ""), ("<script>only", ""),
])
def test_extract(html, want):
    assert op10.extract(html) == want


def test_deep_and_long():
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert op10.extract(deep) == "x"
    long = "<article>" + "<p>w w</p>" * 20_000 + "</article>"
    assert op10.extract(long) == " ".join(["w w"] * 20_000)
    assert op10.extract("<a b='" * 300 + "<p>z") is not None


def test_shape_merges_repeats_and_round_trips():
    a, slots = dom.shape(dom.parse("<body><ul><li>1<li>2</ul><p>a<p>b <b>c</b><div class='X y'>q</div></body>"))
    assert a == "body(ul(li(#)),p(#),div.x(#))" and len(slots) == 3
    b, _ = dom.shape(dom.parse("<body><ul><li>1</ul><p>a<div class='X'>q</div></body>"))
    assert a == b
    tree = dom.read_shape(a)
    assert dom.match(tree, tree) == (9, [(2, 2), (1, 1), (0, 0)]) or sorted(dom.match(tree, tree)[1]) == [(0, 0), (1, 1), (2, 2)]


def test_matching_keeps_order_and_skips():
    a, b = dom.read_shape("body(h1(#),div.a(#),p(#))"), dom.read_shape("body(div.a(#),x(#),p(#),h1(#))")
    size, pairs = dom.match(a, b)
    assert size == 6 and sorted(pairs) == [(1, 0), (2, 2)]
    assert dom.match(("a", (), -1), ("b", (), -1)) == (0, [])


def test_wrapper_tells_template_from_content(spark):
    rows = [(i, f"http://h.example/{i}", f"<body><div>Site name</div><h2>Head {i}</h2><p>text {i} and more that is {i}'s alone</p><div><b>All rights</b> kept</div>"
             + ("<span>odd</span><h3>Extra</h3>" if i % 3 == 0 else "")) for i in range(30)]
    rows += [(100 + i, "http://few.example/", f"<body><div>Kept</div><p>t{i}</p>") for i in range(2)]
    more = " and more that is {}'s alone"
    got = {r.page_id: r for r in op10.main_text(page(spark, rows)).collect()}
    assert got[1].text == "Head 1 text 1" + more.format(1) and got[4].text == "Head 4 text 4" + more.format(4)
    assert got[3].text == "Head 3 text 3" + more.format(3)  # aligned across shapes; the odd parts are constant among themselves
    assert got[100].text == "Kept t0"


def test_copies_of_an_article_are_no_template(spark):
    rows = [(i, "https://c.example/x", "<nav>n</nav><article><p>the same</p></article>") for i in range(20)]
    assert {r.text for r in op10.main_text(page(spark, rows)).collect()} == {"the same"}


def test_edges(spark):
    rows = [(1, None, None), (None, "http://a", "<p>x"), (2, "not a url", ""), (2, "not a url", ""), (3, "http://u@H.x:80/p", "<p>" + "é " * 50_000)]
    got = op10.main_text(page(spark, rows)).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id is None] == ["x"] and [r.n_chars for r in got if r.page_id == 3] == [99_999]
    assert got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    assert op10.main_text(page(spark, [])).collect() == []


@pytest.mark.parametrize(("html", "want"), [
    ("<div class=content>one</div><p>between</p><div class=content>two<div class=content>three</div></div>", "one two three"),
    ("<main>one</main><nav>n</nav><div role=main>two</div>", "one two"),
    ("<div><article>" + "<div>" * 200 + "deep" + "</div>" * 200 + "<p>rest</p></article></div><p>after", "deep rest"),
    ("<article>" + "<div>" * 200 + "in<nav>n</nav><aside>a</aside>" + "</div>" * 200 + "rest</article>", "in rest"),
    ("<article>" + "<b>" * 3000 + "x" + "</b>" * 3000 + "<p>y</article>", "x y"),
])
def test_all_parts_at_any_depth(html, want):
    assert op10.extract(html) == want
    dom.shape(dom.parse(html))


def test_depth_costs_no_square():
    n = 100_000
    assert op10.extract("<div>" * n + "x" + "</p>" * n + "<p>" * n + "<hr>" * n + "y") == "x y"
    shape, slots = dom.shape(dom.parse("<div>" * n + "x"))
    assert shape.count("div") < dom.MAX_DEPTH and len(slots) == 1
    tree = dom.read_shape(shape)
    assert dom.match(tree, tree)[1] == [(0, 0)]


def texts(spark, bodies, host="h.example"):
    got = op10.main_text(page(spark, [(i, f"http://{host}/{i}", b) for i, b in enumerate(bodies)])).collect()
    return [r.text for r in sorted(got, key=lambda r: r.page_id)]


def test_copies_without_mark_up_are_no_template(spark):
    assert texts(spark, ["<div>Site</div><p>the same"] * 8) == ["Site the same"] * 8
    # a group of copies with a shape of its own, among different pages
    own = "<div>Site</div><h2>Own</h2><ul><li>copied</ul><p>copied too"
    bodies = [f"<div>Site</div><p>text {i}" for i in range(8)] + [own] * 7
    assert texts(spark, bodies) == [f"text {i}" for i in range(8)] + ["Own copied copied too"] * 7


def test_copies_in_different_frames_are_no_template(spark):
    frames = ["<nav>n</nav>", "<aside>a</aside>", "<header>h</header>", "<footer>f</footer>", "<form>x</form>", "<script>s</script>"]
    assert texts(spark, [f"{f}<div>{i}</div><article><p>the same</article>" for i, f in enumerate(frames)]) == ["the same"] * 6
    assert texts(spark, [f"{f}<div><p>the same</div>" for f in frames]) == ["the same"] * 6


@pytest.mark.parametrize("part", ["article", "main", "div class=content"])
def test_template_inside_the_article(spark, part):
    end = part.split()[0]
    said = "Head {0} text {0} of this page alone more {0} of the same"
    bodies = [f"<{part}><h1>Head {i}</h1><p>text {i} of this page alone</p><p>more {i} of the same</p><p>Tell <a href=x>your friends</a></p>"
              f"<div>Printed by us</div></{end}>" + ("<p>outside" if i % 2 else "") for i in range(6)]
    assert texts(spark, bodies) == [said.format(i) for i in range(6)]
    # two different pages show it as well as more, one page and its copies do not
    assert texts(spark, bodies[:2] * 3) == [said.format(0), said.format(1)] * 3
    assert texts(spark, bodies[:1] * 3)[0] == said.format(0) + " Tell your friends Printed by us"
    # nor is template what one of the pages lacks
    some = [b.replace("Printed by us", "Printed by you") if i == 2 else b for i, b in enumerate(bodies)]
    assert texts(spark, some)[2:4] == [said.format(2) + " Printed by you", said.format(3) + " Printed by us"]


def test_headings_of_articles_stay(spark):
    bodies = [f"<article><h2>Abstract</h2><p>what {i} is about</p><h2>Results</h2><p>what {i} found</p></article>" for i in range(7)]
    assert texts(spark, bodies) == [f"Abstract what {i} is about Results what {i} found" for i in range(7)]


def test_pages_that_are_mostly_alike_are_no_template(spark):
    """Near copies of one article: the shared text is most of the host's."""
    bodies = ["<article>" + "".join(f"<p>paragraph {k} of the copied article</p>" for k in range(6)) + f"<p>read {i} times</p></article>" for i in range(9)]
    assert all(t.startswith("paragraph 0 of") and f"read {i} times" in t for i, t in enumerate(texts(spark, bodies)))


@pytest.mark.parametrize(("html", "want"), [
    ("<article class='social-science'><p>a</p></article>", "a"),
    ("<article class='search'><p>a</p></article>", "a"),
    ("<article><section id='related-work'><h2>Related</h2><p>b</p></section><p>c</p></article>", "Related b c"),
    ("<article><p class='share-price'>up</p><p class='comment-worthy'>x</p></article>", "up x"),
    ("<main class=widget>m</main><div class='site-header'>h</div>", "m"),
    ("<div class='page-widget'><div class='site-menu'>m</div><article>a</article></div>", "a"),
    ("<div class=widget><p>most of the text of this page</div><p>rest<div class=widget>w</div>", "most of the text of this page rest"),
    ("<article>a<div class='ad-slot'>x</div><div class='share-buttons'>s</div><div class='reader-comments'>c</div></article>", "a"),
    ("<div class='comments'>" + "long thread " * 20 + "</div><p>text", "text"),
    ("<main>m</main><article class='comment'>c</article>", "m"),
])
def test_class_words_are_whole_names(html, want):
    assert op10.extract(html) == want


def brute_template(bodies):
    """(slot, text) on every different page of one shape, if the minor part."""
    units = []
    for b in bodies:
        root = dom.parse(b)
        dom.shape(root)
        units.append(op10._units(root))
    different = {tuple(t for _, t, _ in u): u for u in units}.values()
    blocks = [{(n, t) for n, t, stays in u if not stays} for u in different]
    common = set.intersection(*blocks) if len(blocks) > 1 else set()
    size = sum(len(t) for u in different for n, t, _ in u if (n, t) in common)
    return common if 2 * size < sum(len(t) for u in different for _, t, _ in u) else set(), units


def test_against_brute_force_of_one_shape(spark):
    """Pages of one shape, blocks from small pools: template by intersection."""
    import random

    for seed in range(4):
        rng = random.Random(seed)
        pools = [["c", "c"], ["same words", "same words"], [f"v{i} and more" for i in range(5)], ["a a", "b b"], [f"text {i} " * 3 for i in range(9)]]
        bodies = ["<div class=x>{}</div><p>{}</p><ul><li>{}</ul><h2>{}</h2><article>{}<h3>Fixed</h3></article>".format(
            *(rng.choice(p) for p in pools)) for _ in range(12)]
        bodies = bodies if seed % 2 else [b.replace("<article>", "<section>").replace("</article>", "</section>") for b in bodies]
        template, units = brute_template(bodies)
        want = [" ".join(t for n, t, stays in u if stays or (n, t) not in template) for u in units]
        assert texts(spark, bodies) == want, seed
