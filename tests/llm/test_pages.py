import html
import re

from tessera.llm import pages as P

SCHEMA = "page_id long, url string, html string, host string, path string"
PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style></head><body class="x1">
<header><h2>Site</h2></header><nav><ul><li><a href=/a>a</a></li></ul></nav>
<div id="cookie-notice">We use cookies</div><div class="sidebar"><p>%(side)s</p></div>
<div class="post post-%(n)d"><h1>Head&nbsp;line &amp;amp;</h1><p>First <b>bold</b>&#33;<br>
 second   line<p>Unclosed <i>para <script>var a="</p>";</script>end</i>
<ul><li>one<li>two &lt;x&gt;</ul><form><input name=q>Search</form><!-- <p>no</p> --><table><tr><td>c1<td>c2</table>
<section class="comments"><p>Nice post</p></section><aside>See also</aside></div>
<footer>&copy; 2020</footer></body></html>"""
WANT = ["Head line &amp;", "First bold! second line", "Unclosed para end", "one", "two <x>", "c1", "c2"]


def test_blocks_and_what_is_left_out():
    assert P.extract(PAGE % {"side": "x" * 900, "n": 3}).split("\n\n") == WANT
    assert P.container(P.parse(PAGE % {"side": "", "n": 3})).path == "html/body.x/div.post"


def test_odd_html():
    for t in (None, "", "   ", "<", "<p", "</p></div>", "<!-- never closed <p>x</p>", "<script>x", "<div " * 50, "&#x110000; &bogus; &lt"):
        assert isinstance(P.extract(t), str)
    assert P.extract(None) == "" and P.extract("plain &lt;text&gt;\n here") == "plain <text> here"
    assert P.extract("<div>" * 5000 + "deep text" + "</div>" * 5000) == "deep text"
    assert P.extract("<p>a<p>b</p>c</div>d") == "a\n\nb\n\nc" + "d"


def test_consensus_path_rules_a_page_whose_own_best_is_elsewhere(spark):
    good = "<body><div class='main-{n}'><p>" + "long article text " * 20 + "</p></div><div class='extra'></div></body>"
    odd = "<body><div class='main-9'><p>brief</p></div><div class='extra'><p>" + "a long reader poll " * 30 + "</p></div></body>"
    rows = [(i, "http://Host.example/a", good.replace("{n}", str(i)), None, "x") for i in range(5)] + [(9, "https://host.example:80/b?c", odd, None, None), (10, None, None, None, None), (10, "", "<p>x", None, None)]
    for most in (100, 0):
        got = {(r.page_id, r.url): r for r in P.main_text(spark.createDataFrame(rows, SCHEMA), most_hosts=most).collect()}
        assert len(got) == len(rows)
        assert got[9, "https://host.example:80/b?c"].text == "brief" and got[9, "https://host.example:80/b?c"].n_chars == 5
        assert got[10, None].text == "" and got[10, ""].text == "x"
    assert P.main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_table_against_the_article_element(spark, sf):
    def slow(h):
        body = re.search(r"<article>(.*?)</article>", h, re.DOTALL)[1].replace("<br>", " ")
        parts = re.split(r"</?(?:p|h1|h2|article)\b[^>]*>", body)
        return [t for t in (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", x))).strip() for x in parts) if t]

    rows = spark.read.parquet(f"{sf}/pages.parquet")
    want = {r.page_id: "\n\n".join(slow(r.html)) for r in rows.collect()}
    got = {r.page_id: r for r in P.main_text(rows).collect()}
    assert {i: r.text for i, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())


def test_nothing_of_the_article_is_left_outside():
    long = "<p>" + "body text of the article " * 40 + "</p>"
    for t, parts in (
        (f"<body><article><h1>Title</h1><p>lead</p><div class=body>{long}</div></article></body>", ["Title", "lead"]),
        (f"<body><div class=post><h1>Title</h1><p>lead</p><div class=body>{long}</div></div></body>", ["Title", "lead"]),
        (f"<body><div class=post><section class=a>{long}</section><section class=b><p>second part</p></section></div></body>", ["second part"]),
        (f"<body><div class=post><p>before</p><table><tr><td>{long}</table><p>after</p></div></body>", ["before", "after"]),
        (f"<body><div class=text>{long * 3}</div><article class=card>{long.replace('body', 'card')}</article></body>", ["body text", "card text"]),
    ):
        got = P.extract(t, P.container(P.parse(t)).path)
        assert all(x in got for x in [*parts, "text of the article"]), t


def test_headings_and_sections_beside_the_largest_part_are_kept():
    body = "<p>" + "much more of the text. " * 300 + "</p>"
    for t in (f"<body><div class=top><h1>Title</h1></div><div class=content>{body}</div></body>", f"<body><main><h1>Title</h1><div>{body}</div></main></body>", f"<body><div><div class=a>Title</div><div class=b>{body}</div></div></body>"):
        assert P.extract(t).startswith("Title\n\nmuch more")


def test_headers_outside_article_and_main_are_left_out():
    page = '<body><div class="main-wrap"><header><h1>Site name</h1></header><div class="main-text"><p>the text</p></div></div></body>'
    assert P.extract(page) == "the text"
    assert P.extract("<body><article><header><h1>Head</h1></header><p>x</p></article></body>") == "Head\n\nx"
    assert P.extract("<body><main><header>Head</header><p>x</p></main></body>") == "Head\n\nx"


def test_votes_weigh_by_content(spark):
    row = lambda i, c, n: (i, "http://h.example/", f"<body><div class={c}><p>{'text ' * n}</p></div></body>", None, None)
    rows = [row(0, "long", 4000), row(1, "stub", 1), row(2, "stub", 1)]
    got = P.main_text(spark.createDataFrame([*rows, (3, "http://h.example/", f"<body><div class=stub>a</div>{rows[0][2]}", None, None)], SCHEMA))
    assert {r.host_path for r in got.collect()} == {"html/body/div.long"}


def test_very_long_and_deep_pages_take_time_and_memory_in_proportion():
    import time
    import tracemalloc

    def cost(t):
        tracemalloc.start()
        began = time.time()
        text = P.extract(t, P.container(P.parse(t)).path)
        out = time.time() - began, tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return text, *out

    n = 8_000
    for t in ("<div>" * n + "deep" + "</div>" * n, "<div>" * n + "deep", "<b>" * n + "<hr>" * n + "deep", "<div>" * n + "</span>" * n + "deep", "<p><b>" * n + "deep", "<ul><li>" * n + "deep"):
        text, seconds, peak = cost(t)
        assert text == "deep" and seconds < 20 and peak < 30_000_000, t[:20]
    for t in ("<a href='" * n, '<a href="' * n + "x", "<a " * n, "<a b='\">" * n, "<!--" * n):
        assert cost(t)[1] < 10
    assert P.extract('<p title="a > b">one</p><p title=it\'s>two</p>') == "one\n\ntwo"
    assert P.extract("<article>" + "<p>word</p>" * 50_000 + "</article>") == "\n\n".join(["word"] * 50_000)


def test_pages_without_article_by_brute_force(spark):
    """Bodies of marked and unmarked parts in any order: what is not marked is the text, in page order."""
    import itertools
    import random

    rng = random.Random(11)
    marked = ['<div class="sidebar-left"><p>no %d</p></div>', '<nav><a href=x>no %d</a></nav>', "<footer>no %d</footer>", '<div id="comments"><p>no %d</p></div>', '<div class="ad"><p>no %d</p></div>', "<form><label>no %d</label></form>", '<section role="search">no %d</section>']
    plain = ["<h1>yes %d</h1>", "<p>yes %d</p>", "<div class=body><p>yes %d</p></div>", "<section><h2>yes %d</h2></section>", "<ul><li>yes %d</li></ul>", "<table><tr><td>yes %d</td></tr></table>"]
    count = itertools.count()
    for _ in range(200):
        parts = [rng.choice(marked if rng.random() < 0.4 else plain) % next(count) for _ in range(rng.randrange(1, 9))]
        shell = rng.choice(["<body>%s</body>", '<body><div id=wrap class="main-wrap">%s</div></body>', "<div><div class=x1>%s</div></div>"])
        want = [re.sub(r"<[^>]+>", "", p) for p in parts if "yes" in p]
        assert P.extract(shell % "".join(parts)) == "\n\n".join(want)
