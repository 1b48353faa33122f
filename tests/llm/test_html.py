import html
import random
import re
import time

from shardbrook.llm import html_extract as H

WEIGHTS = list(H.TEXT.values())


def test_cut_is_of_least_cost():
    rng = random.Random(2)
    for _ in range(1500):
        n = rng.randint(1, 9)
        costs = [rng.uniform(-1, 1) * rng.choice((0.2, 1, 3)) for _ in range(n)]
        edges = [
            (i, j, rng.random()) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.4
        ]

        def cost(label):
            own = sum(abs(c) for c, content in zip(costs, label) if (c > 0) != content and c)
            return own + sum(w for i, j, w in edges if label[i] != label[j])

        least = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert abs(cost(H.minimum_cut(costs, edges)) - least) < 1e-9


PAGE = """<html><body class="has-sidebar"><div class="cookie-notice"><p>We use cookies to improve
your experience on this site today.</p></div><header><h1>Site</h1></header>
<div class="menu"><ul><li><a href=a>Home</a><li><a href=b>About us</a></ul></div>
<div id="content"><h2>Title here</h2><p>First &lt;para&gt; with <a href="x>y">a link</a> and more
words to read, enough for a sentence.<p>Second paragraph &amp; more &#233;. It goes on<br>and on.
<div class="ad-box">Buy now! Cheap things for everyone.</div></div>
<div class=sidebar><p>Popular posts this week that you should really read now.</p></div>
<section id="comments"><h3>Comments</h3><div class="comment"><p>Nice article, I liked it very much
indeed.</p></div></section><form><label>Mail</label><input></form>
<script>if(a<b){x="</p>"}</script><footer><p>Copyright 2024 by us.</p></footer></body></html>"""


def test_a_page_without_an_article_element():
    assert H.extract_page(PAGE, WEIGHTS).split("\n\n") == [
        "Title here",
        "First <para> with a link and more words to read, enough for a sentence.",
        "Second paragraph & more é. It goes on and on.",
    ]


def test_broken_and_odd_pages():
    for page in (
        "", "<", "<a", "<p", "<!-- x", "<script>x", "</p></div>", "<p>" * 3000, "<div>" * 3000,
        '<a href="' * 2000, "<![CDATA[", "<p class='", "&#xD800;&bogus;&amp",
    ):
        assert isinstance(H.extract_page(page, WEIGHTS), str)
    assert H.extract_page("<article><p>a<p>b</article>", WEIGHTS) == "a\n\nb"
    assert H.extract_page("<article><p>one two three.<script>if (x) '</p>'", WEIGHTS) == "one two three."
    long = "<article>" + "<p>Some words of a sentence.</p>" * 20_000
    assert H.extract_page(long, WEIGHTS).count("\n\n") == 19_999


def _article(page):
    """The article of a generated page."""
    inside = page[page.index("<article>") + 9 :].split("</article>")[0]
    parts = re.split(r"</?(?:p|h1)>", inside.replace("<br>", " "))
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts)
    return "\n\n".join(t for t in texts if t)


def test_query(spark):
    from shardbrook.llm.queries import LLM_QUERIES

    sf_dir = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = LLM_QUERIES["op5_html_extract"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for row in rows:
        assert row.url == pages[row.page_id].url
        assert row.text == _article(pages[row.page_id].html)
        assert row.n_chars == len(row.text)


def test_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", PAGE), (3, "u", PAGE), (None, "u", PAGE)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = table.selectExpr("*", "'x' AS text", "1 AS n_chars", "2 AS _html")
    found = H.extract(pages, H.learn(pages)).collect()
    assert len(found) == 5
    assert [r.text for r in found if r.page_id in (1, 2)] == ["", ""]
    texts = {r.text for r in found if r.page_id not in (1, 2)}
    assert len(texts) == 1 and "Second paragraph" in texts.pop()
    assert H.extract(pages.limit(0), H.learn(pages.limit(0))).count() == 0


def test_nested_and_unmatched_tags_take_linear_time():
    many = 200_000
    for page in (
        "<b>" * many + "</i>" * many,
        "<b>" * many + "x<div></div>" * many,
        "<p><table><td>" + "<b>" * many + "<div>y</div>" * many,
    ):
        began = time.perf_counter()
        H.blocks_of(page)
        assert time.perf_counter() - began < 10  # seconds; the square would be hours


def test_the_cut_decides_where_names_and_tags_tell_nothing():
    """A block leans one way by itself and goes with its neighbours all the same."""
    long = "<p>" + "A sentence with many words that say something about it. " * 4 + "</p>"
    short = "<p>See <a href=x>there</a></p>"
    links = "<p><a href=x>One</a></p><p><a href=y>Two</a></p>"
    middling = "<p>More <a href=x>on this</a> here</p>"

    def sides(page):
        blocks = H.blocks_of(page)
        assert not any(b.structure for b in blocks)
        costs = [H.cost_of(b, WEIGHTS) for b in blocks]
        labels = H.minimum_cut(costs, H.ties(blocks))
        return [(c > 0, label) for c, label in zip(costs, labels)]

    alone = sides(short)
    assert alone == [(False, False)]
    between = sides(f"<div>{long}{short}{long}</div>")
    assert between == [(True, True), (False, True), (True, True)]
    assert sides(middling) == [(True, True)]
    assert sides(f"<div>{links}{middling}{links}</div>")[2] == (True, False)
    text = H.extract_page(f"<div>{long}{short}{long}</div>", WEIGHTS)
    assert "See there" in text
