import random

from riskengine.llm import html

LAYOUT = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x="</p>";</script></head><body>
<header><h2>Site</h2><p>slogan</p></header><nav><ul><li><a href="/">Home</a><li>More</ul></nav>{body}
<aside>Popular</aside><div class="cookie-notice"><div>We use cookies</div>ok</div><form><label>Mail</label><input name=x></form>
<section id="comments"><h3>Comments</h3><article class="comment"><p>first!</p></article></section><footer>&copy; site</footer></body></html>"""


def text(page):
    lines = html.page_lines(page)
    return html.chosen([p for p, _x in lines], [x for _p, x in lines], set())


def test_article_only():
    page = LAYOUT.format(body='<div class="ad">Buy</div><article><h1>A &amp; B</h1><p>One\n  two<b> three</b>four&nbsp;x<br>five<p>six &lt;i&gt;</p><div class="share">Share</div><footer>by me</footer></article>')
    assert text(page) == "A & B One two threefour x five six <i>"


def test_sections_of_an_article():
    """Names that a section may have decide only together with the alignment."""
    page = '<article><h1>T</h1><section id="discussion"><h2>Discussion</h2><div>one</div><p>two</p></section><div id="market-share">three</div><div class="related"><p>Read more</p></div><p class="notice">four</p><aside>x</aside><div class="share">y</div><div id="comments">z</div></article>'
    lines = html.page_lines(page)
    parts, words = [p for p, _x in lines], [x for _p, x in lines]
    pick = lambda shared: html.chosen(parts, words, {words.index(x) for x in shared})
    assert pick([]) == "T Discussion one two three Read more four"
    assert pick(["Read more", "four"]) == "T Discussion one two three four"
    # the neighbour is a copy of the article
    assert pick(["T", "Discussion", "one", "two", "three", "Read more", "four"]) == "T Discussion one two three Read more four"
    # outside an article the names decide by themselves
    assert text('<div class="related">Read more</div><article><p>a</article><section id="discussion"><p>b</section>') == "a"


def test_unclosed_parts_and_odd_markup():
    assert text('<div class="ad">Buy now<article><p>kept</p></article>') == "kept"
    assert text('<article><p title="a > b">x</p><!-- <p>no</p> --><p>y</article>') == "x y"
    assert text("<article><p class='a>b>c</p><p>z") .endswith("z")
    assert text("<article>a<script>if (a<b) {}</script>c</article>") == "a c"
    assert text("no markup at all &euro;") == "no markup at all €"
    assert text("") == "" and text("<p></p>") == ""


def test_longest_common_subsequence():
    def brute(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(12))] for _ in range(2))
        got = sorted(html.shared_lines(a, b))
        assert len(got) == brute(a, b) == brute([a[k] for k in got], b)


def test_differencing_between_pages(spark, monkeypatch):
    """Without articles the lines that the nearest page of the host has too go."""
    around = lambda x: f"<div>Top line</div><div>{x}</div><div>Bottom line</div>"
    rows = [(i, f"http://h.example/a/{i}", around(f"text number {i}")) for i in range(40)]
    rows += [(100, "http://other.example/x", around("alone")), (101, "http://copy.example/1", around("c")), (102, "http://copy.example/2", around("c"))]
    rows += [(103, None, None), (104, "", ""), (105, "http://h.example/a/5", rows[5][2]), (105, "http://h.example/a/5", rows[5][2])]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()
    out = {r.page_id: r.text for r in got}
    assert len(got) == len(rows)
    assert [out[i] for i in range(40) if i != 5] == [f"text number {i}" for i in range(40) if i != 5]
    assert out[100] == "Top line alone Bottom line"
    assert out[101] == out[102] == "Top line c Bottom line"
    assert out[103] == out[104] == ""
    assert all(r.n_chars == len(r.text) for r in got)


def test_nearest_pages_across_partitions(spark):
    rows = [(i, f"http://h/{i:03d}") for i in range(50)] + [(100 + i, f"http://k/{i}") for i in range(1)]
    got = {r.rid: r.near for r in html.nearest_pages(spark.createDataFrame(rows, "rid long, url string")).collect()}
    assert got[100] is None
    assert all(abs(got[i] - i) == 1 for i in range(50))


def test_edge_cases(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(None, "http://a/1", "<article>x"), (None, "http://a/1", "<article>x"), (2, "http://a/2", "<article>" + "<p>para " * 20000)], "page_id long, url string, html string")
    more = df.withColumns({n: F.lit("y") for n in "rid host path seat part own other hashes parts lines near".split()})
    rows = html.extract(more).collect()
    assert sorted(r.n_chars for r in rows) == [1, 1, 20000 * 5 - 1]
    assert html.extract(df.where("false")).collect() == []
