"""Main text of pages, and equivalence classes against counted vectors."""

from collections import Counter, defaultdict

from quarry.llm.html import extract, main_text, scan, templates

NONE = frozenset()
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- ad 0 --><div class="ad">Buy &amp; go</div>
<article><h1>Head &amp; line</h1><p><b>One&nbsp;two
 three.<br><p>Four <i>fi</i>ve</p><div class="comments"><p>Reader</p></div><form><p>Mail</p></form><aside>Side</aside></article>
<footer>&copy; host</footer></body></html>"""


def test_article_only():
    assert extract(PAGE, NONE) == "Head & line\nOne two three.\nFour five"


def test_odd_pages():
    assert [extract(p, NONE) for p in (None, "", " \n", "plain", "a < b &lt; c", "<p>x<p>y", "<article></article>", "<p>cut <b", "<p>x</p><!-- open",
                                       "<p>a</p><script>open", "&am", "<a title='>'>in</a> line", "<td>1<td>2", "<div hidden class=x>ok</div>", "</p>stray</div>")] == \
        ["", "", "", "plain", "a < b < c", "x\ny", "", "cut", "x", "a", "&am", "in line", "1\n2", "ok", "stray"]
    assert extract("<p>" + "word " * 100_000 + "</p>", NONE) == " ".join(["word"] * 100_000)


def site(host, i, body):
    return f"http://{host}/{i}", f"<html><body><div><span>Site name</span></div><div><p>{body}</p></div><div><p>All rights</p></div></body></html>"


def test_template_text_is_deduced_per_host(spark):
    rows = [(i, *site("A.example", i, f"body {i}"), "h") for i in range(5)] + [(10 + i, *site("b.example", i, f"only {i}"), "h") for i in range(2)]
    rows += [(20, None, "<p>no url</p>", "h"), (21, "no scheme", None, "h"), (None, "http://c/", "<article>Ä  b</article>", "h"), (0, *site("A.example", 0, "body 0"), "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(3)
    out = sorted((tuple(r) for r in main_text(df).collect()), key=str)
    want = [(i, f"http://A.example/{i}", f"body {i}", 6) for i in [0, 0, 1, 2, 3, 4]]
    want += [(10 + i, f"http://b.example/{i}", f"Site name\nonly {i}\nAll rights", 27) for i in range(2)]
    want += [(20, None, "no url", 6), (21, "no scheme", "", 0), (None, "http://c/", "Ä b", 3)]
    assert out == sorted(want, key=str)
    assert main_text(df.limit(0)).collect() == []


def test_classes_equal_counted_vectors(spark):
    pages = [(i, f"http://h/{i}", "<html><body>" + "<ul><li><a>x</a></li></ul>" * (i % 3 + 1) + f"<p>Same</p><p>own {i}</p></body></html>") for i in range(6)]
    got = defaultdict(set)
    parents = {}
    for r in templates(spark.createDataFrame(pages, "page_id long, url string, html string")).collect():
        got[r["class"]].add(r.token)
        parents[r["class"]] = r.parent
    vectors = defaultdict(set)
    counts = [Counter({k: v[0] for k, v in scan(p[2])[1].items()}) for p in pages]
    for token in set.intersection(*(set(c) for c in counts)):
        vectors[tuple(c[token] for c in counts)].add(token)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in vectors.values() if len(v) > 1)
    assert len(got) == 2 and sum(p is not None for p in parents.values()) == 1


def test_template_text_goes_inside_an_article(spark):
    page = "<html><body><article><h1>Title {0}</h1><p>own {0}</p><div class=x><p>Read our <b>letter</b></p></div><p>last {0}</p></article><p>foot</p></body></html>"
    rows = [(i, f"http://h/{i}", page.format(i)) for i in range(4)] + [(10 + i, f"http://two/{i}", page.format(i)) for i in range(2)]
    rows += [(20 + i, f"http://same/{i}", f"<title>{i}</title><p>x {i}</p><article><p>One text</p></article>") for i in range(3)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: f"Title {i}\nown {i}\nlast {i}" for i in range(4)}, **{10 + i: f"Title {i}\nown {i}\nRead our letter\nlast {i}" for i in range(2)},
                   **{20 + i: "One text" for i in range(3)}}


def test_marks_are_whole_names_and_keep_articles():
    art = "<article{}><p>Text</p></article>"
    kept = ["<main class='has-sidebar'><p>Text</p></main>", art.format(" class='post comments-open'"), "<div id=page class=no-banner>" + art.format("") + "</div>",
            "<div class='widget x'>menu" + art.format("") + "</div>", art.format(" class=social"), "<main class=banner>" + art.format("") + "</main>"]
    assert [extract(p, NONE) for p in kept] == ["Text"] * len(kept)
    gone = art.format("") + "<div class='area comments'><article class=c><p>Reader</p></article></div>"
    nested = "<article><p>Text</p><div class=related><article><p>Other</p></article></div><p class='x ad'>Buy</p></article>"
    assert extract(gone, NONE) == extract(nested, NONE) == "Text"
    assert extract("<div class='ad'>Buy</div><p id=footer>f</p><p>Text</p><aside>" + "x</aside>", NONE) == "Text"


def test_copies_of_a_page_are_no_template(spark):
    page = "<body><p>Whole text</p><p>of the page</p></body>"
    rows = [(i, f"http://copies/{i}", page) for i in range(5)] + [(10 + i, f"http://two/{i}", page + "<p>end</p>" * (i % 2)) for i in range(6)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = "Whole text\nof the page"
    assert got == {**{i: want for i in range(5)}, **{10 + i: want + "\nend" * (i % 2) for i in range(6)}}


def test_headings_that_all_pages_share_stay(spark):
    """Nothing of an article goes but whole wrappers that the template holds."""
    page = ("<body><article><h1>Title {0}</h1><h2>Summary</h2><p>short {0}</p><h2>Method</h2><p>The same first line.</p><div><h3>Data</h3><p>own {0}</p></div>"
            "<ul class=share><li><a href=x>Send</a></li><li><a href=y>Print</a></li></ul><section><div>Our letter: <p>every week</p></div></section></article></body>")
    rows = [(i, f"http://h/{i}", page.format(i)) for i in range(4)]
    # the list and the section are cut only where the host's template holds them: with two pages there is none
    rows += [(10 + i, f"http://two/{i}", page.format(i).replace("class=share", "")) for i in range(2)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    kept = "Title {0}\nSummary\nshort {0}\nMethod\nThe same first line.\nData\nown {0}"
    assert got == {**{i: kept.format(i) for i in range(4)}, **{10 + i: kept.format(i) + "\nSend\nPrint\nOur letter:\nevery week" for i in range(2)}}


def test_unclosed_and_deep_tags_are_linear(spark):
    import time
    import tracemalloc
    deep = "<article>" + "<div class=a>x" * 20_000
    tracemalloc.start()
    began = time.time()
    assert extract(deep, NONE).split("\n") == ["x"] * 20_000
    assert time.time() - began < 20 and tracemalloc.get_traced_memory()[1] < 60e6
    tracemalloc.stop()
    stray = "<div>" * 5_000 + "<b>" * 5_000 + "y</i>" * 20_000
    assert len(extract(stray, NONE)) == 20_000
    rows = [(i, f"http://d/{i}", "<article>" + "<div class=a>x" * 3_000 + f" own {i}") for i in range(3)]
    assert all(r.text.endswith(f"own {r.page_id}") for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())


def test_main_text_equals_a_plain_reading(spark):
    """All pages of a given table against another parser's text of their articles."""
    from html.parser import HTMLParser

    from test_pipeline import SF

    class Article(HTMLParser):
        gone = {"nav", "header", "footer", "aside", "form", "script", "style"}

        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.now, self.inside, self.skip = [], "", 0, 0

        def end_block(self):
            if self.now.split():
                self.out.append(" ".join(self.now.split()))
            self.now = ""

        def handle_starttag(self, tag, attrs):
            marks = dict(attrs).get("class") or ""
            if tag == "article":
                self.inside += 1
            self.skip += tag in self.gone or (bool(self.skip) and tag == "div") or (tag == "div" and marks in ("ad", "comments"))
            if tag == "br":
                self.now += " "
            elif tag not in ("b", "i", "a", "span", "em", "strong"):
                self.end_block()

        def handle_endtag(self, tag):
            if tag not in ("b", "i", "a", "span", "em", "strong"):
                self.end_block()
            if self.skip and (tag in self.gone or tag == "div"):
                self.skip -= 1
            if tag == "article":
                self.inside -= 1

        def handle_data(self, data):
            if self.inside and not self.skip:
                self.now += data

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {}
    for r in pages.collect():
        reader = Article()
        reader.feed(r.html or "")
        reader.end_block()
        want[r.page_id] = "\n".join(reader.out)
    got = {r.page_id: r.text for r in main_text(pages).collect()}
    assert got == want and sum(map(len, got.values())) > 1000
