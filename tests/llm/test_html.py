import random

import pytest
from small import text

from costwatch.llm import html

SCHEMA = "page_id long, url string, html string"


def read(page):
    elements = html.parse(page)
    html.digests(elements)
    return html.blocks(elements)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", []),
        ("plain &amp; text\n\nhere", ["plain & text here"]),
        ("<p>one<p>two <b>bold</b>er<br>line", ["one", "two bolder line"]),
        ("<article><h1>A</h1><p><b>x<br><p>y</article><footer>f</footer>", ["A", "x", "y"]),
        ("<body><script>var t='</p><p>';</script><style>p{}</style><!-- c <p> -->a</body>", ["a"]),
        ("<nav>m</nav><header>h</header><main><header><h1>t</h1></header>a<aside>s</aside></main>", ["t", "a"]),
        ("<div class='cookie-notice'>c</div><div id=comments><p>c</p></div><p>k", ["k"]),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>d", ["a", "b", "c", "d"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
        ("a<form>x<input>y</form>b<div hidden>h</div><p style='display: none'>n</p>", ["a", "b"]),
        ("<article>&eacute;&#233;&#xe9; &lt;p&gt; &nbsp; z &unknown; &am</article>", ["ééé <p> z &unknown; &am"]),
        ("<article><p>cut off in a <a href='x", ["cut off in a"]),
        ("<p title=\"a>b\">q</p><a href='it's>r</a>", ["q", "r"]),
        ("<article><div class=ad>x</div>a</article><article>b</article><p>out", ["a", "b"]),
        ("</p></div>a</b><i>b", ["ab"]),
        ("<section class='reader comments'><p>c</p></section><h2>t</h2>", ["t"]),
    ],
)
def test_blocks(page, want):
    assert read(page) == want


def test_deep_nesting_and_long_pages():
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    assert read(deep) == ["x"]
    assert read("<p>" + "y " * 200_000) == [" ".join(["y"] * 200_000)]


def site(rng, n, host, notice, with_article):
    rows = []
    for i in range(n):
        own = f"<p>{text(rng, 12)}</p><p>{text(rng, 9)}</p>"
        shared = "<p>a line that all authors write</p>" if i % 2 else ""
        body = f"{own}{shared}"
        body = f"<article>{body}<div>{notice}</div></article>" if with_article else f"<div>{body}</div>"
        rows.append((f"https://{host}/p/{i}", f"<body><div><span>{notice}</span></div>{body}<div>{notice} end</div></body>"))
    return rows


def test_templates_by_host(spark):
    rng = random.Random(3)
    notice = "we value your privacy"
    rows = site(rng, 12, "a.example", notice, True) + site(rng, 12, "b.example", notice, False)
    rows += site(rng, 3, "c.example", notice, False)
    copies = [(f"https://a.example/copy/{i}", rows[1][1]) for i in range(30)]
    pages = [(i, *r) for i, r in enumerate(rows + copies)]
    out = {r["page_id"]: r for r in html.extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert len(out) == len(pages)
    for i, url, _ in pages:
        lines = out[i]["text"].split("\n")
        assert out[i]["n_chars"] == len(out[i]["text"]) and out[i]["url"] == url
        if "c.example" in url:  # too few pages to tell
            assert notice in lines
            continue
        assert notice not in out[i]["text"]
        # Repeated lines stay in an article; elsewhere nothing tells them from the template.
        assert len(lines) == (3 if i % 2 and "a.example" in url and i < 12 or i >= 27 else 2)


def test_hard_rows(spark):
    pages = [(1, None, None), (None, "", ""), (2, "no url at all", "<p>x"), (2, "no url at all", "<p>x"),
             (3, "http://user@H.example:80/?q", "<nav>only</nav>"), (4, None, "\x00<p>\x00</p>")]
    frame = spark.createDataFrame(pages, SCHEMA).selectExpr("*", "url AS host", "html AS text", "page_id AS subtrees")
    out = html.extract(frame).collect()
    assert sorted((str(r["page_id"]), r["text"]) for r in out) == sorted(
        [("1", ""), ("None", ""), ("2", "x"), ("2", "x"), ("3", ""), ("4", "\x00\n\x00")]
    )
    assert html.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_notices_as_paragraphs_of_articles(spark):
    rng = random.Random(5)
    notice, advert, line = "sign up for our letter", "buy now", "the end"
    rows = []
    for i in range(20):
        own = [text(rng, 12) for _ in range(8)]
        many = [line] if i % 2 else []
        body = [advert, *own[:4], notice if i < 8 else own[4], *own[5:], *many, notice]
        rows.append((i, f"http://a.example/{i}", "<article>" + "".join(f"<p>{x}</p>" for x in body) + "</article>"))
        rows.append((100 + i, f"http://b.example/{i}", f"<article><p>near copy</p><p>{'same ' * 30}</p><p>{i}</p></article>"))
    out = {r["page_id"]: r["text"].split("\n") for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(20):
        assert advert not in out[i] and out[i][-1] != notice
        assert (notice in out[i]) == (i < 8)  # in the middle an author may have written it
        assert (line in out[i]) == (i % 2 == 1)
        assert len(out[i]) == 8 + i % 2
        assert len(out[100 + i]) == 3


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<div class='layout has-sidebar'><article><p>a</article><div class=sidebar>s</div></div>", ["a"]),
        ("<div class='content-sidebar-wrap'><main><p>a</main></div><p>long text that is outside of it", ["a"]),
        ("<div class='no-sidebar'><div id='page-menu-open'><p>all the text is here</div></div>", ["all the text is here"]),
        ("<form><input><article><p>own text<form>search</form></article></form>", ["own text"]),
        ("<div role=form><article>a</article></div>", ["a"]),
        ("<form action=/>the whole page stands in a form<select><option>o</select></form><p>end", ["the whole page stands in a form", "end"]),
        ("<div class='has-sidebar'><article>own text</article><div class=related><article>teaser</article></div></div>", ["own text"]),
        ("<article>own text</article><div class=comments><article>c</article></div>", ["own text"]),
        ("<article><div class='text has-widgets'><p>own text</p><div class=ad>x</div></div></article>", ["own text"]),
        ("<div class=menu hidden><article>a</article></div><p>b", ["b"]),
    ],
)
def test_wrappers_with_names(page, want):
    assert read(page) == want


def test_recurring_wrappers_go_by_their_count(spark):
    rows = [(i, f"http://a.example/{i}", f"<div class=notice>we value your privacy, all of you</div><p>{i}") for i in range(9)]
    out = html.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["page_id"], r["text"]) for r in out) == [(i, str(i)) for i in range(9)]


def by_id(spark, rows):
    return {r["page_id"]: r["text"].split("\n") for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}


@pytest.mark.parametrize(
    "part",
    [
        "<section class='menu-planning'>own words</section>",
        "<div class='social-history share-prices'>own words</div>",
        "<section class=related-work><p>own words</p></section>",
        "<div class=widget-theory id=ads2go-history>own words</div>",
        "<h2 id=related-work>own words</h2>",
        "<p id=notice-1>own words</p>",
        "<li class='comment'>own words</li>",
    ],
)
def test_names_inside_articles_that_mean_something_else(part):
    assert read(f"<article><p>a first long paragraph of the text</p>{part}<p>end</article>") == [
        "a first long paragraph of the text", "own words", "end"
    ]


def test_names_inside_articles_go_by_their_count(spark):
    rng = random.Random(7)
    rows = []
    for i in range(12):
        body = f"<p>{text(rng, 30)}</p><p>{text(rng, 20)}</p>"
        reader = f"<div class=comments id=c{i}><div>reader {text(rng, 5)}</div></div>"
        once = f"<div class=menu>soup and {text(rng, 3)}</div>" if i == 4 else ""
        rows.append((i, f"http://a.example/{i}", f"<article>{body}{once}{reader}</article>"))
        few = f"<article>{body}<div class=menu>soup</div></article>" if i < 3 else f"<article>{body}</article>"
        rows.append((100 + i, f"http://{'b' if i < 4 else 'c'}.example/{i}", few))
    out = by_id(spark, rows)
    for i in range(12):
        assert not any("reader" in line for line in out[i])  # other words on each page
        assert len(out[i]) == (3 if i == 4 else 2)
        assert len(out[100 + i]) == 2  # too few articles to tell, so the name decides


@pytest.mark.parametrize("copies", [6, 60])
def test_near_copies_on_pages_without_an_article_element(spark, copies):
    rng = random.Random(8)
    story = [text(rng, rng.randint(15, 25)) for _ in range(7)]
    rows = []
    for i in range(copies):
        lines = [*story[: i % 7], text(rng, 20), *story[i % 7 + 1 :]]
        rows.append((i, f"http://a.example/{i}", "<body>" + "".join(f"<p>{x}</p>" for x in lines) + "</body>"))
    for i in range(20):
        own = "".join(f"<p>{text(rng, 20)}</p>" for _ in range(4))
        rows.append((1000 + i, f"http://b.example/{i}", f"<body><p>our privacy policy has changed</p><div>{own}</div></body>"))
    out = by_id(spark, rows)
    assert all(len(out[i]) == 7 for i in range(copies))
    assert all(len(out[1000 + i]) == 4 for i in range(20))
