import html
import re

import pytest

from barframe.llm import htmltext


def texts(page):
    return [b.text for b in htmltext.blocks(page)]


def test_blocks():
    assert texts("<p>a<b>b</b>c<br>d\n  e</p>tail") == ["abc d e", "tail"]
    assert texts("<p>one<p><b>two<br><p>three") == ["one", "two", "three"]
    assert texts("x &amp; y &#8217;&ndash;&nosuch; &lt;p&gt;") == ["x & y ’–&nosuch; <p>"]
    assert texts("<script>var t='</p>'; <b></script><style>p{}</style><!-- <p>no</p> -->yes<!-- open") == ["yes"]
    assert texts('<a title="x>y" href=\'>\'>link</a> after') == ["link after"]
    assert texts("a < b <3 c <") == ["a < b <3 c <"]
    assert texts("<ul><li>1<li>2<ul><li>3</ul></ul><td>x") == ["1", "2", "3", "x"]
    assert texts("") == texts("   ") == texts("<p></p><div> </div>") == []


def test_paths():
    found = htmltext.blocks('<body><div class="Side-Bar wide" id=top><p>x</div><main><p>y</main></bogus><section>z</section>')
    assert [b.path for b in found] == [("body", "div", ".side", ".bar", ".wide", "#top", "p"), ("body", "main", "p"), ("body", "section")]
    assert htmltext.blocks("<nav><a>abc</a></nav>")[0].linked == 3


def test_broken_pages_stay_linear():
    for page in ('<a "' * 20_000, "<" * 200_000, "<!--" * 50_000, "<p " * 50_000, "<div>" * 5_000 + "x", "<script>" * 20_000, "</p>" * 20_000):
        htmltext.blocks(page)


@pytest.fixture(scope="module")
def labeller(spark):
    return htmltext.fit_labeller(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_composed_pages_it_never_saw(labeller, words):
    composer = htmltext.Composer(words(1, 500), seed=123)
    right = total = 0
    for _ in range(200):
        page, said = composer.compose()
        found = htmltext.blocks(page)
        marks = labeller.label([found])[0]
        right += sum(bool(m) == (b.text in said) for b, m in zip(found, marks, strict=True))
        total += len(found)
    assert right / total > 0.95


def page_of(c, inner):
    menu = "".join(f'<li><a href="/{i}">{c.some(1, 2)}</a></li>' for i in range(3))
    return f"<html><head><title>{c.some(2, 5)}</title></head><body><nav><ul>{menu}</ul></nav><article>{inner}</article><footer><p>{c.sentence(1, 2)}</p></footer></body></html>"


INSIDE = {
    "p": lambda c: "",
    "ul": lambda c: "<ul>" + "".join(f"<li>{c.some(3, 10)}</li>" for _ in range(3)) + "</ul>",
    "ol": lambda c: "<ol>" + "".join(f"<li>{c.some(3, 10)}</li>" for _ in range(3)) + "</ol>",
    "h4": lambda c: f"<h4>{c.some(2, 6)}</h4>",
    "h6": lambda c: f"<h6>{c.some(2, 6)}</h6>",
    "dl": lambda c: f"<dl><dt>{c.some(1, 3)}</dt><dd>{c.sentence(1, 2)}</dd><dt>{c.some(1, 3)}</dt><dd>{c.sentence(1, 2)}</dd></dl>",
    "pre": lambda c: f"<pre>{c.some(5, 20)}</pre>",
    "figure": lambda c: f"<figure><img src=x><figcaption>{c.some(4, 10)}</figcaption></figure>",
    "section": lambda c: f"<section><h3>{c.some(2, 5)}</h3><p>{c.sentence(1, 3)}</p></section>",
    "table": lambda c: f"<table><tr><td>{c.some(1, 3)}</td><td>{c.some(1, 3)}</td></tr></table>",
    "header": None,
    "short": lambda c: f"<p>{c.some(1, 2).capitalize()}.</p>" * 8,
}


@pytest.mark.parametrize("kind", INSIDE)
def test_articles_of_all_kinds_stay_whole(labeller, words, kind):
    c, lossy = htmltext.Composer(words(2, 400), seed=77), 0
    for _ in range(100):
        title, paragraphs = f"<h1>{c.some(3, 8)}</h1>", [f"<p>{c.sentence(2, 4)}</p>" for _ in range(3)]
        inner = f"<header>{title}</header>{''.join(paragraphs)}" if kind == "header" else title + paragraphs[0] + INSIDE[kind](c) + "".join(paragraphs[1:])
        found = htmltext.blocks(page_of(c, inner))
        lossy += labeller.label([found])[0].tolist() != ["article" in b.path for b in found]
    assert lossy <= 1


def test_the_sample_is_of_whole_pages_and_small(spark):
    pages = spark.range(3000).selectExpr("concat('<p>first ', id, '</p>', repeat('<p>middle</p>', 300), '<p>last', id, '</p>') as html")
    seen = []
    original = htmltext.training_set
    htmltext.training_set = lambda words, n=0: seen.append(words) or original(words, 5)
    try:
        htmltext.fit_labeller(pages, sample_pages=50)
    finally:
        htmltext.training_set = original
    assert 20 < sum(w.startswith("last") for w in seen[0]) <= 100 and "middle" in seen[0]


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<(?:/?(?:p|h1)|br)>", " ", re.sub(r"</?b>", "", inner))).split())


def test_articles_of_the_table(spark, labeller):
    got = htmltext.extract(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"), labeller).collect()
    right = sum(r["text"] == article(r["html"]) for r in got)
    assert right >= 0.98 * len(got)
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_odd_pages(spark, labeller):
    long = "<article><h1>Title</h1>" + "<p>Some words stand here, and more.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (2, None, ""), (None, "u", "<nav><a>menu</a></nav>"), (3, "u", "just some text"), (4, "u", long), (5, "u", "\x00<p>퟿</p>")]
    df = spark.createDataFrame([(*r, "old", 1) for r in rows], "page_id long, url string, html string, Text string, kept int")
    got = htmltext.extract(df, labeller, kept="kept")
    assert got.columns == ["page_id", "url", "html", "text", "n_chars", "kept"]
    by = {r["page_id"]: r for r in got.collect()}
    assert by[1]["text"] == by[2]["text"] == "" and by[1]["n_chars"] == 0
    assert by[4]["text"].count("Some words stand here") == 20_000
    assert got.count() == len(rows)
    assert htmltext.extract(df.limit(0), labeller).count() == 0


def test_no_pages_to_learn_from(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    page = "<nav><a href='/'>w1 w2</a></nav><article><h1>w3 w4 w5</h1><p>W6 w7 w8 w9. W1 w2 w3 w4, w5 w6.</p></article><footer>w9 w8</footer>"
    marks = htmltext.fit_labeller(none).label([htmltext.blocks(page)])[0]
    assert marks.tolist() == [False, True, True, False]
