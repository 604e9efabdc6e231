"""Main text of pages whose article is known."""

from __future__ import annotations

import random

import pytest

from riskloom.llm import wrappers

SCHEMA = "page_id long, url string, html string, host string, plan int, text int"


def page(r, style, n):
    words = lambda k: " ".join(r.choice(["alpha", "beta", "R&amp;D", "caf&eacute;", "x &lt; y", "&#8212;", "delta"]) for _ in range(k))
    paragraphs = [words(r.randrange(8, 40)) for _ in range(n)]
    title = words(5)
    body = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>\n" for p in paragraphs)
    extra = "<nav><ul><li><a href='/'>Home</a><li><a href='/n'>News</a></ul></nav>"
    comments = "<div id='comments'><p>" + words(30) + "</p><article class='comment'><p>me too " + words(5) + "</p></article></div>"
    if style == "article":
        html = f"<html><head><title>t</title><style>p{{}}</style></head><body><header><h2>Site</h2></header>{extra}<!-- <p>no</p> --><div class='ad'>Buy {words(3)}</div><article>{body}</article><aside>{words(9)}</aside>{comments}<footer>&copy; us</footer><script>var a='</p><p>no';</script></body></html>"
    elif style == "plain":
        html = f"<body><div class=top-header>Site name</div><div id=wrap>{extra}<div class='content main'>{body}<form><input><button>Send</button>Your name</form><div class='share-box'>Share it</div></div><div class='sidebar'><p>{words(12)}</p></div></div>{comments}<div class='cookie-notice'>We use cookies</div></body>"
    else:
        html = f"<table><tr><td class=menu><a href=x>{words(4)}</a><td>{body}<tr><td colspan=2 class=footer>{words(3)}</table>"
    text = [title, *paragraphs]
    for a, b in (("&amp;", "&"), ("&eacute;", "é"), ("&lt;", "<"), ("&#8212;", "—")):
        text = [t.replace(a, b) for t in text]
    return html, "\n\n".join(text)


@pytest.mark.parametrize("style", ["article", "plain", "table"])
def test_known_articles(spark, style):
    r = random.Random(7)
    pages = [page(r, style, r.randrange(1, 9)) for _ in range(25)]
    rows = [(i, f"https://u@Host{i % 2}.example:80/p/{i}?x", h, "x", 1, 2) for i, (h, _) in enumerate(pages)]
    got = wrappers.main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.page_id: r.text for r in got} == {i: t for i, (_, t) in enumerate(pages)}


@pytest.mark.parametrize(
    "html",
    [
        "<html><head><title>t</title><body><p>text</p>",
        "<html><head><title>t</title><p>text</p>",
        "<head><meta charset=utf-8><link rel=x href=y><script>a</script>\n text",
        "<head><noscript><style>a{}</style><body><p>text</p>",
        "<title>t</title><meta name=a><p>text",
        "<p>text<head><title>t</title></head>",
        "<html><head><title>t</title></head><p>text</p></body></html>",
    ],
)
def test_head_and_body_tags_left_out(html):
    assert wrappers.extract(html, None) == "text"
    assert wrappers.extract(html, {"path": []}) == "text"


def test_template_texts_inside_the_article(spark):
    """Text of the article stays, also where all pages of a host have it: being equal is no mark."""
    html = "<article><div><p>{}</p></div><section><p>Thanks for reading our fine pages</p></section></article>"
    rows = [(i, "http://one/", html.format(f"story {i} goes on"), "x", 1, 2) for i in range(5)]
    rows += [(10 + i, "http://two/", html.format("a story that all share"), "x", 1, 2) for i in range(5)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    thanks = "\n\nThanks for reading our fine pages"
    assert all(got[i] == f"story {i} goes on{thanks}" for i in range(5))
    assert all(got[10 + i] == f"a story that all share{thanks}" for i in range(5))


@pytest.mark.parametrize("n", [2, 3, 5])
def test_text_that_all_articles_share_stays(spark, n):
    recipe = "<article><h1>Dish {0}</h1><h2>Ingredients</h2><ul><li>salt<li>item {0}</ul><p>Serve warm.</p></article>"
    copies = "<article><h1>T{0}</h1><p>same body</p></article>"
    rows = [(i, "http://one/", recipe.format(i), "x", 1, 2) for i in range(n)]
    rows += [(10 + i, "http://two/", copies.format(i), "x", 1, 2) for i in range(n)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(n):
        assert got[i] == f"Dish {i}\n\nIngredients\n\nsalt\n\nitem {i}\n\nServe warm."
        assert got[10 + i] == f"T{i}\n\nsame body"


def test_edges(spark):
    deep = "<div>" * 3000 + "deep text" + "</div>" * 3000
    rows = [(1, None, None), (2, "", ""), (3, "no address", "just text\n here"), (4, "http://h/", deep), (5, "http://h/", "<p>open <b>bold<p>next<br>line &am &amp"), (6, "http://h/", "<article><p>cut off in the mid"), (None, "http://h/", "<p>x</p>"), (7, "http://long/", "<p>word " * 60_000), (8, "http://h/", "<script>never closed <p>x"), (9, "http://h/", "</div></p><p a='<'>odd</p><"), (3, "no address", "just text\n here")]
    got = wrappers.main_text(spark.createDataFrame([(*x, "x", 1, 2) for x in rows], SCHEMA)).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert text[1] == text[2] == text[8] == ""
    assert text[3] == "just text here" and text[4] == "deep text"
    assert text[5] == "open bold\n\nnext line &am &"
    assert text[6] == "cut off in the mid" and text[None] == "x"
    assert text[7].count("word") == 60_000
    assert text[9].startswith("odd")
    assert {r.page_id: r.url for r in got} == {i: u for i, u, _ in rows}


def test_join_instead_of_broadcast(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "BROADCAST_BYTES", -1)
    rows = [(i, f"http://h{i}/", f"<p>text {i}</p>", "x", 1, 2) for i in range(9)]
    got = wrappers.main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.page_id: r.text for r in got} == {i: f"text {i}" for i in range(9)}


def test_empty(spark):
    assert wrappers.main_text(spark.createDataFrame([], SCHEMA)).collect() == []


def test_wrapper_is_a_union_free_expression():
    one = wrappers.wrapper(wrappers.parse("<div><h1>A</h1><p>x</p><p>y</p></div><div class=z>Same</div>"))
    two = wrappers.wrapper(wrappers.parse("<div><h1>B</h1><p>x</p><h2>more</h2></div><div class=z>Same</div>"))
    found = wrappers.merge(one, two).expression()
    assert found == "<html><div><h1>#</>(<p>#</>)+(<h2>more</>)?</><div.z>Same</></>"


def test_pages_of_the_test_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = wrappers.main_text(pages).collect()
    assert len(got) == pages.count()
    assert all(r.text and "track(" not in r.text and "©" not in r.text for r in got)
