import pytest

from haulback.llm.extract import Weights, best_run, extract_text, learn_weights, main_text

ARTICLE = (
    "<h1>Caf&eacute; &amp; tea</h1><p>One <b>two</b>\n three<p>Four&nbsp;five<br>six"
    "<aside>note</aside><div class='ad box'>buy <div>now</div></div><ul><li>a<li>b</ul>"
)
TEXT = "Café & tea\nOne two three\nFour five six\na\nb"


def page(article, i=0):
    return (
        "<!DOCTYPE html><html><head><title>T</title><script>var a='<p>no</p>';</script>"
        "<style>p{}</style></head><body><header>top</header><nav><ul><li><a href='/'>Home</a></ul></nav>"
        f"<!-- <p>hidden</p> --><div class='cookie-notice'>We use cookies</div><article>{article}"
        f"<form>name <input></form></article><section id='comments'><p>First!</p></section>"
        f"<p>loose {i}</p><footer>&copy; {i} rest of the page"
    )


def test_article_alone(spark):
    rows = [(i, None, page(ARTICLE if i % 2 else f"<p>Short {i}.</p>", i), 1) for i in range(40)]
    odd = [(100, "u", None, 2), (101, "u", "", 2), (102, "u", "no tags  at all", 2), (103, "u", page(""), 2)]
    long = "<p>" + "word " * 200_000 + "</p><p>end</p>"
    odd += [(104, "u", page(long), 2), (None, "u", page(ARTICLE), 2), rows[1]]
    pages = spark.createDataFrame(rows + odd, "page_id long, url string, html string, text long")
    weights = learn_weights(pages)
    assert weights.words[("inside", "p", False)] > 0 > weights.words[("outside", "p", False)]
    got = extract_text(pages, weights).collect()
    assert len(got) == len(rows) + len(odd)
    found = {r.page_id: r.text for r in got}
    assert all(found[i] == (TEXT if i % 2 else f"Short {i}.") for i in range(40))
    assert found[None] == TEXT and [found[100], found[101], found[103]] == ["", "", ""]
    assert found[102] == "no tags at all"
    assert found[104] == ("word " * 200_000).strip() + "\nend"
    assert all(r.n_chars == len(r.text) for r in got)
    assert extract_text(pages.limit(0), weights).count() == 0


def test_contexts_that_no_labelled_page_showed():
    weights = Weights({}, 0.01)
    page = "<p>before<article><p>In <a href=x>it</a></p><p><a href=y>All link</a></p></article><p>after"
    assert main_text(page, weights) == "In it\nAll link"
    assert main_text("<div><a>Home</a></div><div>Text here</div><div><a>Next</a></div>", weights) == "Text here"


def test_items_without_end_tags():
    weights = Weights({}, 0.01)
    listed = "<ul><li class='share'>x<ul><li>y<li>z</ul><li>kept<li class=ad>gone</ul><p>text"
    assert main_text(listed, weights) == "kept\ntext"
    table = "<table><tr><td class='sidebar'>x<table><tr><td>y</table><td>kept<tr class=ad><td>z</table>end"
    assert main_text(table, weights) == "kept\nend"
    assert main_text("<p class=notice>gone<p>kept<div class=ad>gone<div>gone</div></div>kept too", weights) == (
        "kept\nkept too"
    )


def test_best_run_against_all_runs():
    import itertools

    for scores in itertools.product([-2, -1, 1, 2], repeat=5):
        runs = [(a, b) for a in range(5) for b in range(a + 1, 6)]
        best = max(max(sum(scores[a:b]) for a, b in runs), 0)
        a, b = best_run(list(map(float, scores)))
        assert sum(scores[a:b]) == best


def test_links_score_against_a_page_without_marks():
    weights = Weights({("unmarked", "div", True): -4.0, ("unmarked", "p", False): 4.0}, 0.01)
    links = "<div><a>one</a></div><div><a>two</a></div>"
    assert main_text(f"{links}<p>Text here</p><p>and here</p>{links}", weights) == "Text here\nand here"


def test_embedded_elements_take_no_text_beyond_them():
    weights = Weights({}, 0.01)
    assert main_text("<p>a <svg width='1'/> b</p><p>c <svg><text>x</text></svg> d</p>", weights) == "a b\nc d"
    assert main_text("<p>a <video-player>b</video-player> <title-card>c</title-card> d</p>", weights) == "a b c d"
    assert main_text("<p>a <video src=x> b</p><p>c <canvas> d</p>", weights) == "a b\nc d"
    formula = "<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds</p>"
    assert main_text(formula, weights) == "so x=1 holds"
    assert main_text("<p>a<script>var b", weights) == "a"


def test_weights_come_from_the_pages_that_mark_an_article(spark):
    rows = [(i, "<div>no <p>mark</p></div>") for i in range(3000)] + [(5000 + i, page(ARTICLE, i)) for i in range(10)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    assert learn_weights(pages, sample=10) == learn_weights(pages.filter("page_id >= 5000"))


BODY = "<h1>Title</h1><p>One two three four five six seven eight nine ten.</p><p>More of it here, and more.</p>"
BODY_TEXT = "Title\nOne two three four five six seven eight nine ten.\nMore of it here, and more."


@pytest.mark.parametrize("page", [
    "<html><head><title>T</title><meta charset=x><body>" + BODY + "</body></html>",
    "<html><head><title>T</title><link rel=x>" + BODY,
    "<body><nav><ul><li><a href=/>Home</a></ul><article>" + BODY + "</article>",
    "<body><nav><a href=/>Home</a> " + BODY,
    "<body><form action=/find><article>" + BODY + "</article>",
    "<body><label>Find <article>" + BODY + "</article>",
    "<body><form id=aspnet><div>" + BODY + "</div><input type=hidden></form></body>",
    "<body><form id=aspnet><article>" + BODY + "</article></form></body>",
    *(f"<body><div {mark}><article>{BODY}</article></div></body>" for mark in (
        "class='ad-free'", "class=social-science", "class='page share-price'", "class=elementor-widget", "id='notice-of-motion'")),
    *(f"<body><div {mark}>{BODY}</div></body>" for mark in ("class='ad-free'", "id='notice-of-motion'")),
    "<body><article class='ad-free'>" + BODY + "</article></body>",
    "<div class=social-science><p>" + "</p><p>".join(BODY_TEXT.split("\n")) + "</p></div>",
    "<div class=elementor-widget><div class=ad-free><form><main>" + BODY + "<div class=share>Share it</div></main></form></div></div>",
])
def test_ordinary_pages_keep_their_article(page):
    """Missing end tags, pages in a form, and containers whose names only look like adverts."""
    assert main_text(page, Weights({}, 0.01)) == BODY_TEXT


@pytest.mark.parametrize("page", [
    "<nav><a>Home</a></nav><article>" + BODY + "<form>name <input></form></article><footer>&copy; x",
    "<article>" + BODY + "<div class='ad box'>buy <div>now</div></div></article><div class=comments><article class=comment>No!</article></div>",
    "<article>" + BODY + "</article><div class=related><h1>See</h1><article><p>other</p></article></div>",
    "<article>" + BODY + "</article><div class=sidebar><p>a note beside",
    "<header>top<nav>menu</nav></header><main>" + BODY + "</main><footer>bottom</footer>",
])
def test_other_elements_still_go(page):
    assert main_text(page, Weights({}, 0.01)) == BODY_TEXT


def test_nested_elements_without_ends_take_bounded_time():
    page = "<div class=ad-free><nav>" * 2000 + "<article>" + BODY + "</article>"
    main_text(page, Weights({}, 0.01))


@pytest.mark.parametrize("seed", range(5))
def test_runs_drop_blocks_outside_when_nothing_marks_them(seed):
    """Menus without any mark: the scan itself leaves their blocks out."""
    import random

    draw = random.Random(seed)
    weights = Weights({("unmarked", "div", True): -2.0, ("unmarked", "p", False): 1.0}, 0.01)
    dropped = 0
    for _ in range(40):
        menu = "".join(f"<div><a href=/{i}>Item {i}</a></div>" for i in range(draw.randint(1, 9)))
        text = [" ".join(draw.choices(["some", "words", "of", "text"], k=draw.randint(6, 30))) for _ in range(draw.randint(1, 6))]
        page = menu * draw.randint(0, 1) + "".join(f"<p>{t}</p>" for t in text) + menu
        assert main_text(page, weights) == "\n".join(text)
        dropped += 1
    assert dropped == 40
