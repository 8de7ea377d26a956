"""Pages whose scripts, heads or left-out elements do not end as they should keep their article."""

import time

import pytest

from quillrank.llm import html_tree

ARTICLE = "<article><h1>On stones</h1><p>Stones lie in the field, and nobody carries them away, they said.</p></article>"
TEXT = "On stones\n\nStones lie in the field, and nobody carries them away, they said."


@pytest.mark.parametrize("page", [
    f"<body><script>for(var i=0;i<n;i++){{f(i)}}</script>{ARTICLE}</body>",
    f"<body><SCRIPT>if (a<b && c) x='</p><div>'</SCRIPT >{ARTICLE}<script>y</script></body>",
    f"<body><style>a<b{{}}</style>{ARTICLE}</body>",
    f"<body><div><textarea>one <b </textarea></div>{ARTICLE}</body>",
    f"<html><head><title>On <p> tags</title><meta charset=x><body>{ARTICLE}",
    f"<html><head><title>T</title><script>document.write('<div>')</script>{ARTICLE}</html>",
    f"<html><head><title>T</title></head><body>{ARTICLE}</body></html>",
    f"<head><title>T<body>{ARTICLE}",
    f"<head><script>a<b</head><body>{ARTICLE}",
    f"<div><script>a<b</div>{ARTICLE}",
    *(f"<body><div><{name}>Ok</div>{ARTICLE}</body>" for name in "button select textarea svg object template canvas iframe".split()),
    *(f"<body><{name}>Ok{ARTICLE}<div><{name}>No</{name}></div></body>" for name in "button select svg object template".split()),
    f"<body><svg><svg><p>no</p></svg><p>no</p></svg><object><div>no</div></object>{ARTICLE}</body>",
])
def test_article_survives(page):
    nodes = html_tree.parse(page)
    seen = [" ".join("".join(text for _, text in node.texts).split()) for node in nodes]
    assert [text for text in seen if text] == TEXT.split("\n\n")
    assert html_tree.extract(page, html_tree.default_model()) == TEXT


def test_text_outside_every_block_is_kept_by_its_marginal():
    model = html_tree.default_model()
    words = "Stones lie in the field, and <b>nobody</b> carries them away, they said."
    assert html_tree.extract(words, model) == "Stones lie in the field, and nobody carries them away, they said."
    never = html_tree.TreeModel({"tag page": -9.0}, [[0.0, 0.0], [0.0, 0.0]])
    assert html_tree.extract(words, never) == ""


def test_many_unclosed_elements_take_linear_time():
    page = "<div><button><script><object>a<textarea><svg>" * 20_000
    assert len(html_tree.parse(page)) >= 1
    page = "<div><script>a<b</div>" * 20_000
    assert len(html_tree.parse(page)) == 20_001
    page = "<div><button>a<object><p>x" * 20_000
    assert len(html_tree.parse(page)) == 40_001


def shown(page):
    nodes = html_tree.parse(page)
    return [" ".join(text.split()) for text in ("".join(text for _, text in node.texts) for node in nodes) if text.strip()]


def test_comments_end_as_browsers_end_them():
    inner = "<p>one</p>{}<p>two</p><!-- x --><p>three</p>"
    for comment in ("<!-->", "<!--->", "<!---->", "<!-- a --!>", "<!-- > <p>no</p> -->", "<!doctype html>", "<?php x ?>"):
        assert shown(inner.format(comment)) == ["one", "two", "three"], comment
    assert shown("<p>one</p><!-- never closed <p>two</p>\n") == ["one"]


def test_tags_end_outside_quotes_and_unended_ones_are_text():
    assert shown("<p title='a > b' class=\"c > d\">one</p>") == ["one"]
    assert shown("<p>a < b and c<d") == ["a < b and c<d"]
    assert shown("<p>one <b title=\"never closed>two") == ["one <b title=\"never closed>two"]
    assert shown("<p>one <b title=\"never closed <i>two</i>") == ["one <b title=\"never closed two"]
    assert shown("<p>5 <!6 <7") == ["5 <!6 <7"]


@pytest.mark.parametrize("depth", [10, 390, 410, 20_000])
def test_depth_changes_nothing(depth):
    menu = '<ul class="menu nav"><li><a href=x>Home</a></li></ul>'
    page = f"<body>{'<div>' * depth}{menu}{ARTICLE}{'</div>' * depth}</body>"
    nodes = html_tree.parse(page)
    li = next(i for i, node in enumerate(nodes) if node.tag == "li")
    assert nodes[nodes[li].parent].tag == "ul" and html_tree.extract(page, html_tree.default_model()) == TEXT


@pytest.mark.parametrize("piece", [
    "</i x", '<a "', "<a ", "<a b='", "<!", "<?x '", "<a<a<a", "<a<b \"'", "<a \"'<b '\"", "<div>", "</p><div>", "<!--", "<p><div></b>",
])
def test_long_pages_of_broken_tags_take_linear_time(piece):
    def seconds(size, end):
        page = piece * (size // len(piece)) + end
        start = time.process_time()
        html_tree.parse(page)
        return time.process_time() - start

    for end in ("", ">", '">', "'>"):
        assert seconds(1_000_000, end) < 10  # minutes, if each tag looked through the rest of the page
