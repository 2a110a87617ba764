"""Main text of pages: noise of any length stays out, articles stay in, and any markup is read in linear time."""

import math
import random
import time

import pytest

from tabloom.llm import html_text
from tabloom.llm.html_text import main_text

ARTICLE = "<p>" + "Plain words of the article itself. " * 8 + "</p>"
WANT = " ".join(("Plain words of the article itself. " * 8).split())
LONG = "<p>" + "Words that are not of the article at all. " * 60 + "</p>"

NOISE = [
    f'<div class="comments">{LONG}</div>', f'<section id="comments"><div class="comment">{LONG}</div><div class="comment">{LONG}</div></section>',
    f'<div class="sidebar">{LONG}</div>', f'<aside>{LONG}</aside>', f'<div class="cookie-notice">{LONG}</div>',
    f'<div role="alert">{LONG}</div>', f'<div class="comments-wrap"><ol><li class="comment">{LONG}</li></ol></div>',
    f'<ol class="comment-list"><li><article class="comment">{LONG}</article></li></ol>', f'<footer>{LONG}</footer>',
    f'<div class="related-posts">{LONG}</div>', f'<div hidden>{LONG}</div>', f'<form>{LONG}</form>',
]


@pytest.mark.parametrize("noise", NOISE)
@pytest.mark.parametrize("article", [ARTICLE, f"<article>{ARTICLE}</article>", f"<main>{ARTICLE}</main>", f'<div class="post">{ARTICLE}</div>'])
@pytest.mark.parametrize("first", [True, False])
def test_long_noise_never_replaces_or_joins_the_article(noise, article, first):
    page = f"<body>{noise}{article}</body>" if first else f"<body><nav><a href='/'>Home</a></nav><div>{article}{noise}</div></body>"
    assert main_text(page) == WANT


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "has-sidebar", "no-comments", "comments-open", "page with-sidebar"])
@pytest.mark.parametrize("inner", [f"<article>{ARTICLE}</article>", f"<main>{ARTICLE}</main>", ARTICLE])
def test_wrappers_called_like_noise_are_kept(name, inner):
    page = (f'<body><div class="{name}">{inner}<div class="sidebar">{LONG}</div></div>'
            '<div><p>Imprint</p></div></body>')  # fmt: skip
    assert main_text(page) == WANT


def test_marked_parts_are_looked_into_where_nothing_else_is():
    assert main_text('<body><div class="notice"><p>All there is</p></div></body>') == "All there is"
    assert main_text(f'<body><div class="widget">{ARTICLE}<div class="comments">{LONG}</div></div></body>') == WANT
    assert main_text(f'<body><div class="widget"><article>{ARTICLE}</article></div><p>Imprint</p></body>') == WANT


def twin(node):
    """(chars, tags, link chars, link tags) of a subtree, straight from their definitions."""
    chars = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
    tags = link_chars = link_tags = 0
    for p in node.parts:
        if not isinstance(p, str) and p.tag not in html_text.RAW:
            c, t, lc, lt = twin(p)
            chars, tags = chars + c, tags + t + 1
            link_chars, link_tags = link_chars + lc, link_tags + lt + (p.tag == "a")
    return (chars, tags, chars, tags) if node.link else (chars, tags, link_chars, link_tags)


def test_density_equals_its_definition():
    rng = random.Random(3)

    def part(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice(["some words ", "more of them here ", ""])
        tag = rng.choice(["div", "p", "a", "b", "ul", "script"])
        return f"<{tag}>" + "".join(part(depth - 1) for _ in range(rng.randrange(4))) + f"</{tag}>"

    for _ in range(60):
        body = html_text._body(html_text.parse("<body>" + "".join(part(4) for _ in range(4)) + "</body>"))
        order = html_text._order(body)
        html_text._mark(order, set())
        html_text._measure(order)
        html_text._weigh(order, body)
        total, _, linked, _ = twin(body)
        for node in order:
            c, t, lc, lt = twin(node)
            assert (c, t, lc, lt) == (node.chars, node.tags, node.link_chars, node.link_tags)
            if c:
                base = max(math.log(c / max(c - lc, 1) * lc + linked / max(total, 1) * c + math.e), 2)
                want = c / max(t, 1) * max(math.log(c / max(lc, 1) * max(t, 1) / max(lt, 1), base), 0)
                assert node.density == pytest.approx(want or (1e-9 * c if lc < c else 0))
            below = [p.density for p in node.parts if not isinstance(p, str) and p.tag not in html_text.RAW]
            assert node.total == pytest.approx(sum(below) or node.density)


@pytest.mark.parametrize("markup", ["<a ", "<div></b>", "<a \"'", "<a \"", "<!", "<b><div></div>", "<li><ul><b><li></li>", "<p", "<td><table><b><td>", "<" + "a" * 50])
def test_hostile_markup_takes_linear_time(markup):
    def seconds(n):
        began = time.process_time()
        html_text.parse(markup * (n // len(markup)))
        return time.process_time() - began

    seconds(10_000)
    assert seconds(1_000_000) < 8


@pytest.mark.parametrize("markup", ["<div>", "</b>"])
def test_deep_and_unopened_tags(markup):
    assert main_text("<body>" + markup * 100_000 + ARTICLE) == WANT


def test_tables(spark):
    kind = "page_id long, url string, html string, Text string"
    page = f"<body>{ARTICLE}</body>"
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (2, None, None, "x"), (None, "u", "", "x"), (3, "u", "<p>a" + " b" * 300_000, "x")]
    found = html_text.extract_main_text(spark.createDataFrame(rows, kind))
    assert found.columns == ["page_id", "url", "text"]
    texts = sorted((r["page_id"] or 0, r["text"][:20], len(r["text"])) for r in found.collect())
    assert texts == [(0, "", 0), (1, WANT[:20], len(WANT)), (1, WANT[:20], len(WANT)), (2, "", 0), (3, ("a" + " b" * 20)[:20], 600_001)]
    assert html_text.extract_main_text(spark.createDataFrame([], kind)).collect() == []
