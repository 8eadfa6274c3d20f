"""Messages on the tree against all labelings, what names say, and pages that are hard to parse."""

import random
import time
from itertools import product
from math import exp

import pytest

from dailypanel.llm import page_text as P

MODEL = P.Model({})
SENTENCE = "The council met on Tuesday and agreed, after some debate, on a plan for the old harbour that everyone had asked for. "


@pytest.mark.parametrize("seed", range(25))
def test_marginals_are_those_of_all_labelings(seed):
    r = random.Random(seed)

    def some(depth):
        out = ""
        for _ in range(r.randint(1, 2)):
            tag = r.choice(["div", "section", "p", "ul", "h2", "article"])
            inside = some(depth - 1) if depth and tag in ("div", "section", "article") else r.choice(["", "Menu", "<a href=x>One two three</a>", SENTENCE, SENTENCE * 4])
            out += f"<{tag}>{inside}</{tag}>"
        return out

    nodes, _ = P.parse(some(2))
    assert not any(P.against(x) for x in nodes)
    if len(nodes) > 11:
        nodes = nodes[:11]
    seen = P.features(nodes)
    total, yes = 0.0, [0.0] * len(nodes)
    for labels in product((0, 1), repeat=len(nodes)):
        weight = 1.0
        for k, y in enumerate(labels):
            weight *= exp(sum(MODEL.own[name, v][y] for name, v in zip(P.NAMES, seen[k])))
            if k:
                up = nodes[k].parent
                weight *= MODEL.step[labels[up], P.kind(nodes[up])][y]
        total += weight
        for k, y in enumerate(labels):
            yes[k] += weight * y
    assert MODEL.marginals(nodes) == pytest.approx([y / total for y in yes], abs=1e-9)


@pytest.mark.parametrize("names", ["content has-sidebar", "article-body subscriber-content", "post alert-free", "entry-content notice-board", "post-body also-available"])
@pytest.mark.parametrize("paragraphs", [1, 3, 6, 10, 20])
def test_a_word_inside_a_name_is_no_veto(names, paragraphs):
    page = f"<html><body><nav><a href=x>Home</a></nav><header><h1>Title</h1></header><div class='{names}'>" + f"<p>{SENTENCE}</p>" * paragraphs + "</div><footer>Firm</footer></body></html>"
    assert MODEL.extract(page).count("The council met") == paragraphs


@pytest.mark.parametrize("part", ['<section id="discussion">{}</section>', '<div class="text-alert">{}</div>', '<div class="social-sciences">{}</div>', '<h2 id="related-work">{}</h2>', '<h2 id="follow-up">{}</h2>'])
def test_parts_of_an_article_with_odd_names_stay(part):
    page = f"<html><body><article><h1>Title</h1><p>{SENTENCE}</p>" + part.format(f"<p>{SENTENCE}odd</p>" if "h2" not in part else "odd heading") + f"<p>{SENTENCE}</p></article></body></html>"
    assert "odd" in MODEL.extract(page)


@pytest.mark.parametrize("said,cue", [
    ('class="sidebar"', "side"), ('class="left-sidebar-2"', "side"), ('id="comments" class="content-area"', "comment"), ('class="post-comments"', "comment"), ('class="cookieNotice"', "notice"),
    ('role="navigation"', "menu"), ('class="entry-footer"', "foot"), ('class="content sidebar-left"', "main"), ('class="has-sidebar"', "none"), ('class="ad"', "ad"), ("class=text", "main"), ("", "none"), ('class="shadow"', "none")])
def test_names(said, cue):
    assert P.cue_of(" " + said) == cue


@pytest.mark.parametrize("page", ["<div>" * 16_000, "<b>" * 8_000 + "<p>x" * 8_000, "<b><p>x" * 16_000, "<li>x" * 16_000, "<table><tr><td>" * 5_000, "</i>" * 16_000 + "<div></p>" * 16_000])
def test_deep_and_broken_pages_take_linear_time(page):
    start = time.perf_counter()
    MODEL.extract(page)
    assert time.perf_counter() - start < 2.0
