"""Main text: parsing, the cut against enumeration, and whole pages."""

import itertools
import random
import time

import numpy as np

from medalyst.llm import html_mincut
from tests.llm.conftest import words

PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body><header class="site-header"><a href=/>Site name</a></header>
<nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies to make this site work well for you.</p></div>
<div id="content"><h1>Title &amp; story</h1><p>First para with <b>bold</b>word and&nbsp;stuff.<br>It goes on for a while, really.</p><ul><li>one point<li>two point</ul>
<aside class="sidebar"><p>Related story about something else entirely, long enough to look real.</p></aside><script>var t="</p>";</script>
<form><label>Mail</label><input><button>Go</button></form><p>Last a &lt; b &am</p></div>
<section class="comments"><p>Great article, I liked it a lot and so did my mother.</p></section><div class="ad">Buy this now, it is a very good thing.</div>
<footer><p>&copy; 2024 Site name, all rights.</p></footer></body></html>"""
WANTED = "Title & story\nFirst para with boldword and stuff. It goes on for a while, really.\none point\ntwo point\nLast a < b &am"


def test_whole_page():
    assert html_mincut.main_text(PAGE, html_mincut.PRIOR) == WANTED


def test_cut_is_least():
    rng = np.random.default_rng(4)
    for n in (1, 2, 5, 9):
        for _ in range(30):
            content, boiler = rng.random(n) * 3, rng.random(n) * 3
            edges = [(i, i + 1, float(rng.random() * 2)) for i in range(n - 1)] + [(0, n - 1, 0.7)] * (n > 2)

            def cost(side, content=content, boiler=boiler, edges=edges):
                return sum(boiler[i] if s else content[i] for i, s in enumerate(side)) + sum(w for a, b, w in edges if side[a] != side[b])

            found = html_mincut.least_cut(content, boiler, edges)
            assert abs(cost(found) - min(map(cost, itertools.product([False, True], repeat=n)))) < 1e-9


def test_broken_markup():
    for page in ("<p>one<p>two</div></span><li>x", "<p class='a\"b>t</p>", "a < b > c", "<!-- never closed", "<script>never closed", "<" * 500, "<p" * 500, "<div>" * 3000 + "deep",
                 "text<br>more", "<p>t" + " " * 10_000):
        html_mincut.main_text(page, html_mincut.PRIOR)
    assert [b.text() for b in html_mincut.blocks_of("<p>one<p>two</div><li>x<li>y &eacute;<br/>z")] == ["one", "two", "x", "y é z"]
    assert html_mincut.blocks_of("<head><title>t</title></head><p>b")[0].text() == "b"


def test_fit_keeps_marked_articles(spark):
    pages = [f"<nav><a>Home {i}</a></nav><article><p>Story number {i} tells of something.</p><div class='share'>Share this</div></article><div>Loose words {i}</div>" for i in range(20)]
    rows = [(i, f"u{i}", p, "t", 1) for i, p in enumerate(pages)] + [(30, None, None, "t", 1), (31, "u", "", "t", 1), (0, "u0", pages[0], "t", 1), (None, "n", PAGE, "t", 1)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, weights string, key int")
    found = html_mincut.extract(frame.select("page_id", "url", "html", "key")).collect()
    assert len(found) == len(rows)
    text = {r["page_id"]: r["text"] for r in found}
    assert text[3] == "Story number 3 tells of something." and text[30] == text[31] == "" and text[None] == WANTED
    assert html_mincut.extract(frame.limit(0)).collect() == []


def test_no_rare_blocks_are_dropped():
    page = "<article>" + "".join(f"<p>Paragraph {i} says something of its own.</p>" for i in range(3000)) + "</article>"
    assert html_mincut.main_text(page, html_mincut.PRIOR).count("\n") == 2999


def test_names_of_topics_and_tools_do_not_lose_the_article():
    body = "<h1>Title of it</h1><p>The first paragraph says something, and goes on.</p><p>So does the second one here.</p>"
    wanted = "Title of it\nThe first paragraph says something, and goes on.\nSo does the second one here."
    around = ("<nav class='main-nav'><a href=/>Home</a><a href=/b>Other page</a></nav>", "<div class='related-posts'><p>Read this other story about something else, too.</p></div>"
              "<div class='post-tags'><a href=/t>news</a></div><form class='search-form'><label>Find</label></form><footer>All rights are kept.</footer>")
    for start, end in (("<article class='post tag-news category-legal'>", "</article>"), ("<article class='legal'>", "</article>"), ("<main class='search'>", "</main>"),
                       ("<article class='form social alert'>", "</article>"), ("<div class='entry-content tag-side notice'>", "</div>"), ("<div class='post legal'>", "</div>"),
                       ("<div id='articleBody' class='has-sidebar with-comments'>", "</div>"), ("<section role='main' class='toc share'>", "</section>")):
        page = f"<html><body>{around[0]}{start}{body}<div class='comments'><article class='comment'><p>I liked this article a lot, dear author.</p></article></div>{end}{around[1]}</body></html>"
        assert html_mincut.main_text(page, html_mincut.PRIOR) == wanted, start
    assert html_mincut.named_part("div", ["context", "postal", "maintenance"], False) == 0


def test_recall_and_precision_of_planted_articles():
    rng = random.Random(8)
    articles = ["<article class='hentry post-{i} tag-legal category-search'>|</article>", "<div class='entry-content'>|</div>", "<main id='main-content'>|</main>", "<div class='page-wrap'><div class='story'>|</div></div>"]
    noise = ["<ul class='menu'><li><a href=/>{w}</a></li><li><a href=/x>{w}</a></li></ul>", "<div class='cookie-notice'><p>{w} {w}</p></div>", "<aside><p>{w}. {w}</p></aside>", "<div class='ad-slot'>{w}</div>",
             "<section class='comments-area'><article class='comment'><p>{w}. {w}.</p></article></section>", "<div class='social share-buttons'><a href=/s>{w}</a></div>", "<form><label>{w}</label></form>"]
    caught = kept = right = 0
    for i in range(80):
        lines = [words(rng.randrange(10**6), rng.randint(8, 60)) + "." for _ in range(rng.randint(2, 9))]
        junk = [rng.choice(noise).replace("{w}", words(rng.randrange(10**6), rng.randint(2, 14))) for _ in range(6)]
        start, end = rng.choice(articles).replace("{i}", str(i)).split("|")
        page = "<html><body>" + "".join(junk[:3]) + start + "".join(f"<p>{line}</p>" for line in lines) + end + "".join(junk[3:]) + "<footer>" + words(i, 9) + "</footer></body></html>"
        found = html_mincut.main_text(page, html_mincut.PRIOR).split("\n")
        right += len(set(found) & set(lines))
        caught, kept = caught + len(lines), kept + len(found)
    assert right / caught >= 0.99 and right / kept >= 0.99, (right / caught, right / kept)


def test_deeply_nested_elements():
    start = time.perf_counter()
    assert html_mincut.main_text("<div>" * 20_000 + "<p>Deep text.</p>" + "</span>" * 20_000, html_mincut.PRIOR) in ("Deep text.", "")
    assert len(html_mincut.blocks_of("".join(f"<div>line {i}" for i in range(20_000)))) == 20_000 and time.perf_counter() - start < 4
