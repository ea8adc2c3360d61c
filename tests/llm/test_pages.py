"""Pages that only the template or only careful reading gets right, and pages that are malformed and long."""

import time

import pytest
from pyspark.sql import functions as F

from tessera.llm.op07_template_extract import extracted, main_text, parsed

NAMES = ["alpha", "beta", "gamma", "delta", "epsilon"]


def texts_of(spark, pages):
    rows = spark.createDataFrame([(i, None if u is None else u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in extracted(rows).orderBy("page_id").collect()]


def test_class_names_never_take_an_article():
    assert main_text("<article class='post comment-enabled'><h1>T</h1><p>a</p></article>") == "T\n\na"
    assert main_text("<main class='comment'><p>all there is</p></main>") == "all there is"
    assert main_text("<article><p>text</p><article class='comment'><p>nice</p></article></article>") == "text"
    assert main_text("<article><p>text</p></article><article class='user-comment'><p>nice</p></article>") == "text"
    assert main_text("<section class='comments'><article><p>nice</p></article></section><article><p>text</p></article>") == "text"


def test_names_that_only_hold_such_a_word_stay():
    page = "<div class='share-price-table'>prices</div><div class='banner-history'>past</div><div class='site-nav menu-2'>Menu</div><div id='cookie_notice'>Cookies</div><p>end</p>"
    assert main_text(page) == "prices\n\npast\n\nend"
    assert main_text("<header>Site</header><p>a</p><footer>f</footer><div hidden>x</div><p aria-hidden=true>y</p>") == "a"


RECIPE = "<html><body><div>Kitchen</div><article><h1>{0}</h1><h2>Ingredients</h2><p>Two {0}</p><h2>Method</h2><p>Boil the {0}</p><dl><dt>Time</dt><dd>{1} minutes</dd></dl><p>Rate this on our site</p><h3>More of this</h3></article></body></html>"


def test_headings_that_a_host_repeats_stay(spark):
    got = texts_of(spark, [(f"http://k.example/{n}", RECIPE.format(n, i)) for i, n in enumerate(NAMES)])
    assert got == [f"{n}\n\nIngredients\n\nTwo {n}\n\nMethod\n\nBoil the {n}\n\nTime\n\n{i} minutes" for i, n in enumerate(NAMES)]


PLAIN = "<html><body><div class='x1'><span>Home</span> <span>About us</span></div><div class='x2'><h2>Popular</h2><div>Ten tips</div></div><div class='x3'><h1>{0}</h1><h2>Story</h2><p>It began with {0}.</p></div><div class='x4'>All of it since 1999</div></body></html>"


def test_only_the_template_tells_on_pages_without_names(spark):
    got = texts_of(spark, [(f"http://p.example/{n}", PLAIN.format(n)) for n in NAMES])
    assert got == [f"{n}\n\nStory\n\nIt began with {n}." for n in NAMES]
    assert main_text(PLAIN.format("alpha")) != got[0]  # without a template the frame stays


def test_articles_without_a_slot_stay_whole(spark):
    body = "<article><p>One</p><p>Two</p></article><p>{0}</p>"
    assert texts_of(spark, [(None, body.format(i)) for i in range(4)]) == ["One\n\nTwo"] * 4


@pytest.mark.parametrize("page", ["<a " * 300_000, "<a " * 300_000 + ">", "<b>" * 100_000 + "</i>" * 100_000, "<div>" * 100_000 + "x", "<b>" * 100_000 + "<hr>" * 100_000, "<p>" * 200_000, '<a x="' * 150_000 + "'>", "<a x='\"" * 100_000 + ">\"", "<!--" * 200_000, "<" * 500_000 + ">", "<script" * 100_000 + ">", "&" * 500_000, "=" * 300_000 + "<a =" + "= " * 300_000, "</p>" * 200_000, "<svg>" * 200_000])
def test_long_malformed_pages_take_seconds(page):
    began = time.process_time()
    main_text(page + "<p>end</p>")
    assert time.process_time() - began < 8


def test_paths_do_not_grow_with_depth():
    places = [p for kind, _, p in parsed("<div>" * 3000 + "x") if kind == "text"]
    assert isinstance(places[0].path, int) and places[0].path < 1 << 64


def test_text_after_what_does_not_close_stays():
    assert main_text("<p>a</p><svg><g></p><p>b</p>") == "a"  # all that is in it goes
    assert main_text("<p>a</p><svg><g>x</g></svg><p>b</p>") == "a\n\nb"
    assert main_text('<p title="x>a</p><p>b</p>') == "a\n\nb"
    assert main_text("<p>1 < 2 and 3 > 2</p>") == "1 < 2 and 3 > 2"
    assert main_text("<p>a<noscript>n</noscript>b</p><!-- <p>c</p> --><p>d<!-->") == "ab\n\nd"


def test_odd_rows_of_pages(spark):
    rows = spark.createDataFrame([(None, None, None), (1, None, "<p>a"), (1, None, "<p>a"), (2, "", " "), (3, "no url", "é" * 200_000)], "page_id long, url string, html string")
    got = extracted(rows.withColumn("tokens", F.lit(1)).withColumn("text", F.lit("clash"))).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 1), (1, 1), (2, 0), (3, 200_000)]
    assert extracted(rows.limit(0)).count() == 0
