import html
import re

from skyloom.llm import html_extract as he

SF = "/root/testdata/sf0.01"


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    raw = {r.page_id: r.html for r in pages.collect()}
    for r in he.main_text(pages).collect():
        article = raw[r.page_id].split("<article>")[1].split("</article>")[0]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split()) and r.n_chars == len(r.text)


def test_labelled_layouts():
    assert all(he.extract(page) == text for page, text in he.labelled_pages(80, 99))


def test_small_pages():
    cases = {
        None: "",
        "": "",
        "<script>x</script>": "",
        "just text &amp; more": "just text & more",
        "<article><p>a<b>b</b>c</p>\n<p> d \n e<br>f</p></article>": "abc d e f",
        "<article><h1>T</h1><p>x<!-- no --><script>if(a<b){'</p>'}</script>y</article><footer>many many more words here</footer>": "T xy",
        "<article>one<div class='ad'>buy</div>two<form><input>go</form>three<section id=comments>hm</section></article>": "one two three",
        "<main><p>unclosed <b>bold": "unclosed bold",
        '<p title="a>b">x &lt;i&gt; &copy &am</p>': "x <i> © &am",
    }
    for page, text in cases.items():
        assert he.extract(page) == text, page


def test_edges_of_the_input(spark):
    df = spark.createDataFrame([(None, None, None, "x"), (1, "u", "<p>a b c", "x"), (1, "u", "<p>a b c", "x"), (2, "u", "<p>" + "word " * 50_000, "x")], "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.n_chars) for r in he.main_text(df).collect())
    assert got == [(0, 0), (1, 5), (1, 5), (2, 249_999)]
    assert he.main_text(df.limit(0)).count() == 0


def test_layouts_that_the_labelled_pages_lack():
    text = "The river rose again in the night and by morning the lower fields stood under water for the third time this year"
    menu, foot = "<ul>" + "".join(f"<li><a href='/{i}'>topic {i}</a></li>" for i in range(8)) + "</ul>", "<div id='footer'><a href='/p'>privacy</a> <a href='/t'>terms</a></div>"
    inner = {
        "definitions": f"<dl><dt>River</dt><dd>{text}</dd><dt>Field</dt><dd>{text}</dd></dl>",
        "cells": f"<table><tbody><tr><td>{text}</td></tr><tr><td>{text}</td></tr></tbody></table>",
        "breaks": f"<div id='content'>{text}<br><br>{text}</div>",
        "links": f"<div class='entry'><p>{text} <a href='/more'>as told here</a> and after.</p><pre>{text}</pre></div>",
    }
    for name, part in inner.items():
        want = " ".join(re.sub(r"<[^>]*>", " ", part).split())
        got = " ".join(he.extract(f"<html><body><div class='nav'>{menu}</div>{part}{foot}</body></html>").split())
        assert got == want, name


def test_hints_do_not_empty_a_page_and_end_tags_may_be_missing():
    text = "The river rose again in the night and by morning the lower fields stood under water for the third time this year"
    cases = {
        f'<div class="layout has-sidebar"><article><p>{text}</p></article></div>': text,
        f'<main><div id="search-page"><p>{text}</p></div></main>': text,
        f'<div class="content"><p class="notice">buy<p>{text}<p>{text}</div>': f"{text} {text}",
        f'<ul><li class="share">send<li>{text}<li>{text}</ul><p>{text}': f"{text} {text} {text}",
        f'<div class="post"><div class="post-header"><h1>The river</h1></div><p>{text}</p></div>': f"The river {text}",
        f'<div class="page with-sidebar"><div class="sidebar"><p>{text}</p></div><article><p>{text} {text}</p></article></div>': f"{text} {text}",
        f'<table><tr><td class="ad">buy<td>{text}<tr><td>{text}</table>': f"{text} {text}",
        f"<article><p>{text}</p></article><section id='comments'><article class='comment'><p>{text} {text} {text}</p></article></section>": text,
        f"<div class='menu'><a href='/'>home</a></div><div>{text}</div>": text,
        f'<header><p>site</p></header><div class="post"><header><h1>The river</h1></header><p>{text}</p></div>': f"The river {text}",
    }
    for page, want in cases.items():
        assert he.extract(page) == want, page


def test_time_grows_in_proportion_to_the_page():
    import time

    pages = {
        "hints": lambda n: '<div class="ad">' * n + "word",
        "unmatched": lambda n: "<div>" * n + "</section>" * n,
        "rows": lambda n: "<table><tr><td>x" * n,
        "items": lambda n: "<ul><li>a" * n + "<li>b" * n,
        "comments": lambda n: '<div class="comments"><article>x' * n,
        "quotes": lambda n: "<a b=\"'>" * n + "<p>x" * n,
        "open": lambda n: "<!-- x " * n + "<script " * n,
    }
    he.default_weights()
    for name, page in pages.items():
        took = {}
        for n in (5_000, 40_000):
            began = time.process_time()
            he.extract(page(n))
            took[n] = time.process_time() - began
        assert took[40_000] < 8 * 3 * max(took[5_000], 0.02), (name, took)
