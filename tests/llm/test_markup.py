"""Extraction and language ID on markup that is broken, hostile or holds more boilerplate than text."""

import time

import pytest

from starloom.llm import extract, language

TEXT = "<p>The first paragraph says a few things.</p><p>And the second one ends it.</p>"
KEPT = "The first paragraph says a few things.\nAnd the second one ends it."
LONG = "Words that nobody asked for. " * 60
PARTS = [f"<div class=comments><p>{LONG}</p></div>", f"<div class='cookie-notice'>{LONG}</div>", f"<aside>{LONG}</aside>",
         f"<form><p>{LONG}</p></form>", f"<footer>{LONG}</footer>", f"<nav>{LONG}</nav>", f"<section id=x class=comment-list><ul><li>{LONG}</ul></section>"]


@pytest.mark.parametrize("part", PARTS)
def test_parts_go_whatever_their_size(part):
    for page in (f"<body><article>{TEXT}{part}</article></body>", f"<main>{part}{TEXT}</main>", f"<article>{TEXT}</article>{part}"):
        assert extract.main_text(page) == KEPT
    more = "things and more of them" + " and of others" * 8
    assert extract.main_text(f"<body>{TEXT.replace('things', more)}{part}</body>") == KEPT.replace("things", more)


def test_wrapper_of_the_whole_page_stays():
    text = f"<p>{LONG}</p>"
    assert extract.main_text(f"<body><form id=aspnet>{text}<div class=comments>{LONG} too</div></form></body>") == LONG.strip()


def test_apostrophes_and_quotes_in_tags():
    assert extract.main_text("<article><p title=it's>One.</p><p>Two isn't.</p><p>Three.</p></article>") == "One.\nTwo isn't.\nThree."
    assert extract.main_text("<article><p title='a > b' data-x=\"<p>\">One.</p><p title=\"open>Two.</p><p>Three.</p></article>") == "One.\nTwo.\nThree."
    assert extract.main_text("<article><p>1 < 2 and 3 <4</p><p>x</article") == "1 < 2 and 3 <4\nx"


@pytest.mark.parametrize("unit", ["<a ", "<", "<a<a", "<!", "<!--", "</script ", "<script>", "<a x=\"<b\" y=\"<b\" ", "<a x='", "<div>", "<p>", "<b><i></b>"])
def test_time_follows_the_length(unit):
    began = time.process_time()
    extract.main_text(unit * (500_000 // len(unit)))
    assert time.process_time() - began < 15


def test_language_of_hostile_pages(spark):
    pages = [(i, f"http://a{i}.example.com/", u * (400_000 // len(u)) + " und der die das") for i, u in enumerate(["<", "<!--", "<script>", "<html ", "<style></"])]
    pages += [(9, None, "<html lang=de><body>der die und das ist nicht"), (10, None, None), (11, None, "")]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    labelled = spark.createDataFrame([(1, "der die und das ist nicht", "de"), (2, "the and of this is not", "en")], "id long, text string, lang string")
    began = time.time()
    got = {r.page_id: r for r in language.identify_pages(rows, *language.fit_text_model(labelled)).collect()}
    assert time.time() - began < 60
    assert (got[9].declared, got[9].language) == ("de", "de") and got[10].language is None and got[11].language is None
    assert got[0].language == "de" and got[1].language is None and got[2].language is None
