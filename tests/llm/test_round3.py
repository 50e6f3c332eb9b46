"""Cases of the second review: the whole job where the code once did less."""

import math
import random

from starloom.llm import extract, language, suffix_dedup


def test_op2_a_row_given_twice_keeps_one_place(spark):
    r = random.Random(11)
    text = lambda n: " ".join("".join(r.choice("abcdefg") for _ in range(5)) for _ in range(n))
    own, null, twice, shared = text(50), text(50), text(30), text(30)
    near = shared + " " + text(40)
    given = [(7, own)] * 3 + [(None, null)] * 2 + [(8, twice + "|" + twice)] * 2 + [(9, near)] * 2 + [(10, shared + " " + text(40))] * 2
    expected = {(7, own): 0, (None, null): 0, (8, given[5][1]): len(twice), (9, near): 0}
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for parts, n, heavy in ((1, 1000, 1 << 22), (5, 1, 1 << 22), (5, 1, 300)):
        spark.conf.set(size, n)
        try:
            got, name = suffix_dedup.remove_repeats(spark.createDataFrame(given, "doc_id long, text string").repartition(parts), heavy=heavy)
            found = got.collect()
        finally:
            spark.conf.unset(size)
        assert len(found) == len(given)
        for x in found:
            removed = x[name].n_removed
            assert removed == expected[x.doc_id, x.text] if x.doc_id != 10 else len(shared) <= removed <= len(shared) + 2
            assert len(x[name].kept) == len(x.text) - removed


def test_op3_stripped_elements_end_as_html_says():
    body = "<article><p>First text.<p>Second text.</article>"
    for page in ("<html><title>t</title><meta charset=x><p>Not shown</p>" + body, "<head><title>t</title><body>" + body,
                 "<head><title>t</title>" + body, "<div><p class=notice>Buy<div>" + body + "</div></div>",
                 "<ul><li class=menu>Menu<li>x</ul>" + body, "<table><tr><td class=sidebar>Side<td>" + body + "</table>",
                 "<dl><dt class=ad>Ad<dd>x</dl>" + body, "<select><option>a<option>b</select>" + body,
                 "<div class=ad><script>document.write('<div>')</script></div>" + body, "<div class=ad><textarea><div></textarea></div>" + body,
                 "<div><nav>Menu<ul><li>x</div>" + body):
        assert extract.main_text(page) == "First text.\nSecond text.", page
    inner = "<article><p>One.</p>{}<p>Two.</p></article>"
    for x in ("<p class=ad>buy", "<ul><li class=ad>buy</ul>", "<table><tr class=ad><td>buy</table>", "<div class=ad><style>a>b{}<div></style>buy</div>",
              "<div class=ad><p>buy<p>buy</div>", "<div><form>go</div>"):
        assert extract.main_text(inner.format(x)) == "One.\nTwo.", x


def test_op3_only_whole_names_strip_and_never_the_article():
    text = "A sentence of the article. " * 6
    body = f"<article><h1>Title</h1><p>{text}</p></article>"
    for page in ('<div class="layout sidebar-right">{}</div>', '<div class="post comments-open">{}</div>', '<div class="sidebar">{}</div>',
                 "<form action=x>{}<input></form>", "<div role=dialog><nav>Menu</nav>{}</div>", "<header>Top {}</header>",
                 '<div data-id="search" title="class=ad">{}</div>', "<div id=comments><p>" + text * 3 + "</p></div>{}"):
        assert extract.main_text(page.format(body)) == f"Title\n{text.strip()}", page
        assert text.strip() in extract.main_text(page.format(f"<p>{text}</p>")), page
    inner = ('<h2 id="social-impact">Impact</h2><section id="related-work"><p>Work</p></section><div id="search-methods">How</div>'
             '<section id="related">More</section><div id="search">Search</div><pre><span class="token comment"># why</span></pre>')
    kept = ["Impact", "Work", "How", "More", "Search", "# why"]
    assert extract.main_text(f"<article><p>{text}</p>{inner}</article>").split("\n")[1:] == kept
    gone = '<div class="ad">buy</div><section class="x comments"><article>me too</article></section><div role="search">go</div>'
    side = "<aside><article>Other story</article></aside><div id=sidebar><article>Teaser</article></div>"
    assert extract.main_text(f"<article><p>{text}</p>{gone}</article>{side}") == text.strip()


def test_op3_pages_without_marks_keep_their_text():
    long = "A sentence of the article. " * 6
    poem = ["Roses are red", "Violets are blue", "Sugar is sweet", "And so are you"]
    assert extract.main_text("<body>" + "".join(f"<p>{x}</p>" for x in poem)).split("\n") == poem
    assert extract.main_text("<p>Short news.</p>") == "Short news."
    links = "".join(f"<div><a href=/{i}>Link {i}</a></div>" for i in range(5))
    page = f"<body>{links}<p>Title</p><p>{long}</p><p><a href=x>A paragraph that is a link</a></p><p>Next.</p>{links}<p>Short end.</p><p>Bye.</p>{links}"
    assert extract.main_text(page).split("\n") == ["Title", long.strip(), "A paragraph that is a link", "Next.", "Short end.", "Bye."]
    assert extract.main_text(f"<main></main><p>{long}</p>") == long.strip()
    assert extract.main_text(f"<body>{links}") == ""
    assert extract.main_text(f"<article>{links}<p>End</p></article>") == "\n".join([f"Link {i}" for i in range(5)] + ["End"])


def test_op9_every_label_is_sampled(spark):
    r = random.Random(3)
    sounds = {"en": "the and ing tion er", "de": "sch ung ein der ich", "fi": "aa kä yö lla ssa"}
    text = lambda lang: " ".join("".join(r.choice(sounds[lang].split()) for _ in range(3)) for _ in range(30))
    given = [(i, text(x), x) for i in range(300) for x in ("en", "de")] + [(900, text("fi"), "fi"), (901, text("fi"), "fi")]
    schema = "id long, text string, lang string"
    langs, table = language.fit_text_model(spark.createDataFrame(given, schema), sample=20)
    assert langs == ["de", "en", "fi"]
    pages = spark.createDataFrame([(1, "https://a.example.fi/", f"<html lang=fi><p>{text('fi')}")], "page_id long, url string, html string")
    assert language.identify_pages(pages, langs, table).first().language == "fi"
    null = spark.createDataFrame([(None, text("en"), "en") for _ in range(4000)], schema)  # rows without an id are taken one by one
    langs, table = language.fit_text_model(null, sample=40)
    assert langs == ["en"]
    taken = (0.5 / math.exp(table.min()) - language.BUCKETS / 2) / 250  # the least is log(0.5 / (trigrams taken + BUCKETS / 2))
    assert 50 < taken < 600, taken


def test_op9_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None, "s"), (2, None, None, None)], "doc_id long, text string, lang string, source string")
    langs, table = language.fit_text_model(docs.selectExpr("doc_id AS id", "text", "lang"))
    assert langs == [] and language.keep_identified(docs, langs, table).count() == 2
    pages = spark.createDataFrame([(1, "https://a.example.fi/", "<html lang=fi><p>text")], "page_id long, url string, html string")
    assert [(x.language, x.confidence) for x in language.identify_pages(pages, langs, table).collect()] == [(None, 0.0)]
