from __future__ import annotations

import html
import re
import time

import pytest

from tablecheck.llm.html_text import extract_text, main_text

P = "Dieser Absatz ist lang genug, hat Kommas, und steht im Text der Seite, wie es sich gehört."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "furniture",
    [
        "<nav><a href='/x'>Menü</a></nav>",
        "<header><p>Kopf der Seite, mit Worten, die lang genug wären, um zu zählen</p></header>",
        "<footer>&copy; Fuß</footer>",
        "<aside><p>Seitenleiste, die auch lang ist, und Kommas hat, und Kommas, und mehr</p></aside>",
        "<div class='sidebar-left'>links</div>",
        "<div id=\"cookie-notice\"><p>Wir nutzen Kekse, viele, sehr viele, und noch mehr davon</p></div>",
        "<div class='ad'>Kauf!</div>",
        "<form><label>Name</label><input name=a><button>Los</button></form>",
        "<script>var t = '</p>'; if (1 < 2) { a('<p>') }</script>",
        "<style>p { margin: 0 }</style>",
        "<section class=commentList><p>Leserin: sehr schön, wirklich, ganz toll, gerne mehr</p></section>",
        "<div role=navigation>Wege</div>",
        "<div style='display: none'>versteckt</div>",
        "<!-- nicht > zeigen <p>x</p> -->",
    ],
)
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div id=content>{}</div>", "<main>{}</main>"])
def test_furniture_goes(furniture, wrap):
    text = f"<h1>Titel</h1><p>{P}</p><p>Kurz.</p><p>{P}"
    assert main_text(page(furniture + wrap.format(text) + furniture)) == f"Titel {P} Kurz. {P}"
    inside = f"<h1>Titel</h1><p>{P}</p>{furniture}<p>Kurz.</p><p>{P}"
    if "<header>" not in furniture or "div" in wrap:
        assert main_text(page(wrap.format(inside))) == f"Titel {P} Kurz. {P}"


@pytest.mark.parametrize(
    "wrap",
    [
        "<div class='content has-sidebar'>{}</div>",
        "<div class='site has-header-image'><div>{}</div></div>",
        "<div class=overflow-hidden><article>{}</article></div>",
        "<article class='post comments-open'>{}</article>",
        "<article class='post social'>{}</article>",
        "<main id=menu>{}</main>",
        "<div id='page-with-nav'>{}</div>",
        "<div class='widget'><div class='widget-container'>{}</div></div>",
        "<div title='the hidden door' data-class='ad'>{}</div>",
    ],
)
def test_words_of_a_class_do_not_drop_the_text(wrap):
    inner = f"<p>{P}</p><div class='share'>Teilen</div><p>{P}</p>"
    around = "<nav><a href=x>Menü</a></nav>{}<div class='ad'>Kauf!</div>"
    assert main_text(page(around.format(wrap.format(inner)))) == f"{P} {P}"
    # also without points
    assert main_text(page(around.format(wrap.format("<p>Kurzer Text.</p>")))) == "Kurzer Text."


def test_long_comments_beside_an_article_go():
    comments = f"<div id=comments>{f'<article class=comment-body><p>{P}</p></article>' * 5}</div>"
    assert main_text(page(f"<article><p>{P}</p><p>{P}</p></article>{comments}")) == f"{P} {P}"


def test_references_and_white_space():
    body = f"<article><p>{P}</p><p>a&amp;b &lt;c&gt; &#233;&nbsp;&hellip;\n\t x<b>y</b>z<br>w</p></article>"
    assert main_text(page(body)) == P + " a&b <c> é … xyz w"


def test_siblings_of_the_best_container_stay():
    body = f"<div><div><p>{P}</p><p>{P}</p></div><p>Nachsatz.</p><div><a href=x>nur ein Link</a></div></div>"
    assert main_text(page(body)) == f"{P} {P} Nachsatz."


def test_no_points_keeps_the_article():
    assert main_text(page("<div>Rest</div><article><p>Kurz.</p></article>")) == "Kurz."
    assert main_text("nur Text & mehr") == "nur Text & mehr"
    assert main_text("a < b") == "a < b"


@pytest.mark.parametrize("source", [None, "", " ", "<", "<p", "</p>", "<p><", "<script>", "<!--", "<a href=\"x"])
def test_odd_pages(source):
    assert main_text(source) in ("", "<")


def test_time_is_in_proportion_to_the_page():
    for part in ("<div>", "<b>", "<p><b>", "</div>", '<a title="', "<!--", "<p>x", "<li>"):
        start = time.perf_counter()
        main_text(part * 20_000)
        assert time.perf_counter() - start < 5, part


def test_test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for row in extract_text(pages, "html", ["page_id", "html"]).collect():
        body = re.search(r"(?s)<article>(.*?)</article>", row.html)[1]
        plain = html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", body)))
        assert row.text == " ".join(plain.split())


def test_tables(spark):
    frame = spark.createDataFrame([(1, None, "t"), (1, "<p>x", "t")], "page_id int, html string, text string")
    rows = extract_text(frame.withColumnRenamed("text", "other"), "html", ["page_id", "other"]).collect()
    assert sorted(x.text for x in rows) == ["", "x"]
    assert extract_text(frame.limit(0), "html", ["page_id"]).count() == 0
