"""Operator 9 on hand-written pages: no article element, odd quotes, data attributes."""

import pytest

from mercato.llm import html_text
from tests.llm.conftest import SF

PROSE = [
    "The river rose again in the night, and by the morning two of the three bridges were closed to traffic.",
    "Nobody had expected the water to come so early, the mayor said, but the walls had held so far.",
    "Schools will stay shut until Monday; buses run on the northern road only, every half an hour.",
    "In the old town, shopkeepers carried what they could to the upper floors and waited for the rain to end.",
]
LINKS = "".join(f'<li><a href="/{x}">{x}</a></li>' for x in ("Home", "News", "Sport", "Weather", "About us"))
P = "".join(f"<p>{t}</p>" for t in PROSE)
TEXT = "\n".join(["The flood", *PROSE])
MAIN = f"<h1>The flood</h1>{P}"

#: name: (html, main text)
PAGES = {
    "div with an id": (
        f'<html><body><nav><ul>{LINKS}</ul></nav><div id="content">{MAIN}</div>'
        '<footer><p>© 2024 The Paper. All rights reserved.</p></footer></body></html>', TEXT),
    "main and a side bar": (
        f'<body><header><a href="/">The Paper</a></header><main>{MAIN}</main><aside class="sidebar"><h3>Most read</h3>'
        f"<ul>{LINKS}</ul></aside></body>", TEXT),
    "comments below": (
        f'<div class="post">{MAIN}</div><section class="comments"><h2>2 comments</h2><div class="comment"><p>Stay safe, '
        'everyone, and thanks for the report.</p></div><div class="comment"><p>First!</p></div></section>', TEXT),
    "notice, form and advert": (
        '<div class="cookie-notice"><p>We use cookies to improve your visit. Accept?</p></div>'
        f'<div class="entry-content">{MAIN}<div class="ad"><p>Buy two boots, get one free!</p></div></div>'
        '<form class="newsletter"><label>Your address</label><input name=mail><p>Subscribe to our letter</p></form>', TEXT),
    "data attributes of any value": (
        f'<body data-y="none"><nav data-y="1"><ul data-y="">{LINKS}</ul></nav><div class="content" data-y="0.5" data-id="menu">'
        + MAIN.replace("<p>", '<p data-y="abc" data-class="advert">') + "</div></body>", TEXT),
    "quotes in unquoted values": (
        f"<nav><ul>{LINKS}</ul></nav><div class=content title=it's>" + MAIN.replace("<p>", "<p title=don't>")
        + "</div><footer title=o'clock><a href=/x>Imprint</a></footer>", TEXT),
    "a quote closed late": (
        f'<nav><ul>{LINKS}</ul></nav><div class="content"><h1>The flood</h1><p title="a > b, or <b> c">{PROSE[0]}</p>'
        + "".join(f"<p>{t}</p>" for t in PROSE[1:]) + "</div>", TEXT),
    "a quote never closed": (f'<div class="content">{MAIN}</div><div class="footer>The Paper', TEXT),
    "white space and references": (
        '<div class="content">' + MAIN.replace("flood", "&#102;lood").replace(" ", "\n\t ") + "</div>", TEXT),
}


@pytest.fixture(scope="module")
def extracted(spark):
    rows = [(k, f"https://x/{k}", source) for k, (source, _) in enumerate(PAGES.values())]
    given = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    model = html_text.fit(given)
    fit, html_text.fit = html_text.fit, lambda pages: model  # a few pages are too few to learn from
    try:
        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        return {r.page_id: r.text for r in html_text.extracted(df).collect()}
    finally:
        html_text.fit = fit


@pytest.mark.parametrize("name", PAGES)
def test_hand_written_pages(extracted, name):
    assert extracted[[*PAGES].index(name)] == PAGES[name][1]


@pytest.mark.parametrize("source,texts,words", [
    ('<p data-y="abc">x</p>', ["x"], []), ('<p class="x>Hello world</p>', [], []), ("<p title=it's>Hello</p>", ["Hello"], []),
    ('<p data-id="menu">t</p>', ["t"], []), ("<p title='a > b' class=\"nav\">t</p>", ["t"], ["nav"]),
    ('<p title="class=nav">t</p>', ["t"], []), ("<p a=>x</p>", ["x"], []), ('<p a= "b">x</p><p', ["x"], []),
    ('<p CLASS = menu id="main">x', ["x"], ["menu", "main"]), ("<p x='y\"z'>q</p>", ["q"], [])])
def test_attributes(source, texts, words):
    page = html_text.Page(source)
    assert [r[0] for r in page.run if r] == texts
    assert [html_text.WORDS[w] for ws in page.words for w in ws] == words
    assert set(page.label) == {None}


def test_sample_of_a_table_of_copies(spark):
    """Equal pages are sampled once, and only hashes are compared."""
    rows = [(i, "u", "<article><p>same text on every page, of some length.</p></article>") for i in range(500)]
    rows += [(i, f"u{i}", f"<nav>menu</nav><article><p>page {i} has text of its own.</p></article>") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    seen = []
    make = html_text.training_rows
    html_text.training_rows = lambda sources: (seen.extend(sources), make(sources))[1]
    try:
        html_text.fit(df)
    finally:
        html_text.training_rows = make
    assert len(seen) == len(set(seen)) == 41
