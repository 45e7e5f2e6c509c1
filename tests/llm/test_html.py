from html.parser import HTMLParser

import numpy as np
import pytest

from tidemark.llm import html, queries

PAGE = """<!DOCTYPE html><html lang="en"><head><title>T &amp; t</title><style>p{margin:0}</style>
<script>var t="</p><b"; if (a<b) x();</script></head><body class="has-sidebar"><nav><ul><li><a href="/a">Home</a></li>
<li><a href="/b">News</a></li></ul></nav><!-- ad > 0 --><div class="ad">Buy this now, all of you, it is cheap.</div>
<div id="cookie-notice"><p>We use cookies.</p></div>%s<section class="comments"><p>First! I think this is a very long comment that goes on and on,
with many words and no links at all, as readers like to write them.</p></section>
<form><p>Your mail</p><input name="q"><select><option>One</option></select><button>Send</button></form>
<footer>&copy; example.com &middot; all rights reserved</footer></body></html>"""


def article(inner):
    return PAGE % f"<article>{inner}</article>"


CASES = [
    (article("<h1>A &lt;title&gt;</h1><p>One  two\n\tthree.<p>Four &eacute; <b>five</b>,<br>six.</p><p>Seven.</p>"),
     "A <title>\nOne two three.\nFour é five, six.\nSeven."),
    (article("<header><h1>Head</h1></header><p>Text with <a href='x'>a link</a> inside.</p><aside><p>Related: more</p></aside><p>End.</p>"),
     "Head\nText with a link inside.\nEnd."),
    (article("<p><b>Not closed.<br><p>Next &amp;amp; &am &#233; &#x41;.<br>"), "Not closed.\nNext &amp; &am é A."),
    (article("<p>a<script>p</script>b</p><p style='display: none'>no</p><ul><li>x</li><li>y</li></ul><p></p><p>  </p>"), "ab\nx\ny"),
    (PAGE % ("<div class='story'><p>" + "many words here " * 20 + "</p><p>Short one.</p><p>" + "and more words " * 20 + "</p></div>"),
     "many words here " * 19 + "many words here\nShort one.\n" + "and more words " * 19 + "and more words"),
    (PAGE % "", ""),
    ("", ""),
    (None, ""),
    ("<p>", ""),
    ("<script>never closed <p>text</p>", ""),
]


def test_main_text(spark):
    df = spark.createDataFrame([(i, p, "old", i) for i, (p, _) in enumerate(CASES)], "i int, page string, text string, n int")
    rows = html.extract(df.union(df.limit(2)), "page").collect()
    assert [c for c in html.extract(df, "page").columns] == ["i", "n", "text"]
    for r in rows:
        assert r.text == CASES[r.i][1]
    assert html.extract(df.filter("i > 99"), "page").count() == 0


PLAIN = "<p>" + "plain words of a paragraph " * 8 + "</p>"
KEPT = ("plain words of a paragraph " * 8).strip()
LIST = "<ul>" + "".join(f"<li><a href='/{i}'>More about {i}</a></li>" for i in range(5)) + "</ul>"


@pytest.mark.parametrize(
    "page, text",
    [
        (article(f"<h1><a href='/'>A linked headline</a></h1>{PLAIN}"), f"A linked headline\n{KEPT}"),
        (article(f"{PLAIN}<p><a href='/'>A paragraph that is one link and nothing else at all</a></p>{PLAIN}"),
         f"{KEPT}\nA paragraph that is one link and nothing else at all\n{KEPT}"),
        (article("<h1><a href='/'>Only this</a></h1>"), "Only this"),
        (article(f"{PLAIN}{LIST}{PLAIN}"), f"{KEPT}\n{KEPT}"),
        (PAGE % f"<div>{PLAIN}<h2><a href='/'>A linked headline</a></h2>{PLAIN}</div>", f"{KEPT}\nA linked headline\n{KEPT}"),
        (PAGE % f"<div>{PLAIN}{LIST}{PLAIN}</div>", f"{KEPT}\n{KEPT}"),
        (PAGE % f"<div><h1>A headline</h1>{PLAIN}<p>Some words that make twelve in all, no more and no less.</p><h2>Next part</h2>{PLAIN}</div>",
         f"A headline\n{KEPT}\nSome words that make twelve in all, no more and no less.\nNext part\n{KEPT}"),
    ],
)
def test_neighbours_tell_linked_headlines_from_link_lists(page, text):
    assert html.main_text(page, html.trained()) == text


def test_very_long_page(spark):
    page = article("".join(f"<p>paragraph {i}</p>" for i in range(50_000)))
    text = html.extract(spark.createDataFrame([(page,)], "page string"), "page").first().text
    assert text.split("\n") == [f"paragraph {i}" for i in range(50_000)]


def test_tree_learns_the_labelled_table():
    table = np.array(html.LABELLED, float)
    assert (html.classify(html.trained(), table[:, :-1]) == (table[:, -1] == 1)).all()


def test_block_features():
    found = html.blocks("<p>one two <a>three</a></p><main><p>x</p></main>")
    assert found == [("one two three", 3, 1, False, False), ("x", 1, 0, True, False)]
    assert html.described(found).tolist() == [[3, 1 / 3, 0, 0, 1, 0, 0, 0], [1, 0, 3, 1 / 3, 0, 0, 1, 0]]


@pytest.mark.parametrize("page", ["<", "<a", "</", "<!", "<p <p>a", "a < b > c", "&", "<p class='x>y</p>"])
def test_broken_markup_does_not_fail(page):
    assert isinstance(html.main_text(page, html.trained()), str)


BODY = f"{PLAIN}<p>The end.</p>"


@pytest.mark.parametrize(
    "page, text",
    [
        # words inside quoted values of attributes say nothing
        (article(f'<p title="the hidden truth">One.</p><p data-note="a hidden gem">Two.</p>{PLAIN}'), f"One.\nTwo.\n{KEPT}"),
        (article(f"<p data-x='class=ad id=\"menu\"'>One.</p>{PLAIN}"), f"One.\n{KEPT}"),
        (article(f"<p hidden>One.</p><p aria-hidden=true>Two.</p><p class='sidebar left'>Three.</p>{PLAIN}"), KEPT),
        # formulas are text, their sources are not
        (article(f"<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation encoding='application/x-tex'>x=1</annotation></math> be.</p>{PLAIN}"),
         f"Let x=1 be.\n{KEPT}"),
        # sections named by their subject
        (article(f"<section class='legal'>{PLAIN}</section><div class='related-work'><p>Others did this.</p></div>"), f"{KEPT}\nOthers did this."),
        (article(f"<h2 id='search'>Search</h2>{PLAIN}"), f"Search\n{KEPT}"),
        # wrappers of the whole page
        (f"<body><div class='page form-page'><article>{BODY}</article></div>", f"{KEPT}\nThe end."),
        (f"<body><form id='aspnetForm'><div class='has-sidebar'><main>{BODY}</main></div><p>Name</p></form>", f"{KEPT}\nThe end."),
        (f"<body><div class='notice'><article>{BODY}</article></div>", f"{KEPT}\nThe end."),
        # but not of teasers, footers and comments
        (article(BODY) + f"<aside><article>{BODY}</article></aside><div class='related-posts'><article>{BODY}</article></div>", f"{KEPT}\nThe end."),
        (article(BODY) + f"<div id='comments'><article>{BODY}</article></div><div class='page-footer'>{PLAIN}</div>", f"{KEPT}\nThe end."),
        (article(f"<div class='share-buttons'><p>Tell all.</p></div><div class='ad-box'>{PLAIN}</div>{BODY}"), f"{KEPT}\nThe end."),
    ],
)
def test_text_of_the_article_stays(page, text):
    assert html.main_text(page, html.trained()) == text


class Plain(HTMLParser):
    """The article's blocks by the standard library's parser, for pages that have one article element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.off, self.out = False, 0, [""]

    def handle_starttag(self, tag, attrs):
        self.off += tag in {"script", "style"} or dict(attrs).get("class") == "ad"
        self.inside |= tag == "article"
        if tag not in {"b", "i", "em", "strong", "a", "span"}:
            self.out.append("") if tag != "br" else self.handle_data(" ")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        self.off -= tag in {"script", "style"} or (tag == "div" and self.off > 0)
        if tag not in {"b", "i", "em", "strong", "a", "span"}:
            self.out.append("")

    def handle_data(self, data):
        if self.inside and not self.off:
            self.out[-1] += data


def test_query_equals_a_plain_parser(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = queries.op3_html_text(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(pages) > 100
    for r in got:
        parser = Plain()
        parser.feed(pages[r.page_id] or "")
        parser.close()
        assert r.text == "\n".join(" ".join(t.split()) for t in parser.out if t.strip()) and r.n_chars == len(r.text)
