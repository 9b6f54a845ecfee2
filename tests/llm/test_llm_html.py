import html as entities
import re
import time

import pytest

from tillhouse.llm import html_text
from tillhouse.llm.queries import queries
from tillhouse.llm.shared import sample_texts

NAME = "op9_html_extraction"
FOLDER = "/root/testdata/sf0.01"


def article(page):
    """The labelled article of a generated page, block by block."""
    found = re.search(r"<article>(.*?)</article>", page or "", re.S)
    if not found:
        return ""
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", re.sub(r"</?b>", "", found[1])))
    blocks = [" ".join(entities.unescape(b).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_pages_equal_their_articles(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    found = queries()[NAME](spark, FOLDER).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r["text"] == article(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"])
        assert r["url"] == pages[r["page_id"]]["url"]


@pytest.fixture(scope="module")
def weights(spark):
    return html_text.fit(spark.read.parquet(f"{FOLDER}/pages.parquet"))


WORDS = "some words of the text that go on for a while and then end here"


def test_other_layouts(weights):
    page = f"""<html><head><title>No</title><style>p{{}}</style></head><body>
    <header><h1>Site</h1><a href=/>Home</a></header><nav><ul><li><a href=x>Menu</a></ul></nav>
    <div class="cookie-notice"><p>{WORDS}</p></div><aside><p>{WORDS}</p></aside>
    <div id=content><h2>Title &amp; more</h2><p>First {WORDS}<p>Second <i>kind</i>  of\n {WORDS}
    <script>if (a < b) document.write("<p>no</p>")</script><div class="ad">Buy {WORDS}</div>
    <p>Third&nbsp;&eacute;&#233;&#x1F600; {WORDS}</p><!-- <p>no</p> --><form><p>Name</p><input></form>
    <blockquote>Quote</blockquote></div>
    <section id="comments"><p>{WORDS}</p></section><footer>&copy; us</footer>"""
    expected = ["Title & more", f"First {WORDS}", f"Second kind of {WORDS}", f"Third éé\U0001f600 {WORDS}", "Quote"]
    assert html_text.main_text(page, weights) == "\n".join(expected)


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "</p></p>", "<!--", "<script>", "<p class='", "&", "<a><b></a></b>" * 50])
def test_malformed_pages_have_no_text(weights, page):
    assert isinstance(html_text.main_text(page, weights), str)


def test_plain_text_and_long_pages(weights):
    assert html_text.main_text("just text", weights) == "just text"
    page = "<article>" + f"<p>{WORDS}</p>" * 20_000 + "</article>"
    assert html_text.main_text(page, weights).count("\n") == 19_999


def test_best_region_against_all_regions():
    import random

    rng = random.Random(6)
    for _ in range(200):
        tokens = [html_text.Token(rng.choice("abcd")) for _ in range(rng.randint(0, 12))]
        weights = html_text.Weights({c: rng.uniform(-3, 3) for c in "abcd"})
        sums = [sum(weights.of(t) for t in tokens[i:j]) for i in range(len(tokens) + 1) for j in range(i, len(tokens) + 1)]
        a, b = html_text.best_region(tokens, weights)
        assert abs(sum(weights.of(t) for t in tokens[a:b]) - max(sums)) < 1e-9


def test_empty_table_nulls_and_clashes(spark, empty, weights):
    assert queries()[NAME](spark, empty).count() == 0
    schema = "page_id long, url string, html string, text int, n_chars int, skip string"
    rows = [(1, None, None, 5, 5, ""), (None, "u", "", 5, 5, ""), (2, "u", "<p>a b", 5, 5, ""), (2, "u", "<p>a b", 5, 5, "")]
    got = html_text.extract(spark.createDataFrame(rows, schema), weights).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, None, "", 0), (None, "u", "", 0), (2, "u", "a b", 3), (2, "u", "a b", 3)], key=str
    )


def test_elements_that_close_themselves_or_never_leave_the_text_after_them():
    none = html_text.Weights()
    for tag in ('<svg class="icon"/>', "<math />", "<svg>", "<noscript>", "<iframe src=x>"):
        page = f"<p>First {WORDS}</p><p>Second {tag} {WORDS}</p><p>Third {WORDS}</p>"
        assert html_text.main_text(page, none) == f"First {WORDS}\nSecond {WORDS}\nThird {WORDS}"
    for tag in ("<svg><text>no</text></svg>", "<svg class=a/><text>no</text></svg>", "<math><mi>no</mi></math>"):
        assert html_text.main_text(f"<p>One {tag} {WORDS}</p>", none) == f"One {WORDS}"
    assert html_text.main_text(f"<p>One {WORDS}</p><script>{WORDS}", none) == f"One {WORDS}"


def test_names_of_headings_and_sections_do_not_drop_them():
    none = html_text.Weights()
    for tag in ('h2 id="related-work"', 'h2 id="search"', 'p class="notice"', 'section id="legal-history"', 'div data-id="legal"',
                'section id="comments-on-the-theory"', 'div title="see id=legal now"'):
        name = tag.split()[0]
        page = f"<p>First {WORDS}</p><{tag}>Second {WORDS}</{name}><p>Third {WORDS}</p>"
        assert html_text.main_text(page, none) == f"First {WORDS}\nSecond {WORDS}\nThird {WORDS}", tag
    inside = f'<article><p>First {WORDS}</p><section id="search">Second {WORDS}</section></article>'
    assert html_text.main_text(inside, none) == f"First {WORDS}\nSecond {WORDS}"
    for tag in ('div class="big cookie-notice"', 'section id="comments"', 'ul class="social"', "div role=navigation"):
        page = f"<p>First {WORDS}</p><{tag}>Second {WORDS}</{tag.split()[0]}><p>Third {WORDS}</p>"
        assert html_text.main_text(page, none) == f"First {WORDS}\nThird {WORDS}", tag


BOILERPLATE = ["cookie-consent", "ad-slot", "comment-list", "related-posts", "user-comments", "sidebarWidget", "social_share", "newsletter-signup box", "site-footer", "adverts"]


@pytest.mark.parametrize("learned", [True, False])
@pytest.mark.parametrize("name", BOILERPLATE)
@pytest.mark.parametrize("place", ["inside", "behind"])
def test_what_names_speak_of_is_left_out(weights, learned, name, place):
    extra = f'<div class="{name}"><p>{WORDS} extra</p><ul><li>{WORDS}</li></ul></div>'
    inside, behind = (extra, "") if place == "inside" else ("", extra)
    page = f"<body><article><h1>Head</h1><p>One {WORDS}</p>{inside}<p>Two {WORDS}</p></article>{behind}</body>"
    assert html_text.main_text(page, weights if learned else html_text.Weights()) == f"Head\nOne {WORDS}\nTwo {WORDS}"


def test_lists_code_and_quotes_of_an_article_stay(weights):
    page = "<article><h1>Head</h1>" + f"<p>{WORDS}</p>" * 6 + "<ul><li>first item</li><li>second</li></ul><pre>code  here</pre>"
    page += "<blockquote>A quote</blockquote><table><tr><td>cell</td><td>other</td></tr></table><dl><dt>term</dt><dd>what it means</dd></dl></article>"
    page += "<nav><ul><li><a href=x>Menu</a></li></ul></nav>"
    end = ["first item", "second", "code here", "A quote", "cell", "other", "term", "what it means"]
    assert html_text.main_text(page, weights) == "\n".join(["Head", *[WORDS] * 6, *end])


def _menu(n):
    return "".join(f'<li><a href="/{k}">Item {k}</a></li>' for k in range(n))


LAYOUTS = {
    "main and header": "<header><a href=/>Home</a></header><main>{}</main><footer>c</footer>",
    "div soup": "<div><div><div><ul>" + _menu(12) + "</ul></div></div><div><div>{}</div></div><div class=footer>c</div></div>",
    "table layout": "<table><tr><td><ul>" + _menu(9) + "</ul></td><td>{}</td></tr></table>",
    "links behind": "{}<div><a href=a>Other</a> <a href=b>More</a> <a href=c>Next</a></div>",
    "section": "<section id=story>{}</section><section class='reader-comments'><p>" + WORDS + "</p></section>",
    "aside in the middle": "<div id=content>{}<aside><p>" + WORDS + "</p></aside></div>",
    "form first": "<form><p>" + WORDS + "</p><input></form><div role=main>{}</div>",
    "role navigation": "<div role=navigation><p>" + WORDS + "</p></div>{}",
    "unclosed": "<div><ul>" + _menu(5) + "</ul><div>{}",
    "upper case": "<BODY><NAV><UL>" + _menu(4) + "</UL></NAV><DIV>{}</DIV></BODY>",
    "popup behind": "<div class=page>{}</div><div class='modal overlay'><p>" + WORDS + "</p></div>",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_foreign_layouts(weights, name):
    body = f"<h2>Title</h2><p>First {WORDS}</p><p>Second <em>{WORDS}</em></p><p>Third {WORDS}</p>"
    page = f"<html><head><title>t</title></head><body>{LAYOUTS[name].format(body)}</body></html>"
    assert html_text.main_text(page, weights) == f"Title\nFirst {WORDS}\nSecond {WORDS}\nThird {WORDS}"


@pytest.mark.parametrize("piece", ["<a b ", "<a '", '<a "', "<b>x</i>", "<b>", '<a x="', "<!", "<!--", "<svg>", "<script>", "&amp", "<li>"])
def test_work_follows_the_length_of_broken_pages(weights, piece):
    times = []
    for size in (100_000, 400_000):
        page = "<p>hello</p>" + piece * (size // len(piece)) + "</b></div>\">"
        start = time.process_time()
        html_text.main_text(page, weights)
        times.append(time.process_time() - start)
    assert times[1] < 8 * times[0] + 0.2 and times[1] < 3


def test_words_score_positive_and_tags_negative(weights):
    for token in html_text.tokens(f"<article><h1>a</h1><ul><li>b</li></ul></article><div>c<p>d</p><x>e</x></div>{_menu(2)}", weights):
        weight = weights.of(token)
        assert weight > 0 if token.text.strip() else weight <= 0


def test_a_table_of_copies_keeps_its_sample(spark):
    page, rows = "<body><div class=x>no</div><article><p>some text</p></article></body>", []
    rows = [(page,)] * 3000 + [(page.replace("some", f"some {k}"),) for k in range(50)] + [(None,)] * 100
    df = spark.createDataFrame(rows, "html string")
    found = [r.text for r in sample_texts(df, "html", 20).collect()]
    assert len(found) == len(set(found)) == 20
    assert len(sample_texts(df, "html", 500).collect()) == 51
    assert html_text.fit(df, sample_pages=20).known["word p"] > 0
