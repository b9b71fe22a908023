"""Pages of any kind: nothing fails, markup does not leak, text is not lost."""

import random
import time

import pytest

from bookfold.llm import html_content
from bookfold.llm.html_tree import parse_page

MODEL = html_content.ContentModel({"": 5.0}, ((0.0, 0.0), (0.0, 0.0)))
PIECES = [
    "<", ">", "</", "<!", "<![", "<![foo x]>", "<![CDATA[", "]]>", "<!--", "-->", "<!-->", "--!>", "<?", "?>", "<!doctype html>", "<p>", "</p>", "<div class='a", "'", '"', "=", "&", "&amp", "&#x", "&#99999999999;",
    "<a href='x", "<script>", "</script>", "<style>", "</style", "<title>", "<svg>", "<math>", "</math>", "<table><tr><td>", "</table>", "<li>", "</ul>", "\0", "퟿", "text ", "\n", "<textarea>", "<select><option>", "<br/>", "<p/>", "<x-y>", "]", "é",
]


def text_of(page):
    return html_content.extract_text(page, MODEL)


def test_thousands_of_broken_pages_parse():
    rng = random.Random(8)
    for _ in range(6000):
        page = "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 30)))
        nodes = parse_page(page)
        assert all(n.parent < i for i, n in enumerate(nodes))
        text_of(page)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>a <![foo x]> b</p>", "a b"),
        ("<p>a</p><![ x", "a"),
        ("<p>unclosed <!-- c", "unclosed"),
        ("<p>tail <a href='x", "tail"),
        ("<p>a</p", "a"),
        ("<p>a<!weird <b> b", "a b"),
        ("<p>five < six & seven &amp", "five < six & seven &"),
        ("<p>a <?php echo 1 ?> b", "a b"),
        ("<article><p>eq <math><mi>x</mi><mo>=</mo><mn>1</mn></math> here</p></article>", "eq x=1 here"),
        ("<p>set <math><mi><![CDATA[a<b]]></mi></math> end</p>", "set a<b end"),
        ("<p>see <svg><text>label</text></svg> and <object>thing</object></p>", "see label and thing"),
        ("<p>a<script>if (a < b) { x('<!--') }</script> b</p>", "a b"),
        ("<p>one" + "<span>" * 40 + "<div>two</div>", "one\ntwo"),
    ],
)
def test_markup_goes_and_text_stays(page, text):
    assert text_of(page) == text


def test_deep_and_long_pages_take_linear_time():
    began = time.process_time()
    text_of("<div>" * 60_000 + "x" + "</q>" * 60_000)
    text_of("<p>" + "<i>" * 60_000 + "x" + "</b>" * 60_000)
    text_of("word " * 400_000)
    assert time.process_time() - began < 30


def test_a_bad_page_does_not_stop_the_job(spark):
    rows = [(1, "u", "<![foo x]>"), (2, "u", "<p>fine</p>"), (3, None, "<![ x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = html_content.extract_main_text(frame, MODEL).collect()
    assert {r["page_id"]: r["text"] for r in found} == {1: "", 2: "fine", 3: ""}


def test_training_reads_bounded_pages(spark):
    big = "<article><p>" + "word " * 50_000 + "</p></article>"
    frame = spark.createDataFrame([(big,), ("<article><p>small page</p></article>",), (None,)], "html string")
    pages = html_content.labelled_pages(frame)
    assert len(pages) == len(html_content.SEED_PAGES) + 1
