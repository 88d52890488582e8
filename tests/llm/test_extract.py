import html as entities
import random
import re
import time

import numpy as np
import pytest
from conftest import SF_MID
from helpers import rows_of

from pricelake.llm import extract, queries

TREE = extract.trained_tree()


def text(page):
    return extract.main_texts([page], TREE)[0]


def brute(page):
    """The blocks of the one article of a page as the test tables have them."""
    found = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", found[1]) if found else []
    blocks = [" ".join(entities.unescape(re.sub(r"</?b>", "", p).replace("<br>", " ")).split()) for p in parts]
    return "\n".join(b for b in blocks if b)


def test_equal_to_brute_force_on_the_table(spark):
    pages = spark.read.parquet(f"{SF_MID}/pages.parquet")
    want = [(r.page_id, r.url, brute(r.html), len(brute(r.html))) for r in pages.collect()]
    got = queries.op11_html_extraction(spark, SF_MID)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert rows_of(got) == sorted(want, key=repr)


def test_rows_without_text_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "", "x"), (2, "v", "<nav>menu</nav>", "x"), (3, "w", "<article>a<p>b" + " c" * 200000, "x")]
    got = extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    long = "a\nb" + " c" * 200000
    assert rows_of(got) == sorted([(1, "u", "", 0)] * 2 + [(None, None, "", 0), (2, "v", "", 0), (3, "w", long, len(long))], key=repr)
    assert extract.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


BODY = "<h1>Title here</h1><p>First <b>bold</b> words &amp; more&nbsp;of &copy them.<br>Line two.</p><p>Be.</p><ul><li>One</li><li>Two</li></ul>"
SHOWN = "Title here\nFirst bold words & more of © them. Line two.\nBe.\nOne\nTwo"


@pytest.mark.parametrize(
    "page",
    [
        "<nav><a href=/>Home</a></nav><article>{}</article><footer>Foot note.</footer>",
        "<body><header><h1>Site name</h1></header><main>{}</main><aside><p>An aside that is quite long, with many words in it, really.</p></aside>",
        "<div class='cookie-banner'><p>We use cookies to make this site work better for you.</p></div><article><header>{}</header></article>",
        "<article>{}<div class=share><a href=x>Share</a></div><section id=comments><article class=comment><p>Nice text, I read it all.</p></article></section></article>",
        "<article>{}</article><div class='sidebar'><article class='teaser'><p>Read another story that we have here for you.</p></article></div>",
        "<nav><ul><li>Menu<article>{}</article>",  # a frame that is never closed
        "<div class='page has sidebar'><main>{}</main></div>",  # a wrapper named like a frame
        "<form id=aspnet><article>{}</article><label>Your name</label><input><button>Send it</button></form>",
        "<article>{}<script>var a = '<p>no</p>';</script><style>p {{ }}</style><!-- <p>no</p> --><noscript>Turn it on.</noscript></article>",
        "<article>{}<p hidden>Not seen.</p><p style='display: none'>Nor this.</p><template>Nor that.</template></article>",
        "<article title='a > b' data-x=\"<p>no</p>\">{}</article><p",
        "<ARTICLE>{}</ARTICLE><DIV CLASS=adBox id=topBanner>Buy this now, it is cheap.</DIV>",
        "<article>{}</article><div role=alert>Something went wrong while we loaded this.</div><a href='x",
    ],
)
def test_frames_of_many_kinds(page):
    assert text(page.replace("{}", BODY)) == SHOWN


def test_pages_without_a_main_element():
    words = "Plain words make up this long paragraph that anyone would call the text of the page, no doubt about it at all."
    page = f"<div><a href=/>Home</a></div><div><a href=/a>About us</a></div><p>{words}</p><p>{words}</p><p>{words}</p><div><a href=/b>Terms</a></div>"
    assert text(page) == "\n".join([words] * 3)
    assert text(words) == words
    assert text(f'<div class="entry-content"><p>Short.</p><p>{words}</p></div><div class="comments"><p>{words}</p></div>') == f"Short.\n{words}"


def test_character_references_and_stray_signs():
    assert text("<article>&lt;b&gt; &#233;&#xE9; &amp;amp; &unknown; &am a < b <3 </ p></article>") == "<b> éé &amp; &unknown; &am a < b <3"
    assert text("<article><p>un<i>broken</i> wo<b>r</b>d</p></article>") == "unbroken word"
    assert text("<article>a<!-- never closed <p>b</p>") == "a"


def test_no_training_block_is_misjudged_by_much():
    x, y = extract.labelled_table()
    assert ((extract.share_main(TREE, x) >= 0.5) == y).mean() > 0.99
    held_x, held_y = extract.labelled_table(rounds=5, seed=99)
    assert ((extract.share_main(TREE, held_x) >= 0.5) == held_y).mean() > 0.97


def test_tree_splits_where_impurity_falls_most():
    rnd = np.random.default_rng(2)
    x = rnd.integers(0, 6, (60, 3)).astype(float)
    y = (x[:, 1] > 2).astype(float)
    assert extract.grow(x, y, depth=1)[:2] == (1, 2.5)


@pytest.mark.parametrize("piece", ["<a ", "<a b='", "<!--", "<div class=ad>", "</p>", "<p>x", '<a b="x>', "&amp", "<script>", "<li>y<ul>"])
def test_broken_pages_take_linear_time(piece):
    took = []
    for n in (20000, 80000):
        page = "<article>" + piece * n
        start = time.perf_counter()
        extract.read_blocks(page)
        took.append(time.perf_counter() - start)
    assert took[1] < 12 * took[0] + 0.3


def test_random_markup_never_fails():
    rnd = random.Random(8)
    parts = ["<", ">", "p", "/", "article", " ", '"', "'", "=", "class", "ad", "!--", "--", "&amp;", "text", "<p>", "</p>", "<li>", "<td>", "<tr>", "</table>", "script"]
    for _ in range(3000):
        extract.main_texts(["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))], TREE)
