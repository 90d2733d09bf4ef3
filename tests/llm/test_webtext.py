"""Main text of pages against expected texts, and the suffix array against counted windows."""

import random
import time
from collections import Counter

import numpy as np
import pytest

from moorage.llm import registered
from moorage.llm import webtext as w
from moorage.llm.common import prepare

ARTICLE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>no</article>";</script></head><body>'
    '<nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy</div>'
    "<article><h1>Head  &amp; tail</h1><p>One<br>two &lt;b&gt; <b>bold<p>Three&nbsp;four\n five</p>"
    '<div class="user-comments"><p>First!</p></div><form>Mail: <input></form></article>'
    "<footer>&copy; 2024 <p>Foot</p></footer></body></html>"
)
TEXT = "Head & tail\n\nOne two <b> bold\n\nThree four five"


def run(spark, rows):
    prepare(spark)
    pages = spark.createDataFrame([(i, u, h, 1) for i, u, h in rows], "page_id long, url string, html string, host int")
    return {r.page_id: r for r in w.main_text(pages).collect()}


@pytest.mark.parametrize(
    "page, text",
    [
        (ARTICLE, TEXT),
        (ARTICLE.rsplit("</article>", 1)[0], TEXT),
        ("<article><p>cut off in a ta", "cut off in a ta"),
        ("<article><p>cut off in a tag <a href=", "cut off in a tag"),
        ("<main><header><h1>Title</h1></header><p>x</p><aside>side</aside></main>", "Title\n\nx"),
        ("<header>Site</header><article>x<div hidden>no</div><p style='display: none'>no</p></article>", "x"),
        ("<article><p>&amp;amp; &#65;&#x42; &euro;5 &unknown; &am</p></article>", "&amp; AB €5 &unknown; &am"),
        ("<p>plain <i>text</i></p><div role=navigation>no</div><p>more</p>", "plain text\n\nmore"),
        ("just text", "just text"),
        ("<article></article><p>outside</p>", ""),
        ("", ""),
        (None, ""),
        ("<script>never closed <p>x", ""),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ],
)
def test_text_of_a_page(page, text):
    found = w.blocks(page or "")
    inside = [t for t, in_text, marked, _ in found if in_text and not marked]
    loose = [t for t, in_text, marked, _ in found if not in_text and not marked]
    if any(in_text for _, in_text, *_ in found) or page == "<article></article><p>outside</p>":
        assert "\n\n".join(inside) == text
    else:
        assert "\n\n".join(loose) == text


def test_host_runs_are_removed_and_unique_ones_kept(spark):
    shared = " ".join(f"s{i}" for i in range(12))
    rows = [(i, "https://Example.org/p", f"<p>{shared}</p><p>own{i} a{i} b{i} {shared} end{i}</p>") for i in range(5)]
    rows += [(10, "https://other.org/p", f"<p>{shared}</p>"), (11, None, None), (12, "https://example.org", ARTICLE), (13, "x", "")]
    rows += [(20 + i, "https://copies.org", f"<p>{shared}</p>") for i in range(4)]
    found = run(spark, rows)
    assert {i: found[i].text for i in range(5)} == {i: f"own{i} a{i} b{i} end{i}" for i in range(5)}
    assert found[0].repeated_words == 24 and found[0].loose_words == 28
    assert found[10].text == shared and found[11].text == "" and found[13].text == "" and found[11].n_chars == 0
    assert found[12].text == TEXT and found[12].n_chars == len(TEXT)
    assert all(found[20 + i].text == shared for i in range(4))
    assert run(spark, []) == {}


def test_parts_and_repeated_rows(spark):
    rows = [(1, "https://a.org", ARTICLE)] * 30
    prepare(spark)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = w.main_text(pages, part_pages=7).collect()
    assert len(found) == 30 and {r.text for r in found} == {TEXT}


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array_against_windows(seed):
    draw = random.Random(seed)
    streams = [[draw.randrange(3) for _ in range(draw.randint(0, 60))] for _ in range(12)]
    holders = {}
    for page, s in enumerate(streams):
        for i in range(len(s) - 7):
            holders.setdefault(tuple(s[i : i + 8]), set()).add(page)
    for own, got in zip(streams, w.repeated(streams)):
        want = np.zeros(len(own), bool)
        for i in range(len(own) - 7):
            if len(holders[tuple(own[i : i + 8])]) >= w.PAGES:
                want[i : i + 8] = True
        assert np.array_equal(got, want)


def test_unmarked_blocks_of_articles_all_stay(spark):
    notice = "get our letter each week by mail and never miss any story"
    unique = lambda i, n: " ".join(f"u{i}x{k}" for k in range(n))
    rows = [(i, "https://a.org/p", f"<nav>Home</nav><article><h1>Title {i}</h1><p>{unique(i, 6)}</p><p>{notice}</p><p>The {unique(i + 50, 6)}</p></article>") for i in range(4)]
    rows += [(10 + i, "https://a.org/p", f"<article><p>{unique(99, 40)}</p></article>") for i in range(4)]
    found = run(spark, rows)
    for i in range(4):
        assert found[i].text == f"Title {i}\n\n{unique(i, 6)}\n\n{notice}\n\nThe {unique(i + 50, 6)}"
        assert found[10 + i].text == unique(99, 40)


def test_every_article_of_the_table_is_a_document(spark):
    """The unmarked blocks of an article, less its heading, are the words of one document."""
    path = "/root/testdata/sf0.01"
    documents = {" ".join((r.text or "").split()) for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    found = registered.QUERIES["op4_web_text"](spark, path).collect()
    assert len(found) == 250 and dict(Counter(r.page_id for r in found)) == {r.page_id: 1 for r in found}
    for r in found:
        words = r.text.split("\n\n")
        assert " ".join(words) in documents or " ".join(words[1:]) in documents, r.page_id


def test_menus_without_marks_go_by_their_elements(spark):
    """Entries too short for a run of words are one run with their elements."""
    menu = "".join(f"<ul><li>{name}</li></ul>" for name in ("Home", "News", "Sport", "About", "Contact"))
    rows = [(i, "https://a.org/p", f"<div>{menu}</div><p>story{i} of{i} page{i}</p>") for i in range(3)]
    assert {i: r.text for i, r in run(spark, rows).items()} == {i: f"story{i} of{i} page{i}" for i in range(3)}


def test_long_broken_pages_take_linear_time():
    started = time.process_time()
    assert len(w.blocks("<div>x</p>" * 20_000)) == 20_000
    assert time.process_time() - started < 3


def test_parts_of_a_host_do_not_show(spark):
    unique = lambda i: " ".join(f"u{i}x{k}" for k in range(12))
    notice = lambda k: " ".join(f"n{k}x{j}" for j in range(10))
    rows = [(i, f"https://a.org/{i}", f"<article><p>{unique(i)}</p><p>{notice(i // 3)}</p></article>") for i in range(24)]
    rows += [(i, f"https://a.org/{i}", f"<p>{unique(i)}</p><p>{notice(i // 2)}</p>") for i in range(100, 104)]
    rows += [(i, f"https://a.org/{i}", f"<p>{unique(i)}</p><p>{notice(i // 3)}</p>") for i in range(300, 324)]
    prepare(spark)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in w.main_text(pages, part_pages=4).collect()}
    assert {i: found[i] for i in range(24)} == {i: f"{unique(i)}\n\n{notice(i // 3)}" for i in range(24)}
    assert all(found[i] == f"{unique(i)}\n\n{notice(i // 2)}" for i in range(100, 104))
    assert all(found[i] == unique(i) for i in range(300, 324))


@pytest.mark.parametrize(
    "page, text",
    [
        ('<div class="layout has-sidebar"><article><p>a b</p></article></div>', "a b"),
        ('<div id="page-with-header"><p>x</p><main>a b</main></div>', "a b"),
        ('<div class="no-banner"><article>a b</article></div>', "a b"),
        ('<div class="sidebar"><article>a b</article></div>', "a b"),
        ('<article><p class="long-form">a</p><p class="share-price">b</p><div class="entry-header"><h1>c</h1></div></article>', "a\n\nb\n\nc"),
        ('<article>a<div class="share"><p>x</p></div><div class="wide related-posts">y</div><div id="comment-12">z</div></article>', "a"),
        ('<div hidden><article>x</article></div><article>a<div class="comments"><article>x</article></div></article>', "a"),
    ],
)
def test_only_whole_names_mark(page, text):
    assert "\n\n".join(t for t, in_text, marked, _ in w.blocks(page) if in_text and not marked) == text


@pytest.mark.parametrize("part_pages", [512, 2])
def test_the_template_ends_an_article_that_is_never_closed(spark, part_pages):
    """What stands outside articles on three pages follows the article; in its midst, or where it is closed, it is text."""
    about = "<div>all rights of this paper are kept by those who print it</div><ul><li>Home</li><li>News</li><li>Shop</li><li>Mail</li></ul>"
    said = ["all rights of this paper are kept by those who print it", "Home", "News", "Shop", "Mail"]
    own = lambda i: " ".join(f"u{i}x{k}" for k in range(9))
    rows = [(i, "https://a.org/p", f"<article><p>{own(i)}</p></article>{about}") for i in range(3)]
    rows += [(10 + i, "https://a.org/p", f"<article><p>{own(10 + i)}</p>{about}") for i in range(5)]
    rows += [(20, "https://a.org/p", f"<article>{about}<p>{own(20)}</p>{about}<footer>x"), (21, "https://a.org/p", f"<article>{about}")]
    rows += [(22, "https://a.org/p", f"<article>{about}</article>"), (23, "https://b.org/p", f"<article><p>{own(23)}</p>{about}")]
    rows += [(24, "https://a.org/p", f"<main><article><p>{own(24)}</p>{about}</article><p>{own(25)}</p>{about}")]
    prepare(spark)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in w.main_text(pages, part_pages=part_pages).collect()}
    want = {i: [own(i)] for i in (0, 1, 2, *range(10, 15))}
    want |= {20: [*said, own(20)], 21: said, 22: said, 23: [own(23), *said], 24: [own(24), *said, own(25)]}
    assert {i: r.text for i, r in found.items()} == {i: "\n\n".join(t) for i, t in want.items()}
    assert [found[i].lost_words for i in (0, 10, 20, 21, 22, 23)] == [None, 16, 16, 0, None, 0]


def test_open_ends_of_articles():
    found, closed = w._read("<p>a</p><article>b</article><main>c<article>d</article>e<p>f")
    assert [t for t, *_ in found] == ["a", "b", "c", "d", "e", "f"] and closed == 4
    assert w._read("<article>a</article>b")[1] == 2 and w._read("<div><article>a</div>b")[1] == 2 and w._read("")[1] == 0
