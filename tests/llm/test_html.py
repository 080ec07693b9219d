import time
from itertools import product

import pytest

from tessera.llm.html import Model, evidence, extract_text, labelled_pages, main_text, parsed

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News of today</a></li></ul></nav><div class="ad">Buy this now, it is very cheap today.</div>
<article><h1>The &amp; title</h1><p><b>First   part.<br><p>Second &lt;part&gt; of it.</p><aside><p>Related stories that you may like</p></aside></article>
<section id="comments"><div class="comment"><p>I liked it very much, thank you.</p></div></section><footer>&copy; someone, all rights</footer></body>"""


@pytest.fixture(scope="module")
def model():
    return Model(labelled_pages())


def test_main_text(model):
    assert main_text(PAGE, model) == "The & title\nFirst part.\nSecond <part> of it."
    assert main_text("", model) == "" and main_text("<p>Only this.", model) == "Only this."
    for n in range(0, len(PAGE), 7):
        main_text(PAGE[:n], model)


def test_marginals_equal_sums_over_all_labellings(model):
    for page in (PAGE, "<div class='content'><p>a b c d</p><ul><li>x</li><li><a>y</a></li></ul></div>", "<p>x"):
        nodes, _ = parsed(page)
        nodes = nodes[:11]
        seen, parents = evidence(nodes), [x.parent for x in nodes]
        likely = [model.likelihood(x) for x in seen]
        totals, whole = [0.0] * len(nodes), 0.0
        for labels in product((0, 1), repeat=len(nodes)):
            p = 1.0
            for i, y in enumerate(labels):
                p *= likely[i][y] * (model.first[y] if parents[i] < 0 else model.follows[labels[parents[i]]][y])
            whole += p
            for i, y in enumerate(labels):
                totals[i] += p * y
        assert model.marginals(seen, parents) == pytest.approx([x / whole for x in totals])


def test_held_out_accuracy(model):
    right = total = 0
    for seen, parents, labels in labelled_pages(100, seed=99):
        found = [x > 0.5 for x in model.marginals(seen, parents)]
        right += sum(a == bool(b) for a, b in zip(found, labels))
        total += len(labels)
    assert right / total > 0.97


def test_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 5), (2, None, None, 5), (1, "u", "", 5), (None, "v", "<p>" * 2000 + "deep", 5)], "page_id long, url string, html string, n_chars int")
    rows = extract_text(pages).collect()
    assert len(rows) == 4 and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert extract_text(pages.limit(0)).count() == 0


def test_elements_without_their_end_tag_keep_the_article(model):
    article = "<article><h1>The title</h1><p>First part of the text.</p><p>Second part of it.</p></article>"
    want = main_text(f"<body>{article}</body>", model)
    assert "First part of the text." in want
    for broken in ("<svg width=1 />", "<svg><path d='x'/>", "<iframe src='x'>", "<object data='x'>", "<button>Press", "<video src='x'>", "<canvas>", "<math>", "<select><option>One", "<template>", "<noscript>"):
        assert main_text(f"<html><head><title>T</title><meta charset=x><body>{broken}{article}</body></html>", model) == want
        assert main_text(f"<body><div>{broken}</div>{article}<iframe>gone</iframe></body>", model) == want
    assert main_text(f"<body>{article}<svg><g/><text>gone</text></svg><button><b>gone</b></button></body>", model) == want
    assert main_text(f"<body>{article}<script>gone <p>gone", model) == want


ARTICLE = "<h1>The title</h1><p>First part of the text, a sentence of some length.</p><p>Second part of it.</p>"


@pytest.mark.parametrize(
    "page",
    [
        "<title-bar>Shop</title-bar><article>{}</article>",  # by hand, not by the generator of the training pages
        "<article><video-player src='x'></video-player>{}</article>",
        "<script-x></script-x><main>{}</main>",
        "<div class='post share'>{}</div>",
        "<div class='entry-content side-padding'>{}</div>",
        "<div class='main-ad content'>{}</div>",
        "<html><head><title>T</title><meta charset=x><body><main>{}</main>",
        "<article data-x='a > b' title=it's>{}</article>",
        "<div id=main-content class=\"page\">{}</div><div class=footer>The foot of it</div>",
        "<header><a href=/>Home</a></header><nav><a href=/a>News</a> <a href=/b>More news</a></nav><main><article>{}</article></main><footer>Imprint</footer>",
        "<ul class=menu><li><a href=/a>One</a><li><a href=/b>Two</a></ul><section class='article-body'>{}</section><aside><p>Read this too, you may like it.</p></aside>",
        "<div id='cookie-notice'><p>We use cookies here.</p><button>Yes</button></div><div class='content'>{}</div>",
    ],
)
def test_pages_by_hand(model, page):
    text = main_text(page.format(ARTICLE), model)
    assert "The title\nFirst part of the text, a sentence of some length.\nSecond part of it." in text
    for gone in ("Home", "News", "One", "Imprint", "cookies", "Read this", "The foot"):
        assert gone not in text


@pytest.mark.parametrize("unit", ["<script ", "<a ", '<p "', "<p a='", '<p a=">"', "<!--", "<title>", "<", "</", "<svg>", "<b>x", "= '"])
def test_broken_markup_takes_linear_time(model, unit):
    for tail in ("", ">", "'>", '">'):
        begin = time.process_time()
        main_text(unit * ((1 << 19) // len(unit)) + tail, model)
        assert time.process_time() - begin < 8
    begin = time.process_time()
    main_text("<script " * (1 << 17), model)
    assert time.process_time() - begin < 1
