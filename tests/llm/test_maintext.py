import random

import pytest

from tidemark.llm import maintext as M
from tidemark.llm.maintext import Run, best_region, extract_main_text, main_text

HEAD = '<!DOCTYPE html><html lang="en"><head><title>Title words</title><style>p{a:b}</style><script>var t="</p><article>x</article>";</script></head>'
NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li><li><a href="/c">Terms of use here</a></li></ul></nav>'
FOOT = "<footer>&copy; 2024 Site &middot; All rights reserved</footer>"
BODY = "<p>First paragraph of the story, with many words in it.</p><p>Second <b>para</b>graph&nbsp;goes on\n and   on &amp; on.</p>"
TEXT = "First paragraph of the story, with many words in it. Second paragraph goes on and on & on."

PAGES = {
    "article": (f'{HEAD}<body>{NAV}<div class="ad">Buy this now please</div><article><h1>The headline</h1>{BODY}</article>{FOOT}</body></html>', "The headline " + TEXT),
    "cut off": (f"{HEAD}<body>{NAV}<article><h1>The headline</h1>{BODY}</article>{FOOT[:30]}", "The headline " + TEXT),
    "main with sidebar and comments": (
        f'{HEAD}<body><header><h2>Site name</h2></header><main><h1>Head</h1>{BODY}<aside>Read more stories like this</aside>'
        '<section id="comments"><h3>3 comments</h3><p>I liked this a great deal, thanks for it all.</p></section></main></body>',
        "Head " + TEXT,
    ),
    "boilerplate inside the article": (
        f'<body><article class="post">{BODY}<div class="ad-box"><p>Sponsored words</p></div><ul><li>one</li><li>two<li>three</ul>'
        '<form><label>Mail</label><input value="x > y"><button>Subscribe</button></form>'
        '<blockquote>quoted &quot;words&quot;</blockquote><div class="shareButtons">Share this</div><p>End.</article>',
        TEXT + ' one two three quoted "words" End.',
    ),
    "classes only": (
        f'<html><body><div id="top-menu"><a href="/">Home</a> <a href="/x">News</a></div><div class="cookieNotice">We use cookies on this site.</div>'
        f'<div class="content"><h1>Head</h1>{BODY}</div><div class="sidebar"><p>Popular posts of this week</p></div><div class="page-footer">Contact us</div></body></html>',
        "Head " + TEXT,
    ),
    "role": (f'<div>Logo</div><div role="main">{BODY}</div><div role="contentinfo">Imprint and contact</div>', TEXT),
    "comments as articles": (f'<article>{BODY}</article><article class="comment"><p>Nice text you wrote here.</p></article>', TEXT),
    "links around": ('<a href="/1">First link</a> <a href="/2">Second link</a><p>' + "plain words " * 20 + '</p><a href="/3">Third link</a>', ("plain words " * 20).strip()),
    "no markup": ("just a &lt;text&gt; without\n any markup, 1 < 2", "just a <text> without any markup, 1 < 2"),
    "comments and odd attributes": (f"<!-- <article>no</article> --><article data-x='a>b' hidden-note=\"1\"><![CDATA[ no ]]>{BODY}<!-- gone -->", TEXT),
    "inline elements and breaks": ("<article><p>one<br>two <i>th</i>ree<br/>four</p>five<div>six</div>seven</article>", "one two three four five six seven"),
    "unclosed paragraphs": ("<article><h1>Cut &am</h1><p><b>Bold start.<br><p>Next &amp;&amp; more.</article><footer>No</footer>", "Cut &am Bold start. Next && more."),
    "hidden": ('<article><p hidden>not seen</p><p style="display: none">nor this</p><p>seen words</p></article>', "seen words"),
    "table and definition list": ("<main><table><tr><th>a<td>b<tr><td>c</table><dl><dt>d<dd>e</dl></main>", "a b c d e"),
    "apostrophes and open quotes in tags": ("<article><p don't>It isn't a quote</p><p title=\"open>and neither is this</p></article>", "It isn't a quote and neither is this"),
    "only a menu": (f"<body>{NAV}</body>", ""),
    "empty": ("", ""),
    "blank": (" \n ", ""),
    "null": (None, ""),
}


def page_frame(spark, rows):
    return spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")


@pytest.mark.parametrize("name", PAGES)
def test_prior_weights_are_enough(name):
    page, text = PAGES[name]
    assert main_text(page, {}) == text


def test_learned_weights_give_the_same(spark):
    rows = [(i, name, page) for i, (name, (page, _)) in enumerate(PAGES.items())] * 2 + [(None, None, None), (None, "u", PAGES["article"][0])]
    out = extract_main_text(page_frame(spark, rows))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert {r.url: r.text for r in got if r.url in PAGES} == {name: text for name, (_, text) in PAGES.items()}
    assert [r.text for r in got if r.url == "u"] == [PAGES["article"][1]]


def test_weights(spark):
    rows = [(i, "u", PAGES["article"][0]) for i in range(20)] + [(99, "v", "<p>not labelled</p>")]
    weights = M.learn(page_frame(spark, rows), sample=10)
    assert weights["main p"] == M.MOST and weights["boiler item link"] == -M.MOST
    assert weights["page p"] > 2 and "outside p" not in weights
    assert all(w <= M.LEAST_TAG for kind, w in weights.items() if "<" in kind)
    assert M.learn(page_frame(spark, rows[20:])) == {} == M.learn(page_frame(spark, []))


def test_best_region_equals_brute_force():
    dice = random.Random(4)
    kinds = ["main p", "outside div", "main <p>", "boiler div", "page item link"]
    for _ in range(300):
        weights = {k: dice.uniform(-2, 2) for k in kinds}
        page = []
        for _ in range(dice.randrange(14)):
            kind = dice.choice(kinds)
            page.append(Run(kind, None if "<" in kind else "w " * dice.randrange(4), False, False, 0))
        scores = [weights[r.kind] * (1 if r.text is None else len(r.text.split())) for r in page]
        start, stop = best_region(page, weights)
        best = max([sum(scores[i:j]) for i in range(len(page)) for j in range(i + 1, len(page) + 1)], default=0)
        assert sum(scores[start:stop]) == pytest.approx(max(best, 0.0), abs=1e-9)


def test_very_long_and_deep_pages(spark):
    long = "<article>" + "<p>some more words</p>" * 60_000 + "</article>"
    deep = "<div>" * 3000 + "<p>" + "deep words " * 3000 + "</p>" + "</div>" * 3000
    open_tag = "<article><p>words before</p>" + "<" * 50_000
    inline = "<article><p>" + "<b>x " * 50_000 + "</i>" * 50_000 + "</p></article>"
    rows = [(1, "a", long), (2, "b", deep), (3, "c", open_tag), (4, "d", inline)]
    got = {r.page_id: r.text for r in extract_main_text(page_frame(spark, rows)).collect()}
    assert got[4] == " ".join(["x"] * 50_000)
    assert got[1] == " ".join(["some more words"] * 60_000)
    assert got[2] == ("deep words " * 3000).strip()
    assert got[3].startswith("words before")


def test_empty_table(spark):
    assert extract_main_text(page_frame(spark, [])).count() == 0
