import html as entities
import math
import random
import re

import pytest
from pavilion.llm import html_text

PROSE = "Some words of the article that go on for quite a while, as articles do, and end with a stop."
MENU = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}</body></html>"


CASES = {
    "article": (f"{MENU}<article><h1>Title</h1><p>{PROSE}</p><p>Second &amp; <b>bold</b>\n text.</p></article><footer>&copy; x</footer>", ["Title", PROSE, "Second & bold text."]),
    "short article, long advert": (f"<div class='ad'>{PROSE * 3}</div><article><h1>A</h1><p>B</p></article>", ["A", "B"]),
    "no article tag": (f"<div id='menu'><a href=x>{PROSE}</a></div><div><div><h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p></div></div><div class='sidebar'>x</div>", ["Title", PROSE, PROSE]),
    "comments and forms": (f"<main><h1>T</h1><p>{PROSE}</p><form>Name <input></form><div class='comments'><p>{PROSE}</p></div><!-- <p>no</p> --></main>", ["T", PROSE]),
    "open tags": (f"<article><h1>T</h1><p><b>{PROSE}<br><p>Next</p><p>Last", ["T", PROSE, "Next", "Last"]),
    "references": ("<article><p>&lt;x&gt; &#233;&#xe9; &nbsp; &unknown; a&nbsp;b</p><p>5 < 6</p></article>", ["<x> éé &unknown; a b", "5 < 6"]),
    "cookie notice": (f"<div class='cookie-notice'>{PROSE}{PROSE}{PROSE}</div><article><h2>T</h2><p>{PROSE}</p></article>", ["T", PROSE]),
    "quoted angle": (f"<article><p title='a > b'>{PROSE}</p><p>Two</p></article>", [PROSE, "Two"]),
}


# Pages whose class words are about the article's surroundings, or only seem so.
ARTICLE = f"<h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p>"
KEPT = ["Title", PROSE, PROSE]
CASES |= {
    "has-sidebar": (f"{MENU}<div class='content has-sidebar'>{ARTICLE}</div><div class=sidebar>x</div>", KEPT),
    "with-comments": (f"<div class='post with-comments no-footer'>{ARTICLE}</div>", KEPT),
    "entry-header": (f"<article><div class='entry-header'><h1>Title</h1></div><p>{PROSE}</p><p>{PROSE}</p></article>", KEPT),
    "header element": (f"<header><h1>Site</h1>{MENU}</header><article><header class=header><h1>Title</h1></header><p>{PROSE}</p><p>{PROSE}</p></article>", KEPT),
    "caption": (f"<article>{ARTICLE}<figure><img src=x><figcaption>A caption.</figcaption></figure></article>", [*KEPT, "A caption."]),
    "notice": (f"<article><h1>Title</h1><p class='notice'>{PROSE}</p><p>{PROSE}</p><div class=notice>Log in.</div></article>", KEPT),
    "wrapper by name": (f"<div id='modal'>{MENU}<article>{ARTICLE}</article></div>", KEPT),
    "most of the text": (f"{MENU}<div class='widget'>{ARTICLE}</div><div class='ad'>Buy.</div>", KEPT),
    "site header": (f"<div class='site-header'>Site</div><div><div>{ARTICLE}</div></div><div class='article-comments'>{PROSE}</div>", KEPT),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    body, blocks = CASES[name]
    assert html_text.main_text(page(body)).split("\n") == blocks


@pytest.mark.parametrize("broken", ["", None, "<", "<p", "</p></div>", "<script>x", "<!--", "<html><body></body></html>", "<p></p>", "&", "<a<b>c"])
def test_broken_markup(broken):
    assert isinstance(html_text.main_text(broken), str)


def test_plain_and_deep_pages():
    assert html_text.main_text("just text") == "just text"
    deep = "<div>" * 5000 + PROSE + "</div>" * 5000
    assert html_text.main_text(page(deep)) == PROSE
    assert html_text.main_text(page("<article>" + f"<p>{PROSE}</p>" * 3000 + "</article>")).count("\n") == 2999


def test_whole_table(spark, sf_dir):
    """The sample pages hold their article in one element, so cutting it out by hand tells what is right."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        texts = (" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", block)).split()) for block in re.split(r"</?(?:p|h1)>", inner))
        want[r.page_id] = (r.url, "\n".join(t for t in texts if t))
    got = html_text.extract(pages).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def test_rows(spark):
    rows = [(1, None, None, "t"), (1, None, None, "t"), (None, "u", "", "t"), (2, "u", page("<p>x</p>"), "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, html_text.extract(pages).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (1, None, "", 0), (None, "u", "", 0), (2, "u", "x", 1)], key=str)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_densest_node_against_a_plain_reading():
    """Without names or special elements: the article's node is the one whose children's densities add up highest, worked out anew."""
    rng = random.Random(4)
    for _ in range(60):
        sections = []
        for _ in range(rng.randrange(1, 6)):
            links = "".join(f"<a href=x>{'w' * rng.randrange(1, 9)}</a> " for _ in range(rng.randrange(6)))
            texts = "".join(f"<p>{'word ' * rng.randrange(1, 60)}</p>" for _ in range(rng.randrange(5)))
            sections.append(f"<div>{links}{texts}</div>")
        tree = html_text.parse(f"<body>{''.join(sections)}</body>")
        html_text.weigh(tree)

        def counts(node):
            """(characters, tags, characters in links, links) below a node."""
            own = [len(" ".join(p.split())) for p in node.parts if isinstance(p, str)]
            below = [(counts(p), p.tag) for p in node.parts if not isinstance(p, str)]
            c, t = sum(own) + sum(b[0] for b, _ in below), sum(b[1] + 1 for b, _ in below)
            return c, t, c if node.tag == "a" else sum(b[2] for b, _ in below), sum(b[3] + (tag == "a") for b, tag in below)

        all_c, _, all_l, _ = counts(tree)

        def density(node):
            c, t, lc, lt = counts(node)
            if not c:
                return 0.0
            t, plain, lc, lt = max(t, 1), max(c - lc, 1), max(lc, 1), max(lt, 1)
            base = max(math.log(c / plain * lc + all_l / max(all_c, 1) * c + math.e), 1.0001)
            return max(c / t * (math.log(max(c / lc * t / lt, 1.0) + 1e-9) / math.log(base)), c / t * 1e-6)

        stack = [tree]
        while stack:
            node = stack.pop()
            inner = [p for p in node.parts if not isinstance(p, str)]
            assert node.total == pytest.approx(sum(map(density, inner)))
            stack += inner
