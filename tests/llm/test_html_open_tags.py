"""Pages whose dropped parts have no end tag of their own."""

import pytest
from pavilion.llm import html_text

PROSE = "Some words of the article that go on for quite a while, as articles do, and end with a stop."
AD = "An advert."
CASES = {
    "head": (f"<html><head><meta charset=x><title>T</title><link rel=y><body><article><h1>A</h1><p>{PROSE}</p></article></body></html>", ["A", PROSE]),
    "head, no body": (f"<head><title>T</title><article><h1>A</h1><p>{PROSE}</p></article>", ["A", PROSE]),
    "head, text": (f"<head><title>T</title>{PROSE}", [PROSE]),
    "p": (f"<body><article><h1>A</h1><p class='ad'>{AD}<p>{PROSE}<p>Last</article></body>", ["A", PROSE, "Last"]),
    "p, inline": (f"<body><article><h1>A</h1><p class='ad'><b>{AD}<div>{PROSE}</div><p>Last</p></article></body>", ["A", PROSE, "Last"]),
    "inline in p": (f"<body><article><p>{PROSE}<span class='ad'>{AD}<p>Last</p></article></body>", [PROSE, "Last"]),
    "li": (f"<body><article><p>{PROSE}</p><ul><li>One<li class='share'>Share<li>Two</ul><p>Last</p></article></body>", [PROSE, "One", "Two", "Last"]),
    "li, nested": (f"<body><article><p>{PROSE}</p><ul><li class='share'>Share<ul><li>in<li>in</ul>still<li>Two</ul></article></body>", [PROSE, "Two"]),
    "td": (f"<body><article><p>{PROSE}</p><table><tr><td class='ad'>{AD}<td>One<tr><td>Two</table></article></body>", [PROSE, "One", "Two"]),
    "end of an ancestor": (f"<body><article><div><aside>{AD}</div><p>{PROSE}</p><p>Last</p></article></body>", [PROSE, "Last"]),
    "all ends": (f"<body><article><p class='ad'>{AD}<button>x</button>{AD}</p><p>{PROSE}</p><p>Last</p></article></body>", [PROSE, "Last"]),
}


@pytest.mark.parametrize("name", CASES)
def test_open_dropped_tags(name):
    page, blocks = CASES[name]
    assert html_text.main_text(page).split("\n") == blocks
