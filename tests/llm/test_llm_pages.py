"""Main text of generated pages, whose article is known."""

import random

import pytest

from tidemart.llm import html

WORDS = "river stone market winter harbour letter garden engine copper valley morning silver window bridge forest paper".split()
NOISE = [
    "<nav><ul><li><a href='/'>Home</a></li><li><a href='/a'>About us</a></li></ul></nav>",
    "<div class='sidebar'><h3>Popular</h3><p>Five things that you did not know</p></div>",
    "<aside><p>Beside the point</p></aside>", "<div id='cookie-notice'>This site stores cookies</div>",
    "<div class='ad-slot'><p>Buy one, get one</p></div>", "<form action='/s'><label>Find</label><input name='q'></form>",
    "<script>if (a < b) { document.write('<p>no</p>') }</script>", "<style>p > a { color: red }</style>", "<!-- <p>gone</p> -->",
]
COMMENTS = "<section class='comments'><h2>Comments</h2><p>I read all of this twice and liked it</p><p>Me too</p></section>"
FOOTER = "<footer><p>&copy; The owners of this page</p></footer>"
WRAPPERS = ["article", "main", "div", "div class='content'", "section id='story'"]


def block(rng):
    """Markup of one paragraph, and its text."""
    marked, plain = [], []
    for _ in range(rng.randrange(14, 60)):
        word = rng.choice(WORDS)
        kind = rng.randrange(20)
        shown = {0: f"<b>{word}</b>", 1: f"<em>{word}</em>", 2: f"{word}&amp;co", 3: f"{word[:2]}<i>{word[2:]}</i>", 4: f"&lt;{word}&#62;"}
        read = {2: f"{word}&co", 4: f"<{word}>"}
        marked.append(shown.get(kind, word))
        plain.append(read.get(kind, word))
    space = rng.choice([" ", "\n", "  \t"])
    return space.join(marked), " ".join(plain)


def page(rng, wrapper):
    blocks = [block(rng) for _ in range(rng.randrange(2, 12))]
    inner = ""
    for shown, _ in blocks:
        name = rng.choice(["p", "p", "div", "blockquote"])
        inner += f"<{name}>{shown}</{name}>" + (rng.choice(NOISE[4:]) if rng.random() < 0.2 else "")
    before = "".join(rng.sample(NOISE, rng.randrange(5)))
    after = "".join(rng.sample(NOISE, rng.randrange(4))) + (COMMENTS if rng.random() < 0.5 else "") + FOOTER
    body = f"<header><a href='/'>Site</a></header>{before}<{wrapper}>{inner}</{wrapper.split()[0]}>{after}"
    return f"<html><head><title>Title</title></head><body>{body}</body></html>", " ".join(text for _, text in blocks)


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_generated_pages_give_exactly_their_article(wrapper):
    rng = random.Random(wrapper)
    for _ in range(60):
        source, expected = page(rng, wrapper)
        assert html.main_text(source)[0] == expected
