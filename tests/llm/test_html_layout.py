"""Pages whose markup does not name their parts, and markup that must not swallow text."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest

from tests.llm.test_fixtures import labeller  # noqa: F401
from tidegate.llm import html_text

SAID = "The quick article text goes on for a good while here, with many words in a sentence. It has a second sentence as well, which says more."
LINKS = '<ul><li><a href="/">Home</a></li><li><a href="/a">News</a></li><li><a href="/b">About</a></li></ul>'
RIGHTS = "Copyright 2020 Company. All rights reserved."


@pytest.mark.parametrize(
    "page, want",
    [
        (f'<html><body><div class="q1">{LINKS}</div><div class="kk3"><h1>Some title of it</h1><p>{SAID}</p><p>{SAID} And more.</p></div><div class="z9">{RIGHTS}</div></body></html>', ["Some title of it", SAID, SAID + " And more."]),
        (f"<article><h1>Some title</h1><p>{SAID}</p><p>{SAID}</p></article><div>{RIGHTS}</div>", ["Some title", SAID, SAID]),
        (f'<article><h1>Some title</h1><p>{SAID}</p><p>{SAID}</p><section class="u-reactions"><h3>12 readers said</h3><div><p>I do not agree with that at all.</p></div><div><p>Nice post, thanks.</p></div></section></article>', ["Some title", SAID, SAID]),
        (f'<div class="post"><h1>Some title</h1><p>{SAID}</p><div class="share-note"><p>{SAID} In a note.</p></div><p>{SAID} End.</p></div><div class="footer">About us</div>', ["Some title", SAID, SAID + " In a note.", SAID + " End."]),
        (f"<article><h1>T one</h1><p>{SAID}</p><svg width=1><p>{SAID} two</p></article><footer>x</footer>", ["T one", SAID, SAID + " two"]),
        (f"<article><h1>T one</h1><p>Let <math><mi>x</mi>=4</math> be {SAID}</p><object><p>A fallback sentence stands here for you to read.</p></object></article>", ["T one", "Let x=4 be " + SAID, "A fallback sentence stands here for you to read."]),
    ],
)
def test_layout_decides_where_names_do_not(labeller, page, want):  # noqa: F811
    assert html_text.extract([page], labeller)[0].split("\n\n") == want


def test_given_pages_without_telling_markup(labeller):  # noqa: F811
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet").html
    want = ["\n\n".join(b.text for b in html_text.blocks(p[p.index("<article>") : p.index("</article>") + 10])) for p in pages]
    plain = [p.replace("<article>", "<div>").replace("</article>", "</div>") for p in pages]
    for given, least in ((pages, 1.0), (plain, 0.98), ([re.sub(r'\s(class|id)="[^"]*"', "", p) for p in plain], 0.98)):
        assert np.mean([a == b for a, b in zip(html_text.extract(list(given), labeller), want, strict=True)]) >= least


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>one</p><video-player></video-player><p>two</p>", ["one", "two"]), ("<p>one<svg/>two</p>", ["one two"]), ("<p>a<svg><text>no</text></svg>b</p>", ["a b"]), ("<p>a<script>no", ["a"]),
        ("<p>a<select><option>no</select>b", ["a b"]), ("<p>x<noscript>y</noscript><canvas>z</canvas>", ["xyz"]), ("<script-x>a</script-x><p>b", ["a", "b"]), ("a</p></p></div>b", ["a", "b"]),
        ("<style>p{}</style ><p>c&amp;d&#x41;", ["c&dA"]), ("<!-- x --><p>a<!-- <p>b", ["a"]), ("<svg><p>a<svg><p>b", ["a", "b"]), ("", []), ("<", ["<"]),
    ],
)
def test_blocks(page, want):
    assert [b.text for b in html_text.blocks(page)] == want


def test_deep_and_long_pages(labeller):  # noqa: F811
    """Nothing is quadratic in depth or length, and the whole path counts: a comment container 40 levels up is still seen."""
    deep = "<div>" * 30_000 + "".join(f"<p>text {k}" for k in range(2000))
    assert len(html_text.blocks(deep)) == 2000 and len(html_text.label([html_text.blocks(deep)], labeller)[0]) == 2000
    assert len(html_text.blocks("<svg><p>a" * 20_000)) == 20_000 and len(html_text.blocks("</div><p>a" * 20_000)) == 20_000
    page = html_text.blocks('<div class="comments">' + "<div>" * 40 + "<p>text")
    path = html_text._paths(page)[0]
    assert html_text._bucket(".comments") in path and len(path) == 44
    table = np.random.default_rng(1).normal(size=(html_text.PATHS, 3))
    assert np.allclose(html_text._path_sums(page, table)[0], table[path].sum(axis=0))


def test_lots_are_bounded_and_do_not_matter(labeller, monkeypatch):  # noqa: F811
    pages, _ = html_text.made_up_pages(40, 9)
    whole = html_text.label(pages, labeller)
    monkeypatch.setattr(html_text, "LOT_CELLS", 40)
    cuts = list(html_text._lots(sizes := sorted(len(p) for p in pages)))
    assert [a for a, _ in cuts[1:]] == [b for _, b in cuts[:-1]] and all(b == a + 1 or (b - a) * sizes[b - 1] <= 40 for a, b in cuts)
    assert all((a == b).all() for a, b in zip(whole, html_text.label(pages, labeller), strict=True))
