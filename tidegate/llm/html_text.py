"""Main text of web pages, by a recurrent labeller of blocks.

A page is cut into leaf blocks, runs of text between block-level tags. Each block is a vector of its tag
path (tags, class and id words of all elements around it, hashed), of its words (hashed, averaged) and of
numbers: its own size and links, and how much of the page's text, links and blocks its nearest
elements hold. A bidirectional LSTM, in numpy, reads the whole sequence of blocks, so each is judged
knowing all that stands before and after it, and every block is labelled as main text or not.

No page comes with labels. The network is trained here, on pages made up from random words by the
rules below, in which any text may stand in any role. Many of them have no telling tags, or no or
random class names, so that layout and links alone have to do.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidegate.llm.common import arrow_map, lowered, prefix_hash, range_hash, word_spans

#: NEAR elements around a block have their shares among the numbers.
PATHS, WORDS, PATH_DIM, WORD_DIM, NEAR, HIDDEN = 4096, 2048, 24, 8, 3, 16
NUMBERS = 6 + 4 * NEAR
INPUT = PATH_DIM + WORD_DIM + NUMBERS
#: Cells (steps x pages, padding included) that go through the network together when scoring.
LOT_CELLS = 1 << 15

#: Elements whose content is raw text up to their end tag, and others that hold markup or forms but no text;
#: elements that begin and end a block, and those without content.
RAW = frozenset("script style textarea iframe".split())
HIDDEN_TAGS = RAW | frozenset("select svg template".split())
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end by themselves when another of the group begins.
CLOSES = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",), "body": ("head", "title")}
_ENDS_P = BLOCK - {"p", "body", "html", "head", "title", "label", "button", "option", "legend", "summary", "caption"}

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:\"[^\"<]*\"|'[^'<]*'|[^'\"<>])*|[^<>]*)>"
    r"|<[!?/][^>]*>|(?P<text>[^<]+|<)",
    re.S,
)
_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in HIDDEN_TAGS}
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME_WORD = re.compile(r"[a-z]+", re.I)


@lru_cache(maxsize=100_000)
def _bucket(token: str) -> int:
    return zlib.crc32(token.encode("utf-8", "replace")) % PATHS


@lru_cache(maxsize=20_000)
def _element(tag: str, rest: str) -> tuple[int, ...]:
    names = " ".join(a or b or c for a, b, c in _NAMED.findall(rest)) if rest else ""
    return (_bucket(tag), *sorted({_bucket("." + w.lower()) for w in _NAME_WORD.findall(names)}))


class Block:
    """A run of text, the share of it in links, and its innermost element."""

    __slots__ = ("element", "leaf", "linked", "text")

    def __init__(self, element: int, leaf: int, text: str, linked: float) -> None:
        self.element, self.leaf, self.text, self.linked = element, leaf, text, linked


class Page(list):
    """The blocks of a page, and its elements: each one's parent, which comes before it, and its own buckets. Element 0 is the page."""

    def __init__(self) -> None:
        super().__init__()
        self.parent: list[int] = [0]
        self.own: list[tuple[int, ...]] = [()]
        self.facts: tuple | None = None


def blocks(page: str) -> Page:
    """The leaf blocks of a page, in order, with character references decoded and white space made single blanks.

    Only script, style, textarea and iframe run to the end of the page where their end tag is missing; other
    hidden elements without one hide nothing.
    """
    out = Page()
    stack: list[tuple[str, int]] = [("", 0)]
    opened: Counter[str] = Counter()
    endless: set[str] = set()
    text: list[str] = []
    in_link = False
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        if text:
            words = html.unescape("".join(text)).split()
            if words:
                whole = " ".join(words)
                out.append(Block(stack[-1][1], _bucket("leaf:" + stack[-1][0]), whole, min(1.0, linked / max(1, len(whole)))))
            text.clear()
        linked = 0

    def pop() -> None:
        opened[stack.pop()[0]] -= 1

    while (m := _TOKEN.match(page, at)) is not None:
        at = m.end()
        if (found := m["text"]) is not None:
            text.append(found)
            if in_link:
                linked += len(found.strip())
            continue
        if (tag := m["tag"]) is None:
            continue
        tag = tag.lower()
        if tag in HIDDEN_TAGS:
            text.append(" ")
            if m["close"] or tag == "svg" and m["rest"].endswith("/"):
                continue
            end = None if tag in endless else _END[tag].search(page, at)
            if end is not None:
                at = end.end()
            elif tag in RAW:
                break
            else:
                endless.add(tag)
            continue
        if tag not in BLOCK:
            if tag == "a":
                in_link = not m["close"]
            elif tag in ("br", "img", "input", "wbr"):
                text.append(" ")
            continue
        flush()
        in_link = False
        if m["close"]:
            if opened[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        ends = CLOSES.get(tag, ("p",) if tag in _ENDS_P else ())
        while stack[-1][0] in ends:
            pop()
        if tag not in VOID:
            out.parent.append(stack[-1][1])
            out.own.append(_element(tag, m["rest"]))
            stack.append((tag, len(out.own) - 1))
            opened[tag] += 1
    flush()
    return out


def _shares(page: Page) -> np.ndarray:
    """(blocks, 1 + 4 * NEAR): depth, and of the NEAR innermost elements the share of the page's text, of links in it, how many blocks and children."""
    parent = page.parent
    total, links, count, children, depth = ([0.0] * len(parent) for _ in range(5))
    for b in page:
        total[b.element] += len(b.text)
        links[b.element] += b.linked * len(b.text)
        count[b.element] += 1
    for e in range(1, len(parent)):
        depth[e] = depth[parent[e]] + 1
    for e in range(len(parent) - 1, 0, -1):
        up = parent[e]
        total[up] += total[e]
        links[up] += links[e]
        count[up] += count[e]
        children[up] += 1
    total, links, count, children, depth = (np.array(x) for x in (total, links, count, children, depth))
    up = np.array(parent)
    at = np.array([b.element for b in page])
    out = [np.log1p(depth[at]) / 3]
    for _ in range(NEAR):
        out += [total[at] / max(1.0, total[0]), links[at] / np.maximum(total[at], 1), np.log1p(count[at]) / 4, np.log1p(children[at]) / 4]
        at = up[at]
    return np.stack(out, axis=1)


def _path_sums(page: Page, table: np.ndarray) -> np.ndarray:
    """Sum of the embeddings of all elements around each block, level by level, so a deep page costs one row per element."""
    own = np.fromiter((x for e in page.own for x in e), np.int64)
    of = np.repeat(np.arange(len(page.own)), [len(e) for e in page.own])
    total = _sums(table, own, of, len(page.own))
    depth = np.zeros(len(page.parent), np.int64)
    for e in range(1, len(depth)):
        depth[e] = depth[page.parent[e]] + 1
    order = np.argsort(depth, kind="stable")
    up = np.array(page.parent)
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)[1:]:
        total[level] += total[up[level]]
    return total[[b.element for b in page]] + table[[b.leaf for b in page]]


def _paths(page: Page) -> list[list[int]]:
    """All buckets of each block's path; only training needs them one by one."""
    out = []
    for b in page:
        path, e = [b.leaf], b.element
        while e:
            path += page.own[e]
            e = page.parent[e]
        out.append(path)
    return out


def features(pages: list[Page], model: dict) -> np.ndarray:
    """(blocks of all pages, INPUT) inputs of the recurrent layers."""
    return _inputs(pages, model)[0]


def _facts(page: Page) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What a page's inputs are made of, whatever the model: (numbers, word buckets, block of each word, words of each block)."""
    if page.facts is None:
        raw = [b.text.encode("utf-8", "replace") for b in page]
        offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        data = lowered(np.frombuffer(b"".join(raw), np.uint8))
        start, end, word_of = word_spans(data, offs)
        with np.errstate(over="ignore"):
            word = (range_hash(prefix_hash(data), start, end) % np.uint64(WORDS)).astype(np.int64)
        words = np.bincount(word_of, minlength=len(page))
        last = np.array([b.text[-1] in ".!?:;\"'”»)" for b in page], np.float32)
        own = np.stack([np.log1p(np.diff(offs)) / 8, np.log1p(words) / 6, [b.linked for b in page], np.linspace(0, 1, len(page)), last], axis=1)
        page.facts = np.concatenate([own, _shares(page)], axis=1), word, word_of, words
    return page.facts


def _inputs(pages: list[Page], model: dict) -> tuple[np.ndarray, tuple]:
    pages = [p for p in pages if p]
    numbers, word, word_of, words = zip(*map(_facts, pages), strict=True)
    before = np.cumsum([0, *(len(p) for p in pages)])
    word_of = np.concatenate([w + k for w, k in zip(word_of, before[:-1], strict=True)])
    word, words = np.concatenate(word), np.concatenate(words)
    path = np.concatenate([_path_sums(p, model["P"]) for p in pages])
    x = np.concatenate([path, _sums(model["Q"], word, word_of, before[-1]) / np.maximum(words, 1)[:, None], np.concatenate(numbers)], axis=1).astype(np.float32)
    return x, (word, word_of, words)


def _sums(table: np.ndarray, ids: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(of, table[ids, k], n) for k in range(table.shape[1])], axis=1)


def _lstm(x: np.ndarray, w: np.ndarray, b: np.ndarray, mask: np.ndarray, taped: bool) -> tuple[np.ndarray, list]:
    """x (steps, batch, inputs) -> outputs, and where taped what training needs; steps where mask is 0 leave the state as it is."""
    h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
    out, tape = np.zeros((*x.shape[:2], HIDDEN), np.float32), []
    for t in range(len(x)):
        z = x[t] @ w[:INPUT] + b + h @ w[INPUT:]
        i, f, o = (1 / (1 + np.exp(-np.clip(z[:, k * HIDDEN : (k + 1) * HIDDEN], -30, 30))) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        m = mask[t][:, None]
        new_c = f * c + i * g
        s = np.tanh(new_c)
        if taped:
            tape.append((h, c, i, f, o, g, s, m))
        c = m * new_c + (1 - m) * c
        h = m * o * s + (1 - m) * h
        out[t] = h
    return out, tape


def _lstm_back(x: np.ndarray, w: np.ndarray, tape: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    d_w, d_x = np.zeros_like(w), np.zeros_like(x)
    d_b = np.zeros(4 * HIDDEN, np.float32)
    d_h = d_c = np.zeros((x.shape[1], HIDDEN), np.float32)
    for t in range(len(x) - 1, -1, -1):
        h, c, i, f, o, g, s, m = tape[t]
        d_h = d_h + d_out[t]
        live = m * d_h
        d_new = m * d_c + live * o * (1 - s * s)
        d_z = np.concatenate([d_new * g * i * (1 - i), d_new * c * f * (1 - f), live * s * o * (1 - o), d_new * i * (1 - g * g)], axis=1)
        d_w[:INPUT] += x[t].T @ d_z
        d_w[INPUT:] += h.T @ d_z
        d_b += d_z.sum(axis=0)
        d_x[t] = d_z @ w[:INPUT].T
        d_h = (1 - m) * d_h + d_z @ w[INPUT:].T
        d_c = (1 - m) * d_c + d_new * f
    return d_w, d_b, d_x


def _padded(x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(steps, pages, inputs) from stacked sequences, the mask, and each row's step and page."""
    page = np.repeat(np.arange(len(sizes)), sizes)
    step = np.arange(len(page)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((int(sizes.max()), len(sizes), x.shape[1]), np.float32)
    mask = np.zeros(out.shape[:2], np.float32)
    out[step, page], mask[step, page] = x, 1
    return out, mask, step, page


def _forward(x: np.ndarray, sizes: np.ndarray, model: dict, taped: bool = False) -> tuple[np.ndarray, tuple]:
    grid, mask, step, page = _padded(x, sizes)
    ahead, tape_a = _lstm(grid, model["Wa"], model["ba"], mask, taped)
    behind, tape_b = _lstm(grid[::-1], model["Wb"], model["bb"], mask[::-1], taped)
    both = np.concatenate([ahead[step, page], behind[::-1][step, page]], axis=1)
    return both @ model["V"] + model["v"], (grid, tape_a, tape_b, step, page, both)


def _lots(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Cuts of ascending sizes into lots of at most LOT_CELLS padded cells, or of one page."""
    a = 0
    for b in range(1, len(sizes) + 1):
        if b == len(sizes) or (b + 1 - a) * sizes[b] > LOT_CELLS:
            yield a, b
            a = b


def label(pages: list[Page], model: dict) -> list[np.ndarray]:
    """For each page, which blocks are main text. Pages of like length go through the network together."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k, p in enumerate(pages) if p), key=lambda k: len(pages[k]))
    for a, b in _lots([len(pages[k]) for k in order]):
        part = order[a:b]
        sizes = np.array([len(pages[k]) for k in part])
        logit = _forward(features([pages[k] for k in part], model), sizes, model)[0]
        for k, z in zip(part, np.split(logit, np.cumsum(sizes)[:-1]), strict=True):
            out[k] = z > 0
    return out


def extract(pages: list[str], model: dict) -> list[str]:
    cut = [blocks(p) for p in pages]
    return ["\n\n".join(b.text for b, main in zip(page, keep.tolist(), strict=True) if main) for page, keep in zip(cut, label(cut, model), strict=True)]


MARK = "\ue000"
#: Names that pages give to their parts.
NAMES = {
    "menu": "nav menu navbar navigation topnav breadcrumb breadcrumbs pagination toc skip links",
    "header": "header site-header masthead top banner logo branding tagline",
    "footer": "footer site-footer bottom copyright legal colophon",
    "side": "sidebar aside widget related recommended popular trending more-links side rail",
    "notice": "notice cookie cookies cookie-notice consent gdpr alert popup modal overlay warning paywall",
    "advert": "ad ads advert advertisement sponsored promo banner-ad adsense sponsor promoted",
    "form": "form newsletter subscribe search signup login contact search-form",
    "comments": "comments comment reader-comments discussion responses replies comment-list reply disqus",
    "share": "share social sharing tags meta-links toolbar",
    "main": "content post article entry entry-content main story post-body article-body text body-text page-content",
}
#: Words of menus and notices, beside the random ones.
CHROME = "home about contact login search privacy terms cookies accept subscribe share print next previous menu close more copyright rights reserved advertisement sponsored related comments reply email password sign up".split()
#: What parts say about themselves where no tag or name tells them.
SAYS = {
    "footer": ("Copyright 2020 {}. All rights reserved.", "&copy; {}", "&copy; 2019 {} &middot; Terms &middot; Privacy", "{} Ltd. All rights reserved", "Copyright {}"),
    "notice": ("We use cookies. {}", "This site uses cookies to {}. Accept", "Please accept our terms. {}", "By using this site you consent to {}"),
    "advert": ("Advertisement", "Sponsored: {}", "Buy now! {}", "Special offer: {}", "Sale {} Shop now"),
    "share": ("Share this: {}", "Tags: {}", "Share on {}", "Follow us"),
    "form": ("Subscribe to our newsletter", "Enter your email", "Search", "Sign up for {}"),
    "comments": ("{} comments", "Comments", "12 readers said", "Leave a reply", "3 responses to {}", "Discussion", "Reader comments"),
    "side": ("Related", "More from {}", "Popular", "Recommended for you", "Latest"),
    "header": ("{}",),
    "menu": ("{}",),
}


class _Maker:
    """Made-up pages; text blocks of the main part begin with MARK.

    A page may name its parts plainly, in random syllables or not at all, and may do without telling tags. Where
    neither tags nor names tell, the parts around the main one say what they are, or are made of links.
    """

    def __init__(self, rng: np.random.Generator) -> None:
        self.rng = rng
        self.parts = ["".join(map(str, x)) for x in rng.choice(list("aeiouthsrnldcmgp"), (60, 3))]
        self.naming, self.telling, self.early, self.given = "plain", True, False, {}

    def pick(self, *options):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def words(self, low: int, high: int) -> str:
        n = int(self.rng.integers(low, high + 1))
        return " ".join("".join(self.pick(*self.parts) for _ in range(int(self.rng.integers(1, 4)))) for _ in range(n))

    def sentence(self, low: int = 1, high: int = 25) -> str:
        return self.words(low, high).capitalize() + self.pick(".", ".", ".", "!", "?", "", " &copy;", " &amp; x.", "***")

    def text(self) -> str:
        return " ".join(self.sentence() for _ in range(int(self.rng.integers(1, self.pick(2, 3, 8)))))

    def inline(self, text: str) -> str:
        words = text.split(" ")
        if self.chance(0.3) and len(words) > 2:
            k = int(self.rng.integers(len(words)))
            words[k] = self.pick("<b>{}</b>", "<a href='/x'>{}</a>", "<em>{}</em>", "<span class=x>{}</span>", "{}<br>", "<b>{}").format(words[k])
        return " ".join(words)

    @property
    def told(self) -> bool:
        """Whether a part can be known by its name."""
        return self.naming == "plain"

    def named(self, kind: str) -> str:
        if self.naming == "none":
            return ""
        name = self.pick(*NAMES[kind].split())
        if self.naming == "random":
            name = self.given.setdefault((kind, self.pick(0, 1)), self.pick(*self.parts) + self.pick("", "3", "-x", "_1") + self.pick("", "", self.pick(*self.parts)))
        elif self.chance(0.2):
            name = self.pick("{} left", "site {}", "{}-wrap", "{}_box", "x-{}", "{} clear").format(name)
        return " " + self.pick("class", "class", "id") + self.pick('="{}"', "='{}'").format(name)

    def part(self, kind: str, inside: str, own: str = "") -> str:
        if own and self.telling and self.chance(0.5):
            return f"<{own}{self.pick('', self.named(kind))}>{inside}</{own}>"
        tag = self.pick("div", "div", "section", "aside" if self.telling and kind in ("side", "advert", "notice") else "div")
        return f"<{tag}{self.named(kind)}>{inside}</{tag}>"

    def chrome(self) -> str:
        return self.pick(*CHROME) if self.chance(0.5) else self.words(1, 4)

    def links(self) -> str:
        items = [f"<a href='/{k}'>{self.chrome()}</a>" for k in range(int(self.rng.integers(2, 9)))]
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if self.chance(0.7) else self.pick(" ", " | ", "<br>").join(items)

    def says(self, kind: str) -> str:
        line = self.pick(*SAYS[kind]).format(self.words(1, 4))
        return self.pick("{}", "<p>{}</p>", "<span>{}</span>", "<div>{}</div>", "<h3>{}</h3>").format(line)

    def plain(self, kind: str) -> str:
        if not self.told and not (self.early and self.chance(0.7)):
            return self.says(kind)
        t = self.text() if self.chance(0.7) else self.chrome()
        return self.pick("{}", "<p>{}</p>", "<span>{}</span>", "<div>{}</div>", "<h3>{}</h3>").format(t)

    def teasers(self) -> str:
        return "".join(f"<div><h4><a href='/{k}'>{self.words(2, 8)}</a></h4>{self.pick('', f'<p>{self.sentence(3, 9)}</p>')}</div>" for k in range(int(self.rng.integers(2, 5))))

    def remarks(self) -> str:
        shape = self.pick(f"<div{self.pick('', self.named('comments'))}>{{}}</div>", "<li><p>{}</p></li>", "<p>{}</p>", "<div><b>{}</b></div>" if self.chance(0.1) else "<div><p>{}</p></div>")
        by = self.pick("", "", "<span>{} said</span> ", "<b>{}</b> 3 days ago ", "<cite>{} says:</cite> ", "{}: ")
        reply = self.pick("", "", " <a href='#'>Reply</a>")
        return "".join(shape.format(by.format(self.words(1, 2)) + self.text() + reply) for _ in range(int(self.rng.integers(1, 6))))

    def boilerplate(self, kind: str) -> str:
        if kind == "menu":
            return self.part(kind, self.links(), "nav")
        if kind == "header":
            title = self.pick(f"<h1>{self.words(1, 4)}</h1>", f"<div>{self.words(1, 5)}</div>") if self.told or self.telling else f"<div><a href='/'>{self.words(1, 4)}</a></div>"
            return self.part(kind, self.pick(title, self.links()) + self.pick("", self.links() if not self.told else self.plain(kind)), "header")
        if kind == "footer":
            return self.part(kind, self.pick("&copy; " + self.words(1, 3) + " &middot; " + self.text(), self.says(kind), self.says(kind), self.links(), self.plain(kind) + self.links()), "footer")
        if kind == "side":
            head = self.pick("", f"<h{self.pick(2, 3, 4)}>{self.words(1, 4)}</h3>") if self.told else self.pick("", f"<h3>{self.pick(*SAYS[kind]).format(self.words(1, 2))}</h3>")
            return self.part(kind, head + self.pick(self.links(), self.teasers(), self.plain(kind) + (self.plain(kind) if self.told else self.links())), "aside")
        if kind == "form":
            return self.part(kind, f"<label>{self.chrome()}</label><input name=q><button>{self.chrome()}</button>" + self.pick("", self.plain(kind)), "form")
        if kind == "comments":
            said = self.pick(*SAYS[kind]).format(self.words(1, 1) if self.chance(0.5) else int(self.rng.integers(1, 99)))
            head = f"<h{self.pick(2, 3, 4)}>{said if not self.told or self.chance(0.5) else self.words(1, 3)}</h2>"
            return self.part(kind, (self.pick("", head) if self.told else head) + self.remarks())
        return self.part(kind, self.pick(self.plain(kind), self.plain(kind), self.plain(kind) + self.links()))

    def odd(self) -> str:
        """Now and then a block of the main part has a name that belongs to another part."""
        if self.told and self.chance(0.04):
            return f' class="{self.pick(*NAMES[self.pick(*NAMES)].split())}-{self.pick("note", "lead", "text", "x")}"'
        return self.pick("", "", "", " class=" + self.pick(*self.parts)) if self.naming == "random" else ""

    def main(self) -> str:
        out = []
        if self.chance(0.85) or not (self.told or self.telling):
            h = self.pick("h1", "h1", "h2")
            out.append(f"<{h}>{MARK}{self.words(2, 12)}</{h}>")
        least = 1 if self.told or self.telling else 2
        for _ in range(int(self.rng.integers(least, self.pick(3, 6, 20)))):
            roll = self.rng.random()
            if roll < 0.75:
                t = self.inline(self.text())
                if self.chance(0.05) and least == 1:
                    t = self.pick(*SAYS[self.pick(*SAYS)]).format(self.words(1, 3))
                if least == 2:  # nothing but its text tells this page's main part
                    t = self.inline(self.sentence(6, 25) + " " + self.text())
                out.append(self.pick("<p{}>{}</p>", "<p{}>{}</p>", "<p{}>{}</p>", "<p{}>{}", "<p{}><b>{}<br>", "<div{}>{}</div>").format(self.odd(), MARK + t))
            elif roll < 0.82:
                tag = self.pick("ul", "ol")
                out.append(f"<{tag}>" + "".join(f"<li>{MARK}{self.inline(self.sentence())}</li>" for _ in range(int(self.rng.integers(1, 6)))) + f"</{tag}>")
            elif roll < 0.88:
                out.append(f"<{self.pick('h2', 'h3', 'h4')}>{MARK}{self.words(1, 8)}</h2>")
            elif roll < 0.92:
                out.append(f"<blockquote><p>{MARK}{self.text()}</p></blockquote>")
            elif roll < 0.95:
                out.append(f"<table><tr><td>{MARK}{self.words(1, 4)}</td><td>{MARK}{self.words(1, 4)}</td></tr></table>")
            elif roll < 0.97:
                out.append(f"<figure><img src=x><figcaption>{MARK}{self.sentence()}</figcaption></figure>")
            else:
                out.append(f"<pre>{MARK}{self.words(2, 9)}</pre>")
            if self.chance(0.06):
                out.append(self.boilerplate(self.pick("advert", "side", "notice", "form", "share")))
        return "".join(out)

    def page(self) -> str:
        self.naming = self.pick("plain", "plain", "random", "none")
        self.telling = self.chance(0.6)
        self.given = {}
        self.early = True  # text ahead of the first heading need not say what it is
        before = [self.boilerplate(k) for k in ("menu", "header", "notice", "advert", "side", "form", "share") if self.chance(0.45)]
        self.early = False
        after = [self.boilerplate(k) for k in ("advert", "share", "side", "comments", "form", "notice", "menu", "footer") if self.chance(0.45)]
        self.rng.shuffle(before)
        tag = self.pick("article", "article", "main", "div", "section", "none") if self.telling else self.pick("div", "div", "section", "none")
        body = self.main()
        if self.chance(0.15) and tag != "none":  # reader comments inside of the container
            body += self.boilerplate("comments")
        if tag != "none":
            body = f"<{tag}{self.named('main')}>{body}</{tag}>" if tag in ("div", "section") or self.chance(0.3) else f"<{tag}>{body}</{tag}>"
            for _ in range(self.pick(0, 0, 1, 2)):
                body = f"<div{self.pick('', self.named('main'))}>{body}</div>"
        if self.chance(0.3):
            body = f"<div {self.pick('class', 'id')}='{self.pick('wrapper', 'container', 'page', 'layout')}'>{''.join(before)}{body}{''.join(after)}</div>"
        else:
            body = "".join(before) + body + "".join(after)
        head = f"<head><title>{self.words(1, 8)}</title><style>p{{}}</style></head>" if self.chance(0.9) else ""
        return f"<!DOCTYPE html><html>{head}<body>{body}" + self.pick("</body></html>", "")


def made_up_pages(n: int, seed: int) -> tuple[list[Page], list[np.ndarray]]:
    """Training pages: their blocks and which of them are main text."""
    maker = _Maker(np.random.default_rng(seed))
    pages, labels = [], []
    for _ in range(n):
        page = blocks(maker.page())
        if page:
            labels.append(np.array([MARK in b.text for b in page]))
            for b in page:
                b.text = " ".join(b.text.replace(MARK, "").split()) or "x"
            pages.append(page)
    return pages, labels


@lru_cache(maxsize=4)
def train(n_pages: int = 3500, epochs: int = 8, lot: int = 24, seed: int = 11, rate: float = 1e-2) -> dict:
    """Fit embeddings, both LSTMs and the output jointly by Adam, on made-up pages; the same on every run."""
    rng = np.random.default_rng(seed)
    model = {"P": rng.normal(0, 0.05, (PATHS, PATH_DIM)), "Q": rng.normal(0, 0.02, (WORDS, WORD_DIM)), "V": rng.normal(0, 0.3, 2 * HIDDEN), "v": np.zeros(1)}
    for k in "ab":
        model["W" + k] = rng.normal(0, (INPUT + HIDDEN) ** -0.5, (INPUT + HIDDEN, 4 * HIDDEN))
        model["b" + k] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    model = {k: v.astype(np.float32) for k, v in model.items()}
    pages, labels = made_up_pages(n_pages, seed)
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    lots, step = max(1, len(pages) // lot), 0
    for _ in range(epochs):
        order = rng.permutation(len(pages))
        order = order[np.argsort([len(pages[k]) // 8 for k in order], kind="stable")]
        for part in rng.permutation(np.array_split(order, lots) if len(order) % lots == 0 else np.array(np.array_split(order, lots), dtype=object)):
            part = np.asarray(part, np.int64)
            grads = _gradients([pages[k] for k in part], np.concatenate([labels[k] for k in part]), model)
            step += 1
            now = rate * min(1.0, 2 * (1 - step / (epochs * lots + 1)))
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                model[k] -= (now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return model


def _gradients(pages: list[Page], y: np.ndarray, model: dict) -> dict:
    sizes = np.array([len(p) for p in pages])
    x, (word, word_of, words) = _inputs(pages, model)
    paths = [path for p in pages for path in _paths(p)]
    path, path_of = np.concatenate(paths), np.repeat(np.arange(len(paths)), [len(q) for q in paths])
    logit, (grid, tape_a, tape_b, step, page, both) = _forward(x, sizes, model, True)
    error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / len(pages)).astype(np.float32)
    grads = {"V": both.T @ error, "v": error.sum(keepdims=True)}
    d_both = error[:, None] * model["V"]
    d_ahead = np.zeros((*grid.shape[:2], HIDDEN), np.float32)
    d_behind = np.zeros_like(d_ahead)
    d_ahead[step, page], d_behind[step, page] = d_both[:, :HIDDEN], d_both[:, HIDDEN:]
    grads["Wa"], grads["ba"], d_x = _lstm_back(grid, model["Wa"], tape_a, d_ahead)
    grads["Wb"], grads["bb"], d_y = _lstm_back(grid[::-1], model["Wb"], tape_b, d_behind[::-1])
    d_in = (d_x + d_y[::-1])[step, page]
    grads["P"] = _sums(d_in[:, :PATH_DIM], path_of, path, PATHS).astype(np.float32)
    grads["Q"] = _sums(d_in[:, PATH_DIM : PATH_DIM + WORD_DIM] / np.maximum(words, 1)[:, None], word_of, word, WORDS).astype(np.float32)
    return grads


def _batches(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = extract([h or "" for h in batch.column("html").to_pylist()], model)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def main_texts(pages: DataFrame, model: dict) -> DataFrame:
    """pages(page_id, url, html, ...) -> page_id, url, text, n_chars; one row per input row.

    text is the main text's blocks, joined by two line feeds; empty if there are none, or if html is
    null or empty. Ids and urls may be null or repeat. n_chars counts code points.
    """
    return arrow_map(pages.select("page_id", "url", "html"), _batches(model), "page_id long, url string, text string, n_chars long")
