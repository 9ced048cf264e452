"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: texts between tags of block elements.  Each block becomes a vector from its
tag path (element names, classes, ids, roles), its hashed words and a few shares.  A bidirectional LSTM in numpy reads
the blocks of a page in both directions and decides about each one with the whole page as context.

The net is trained here, on at most TRAIN_PAGES pages: their own blocks, labelled by the names of their containers where a name tells, and pages
put together anew from their texts.  Half of these have other usual names of content and of boilerplate; the other half have
containers without a telling name (body, div, td, names without a meaning), so that length, links, position, words and
neighbours must decide.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewgrain.llm.shared import Batches, bounded_sample, texts

#: Pages used for training at most, composed pages, passes over them, and the width of the net in each direction.
TRAIN_PAGES, COMPOSED_PAGES, EPOCHS, WIDTH = 256, 2048, 16, 16
PATH_SIZE, WORD_SIZE = 64, 32
#: Pages that the net reads at once.
READ_AT_ONCE = 256
SEED = 11

BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: An open element of the left kind ends where one of the right kinds begins.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "head": {"body"},
    "p": BLOCK - {"button", "option", "optgroup", "legend", "caption", "summary", "title"},
}
#: Elements that an end by ENDS does not reach out of.
HOLDS = frozenset("article aside blockquote body button div dl fieldset figure footer form header main nav ol section table td th ul".split())
#: Elements that are left out up to their end tag; without one only the start tag is.
SKIPPED = "noscript template svg math iframe object canvas audio video".split()
END_OF = {name: re.compile(rf"</{name}\s*>", re.I) for name in SKIPPED}
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea)(?=[\s/>])[^>]*?(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    rf"|<(?P<skipped>{'|'.join(SKIPPED)})(?=[\s/>])[^>]*>"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
NAMED = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
#: Words of notices, in the languages that pages often have them in.
STOCK_WORDS = re.compile(
    r"©|\(c\)|\b(?:copyright|rights reserved|cookies?|privacy|terms of|newsletter|subscribe|sign up|log ?in|register|advertisement|sponsored|"
    r"powered by|impressum|datenschutz|mentions légales|confidentialité|privacidad|derechos reservados|alle rechte|tous droits)\b",
    re.I,
)
PIECES = re.compile(r"[A-Za-z][a-z]+|[A-Z]+|[a-z]")


class Part(NamedTuple):
    """A leaf block: the open elements as (name, attributes), its text, and the share of it that is link text."""

    path: tuple[tuple[str, str], ...]
    text: str
    linked: float


def parts(html: str | None) -> list[Part]:
    """The leaf blocks of a page in order, whole; character references decoded, white space as one space."""
    out: list[Part] = []
    stack: list[tuple[str, str]] = []
    text: list[str] = []
    links, linked = 0, 0

    def flush() -> None:
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined:
            out.append(Part(tuple(stack), joined, min(1.0, linked / len(joined))))
        text.clear()
        linked = 0

    def close(names, stop: frozenset = frozenset()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in stop:
                return

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            plain = entities.unescape(raw) if "&" in raw else raw
            text.append(plain)
            if links:
                linked += len(plain)

    html = html or ""
    at = 0
    unclosed: set[str] = set()  # names without an end tag in the rest of the page
    while m := MARKUP.search(html, at):
        add(html[at : m.start()])
        at = m.end()
        skipped = (m["skipped"] or "").lower()
        if skipped and skipped not in unclosed and not m[0].endswith("/>"):
            end = END_OF[skipped].search(html, at)
            if end:
                at = end.end()
            else:
                unclosed.add(skipped)
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in BLOCK:
            if tag == "a":
                links = max(0, links - 1) if m["end"] else 1
            elif tag == "br":
                text.append(" ")
            continue
        flush()
        links = 0
        if m["end"]:
            close({tag})
            continue
        for name, enders in ENDS.items():
            if tag in enders:
                close({name}, HOLDS - {name})
        if tag not in VOID:
            stack.append((tag, m["rest"]))
    rest = html[at:]
    add(rest[: rest.find("<")] if re.match(r"[^<]*<[a-zA-Z/!][^>]*\Z", rest, re.S) else rest)
    flush()
    return out


def names_of(element: tuple[str, str]) -> list[str]:
    """An element's name and the parts of its class, id, role and itemprop."""
    tag, rest = element
    found = [tag]
    for m in NAMED.finditer(rest) if "=" in rest else ():
        found += [f".{p.lower()}" for p in PIECES.findall(m[2] or m[3] or m[4] or "")]
    return found


class Vectors:
    """Turns blocks into vectors; remembers paths and words."""

    size = PATH_SIZE + 1 + WORD_SIZE + 9

    def __init__(self, remembered: int = 200_000):
        self.paths: dict[tuple, np.ndarray] = {}
        self.words: dict[str, int] = {}
        self.remembered = remembered

    def path(self, path: tuple) -> np.ndarray:
        found = self.paths.get(path)
        if found is None:
            if len(self.paths) >= self.remembered // 20:
                self.paths.clear()
            found = np.zeros(PATH_SIZE + 1, np.float32)
            told = told_by_name(path)
            found[PATH_SIZE] = 0 if np.isnan(told) else 2 * told - 1
            for up, element in enumerate(reversed(path)):
                for name in names_of(element):
                    for salt in ("a", "b") if up else ("a", "b", "leaf"):
                        code = zlib.crc32(f"{salt}{name}".encode("utf-8", "surrogatepass"))
                        found[code % PATH_SIZE] += 1.0 if code >> 16 & 1 else -1.0
            self.paths[path] = found
        return found

    def page(self, blocks: list[Part]) -> np.ndarray:
        out = np.zeros((len(blocks), self.size), np.float32)
        codes, counts = [], []
        words = self.words
        for i, block in enumerate(blocks):
            out[i, : PATH_SIZE + 1] = self.path(block.path)
            found = block.text.split()
            counts.append(len(found))
            for word in found:
                code = words.get(word)
                if code is None:
                    if len(words) >= self.remembered:
                        words.clear()
                    code = words[word] = zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % (2 * WORD_SIZE)
                codes.append(code)
            n = len(block.text)
            ends = block.text[-1] in ".!?:;\"'”»"
            stock = len(STOCK_WORDS.findall(block.text))
            out[i, -9:] = (
                stock / (len(found) + 1) ** 0.5, np.log1p(len(found)) / 3, np.log1p(n) / 5, block.linked, block.text.count(",") / (len(found) + 1),
                ends, len(block.path) / 8, i / max(1, len(blocks) - 1), 1.0,
            )
        if codes:
            row = np.repeat(np.arange(len(blocks)), counts)
            code = np.array(codes)
            signs = np.where(code & 1, 1.0, -1.0)
            sums = np.bincount(row * WORD_SIZE + (code >> 1), signs, len(blocks) * WORD_SIZE).reshape(-1, WORD_SIZE)
            out[:, PATH_SIZE + 1 : PATH_SIZE + 1 + WORD_SIZE] = np.clip(sums / np.sqrt(np.maximum(counts, 1))[:, None], -3, 3)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def padded(pages: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks as [step, page, value], the same in reverse order, and which steps a page has."""
    steps = max(len(p) for p in pages)
    ahead = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32)
    back, mask = np.zeros_like(ahead), np.zeros((steps, len(pages), 1), np.float32)
    for i, p in enumerate(pages):
        ahead[: len(p), i], back[: len(p), i], mask[: len(p), i] = p, p[::-1], 1
    return ahead, back, mask


class Direction:
    """One LSTM: forward over padded steps, and gradients through time."""

    def __init__(self, size: int, width: int, rng):
        self.w = (rng.standard_normal((size + width, 4 * width)) / np.sqrt(size + width)).astype(np.float32)
        self.b = np.zeros(4 * width, np.float32)
        self.b[width : 2 * width] = 1
        self.size, self.width = size, width

    def forward(self, x: np.ndarray, keep: bool = False):
        steps, n, _ = x.shape
        k = self.width
        inputs = x @ self.w[: self.size] + self.b
        h, c = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
        out, memory = np.empty((steps, n, k), np.float32), []
        for t in range(steps):
            z = inputs[t] + h @ self.w[self.size :]
            gates = _sigmoid(z[:, : 3 * k])
            i, f, o, g = gates[:, :k], gates[:, k : 2 * k], gates[:, 2 * k :], np.tanh(z[:, 3 * k :])
            before, c = c, f * c + i * g
            s = np.tanh(c)
            if keep:
                memory.append((h, before, i, f, o, g, s))
            h = o * s
            out[t] = h
        return (out, memory) if keep else out

    def backward(self, x: np.ndarray, memory: list, grad: np.ndarray) -> list[np.ndarray]:
        steps, n, _ = x.shape
        dw, db = np.zeros_like(self.w), np.zeros_like(self.b)
        dh, dc = np.zeros((n, self.width), np.float32), np.zeros((n, self.width), np.float32)
        for t in range(steps - 1, -1, -1):
            h, before, i, f, o, g, s = memory[t]
            dh = dh + grad[t]
            dc = dc + dh * o * (1 - s * s)
            dz = np.concatenate((dc * g * i * (1 - i), dc * before * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - g * g)), axis=1)
            dw[: self.size] += x[t].T @ dz
            dw[self.size :] += h.T @ dz
            db += dz.sum(axis=0)
            dh, dc = dz @ self.w[self.size :].T, dc * f
        return [dw, db]


class Labeller:
    """The bidirectional net with a logistic output per block."""

    def __init__(self, size: int, width: int = WIDTH, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.ahead, self.back = Direction(size, width, rng), Direction(size, width, rng)
        self.out, self.bias = np.zeros(2 * width, np.float32), np.zeros(1, np.float32)

    @staticmethod
    def _turned(states: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """States over reversed pages in the order of the blocks."""
        steps = np.arange(len(states))[:, None]
        at = np.where(steps < lengths, lengths - 1 - steps, steps)
        return np.take_along_axis(states, at[:, :, None], axis=0)

    def scores(self, pages: Sequence[np.ndarray]) -> list[np.ndarray]:
        ahead, back, _ = padded(pages)
        lengths = np.array([len(p) for p in pages])
        both = np.concatenate((self.ahead.forward(ahead), self._turned(self.back.forward(back), lengths)), axis=2)
        found = _sigmoid(both @ self.out + self.bias)
        return [found[: len(p), i] for i, p in enumerate(pages)]

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = SEED, rate: float = 0.01) -> None:
        """Adam on the cross entropy, pages of similar length together; blocks labelled NaN are read but teach nothing."""
        rng = np.random.default_rng(seed)
        weights = [self.ahead.w, self.ahead.b, self.back.w, self.back.b, self.out, self.bias]
        first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        order = sorted(range(len(pages)), key=lambda i: (len(pages[i]), i))
        groups = [order[i : i + 32] for i in range(0, len(order), 32)]
        for epoch in range(epochs):
            for g in rng.permutation(len(groups)):
                own = [pages[i] for i in groups[g]]
                ahead, back, mask = padded(own)
                lengths = np.array([len(p) for p in own])
                wanted = padded([labels[i][:, None] for i in groups[g]])[0][:, :, 0]
                a, memory_a = self.ahead.forward(ahead, True)
                b, memory_b = self.back.forward(back, True)
                both = np.concatenate((a, self._turned(b, lengths)), axis=2)
                taught = mask[:, :, 0] * ~np.isnan(wanted)
                error = (_sigmoid(both @ self.out + self.bias) - np.nan_to_num(wanted)) * taught / max(1.0, taught.sum())
                states = error[:, :, None] * self.out
                k = self.ahead.width
                grads = [
                    *self.ahead.backward(ahead, memory_a, states[:, :, :k]),
                    *self.back.backward(back, memory_b, self._turned(states[:, :, k:], lengths)),
                    np.einsum("tnk,tn->k", both, error), np.array([error.sum()], np.float32),
                ]
                step += 1
                pace = rate * (1 - epoch / epochs) ** 0.5 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for w, grad, m, v in zip(weights, grads, first, second, strict=True):
                    grad = np.clip(grad, -1, 1)
                    m += 0.1 * (grad - m)
                    v += 0.001 * (grad * grad - v)
                    w -= (pace * m / (np.sqrt(v) + 1e-8)).astype(np.float32)


# training pages

CONTENT_NAMES = frozenset("article main .article .content .entry .post .story .body .articlebody .text".split())
OTHER_NAMES = frozenset(
    "nav header footer aside form button select title head menu .nav .menu .navbar .breadcrumb .breadcrumbs .header .footer .sidebar .widget .related "
    ".ad .ads .advert .advertisement .sponsored .promo .banner .cookie .cookies .consent .notice .alert .popup .modal .share .social "
    ".comment .comments .respond .reply .newsletter .subscribe .copyright .login .search .pagination .tags .meta".split()
)
CONTENT_BOXES = (
    "<article>", "<main>", '<div class="content">', '<div id="content">', '<div class="post-body">', '<section class="story">',
    '<div class="entry-content">', '<div class="article-text">', '<div itemprop="articleBody">', '<div id="main">', '<div class="main-content">',
    "<main><article>", '<article class="post">', '<div class="article"><div class="text">', '<div role="main">', "<section>", '<div class="page">',
)
CONTENT_PARTS = ("p", "p", "p", "p", "p", "h2", "h3", "blockquote", "li", "pre", "td", "dd", "figcaption")
OTHER_BOXES = (
    ("link", "<nav>"), ("link", '<ul class="menu">'), ("link", '<div class="navbar">'), ("link", '<div id="menu">'), ("link", '<div class="breadcrumbs">'),
    ("link", '<div class="related">'), ("link", '<aside class="widget">'), ("link", '<div class="tags">'), ("link", '<div class="pagination">'),
    ("link", '<div class="share social">'), ("link", '<nav class="top-nav">'), ("link", '<div role="navigation">'), ("link", "<menu>"),
    ("text", "<header>"), ("text", '<div class="header">'), ("text", '<div id="header">'), ("text", '<header class="site-header">'), ("text", '<div role="banner">'),
    ("text", "<aside>"), ("text", '<div class="sidebar">'), ("text", '<div id="sidebar">'), ("text", '<aside class="sidebar">'), ("text", '<div role="complementary">'),
    ("text", '<div class="ad">'), ("text", '<div class="ads">'), ("text", '<div class="advert">'), ("text", '<div class="advertisement">'),
    ("text", '<div class="sponsored">'), ("text", '<div class="promo">'), ("text", '<section class="ad-slot">'), ("text", '<p class="ad">'),
    ("text", '<div class="cookie-notice">'), ("text", '<div class="notice">'), ("text", '<div class="cookie-banner">'), ("text", '<div id="cookies">'),
    ("text", '<div class="alert">'), ("text", '<div class="banner">'), ("text", '<div class="consent">'), ("text", '<div class="popup modal">'), ("text", '<div role="alert">'),
    ("form", "<form>"), ("form", '<form class="newsletter">'), ("form", '<div class="subscribe">'), ("form", '<form id="search">'), ("form", '<div class="login">'),
    ("text", "<footer>"), ("text", '<div class="footer">'), ("text", '<div id="footer">'), ("text", '<div class="copyright">'), ("text", '<div role="contentinfo">'),
    ("comment", '<section class="comments">'), ("comment", '<div id="comments">'), ("comment", '<ol class="comment-list">'), ("comment", '<div class="comments">'),
    ("comment", '<section id="comments">'), ("comment", '<div class="reader-comments">'), ("comment", '<aside class="comments">'),
)
COMMENT_BOXES = ('<div class="comment">', '<li class="comment">', '<article class="comment">', '<p class="comment">', "<p>", '<div class="reply">')
KEEP, DROP = ' data-keep="1"', ' data-keep="0"'


def _end(box: str) -> str:
    return "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", box)))


def _marked(box: str, mark: str) -> str:
    return re.sub(r"<(\w+)", rf"<\1{mark}", box, count=1)


def told_by_name(path: tuple) -> float:
    """The weak label of a given page's block: the innermost telling name among its containers, NaN if none tells."""
    for element in reversed(path):
        names = set(names_of(element))
        if names & OTHER_NAMES:
            return 0.0
        if names & CONTENT_NAMES:
            return 1.0
    return np.nan


def compose(rng, content: list[str], other: list[str], short: list[str]) -> str:
    """A page from given texts in random containers; marked elements say what to keep."""
    pick = lambda values: values[rng.integers(len(values))]

    def boilerplate(kind_box: tuple[str, str]) -> str:
        kind, box = kind_box
        if kind == "link":
            inner = "".join(f'<li><a href="/x">{pick(short)}</a></li>' for _ in range(rng.integers(2, 9)))
            inner = f"<ul>{inner}</ul>" if "<ul" not in box and rng.random() < 0.6 else inner
        elif kind == "form":
            inner = f'<label>{pick(short)}</label><input type="text"><p>{pick(other)}</p><button>{pick(short)}</button>'
        elif kind == "comment":
            inner = f"<h3>{pick(short)}</h3>" * int(rng.integers(2))
            for _ in range(rng.integers(1, 5)):
                own = pick(COMMENT_BOXES)
                inner += own + (f"<p>{pick(content)}</p>" if "<p" not in own and rng.random() < 0.7 else pick(content)) + _end(own)
        else:
            title = pick(("h1", "h2", "h3", "h4"))
            head = f"<{title}>{pick(short)}</{title}>" if rng.random() < 0.35 else ""
            inner = head + pick(other) if rng.random() < 0.6 else "".join(f"<p>{pick(content if rng.random() < 0.4 else other)}</p>" for _ in range(rng.integers(1, 4)))
        return _marked(box, DROP) + inner + _end(box)

    some = lambda low, high: "".join(boilerplate(pick(OTHER_BOXES)) for _ in range(rng.integers(low, high)))
    body = f"<h1>{pick(short)} {pick(short)}</h1>" if rng.random() < 0.8 else ""
    for _ in range(rng.integers(1, 12)):
        name = pick(CONTENT_PARTS)
        inside = f"<{name}>{pick(content) if rng.random() < 0.85 else pick(short)}</{name}>"
        body += {"li": f"<ul>{inside}</ul>", "td": f"<table><tr>{inside}</tr></table>", "dd": f"<dl>{inside}</dl>", "figcaption": f"<figure>{inside}</figure>"}.get(name, inside)
        if rng.random() < 0.15:
            body += some(1, 2)
    body += some(0, 2) if rng.random() < 0.4 else ""
    box = pick(CONTENT_BOXES)
    main = _marked(box, KEEP) + body + _end(box)
    page = some(0, 4) + main + some(0, 4)
    if rng.random() < 0.4:
        wrap = pick(('<div class="wrapper">', '<div class="container"><div class="row">', '<div id="page">', "<div>", "<section>"))
        page = wrap + page + _end(wrap)
    return f"<html><head><title>{pick(short)}</title></head><body>{page}</body></html>"


STOCK = (
    "Copyright {year} {name}", "© {year} {name}. All rights reserved.", "(c) {year} {name}", "All rights reserved", "Terms of use", "Privacy policy", "{name} © {year}",
    "We use cookies to improve this site. Accept or read our cookie policy.", "This website uses cookies.", "Subscribe to our newsletter", "Sign up for free updates by email",
    "Log in or register", "Share this page", "Follow us", "Powered by {name}", "Contact us at info@example.org", "Advertisement", "Sponsored: buy now at {name}",
    "You may also like", "Skip to content", "Back to top", "Leave a comment", "Filed under {name}", "Order today and save 20 %", "Designed by {name}",
)
PLAIN_BOXES = ("div", "div", "div", "div", "span><div", "section", "table><tr><td", "table><tr><td", "center", "td", "ul><li", "font><div")


def compose_plain(rng, content: list[str], other: list[str], short: list[str]) -> str:
    """A page from given texts whose containers have no telling names: bare elements, or names without a meaning."""
    pick = lambda values: values[rng.integers(len(values))]

    def name() -> str:
        made = "".join(pick("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.integers(1, 7)))
        return made + pick(("", "", "-", "_")) + (str(rng.integers(100)) if rng.random() < 0.5 else "")

    def named() -> str:
        form = rng.random()
        return "" if form < 0.4 else f' id="{name()}"' if form < 0.5 else f' class="{" ".join(name() for _ in range(rng.integers(1, 4)))}"'

    def boxed(inner: str, mark: str, tag: str | None = None) -> str:
        box = f"<{tag or pick(PLAIN_BOXES)}>"
        own = re.sub(r"<(\w+)>", lambda m: f"<{m[1]}{named()}>", box)
        return _marked(own, mark) + inner + _end(box)

    def stock() -> str:
        return pick(STOCK).format(year=rng.integers(1995, 2030), name=pick(short)) if rng.random() < 0.85 else pick(other)

    def boilerplate() -> str:
        form = rng.random()
        if form < 0.55:
            joint = pick(("", " ", " | ", " · ", "</li><li>", "</p><p>", "</div><div>", "<br>"))
            links = joint.join(f'<a href="/x">{pick(short)}</a>' for _ in range(rng.integers(1, 10)))
            if joint.startswith("</"):
                links = f"<{joint[2:].split('>')[0]}>{links}{joint.split('<')[1].join(('<', ''))}"
                links = f"<ul>{links}</ul>" if "<li>" in links and rng.random() < 0.7 else links
            return boxed(links, DROP)
        if form < 0.9:
            return boxed("".join(f"<p>{stock()}</p>" for _ in range(rng.integers(1, 3))) if rng.random() < 0.4 else stock(), DROP)
        return boxed(f'<form><label>{pick(short)}</label><input><button>{pick(short)}</button></form>', DROP)

    some = lambda low, high: "".join(boilerplate() for _ in range(rng.integers(low, high)))
    body = f"<h1>{pick(short)} {pick(content)[:60]}</h1>" if rng.random() < 0.7 else ""
    form, long = rng.random(), [c for c in content if len(c) >= 40] or content
    for _ in range(rng.integers(1, 14)):
        text = pick(long) if rng.random() < 0.85 else pick(content)
        text = f'{text} <a href="/x">{pick(short)}</a> {pick(content)}' if rng.random() < 0.1 else text
        if form < 0.55:
            tag = pick(("p", "p", "p", "p", "p", "p", "h2", "h3", "blockquote", "pre"))
            body += f"<{tag}>{text[:80] if tag[0] == 'h' else text}</{tag}>" if rng.random() < 0.93 else f"<ul><li>{text}</li><li>{pick(content)}</li></ul>"
        elif form < 0.7:
            body += f"{text}<br>{'<br>' if rng.random() < 0.5 else ''}"
        elif form < 0.85:
            body += f"<div>{text}</div>" if rng.random() < 0.8 else f"<p>{text}</p>"
        else:
            body += f"<div{named()}>{text}<br>{pick(content)}</div><p>{pick(long)}</p>"
        if rng.random() < 0.05:
            body += boilerplate()
    place = rng.random()
    lead, tail = some(0, 4), some(0, 4)
    if place < 0.3:
        return f"<html><head><title>{pick(short)}</title></head><body{KEEP}>{lead}{body}{tail}</body></html>"
    page = lead + boxed(body, KEEP, pick(("div", "div", "div", "table><tr><td", "div><div", "section"))) + tail
    if rng.random() < 0.4:
        page = f"<div{named()}>{page}</div>"
    return f"<html><head><title>{pick(short)}</title></head><body>{page}</body></html>"


def kept_by_mark(block: Part) -> bool:
    for _, rest in reversed(block.path):
        if "data-keep" in rest:
            return KEEP in rest
    return False


def fit(pages: DataFrame, html: str = "html", id: str = "page_id", train_pages: int = TRAIN_PAGES, composed: int = COMPOSED_PAGES) -> Labeller:
    """Train the net on at most ``train_pages`` pages, chosen by a digest of id and page, and pages composed of their texts."""
    key = F.col(f"`{id}`").cast("string")
    sample = pages.select(key.alias("id"), F.col(f"`{html}`").alias("html")).where("html IS NOT NULL")
    rows = [r[0] for r in bounded_sample(sample, F.xxhash64("id", "html"), train_pages, pages.count()).select("html").collect()]
    cut = [p for p in map(parts, rows) if p]
    own = [np.array([told_by_name(b.path) for b in p], np.float32) for p in cut]
    quoted = lambda values: [entities.escape(v, quote=False) for v in values]
    told = [(b, k) for p, y in zip(cut, own, strict=True) for b, k in zip(p, y, strict=True)]
    content = quoted(b.text for b, k in told if k == 1) or quoted(b.text for b, k in told if not k == 0 and not b.linked and len(b.text) >= 80)
    content = content or ["Some words about something that goes on for a line, and more of it."]
    rest = quoted(b.text for b, k in told if k == 0)
    short = [t for t in rest if len(t) < 40] or ["More"]
    other = [t for t in rest if len(t) >= 15] or ["All rights reserved."]
    rng = np.random.default_rng(SEED)
    made = [parts((compose_plain if i % 2 else compose)(rng, content, other, short)) for i in range(composed)]
    made = [p for p in made if p]
    vectors = Vectors()
    labels = own + [np.array([kept_by_mark(b) for b in p], np.float32) for p in made]
    net = Labeller(Vectors.size)
    vectors_of = [vectors.page(p) for p in (*cut, *made)]
    net.train([*vectors_of, *vectors_of[: len(cut)] * 4], [*labels, *own * 4])  # given pages count five times
    return net


def extract(pages: DataFrame, net: Labeller, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default page_id, url) of each row plus text, n_chars, n_blocks and n_kept.

    text joins the kept blocks in page order by one line feed.  A NULL or empty page, and one of which nothing is kept, has an empty text.
    Broken markup is read as far as it goes; repeated rows get equal results; other columns are not read.
    """
    keep = ["page_id", "url"] if keep is None else keep
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html}`").alias("_html"))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, out = Vectors(), None
        for batch in batches:
            if out is None:
                more = [pa.field("text", pa.string()), *(pa.field(c, pa.int64()) for c in ("n_chars", "n_blocks", "n_kept"))]
                out = Batches(pa.schema([*(batch.schema.field(c) for c in keep), *more]))
            kept = [batch.column(c) for c in keep]
            for start in range(0, batch.num_rows, READ_AT_ONCE):
                cut = [parts(v) for v in texts(batch.slice(start, READ_AT_ONCE), "_html")]
                chosen: list[np.ndarray] = [np.zeros(0)] * len(cut)
                order = sorted((i for i, p in enumerate(cut) if p), key=lambda i: len(cut[i]))
                for group in (order[i : i + 64] for i in range(0, len(order), 64)):
                    for i, found in zip(group, net.scores([vectors.page(cut[i]) for i in group]), strict=True):
                        chosen[i] = found
                for i, blocks in enumerate(cut):
                    lines = [b.text for b, p in zip(blocks, chosen[i], strict=True) if p >= 0.5]
                    text = "\n".join(lines)
                    yield from out.add((*(c[start + i].as_py() for c in kept), text, len(text), len(blocks), len(lines)), len(text) + 64)
        if out is not None:
            yield from out.flush()

    return rows.mapInArrow(run, f"{schema}, text string, n_chars long, n_blocks long, n_kept long")
