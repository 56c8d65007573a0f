"""Main text of web pages by a recurrent block labeller.

A page becomes its leaf sequence: runs of text between block-level tags, each
with the path of open elements.  A bidirectional LSTM in numpy reads, for every
block, hashed vectors of its tag path and words and a few sizes, and labels
every block with the whole page as context.  The labeller is trained when first
used, on pages that this module makes up from a fixed seed.
"""

from __future__ import annotations

import html
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import slices

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|noscript|template|svg|textarea|iframe|object)\b[^>]*(?:>.*?(?:</(?P=raw)\b[^>]*(?:>|\Z)|\Z)|\Z)"
    r"""|<(?P<tag>[a-zA-Z/!?](?>[^>"'=]+|=\s*"[^"]*(?:"|\Z)|=\s*'[^']*(?:'|\Z)|["'=])*+)(?:>|\Z)"""
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9]*)")
MARKS = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")
#: Elements that do not end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that an opening tag of the same kind ends.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

PATH_BINS, WORD_BINS, SIZES = 64, 32, 8
WIDTH = PATH_BINS + WORD_BINS + SIZES
HIDDEN = 16


def _bin(word: str, bins: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % bins


def leaves(page: str) -> list[tuple[str, tuple[str, ...], int]]:
    """(text, path, characters inside links) of each block.  Character
    references are decoded and white space is one space."""
    out: list[tuple[str, tuple[str, ...], int]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, in_link = 0, False

    def end():
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        if text:
            out.append((text, tuple(x for _, marks in stack for x in marks), linked))
        parts, linked = [], 0

    for m in TOKEN.finditer(page):
        text, tag = m["text"], m["tag"]
        if text is not None:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            linked += len(text) if in_link else 0
        elif tag is not None and (n := NAME.match(tag)):
            closing, name = bool(n[1]), n[2].lower()
            if name in INLINE:
                in_link = not closing if name == "a" else in_link
                if name == "br":
                    parts.append(" ")
                continue
            end()
            if closing:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
            elif name not in VOID and not tag.endswith("/"):
                if stack and stack[-1][0] in CLOSES.get(name, ()):
                    stack.pop()
                marks = [name]
                for a in MARKS.findall(tag):
                    marks.extend(WORDS.findall("".join(a).lower()))
                stack.append((name, tuple(marks)))
            in_link = False
        elif m["raw"]:
            end()
    end()
    return out


def features(blocks: list[tuple[str, tuple[str, ...], int]], before: int = 0, total: int = 0) -> np.ndarray:
    """A vector for each block; ``before`` blocks of the page's ``total`` come
    first, where these are a part of it."""
    total = total or len(blocks)
    out = np.zeros((len(blocks), WIDTH), np.float32)
    for i, (text, path, linked) in enumerate(blocks):
        for mark in path:
            out[i, _bin(mark, PATH_BINS)] = 1
        ws = text.split(" ")
        bag = np.bincount([_bin(w, WORD_BINS) for w in ws], minlength=WORD_BINS)
        out[i, PATH_BINS : PATH_BINS + WORD_BINS] = bag / len(ws)
        n = len(text)
        out[i, PATH_BINS + WORD_BINS :] = (
            np.log1p(n) / 8,
            np.log1p(len(ws)) / 6,
            min(linked / n, 1.0),
            sum(text.count(c) for c in ".!?") / len(ws),
            float(path[-1:] == ("p",)),
            float(path[-1:] == ("li",)),
            (before + i) / total,
            len(path) / 16,
        )
    return out


class Labeller:
    """A bidirectional LSTM with a logistic output for each block."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.p = {}
        for side in "fb":
            self.p["W" + side] = (rng.standard_normal((WIDTH + HIDDEN, 4 * HIDDEN)) / np.sqrt(WIDTH / 4)).astype(np.float32)
            self.p["b" + side] = np.repeat(np.float32([0, 1, 0, 0]), HIDDEN)
        self.p["V"] = (rng.standard_normal(2 * HIDDEN) / np.sqrt(HIDDEN)).astype(np.float32)
        self.p["c"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, state=None):
        """Yields the steps of one direction: time, state before, gates, state
        after; x is (time, batch, width), mask (time, batch)."""
        steps, batch, _ = x.shape
        w, u = self.p["W" + side][:WIDTH], self.p["W" + side][WIDTH:]
        given = x @ w + self.p["b" + side]
        h, c = state or (np.zeros((batch, HIDDEN), np.float32), np.zeros((batch, HIDDEN), np.float32))
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = given[t] + h @ u
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            c_new = (f * c + i * g) * m
            h_new = o * np.tanh(c_new) * m
            yield t, h, c, i, f, o, g, c_new, h_new
            h, c = h_new, c_new

    def _side(self, side: str) -> np.ndarray:
        k = "fb".index(side)
        return self.p["V"][k * HIDDEN : (k + 1) * HIDDEN]

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        out = np.full(x.shape[:2], self.p["c"][0], np.float32)
        for s in "fb":
            for step in self._run(x, mask, s):
                out[step[0]] += step[-1] @ self._side(s)
        return out

    def logits_of(self, blocks: list, most: int) -> np.ndarray:
        """The logits of one page of any length, ``most`` blocks at a time: of
        each part only the state at its end is carried on."""
        out = np.full(len(blocks), self.p["c"][0], np.float32)
        for s in "fb":
            state = None
            starts = range(0, len(blocks), most)
            for at in starts if s == "f" else reversed(starts):
                part = blocks[at : at + most]
                x, mask = padded([features(part, at, len(blocks))])
                for step in self._run(x, mask, s, state):
                    out[at + step[0]] += (step[-1] @ self._side(s))[0]
                    state = step[-1], step[-2]
        return out

    def gradients(self, x, mask, y):
        runs = {s: list(self._run(x, mask, s)) for s in "fb"}
        states = np.zeros((*x.shape[:2], 2 * HIDDEN), np.float32)
        for k, s in enumerate("fb"):
            for step in runs[s]:
                states[step[0], :, k * HIDDEN : (k + 1) * HIDDEN] = step[-1]
        out = states @ self.p["V"] + self.p["c"]
        d_out = (1 / (1 + np.exp(-out)) - y) * mask / mask.sum()
        grads = {"V": np.einsum("tbh,tb->h", states, d_out), "c": np.array([d_out.sum()])}
        for k, s in enumerate("fb"):
            u, d_u = self.p["W" + s][WIDTH:], np.zeros((HIDDEN, 4 * HIDDEN), np.float32)
            d_z_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            d_h, d_c = np.zeros_like(runs[s][0][1]), np.zeros_like(runs[s][0][1])
            v = self.p["V"][k * HIDDEN : (k + 1) * HIDDEN]
            for t, h, c, i, f, o, g, c_new, _ in reversed(runs[s]):
                m = mask[t][:, None]
                d_h = (d_h + d_out[t][:, None] * v) * m
                tc = np.tanh(c_new)
                d_c = (d_c + d_h * o * (1 - tc * tc)) * m
                d_z = np.concatenate([d_c * g * i * (1 - i), d_c * c * f * (1 - f), d_h * tc * o * (1 - o), d_c * i * (1 - g * g)], axis=1)
                d_z_all[t] = d_z
                d_u += h.T @ d_z
                d_h, d_c = d_z @ u.T, d_c * f
            d_w = np.einsum("tbi,tbj->ij", x, d_z_all, optimize=True)
            grads["W" + s], grads["b" + s] = np.concatenate([d_w, d_u]), d_z_all.sum((0, 1))
        return grads

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """True for the blocks of the main text; pages of like length together."""
        out: list = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            most = 1
            while at + most < len(order) and most < 256 and (most + 1) * len(pages[order[at + most]]) <= 50_000:
                most += 1
            some = order[at : at + most]
            x, mask = padded([pages[i] for i in some])
            good = self.logits(x, mask) > 0
            for k, i in enumerate(some):
                out[i] = good[: len(pages[i]), k]
            at += most
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((steps, len(pages), WIDTH), np.float32), np.zeros((steps, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, 1
    return x, mask


# ---- made-up pages to train on

#: Boilerplate by kind: opening tags that pages of many sites use.
ROUND = {
    "menu": ["nav", 'div class="menu"', 'div id="nav"', 'ul class="navigation"', 'div class="breadcrumbs"', 'div role="navigation"', 'div class="navbar top"'],
    "header": ["header", 'div class="header"', 'div id="masthead"', 'div class="site-header"', 'div role="banner"', 'div class="topbar"'],
    "footer": ["footer", 'div class="footer"', 'div id="footer"', 'div class="copyright"', 'div role="contentinfo"'],
    "side": ["aside", 'div class="sidebar"', 'div id="sidebar"', 'div class="widget"', 'section class="related"', 'div class="related-posts"', 'div class="share social"', 'div class="tags"'],
    "notice": ['div class="notice"', 'div class="cookie-banner"', 'div id="consent"', 'div class="alert"', 'p class="notice"', 'div class="gdpr popup"', 'div class="message"'],
    "ad": ['div class="ad"', 'div class="ads"', 'div class="advert"', 'div class="advertisement"', 'div class="sponsored"', 'div id="banner-ad"', 'div class="promo"', 'p class="ad"'],
    "form": ["form", 'form class="newsletter"', 'form id="search"', 'div class="subscribe"', 'div class="login form"'],
    "comments": ['div id="comments"', 'section class="comments"', 'div class="comment-list"', 'ol class="commentlist"', 'div class="comment"', 'article class="comment"', 'div class="disqus reader-comments"', 'div class="replies"'],
}
MAIN = ["article", "main", 'div id="content"', 'div class="content"', 'div class="post"', 'div class="entry-content"', 'article class="post"', 'div class="article-body"', 'section class="story"', 'div role="main"', 'div class="text"']
PHRASES = {
    "notice": "we use cookies to improve your experience accept this site privacy policy terms".split(),
    "footer": "copyright all rights reserved contact imprint privacy terms".split(),
    "form": "search subscribe email your name submit login password send".split(),
    "comments": "reply says posted by report thanks great post agree comment".split(),
    "ad": "advertisement sponsored buy now sale offer free click here".split(),
    "side": "related read more popular share tweet follow latest tags".split(),
}


def made_page(rng: random.Random) -> tuple[str, list[int]]:
    """A page and the labels of its blocks."""
    tongue = ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    word = lambda: "".join(rng.choice(tongue) for _ in range(rng.randint(1, 3)))
    parts, labels = ["<html><body>"], []

    def say(n: int, kind: str = "") -> str:
        ws = [rng.choice(PHRASES[kind]) if kind in PHRASES and rng.random() < 0.4 else word() for _ in range(max(n, 1))]
        for k in range(len(ws)):
            ws[k] += rng.choice([".", ",", ""]) if rng.random() < 0.15 else ""
        return " ".join(ws).capitalize()

    def block(open_: str, inner: str, label: int) -> None:
        parts.append(f"<{open_}>{inner}" + (f"</{open_.split()[0]}>" if rng.random() < 0.95 or open_ != "p" else ""))
        labels.append(label)

    def around(kind: str) -> None:
        open_ = rng.choice(ROUND[kind])
        name = open_.split()[0]
        if name == "p" or rng.random() < 0.45 and kind != "menu":  # text straight inside
            block(open_, say(rng.randint(1, 40), kind), 0)
            return
        parts.append(f"<{open_}>")
        for _ in range(rng.randint(1, 7)):
            text = say(rng.randint(1, 4) if kind in ("menu", "header", "form") else rng.randint(1, 45 if kind == "comments" else 25), kind)
            if kind in ("menu", "side", "footer", "header") and rng.random() < 0.7:
                text = f'<a href="/{word()}">{text}</a>'
            block(rng.choice(["li", "li", "p", "div"] if kind in ("menu", "side") else ["p", "p", "div", "li", "h3"]), text, 0)
        parts.append(f"</{name}>")

    for kind in ("notice", "header", "menu", "ad", "side"):
        if rng.random() < 0.5:
            around(kind)
    wrapped = rng.random() < 0.3
    if wrapped:
        parts.append(f'<div class="{rng.choice(["wrap", "container", "page", "row", "main wrapper", word()])}">')
    open_ = rng.choice(MAIN) if rng.random() < 0.9 else f'div class="{word()}"'
    parts.append(f"<{open_}>")
    if rng.random() < 0.85:
        block(rng.choice(["h1", "h1", "h2"]), say(rng.randint(1, 14)), 1)
    for _ in range(rng.choice([1, 2, 3, 5, 8, 12])):
        r = rng.random()
        if r < 0.7:
            text = say(rng.choice([1, 2, 5, 20, 60, 120]))
            if rng.random() < 0.2:
                text = f"<b>{text}</b>" if rng.random() < 0.5 else f'{text} <a href="/x">{word()}</a>'
            block("p", text, 1)
        elif r < 0.85:
            block(rng.choice(["h2", "h3", "blockquote", "pre", "figcaption", "div"]), say(rng.randint(1, 20)), 1)
        elif r < 0.93:
            parts.append("<ul>")
            for _ in range(rng.randint(1, 4)):
                block("li", say(rng.randint(1, 15)), 1)
            parts.append("</ul>")
        else:
            around(rng.choice(["ad", "ad", "side", "notice", "form"]))
    if rng.random() < 0.15:
        around("comments")
    parts.append(f"</{open_.split()[0]}>")
    for kind in ("comments", "side", "form", "ad"):
        if rng.random() < 0.35:
            around(kind)
    if wrapped:
        parts.append("</div>")
    if rng.random() < 0.8:
        around("footer")
    return "".join(parts) + "</body></html>", labels


def train(pages: int = 1000, rounds: int = 10, seed: int = 7) -> Labeller:
    """Fit a labeller on made-up pages by Adam; the same for the same seed."""
    rng, own = random.Random(seed), Labeller()
    made = []
    while len(made) < pages:
        page, labels = made_page(rng)
        found = leaves(page)
        if len(found) == len(labels):
            made.append((features(found), np.float32(labels)))
    made.sort(key=lambda x: len(x[1]))
    batches = [made[i : i + 25] for i in range(0, len(made), 25)]
    first, second, step = {k: 0.0 for k in own.p}, {k: 0.0 for k in own.p}, 0
    for _ in range(rounds):
        rng.shuffle(batches)
        for batch in batches:
            x, mask = padded([f for f, _ in batch])
            y = np.zeros_like(mask)
            for k, (_, labels) in enumerate(batch):
                y[: len(labels), k] = labels
            step += 1
            for k, g in own.gradients(x, mask, y).items():
                g = np.clip(g, -1, 1)
                first[k], second[k] = 0.9 * first[k] + 0.1 * g, 0.99 * second[k] + 0.01 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                own.p[k] = (own.p[k] - 0.02 * move).astype(np.float32)
    return own


_trained: list[Labeller] = []


def labeller() -> Labeller:
    """The labeller of this process, trained at its first use."""
    if not _trained:
        _trained.append(train())
    return _trained[0]


#: Blocks of a page that are labelled at once; a longer page goes on in parts.
PART = 10_000


def main_text(pages: list[str], own: Labeller, part: int = PART) -> list[str]:
    blocks = [leaves(p or "") for p in pages]
    labels = own.label([features(b if len(b) <= part else []) for b in blocks])
    labels = [own.logits_of(b, part) > 0 if len(b) > part else good for b, good in zip(blocks, labels)]
    return ["\n".join(x[0] for x, good in zip(b, keep) if good) for b, keep in zip(blocks, labels)]


def _batches(shared):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                texts = main_text(part.column("html").to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: Labeller | None = None) -> DataFrame:
    """One row for each row of ``pages``: id, url, text, n_chars (code points).

    The text is that of the blocks labelled main, joined in page order by line
    feeds.  Null and empty pages, and pages without a main block, give an empty
    text; markup cut off at a page's end is markup; repeated rows and null ids
    are rows like others.  Pages may have any length: beyond ``PART`` blocks
    the states are carried from part to part.  Other columns are not read.  The
    model is a few thousand weights, whatever the input.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or labeller())
    kinds = dict(pages.dtypes)
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    out = source.mapInArrow(_batches(shared), f"id {kinds[id_col]}, url {kinds[url_col]}, text string, n_chars bigint")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
