"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, each with the
path of its open elements. A bidirectional LSTM in numpy reads, block by block, a vector
of the hashed path (tags, classes, ids, roles), a vector of hashed words and a few
measures, so that each block is judged with the whole page in view. It is trained on a
bounded sample of pages: their blocks, labelled by the element that holds them, as they
stand and set anew into many page layouts whose parts are known.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 400  # pages that are learnt from, at most
LAYOUTS = 900  # pages composed from their blocks
PATH_SIZE, WORD_SIZE, MEASURES = 96, 128, 6
HIDDEN = 16
KNOWN_WORDS = 500_000  # words whose places are kept in memory
PAGES_AT_ONCE = 256

RESULT = "page_id long, url string, text string, n_chars long"

# Elements by their part in HTML.
RAW = {"script", "style", "noscript", "template", "svg", "iframe", "textarea", "select", "object", "canvas", "math", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q",
    "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "input", "button",
}
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
OUTSIDE = {"head", "nav", "footer", "aside", "form", "dialog", "menu"}
WRAPS = {"form", "dialog"}  # of these, what also holds whole pages

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PIECE = re.compile(r"[a-z]+")
_ENDS = {tag: re.compile(rf"</{tag}[^>]*+>", re.I) for tag in RAW}


class Block:
    __slots__ = ("text", "path", "linked", "tags")

    def __init__(self, text: str, path: tuple[int, ...], linked: int, tags: tuple[str, ...]):
        self.text, self.path, self.linked, self.tags = text, path, linked, tags


def _slot(name: str, size: int) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % size


_places: dict[str, int] = {}


def word_counts(words: list[str]) -> np.ndarray:
    """How many of the words fall into each place; all of them count."""
    if len(_places) > KNOWN_WORDS:
        _places.clear()
    places = []
    for w in words:
        at = _places.get(w)
        if at is None:
            at = _places[w] = _slot(w, WORD_SIZE)
        places.append(at)
    return np.bincount(places, minlength=WORD_SIZE)


def _slots(tag: str, attributes: str) -> tuple[int, ...]:
    """Places of an element in the path vector: its tag, and the words of its names."""
    out = [_slot("<" + tag, PATH_SIZE)]
    if attributes:
        for found in _NAMES.findall(attributes):
            out += [_slot(w, PATH_SIZE) for w in _PIECE.findall("".join(found).lower()) if len(w) > 1]
    return tuple(out)


def leaf_blocks(page: str) -> list[Block]:
    """Non-empty runs of text between block-level tags, in page order."""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[int, ...]]] = []
    held: list[str] = []
    linked = at = anchors = hidden = 0

    def flush():
        nonlocal linked
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text and not hidden:
                path = tuple(s for _, slots in stack for s in slots)
                blocks.append(Block(text, path, min(linked, len(text)), tuple(t for t, _ in stack)))
            held.clear()
        linked = 0

    def close(upto: int):
        nonlocal anchors, hidden
        for tag, _ in stack[upto:]:
            anchors -= tag == "a"
            hidden -= tag == "head"
        del stack[upto:]

    while True:
        found = _TOKEN.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            held.append(text)
            linked += len(text) if anchors > 0 else 0
        if not found:
            break
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            flush()
        elif tag == "br":
            held.append(" ")
        if found[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
        elif tag in RAW:
            end = _ENDS[tag].search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not found[3].endswith("/"):
            shut = CLOSES.get(tag)
            if shut:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in shut:
                        close(i)
                        break
                    if stack[i][0] not in INLINE and stack[i][0] not in shut:
                        break
            if tag == "body":
                close(next((i for i, s in enumerate(stack) if s[0] == "head"), len(stack)))
            stack.append((tag, _slots(tag, found[3])))
            anchors += tag == "a"
            hidden += tag == "head"
    flush()
    return blocks


def vectors(blocks: list[Block]) -> np.ndarray:
    """Input of the labeller, one row per block."""
    out = np.zeros((len(blocks), PATH_SIZE + WORD_SIZE + MEASURES), dtype=np.float32)
    for i, b in enumerate(blocks):
        row = out[i]
        row[list(b.path)] = 1.0
        words = b.text.split(" ")
        row[PATH_SIZE : PATH_SIZE + WORD_SIZE] = word_counts(words) / len(words)
        n = len(b.text)
        row[-MEASURES:] = (
            math.log1p(n) / 8,
            b.linked / max(1, n),
            min(1.0, sum(map(b.text.count, ".,;:!?")) * 10 / n),
            i / len(blocks),
            1 - (i + 1) / len(blocks),
            math.log1p(len(words)) / 6,
        )
    return out


# ---- the network --------------------------------------------------------------


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_network(seed: int, width: int) -> dict:
    draw = np.random.default_rng(seed)
    net = {}
    for side in ("f", "b"):
        net[f"w{side}"] = (draw.standard_normal((width, 4 * HIDDEN)) * 0.15).astype(np.float32)
        net[f"u{side}"] = (draw.standard_normal((HIDDEN, 4 * HIDDEN)) * 0.15).astype(np.float32)
        net[f"c{side}"] = np.zeros(4 * HIDDEN, dtype=np.float32)
        net[f"c{side}"][HIDDEN : 2 * HIDDEN] = 1.0
    net["o"] = (draw.standard_normal(2 * HIDDEN) * 0.2).astype(np.float32)
    net["d"] = np.zeros(width, dtype=np.float32)
    net["z"] = np.zeros(1, dtype=np.float32)
    return net


def _pass(net: dict, side: str, x: np.ndarray, mask: np.ndarray):
    """One direction over ``steps, pages, width``; keeps what the gradient needs."""
    steps, pages, _ = x.shape
    h = np.zeros((pages, HIDDEN), np.float32)
    c = np.zeros((pages, HIDDEN), np.float32)
    fed = x @ net[f"w{side}"] + net[f"c{side}"]
    tape, out = [], np.zeros((steps, pages, HIDDEN), np.float32)
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        a = fed[t] + h @ net[f"u{side}"]
        i, f, o = _sigmoid(a[:, :HIDDEN]), _sigmoid(a[:, HIDDEN : 2 * HIDDEN]), _sigmoid(a[:, 2 * HIDDEN : 3 * HIDDEN])
        g = np.tanh(a[:, 3 * HIDDEN :])
        m = mask[t][:, None]
        new = f * c + i * g
        tape.append((t, h, c, i, f, o, g, np.tanh(new), m))
        c = np.where(m, new, c)
        h = np.where(m, o * np.tanh(new), h)
        out[t] = h
    return out, tape


def label(net: dict, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Chance that each block is main text, ``steps, pages``."""
    forward, backward = _pass(net, "f", x, mask)[0], _pass(net, "b", x, mask)[0]
    return _sigmoid(forward @ net["o"][:HIDDEN] + backward @ net["o"][HIDDEN:] + x @ net["d"] + net["z"])


def _gradient(net: dict, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict:
    outs, tapes = zip(*(_pass(net, s, x, mask) for s in ("f", "b")))
    z = outs[0] @ net["o"][:HIDDEN] + outs[1] @ net["o"][HIDDEN:] + x @ net["d"] + net["z"]
    gap = np.where(mask, _sigmoid(z) - y, 0.0).astype(np.float32) / max(1, mask.sum())
    grad = {"z": np.array([gap.sum()]), "d": np.einsum("tp,tpw->w", gap, x)}
    grad["o"] = np.concatenate([np.einsum("tp,tph->h", gap, o) for o in outs])
    for k, side in enumerate("fb"):
        u = net[f"u{side}"]
        weight = net["o"][k * HIDDEN : (k + 1) * HIDDEN]
        dh = np.zeros((x.shape[1], HIDDEN), np.float32)
        dc = np.zeros_like(dh)
        da_all = np.zeros((x.shape[0], x.shape[1], 4 * HIDDEN), np.float32)
        gu = np.zeros_like(u)
        for t, h, c, i, f, o, g, squashed, m in reversed(tapes[k]):
            dh = dh + gap[t][:, None] * weight
            inner = np.where(m, dh, 0.0)
            dnew = inner * o * (1 - squashed**2) + np.where(m, dc, 0.0)
            da = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), inner * squashed * o * (1 - o), dnew * i * (1 - g**2)], axis=1)
            da_all[t] = da
            gu += h.T @ da
            dh = np.where(m, da @ u.T, dh)
            dc = np.where(m, dnew * f, dc)
        grad[f"u{side}"] = gu
        grad[f"w{side}"] = np.einsum("tpw,tpk->wk", x, da_all, optimize=True)
        grad[f"c{side}"] = da_all.sum(axis=(0, 1))
    return grad


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(r) for r in rows)
    x = np.zeros((steps, len(rows), rows[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(rows)), dtype=bool)
    for i, r in enumerate(rows):
        x[: len(r), i] = r
        mask[: len(r), i] = True
    return x, mask


def train_network(samples: list[tuple[np.ndarray, np.ndarray]], epochs: int = 7, seed: int = 7) -> dict:
    """Fit on ``(vectors, labels)`` of pages with Adam; deterministic."""
    width = PATH_SIZE + WORD_SIZE + MEASURES
    net = new_network(seed, width)
    samples = [s for s in samples if len(s[0])]
    order = random.Random(seed)
    first = {k: np.zeros_like(v) for k, v in net.items()}
    second = {k: np.zeros_like(v) for k, v in net.items()}
    turn = 0
    for epoch in range(epochs):
        order.shuffle(samples)
        for a in range(0, len(samples), 64):
            part = samples[a : a + 64]
            x, mask = padded([s[0] for s in part])
            y = np.zeros(mask.shape, np.float32)
            for i, (_, labels) in enumerate(part):
                y[: len(labels), i] = labels
            turn += 1
            rate = 0.02 * (0.5 if epoch >= epochs // 2 else 1.0)
            for k, g in _gradient(net, x, mask, y).items():
                g = np.clip(g, -1, 1) + (1e-5 * net[k] if k != "z" else 0)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net[k] = (net[k] - rate * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.999**turn)) + 1e-8)).astype(np.float32)
    return net


# ---- training pages -------------------------------------------------------------

GOOD = ("article", "content", "main", "post", "entry", "story", "post body", "article text", "entry content", "page content", "main content")
PARTS = {  # parts of a page that are not main text: elements, names
    "menu": (("nav", "div", "ul", "header"), ("nav", "menu", "navbar", "navigation", "breadcrumb", "topnav", "site nav", "main menu", "breadcrumbs", "toc links")),
    "header": (("header", "div"), ("header", "site header", "masthead", "banner", "top bar", "logo", "branding", "page header")),
    "footer": (("footer", "div"), ("footer", "site footer", "copyright", "bottom", "colophon", "legal footer", "page footer")),
    "side": (("aside", "div", "section"), ("sidebar", "aside", "widget", "related", "side", "recommended", "most read", "related posts", "popular", "trending")),
    "advert": (("div", "aside", "section", "p"), ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad banner", "sponsor", "promotion")),
    "notice": (("div", "section", "p", "dialog"), ("cookie", "notice", "consent", "cookie notice", "gdpr", "alert", "popup", "modal", "cookie banner", "warning")),
    "form": (("form", "div"), ("form", "login", "search", "newsletter", "subscribe", "signup", "contact form", "search form")),
    "share": (("div", "ul"), ("share", "social", "tags", "meta", "byline", "pagination", "tools", "author info")),
    "comments": (("section", "div", "ol"), ("comments", "comment", "comment list", "responses", "discussion", "replies", "user comments", "disqus")),
}


def _element(tag: str, names: str, body: str, draw: random.Random) -> str:
    joiner = draw.choice(("-", " ", "_", ""))
    attribute = draw.choice(("class", "class", "id", "role")) if names else ""
    return f'<{tag} {attribute}="{names.replace(" ", joiner)}">{body}</{tag}>' if attribute else f"<{tag}>{body}</{tag}>"


def compose(draw: random.Random, good: list[str], bad: list[str]) -> tuple[str, list[int]]:
    """A page in a random layout, and the label of each of its blocks."""
    labels: list[int] = []

    def words(low: int, high: int) -> str:
        source = draw.choice(bad if bad and draw.random() < 0.5 else good).split()
        start = draw.randrange(max(1, len(source) - low))
        return entities.escape(" ".join(source[start : start + draw.randint(low, high)]) or "x", quote=False)

    def part(kind: str) -> str:
        tags, names = PARTS[kind]
        tag, name = draw.choice(tags), draw.choice(names)
        if draw.random() < 0.3 and tag in ("nav", "footer", "aside", "form", "header"):
            name = ""
        if kind == "menu":
            n = draw.randint(2, 8)
            inner = "".join(f'<li><a href="/">{words(1, 2)}</a></li>' for _ in range(n))
            body = inner if tag == "ul" else f"<ul>{inner}</ul>"
            labels.extend([0] * n)
        elif kind == "comments":
            n = draw.randint(1, 5)
            item = draw.choice(("div", "li", "article", "p"))
            body = "".join(_element(item, draw.choice(("comment", "comment body", "reply", "")), words(4, 60), draw) for _ in range(n))
            body = ("<h3>" + words(1, 3) + "</h3>" if tag != "ol" else "<li>" + words(1, 3) + "</li>") + body
            labels.extend([0] * (n + 1))
        elif kind in ("side", "share", "footer", "header", "notice", "form") and draw.random() < 0.5:
            n = draw.randint(1, 4)
            item = draw.choice(("p", "div", "h4", "li"))
            link = draw.random() < 0.5
            body = "".join(f"<{item}>" + (f'<a href="#">{words(1, 9)}</a>' if link else words(1, 25)) + f"</{item}>" for _ in range(n))
            labels.extend([0] * n)
        else:
            body = words(1, 30)
            labels.append(0)
        # The element must not hold what may not stand in it.
        return _element("div" if tag == "p" and "<" in body else tag, name, body, draw)

    def text() -> str:
        out, n = "", draw.randint(1, 9)
        if draw.random() < 0.8:
            out += draw.choice(("<h1>{}</h1>", "<h2>{}</h2>", "<header><h1>{}</h1></header>")).format(words(2, 14))
            labels.append(1)
        for _ in range(n):
            kind = draw.random()
            if kind < 0.72:
                block = words(1, 6) if draw.random() < 0.15 else entities.escape(draw.choice(good), quote=False)
                out += f"<p>{block}" + draw.choice(("</p>", "</p>", "<br>"))
                labels.append(1)
            elif kind < 0.84:
                tag = draw.choice(("h2", "h3", "blockquote", "pre", "div"))
                out += f"<{tag}>{words(2, 30)}</{tag}>"
                labels.append(1)
            elif kind < 0.92:
                m = draw.randint(2, 4)
                out += "<ul>" + "".join(f"<li>{words(2, 20)}</li>" for _ in range(m)) + "</ul>"
                labels.extend([1] * m)
            else:
                out += part(draw.choice(("advert", "share", "notice", "side", "form")))
        return out

    page = "".join(part(k) for k in ("notice", "header", "menu", "advert", "form") if draw.random() < 0.45)
    tag = draw.choice(("article", "article", "main", "div", "section"))
    name = draw.choice(GOOD) if tag in ("div", "section") or draw.random() < 0.4 else ""
    main = _element(tag, name, text(), draw)
    page += _element("dialog", draw.choice(("", "reader", "modal", "popup")), main, draw) if draw.random() < 0.08 else main
    page += "".join(part(k) for k in ("share", "comments", "side", "advert", "form", "footer", "notice") if draw.random() < 0.45)
    page = f'<div class="{draw.choice(("wrap", "page", "container", "row"))}">{page}</div>' if draw.random() < 0.5 else page
    # Some servers set the whole page in one form.
    page = _element("form", draw.choice(("", "", "form1", "aspnet form", "main form", "page", "form")), page, draw) if draw.random() < 0.2 else page
    return f"<html><body>{page}</body></html>", labels


def wrapped(blocks: list[Block]) -> bool:
    """Whether forms or dialogs hold more than half of a page's text."""
    return 2 * sum(len(b.text) for b in blocks if WRAPS.intersection(b.tags)) > sum(len(b.text) for b in blocks)


def weak_label(block: Block, wide: bool = False) -> int | None:
    """By the element that holds a block; none where that does not tell.

    In a ``wide`` page a form or dialog tells nothing, as it may hold the main text.
    """
    for tag in reversed(block.tags):
        if wide and tag in WRAPS:
            continue
        if tag in OUTSIDE:
            return 0
        if tag in ("article", "main"):
            return 1
    return 0 if block.tags and block.tags[-1] == "div" and len(block.tags) <= 3 else None


def train_on(pages: list[str], layouts: int = LAYOUTS) -> dict:
    draw = random.Random(11)
    samples, good, bad = [], [], []
    for page in pages:
        blocks = leaf_blocks(page)
        wide = wrapped(blocks)
        labels = [weak_label(b, wide) for b in blocks]
        good += [b.text for b, y in zip(blocks, labels) if y == 1]
        bad += [b.text for b, y in zip(blocks, labels) if y == 0]
        if blocks and None not in labels and 1 in labels:
            samples.append((vectors(blocks), np.array(labels, np.float32)))
    good, bad = good or ["Lorem ipsum dolor sit amet."], bad or ["Home", "About us", "All rights reserved."]
    for _ in range(layouts):
        page, labels = compose(draw, good, bad)
        blocks = leaf_blocks(page)
        if len(blocks) == len(labels):
            samples.append((vectors(blocks), np.array(labels, np.float32)))
    return train_network(samples)


def main_text(net: dict, pages: list[str]) -> list[str]:
    """Main text of each page: its labelled blocks joined by blank lines."""
    parsed = [leaf_blocks(p) for p in pages]
    out = [""] * len(pages)
    full = sorted((i for i, b in enumerate(parsed) if b), key=lambda i: len(parsed[i]))
    while full:
        # Pages of like length together, and fewer of them if they are long.
        size = max(1, min(PAGES_AT_ONCE, 60_000 // len(parsed[full[-1]])))
        part, full = full[-size:], full[:-size]
        x, mask = padded([vectors(parsed[i]) for i in part])
        chance = label(net, x, mask)
        for k, i in enumerate(part):
            kept = [b.text for b, c in zip(parsed[i], chance[:, k]) if c >= 0.5]
            out[i] = "\n\n".join(kept)
    return out


def _extractor(net: dict):
    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a in range(0, len(frame), 1024):
                part = frame.iloc[a : a + 1024]
                text = main_text(net, [h if isinstance(h, str) else "" for h in part["html"]])
                yield pd.DataFrame({"page_id": part["page_id"].astype("Int64").array, "url": part["url"].array, "text": text, "n_chars": [len(t) for t in text]})

    return extract


def extract_main_text(pages: DataFrame, sample: int = SAMPLE_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` of each page, from its whole html.

    A null or empty html, and a page without main text, give an empty text. Character
    references are decoded, white space inside a block becomes one space, and blocks are
    joined by a blank line. The labeller learns from at most ``sample`` pages, drawn by a
    hash. Repeated rows give equal results; other columns are ignored; an empty table
    gives an empty result.
    """
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    # Very long pages are left out of the sample alone, to bound what the driver holds.
    drawn = given.filter("length(html) BETWEEN 1 AND 200000").orderBy(F.xxhash64("page_id"), F.xxhash64("html")).select("html").limit(sample)
    net = train_on([r["html"] for r in drawn.collect()])
    return given.mapInPandas(_extractor(net), RESULT)
