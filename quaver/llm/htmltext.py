"""Main-text extraction: a numpy bidirectional LSTM labels the leaf blocks of a page.

A page becomes the sequence of its text blocks (text between block-level tags or `br`; inline
tags do not break a block; scripts, styles, templates and comments have no text). A block is
read as a decayed sum of hashed vectors of its tag path (tags, class and id words), the mean of
hashed vectors of its words, its length, its share of linked text and whether it ends like a sentence.
Both directions of the LSTM see the whole page; each block is main text or not.

The model is trained here on TRAIN_PAGES invented pages whose blocks are labelled by how they
were made: articles with headings, paragraphs, lists, quotes and tables,
among menus, headers, footers, sidebars, notices, adverts, forms and comments, in landmark tags,
in containers with telling names, or in containers whose names (col1, wrap, box) say nothing.
Ends of tags that the HTML standard lets one leave out are left out at times. No row of the input is used to train it.

Edge cases: a null or empty page has an empty text; unclosed, unknown and cut-off tags are
tolerated; nothing is cut, whatever the page's length; repeated rows are alike; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaver.llm.textvec import LOWER, Words, slices, text_bytes
from quaver.session import ship

PATH_DIM, WORD_DIM, HIDDEN = 96, 16, 20
DIM = PATH_DIM + WORD_DIM + 4
DECAY = 0.85
TRAIN_PAGES, EPOCHS, BATCH, RATE, SEED = 3500, 9, 40, 0.01, 5
#: Blocks of pages that are labelled at once.
BLOCKS_AT_ONCE = 6000

# Fixed values of the HTML standard: tags without content, with raw content, and within a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript textarea iframe svg".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

# A quote begins a value only after an equals sign; elsewhere it is part of a name or of an unquoted value.
_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^"'\s>][^\s>]*)|=|[^>=])*)(?:>|\Z))""", re.DOTALL)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")
SENTENCE_ENDS = frozenset(".!?:;\u3002\uff01\uff1f\u2026\u00bb\u201d\"")


@functools.lru_cache(maxsize=1 << 16)
def hashed(token: str, dim: int) -> np.ndarray:
    """A fixed pseudo-random vector of a token."""
    rng = np.random.Generator(np.random.PCG64(xxhash.xxh64_intdigest(token.encode("utf-8", "replace"), dim)))
    return (rng.standard_normal(dim) / np.sqrt(dim) * 2).astype(np.float32)


@functools.lru_cache(maxsize=1 << 14)
def _tag_vector(tag: str, attributes: str) -> np.ndarray:
    out = hashed(f"<{tag}>", PATH_DIM).copy()
    names = {p for m in _NAMES.finditer(attributes) for p in _PART.findall((m[1] or m[2] or m[3] or "").lower())}
    for p in sorted(names):
        out += hashed(f".{p}", PATH_DIM)
    return out


@dataclass
class Block:
    text: str
    path: np.ndarray
    linked: float
    start: int  # where its text begins in the page


@dataclass
class _Open:
    tags: list[str] = field(default_factory=list)
    paths: list[np.ndarray] = field(default_factory=list)

    def path(self) -> np.ndarray:
        return self.paths[-1] if self.paths else np.zeros(PATH_DIM, np.float32)

    def push(self, tag: str, attributes: str) -> None:
        self.paths.append(self.path() * DECAY + _tag_vector(tag, attributes))
        self.tags.append(tag)

    def pop_to(self, tags: tuple[str, ...], stop: frozenset[str] = frozenset()) -> None:
        """Close the innermost of the tags and what is open within it."""
        for k in range(len(self.tags) - 1, -1, -1):
            if self.tags[k] in tags:
                del self.tags[k:], self.paths[k:]
                return
            if self.tags[k] in stop:
                return


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page, in order."""
    out: list[Block] = []
    stack, parts, path = _Open(), [], None
    linked = begin = 0

    def flush() -> None:
        nonlocal path, linked
        if path is not None:
            raw = "".join(parts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append(Block(text, path, min(1.0, linked / max(1, len(raw))), begin))
        parts.clear()
        path, linked = None, 0

    def say(text: str, at: int) -> None:
        nonlocal path, linked, begin
        if not text:
            return
        if path is None and not text.isspace():
            path, begin = stack.path(), at
        parts.append(text)
        if "a" in stack.tags[-3:]:
            linked += len(text)

    page = page or ""
    at = 0
    while True:
        m = _TAG.search(page, at)
        if m is None:
            say(page[at:], at)
            break
        if m.start() > at:
            say(page[at : m.start()], at)
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag not in INLINE:
                flush()
            stack.pop_to((tag,))
            continue
        if tag not in INLINE:
            flush()
        if tag in CLOSES_P:
            stack.pop_to(("p",), _SCOPE)
        if tag in SIBLINGS:
            stack.pop_to(SIBLINGS[tag], _LISTS)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not m[3].endswith("/"):
            stack.push(tag, m[3])
    flush()
    return out


_SCOPE = frozenset("article aside body button caption div footer form header main nav section table td th".split())
_LISTS = frozenset("ul ol dl table tbody thead".split())


WORDS = np.random.Generator(np.random.PCG64(77)).standard_normal((1 << 12, WORD_DIM)).astype(np.float32)


def vectors(pages: list[list[Block]]) -> list[np.ndarray]:
    """[block, DIM] for each page: what the LSTM reads."""
    every = [b for page in pages for b in page]
    x = np.zeros((len(every), DIM), np.float32)
    if every:
        data, offsets = text_bytes(pa.array([b.text for b in every], pa.large_string()))
        words = Words(LOWER[data], offsets)
        vector = WORDS[(words.hashes() >> np.uint64(52)).astype(np.int64)]
        some = np.flatnonzero(words.count)
        x[some, PATH_DIM : PATH_DIM + WORD_DIM] = np.add.reduceat(vector, words.first[some]) / words.count[some][:, None]
        x[:, :PATH_DIM] = [b.path for b in every]
        x[:, -4] = np.log1p(np.diff(offsets)) / 5
        x[:, -3] = [b.text[-1] in SENTENCE_ENDS for b in every]
        x[:, -2] = [b.linked for b in every]
        x[:, -1] = 1
    return np.split(x, np.cumsum([len(p) for p in pages])[:-1])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


class BiLSTM:
    """One bidirectional layer and a logistic output that also sees the block itself."""

    def __init__(self, rng: np.random.Generator) -> None:
        h = HIDDEN
        self.p = [(rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32) for s in ((DIM, 4 * h), (h, 4 * h), (DIM, 4 * h), (h, 4 * h), (2 * h + DIM, 1))]
        for w in (self.p[0], self.p[2]):
            w[-1] = 0
            w[-1, h : 2 * h] = 1  # the last input is constant: an open forget gate

    @staticmethod
    def _reverse(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        t = np.arange(x.shape[1])
        at = np.where(t < lengths[:, None], lengths[:, None] - 1 - t, t)
        return np.take_along_axis(x, at[:, :, None], 1)

    def _run(self, x: np.ndarray, wx: np.ndarray, wh: np.ndarray, keep: bool):
        n, steps, _ = x.shape
        z = (x.reshape(-1, DIM) @ wx).reshape(n, steps, -1)
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, tape = np.zeros((n, steps, HIDDEN), np.float32), []
        for t in range(steps):
            a = z[:, t] + h @ wh
            i, f, o = np.split(_sigmoid(a[:, : 3 * HIDDEN]), 3, 1)
            g = np.tanh(a[:, 3 * HIDDEN :])
            before = (h, c)
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[:, t] = h
            if keep:
                tape.append((i, f, o, g, tc, *before))
        return out, tape

    def forward(self, x: np.ndarray, lengths: np.ndarray, keep: bool = False):
        back = self._reverse(x, lengths)
        a, tape_a = self._run(x, self.p[0], self.p[1], keep)
        b, tape_b = self._run(back, self.p[2], self.p[3], keep)
        seen = np.concatenate([a, self._reverse(b, lengths), x], 2)
        return (seen @ self.p[4])[:, :, 0], (back, seen, tape_a, tape_b)

    def _gradient(self, x: np.ndarray, tape: list, up: np.ndarray, wh: np.ndarray):
        n, steps, _ = x.shape
        dz = np.zeros((n, steps, 4 * HIDDEN), np.float32)
        dwh, dh, dc = np.zeros_like(wh), np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            i, f, o, g, tc, h0, c0 = tape[t]
            dh = dh + up[:, t]
            dc = dc + dh * o * (1 - tc * tc)
            dz[:, t] = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            dwh += h0.T @ dz[:, t]
            dh, dc = dz[:, t] @ wh.T, dc * f
        return x.reshape(-1, DIM).T @ dz.reshape(-1, 4 * HIDDEN), dwh

    def gradients(self, x: np.ndarray, lengths: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        z, (back, seen, tape_a, tape_b) = self.forward(x, lengths, keep=True)
        mask = np.arange(x.shape[1]) < lengths[:, None]
        gap = (((_sigmoid(z) - y) * mask) / mask.sum()).astype(np.float32)[:, :, None]
        up = gap @ self.p[4].T
        da = self._gradient(x, tape_a, up[:, :, :HIDDEN], self.p[1])
        db = self._gradient(back, tape_b, self._reverse(up[:, :, HIDDEN : 2 * HIDDEN], lengths), self.p[3])
        return [*da, *db, seen.reshape(-1, seen.shape[2]).T @ gap.reshape(-1, 1)]

    def main(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Which blocks of each page are main text."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        while order:
            width = len(pages[order[-1]])
            some = order[-max(1, BLOCKS_AT_ONCE // width) :]
            del order[-len(some) :]
            x, lengths = pad([pages[k] for k in some])
            z, _ = self.forward(x, lengths)
            for k, row in zip(some, z, strict=True):
                out[k] = row[: len(pages[k])] > 0
        return out


def pad(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in pages])
    x = np.zeros((len(pages), lengths.max(), DIM), np.float32)
    for k, p in enumerate(pages):
        x[k, : len(p)] = p
    return x, lengths


@functools.lru_cache
def _split(text: str) -> list[str]:
    return text.split()


class Maker:
    """Invents labelled pages: lists of (html, is main text) pieces, every text with its own mark."""

    # fixed values: what containers of each kind are called on the web
    LANDMARK = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}
    CLASSES = {
        "menu": "nav menu navbar navigation breadcrumb breadcrumbs topnav pagination toc tabs",
        "header": "header masthead topbar banner site-header branding logo",
        "footer": "footer site-footer copyright legal colophon bottom",
        "sidebar": "sidebar aside related widget rail recommended popular trending teaser",
        "notice": "notice cookie cookie-banner consent gdpr alert popup modal newsletter paywall",
        "advert": "ad ads advert advertisement sponsored promo banner-ad sponsor adslot",
        "form": "form search login signup subscribe contact",
        "comments": "comments comment replies discussion disqus responses reply",
        "share": "share social sharing follow tools",
    }
    MAIN = "content main article post entry story body text article-body post-content entry-content main-content page-content"
    NEUTRAL = "wrap wrapper col col1 col2 col3 row box block inner outer container grid cell left right center panel module section unit layer zone part area"

    def __init__(self, rng: np.random.Generator) -> None:
        self.rng = rng
        syllables = [a + b for a in "b d f g k l m n p r s t v z th sh ch gr st tr".split() for b in "a e i o u an er in on es it ou ar ion".split()]
        self.words = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(3000)]
        self.open_ends = 0.0  # how often this page leaves out an end tag that it may

    def pick(self, text: str) -> str:
        names = _split(text)
        return names[int(self.rng.random() * len(names))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def say(self, low: int, high: int, full: float = 0.6) -> str:
        words = [self.words[k] for k in self.rng.integers(0, len(self.words), self.rng.integers(low, high + 1)).tolist()]
        for k in range(int(self.rng.integers(8, 20)), len(words), int(self.rng.integers(8, 20))):
            words[k - 1] += "."
        if self.chance(0.2):
            signs = "% # * $ ! &amp; ,".split()
            words = [w + signs[a] * b for w, a, b in zip(words, self.rng.integers(0, 7, len(words)).tolist(), self.rng.integers(1, 4, len(words)).tolist(), strict=True)]
        text = " ".join(words).capitalize() + (self.pick(". . . ! ?") if self.chance(full) else "")
        return text.replace(" ", " &amp; ", 1) if self.chance(0.1) else text

    def marked(self, text: str) -> str:
        """Now and then a tag within the line around some of the words, or a break."""
        words = text.split(" ")
        if len(words) > 3 and self.chance(0.3):
            a, b = sorted(self.rng.choice(len(words), 2, replace=False).tolist())
            tag = self.pick("b i em strong span a code")
            words[a] = (f"<{tag}>" if tag != "a" else '<a href="/z">') + words[a]
            words[b] += f"</{tag}>" if tag in "a span code" or not self.chance(self.open_ends) else ""
        return " ".join(words)

    def end(self, tag: str) -> str:
        return "" if self.chance(self.open_ends) else f"</{tag}>"

    def name(self, kind: str, telling: float) -> str:
        """A class or id: telling, or one that may stand on anything."""
        text = (self.MAIN if kind == "main" else self.CLASSES[kind]) if self.chance(telling) else self.NEUTRAL
        value = self.pick(text)
        return f" {self.pick('class class id')}=" + (f'"{value}"' if self.chance(0.85) else value if self.chance(0.5) else f"'{value}'")

    def open(self, kind: str, telling: float) -> tuple[str, str]:
        """The tag of a container of a kind, and its end; without a landmark its name tells the kind so often."""
        landmark = self.LANDMARK.get(kind)
        tag = landmark if landmark and self.chance(0.5) else self.pick("div div section ul" if kind in ("menu", "share") else "div div div section td")
        named = tag != landmark or self.chance(0.3)
        return f"<{tag}{self.name(kind, telling) if named else ''}>", f"</{tag}>"

    def side(self, kind: str) -> list[tuple[str, bool]]:
        links = kind in ("menu", "share", "sidebar") and self.chance(0.85)
        # what reads like running text and has no landmark must have a telling name
        start, end = self.open(kind, 0.7 if links or kind == "form" else 1.0)
        out = [(start, False)]
        if links:
            out += [(f"<{(t := self.pick('h2 h3 h4 b'))}>{self.say(1, 3, 0.1)}</{t}>", False)] if self.chance(0.3) else []
            items = [(f'<li><a href="/x">{self.say(1, 6, 0.2)}</a>' + self.end("li"), False) for _ in range(self.rng.integers(1, 11))]
            out += [("<ul>", False), *items, ("</ul>", False)] if not start.startswith("<ul") else items
        elif kind == "form":
            out += [(f"<label>{self.say(1, 3)}</label><input name=q><button>{self.say(1, 2)}</button>", False)]
        elif kind == "comments":
            out += [(f"<h3>{self.say(1, 4)}</h3>", False)] if self.chance(0.5) else []
            for _ in range(self.rng.integers(1, 5)):
                inner = self.say(3, 60)
                out.append((f"<p>{inner}{self.end('p')}" if self.chance(0.5) else f'<div class="comment"><b>{self.say(1, 2)}</b><p>{inner}</p></div>', False))
        else:
            for _ in range(self.rng.integers(1, 3)):
                text = self.say(2, 30) if kind != "footer" else self.pick("&copy; &copy; &#169; 2019 Copyright") + " " + self.say(1, 30)
                out.append((f"<p>{text}{self.end('p')}" if self.chance(0.4) else text + self.pick("<br> <br/> ."), False))
        return [*out, (end, False)]

    def article(self, plain: bool) -> list[tuple[str, bool]]:
        """An article; a plain one stands in a container that says nothing."""
        if plain:
            tag = self.pick("div div td section center")
            start = f"<{tag}{self.name('main', 0.0) if self.chance(0.8) else ''}>"
        elif self.chance(0.6):
            tag = self.pick("article article main")
            start = f"<{tag}{self.name('main', 0.7) if self.chance(0.3) else ''}>"
        else:
            tag = self.pick("div div section")
            start = f"<{tag}{self.name('main', 1.0)}>"
        out = [(start, False)]
        out += [(f"<div{self.name('main', 0.5)}>", False)] if self.chance(0.2) else []
        out += [(f"<{(t := self.pick('h1 h1 h1 h2'))}>{self.say(1, 14, 0.4)}</{t}>", True)] if self.chance(0.8) else []
        full = float(self.rng.choice([0.95, 0.9, 0.6, 0.9 if plain else 0.0]))  # how many paragraphs end like sentences
        for _ in range(self.rng.integers(1, 16) + 2 * plain):
            kind, text = self.rng.random(), self.marked(self.say(1, int(self.rng.choice([10, 120])), full))
            if kind < 0.66:
                out.append((f"<p>{text}{self.end('p')}", True))
            elif kind < 0.72:
                out.append((f"<p>{text}{self.pick('<br> <br/>')}{self.say(1, 40, 0.8)}{self.end('p')}", True))
            elif kind < 0.78:
                out.append((f"<{(t := self.pick('h2 h2 h3'))}>{self.say(1, 8, 0.1)}</{t}>", True))
            elif kind < 0.84:
                t = self.pick("ul ul ol")
                out += [(f"<{t}>", False), *((f"<li>{self.say(1, 20)}{self.end('li')}", True) for _ in range(self.rng.integers(1, 6))), (f"</{t}>", False)]
            elif kind < 0.88:
                out.append((f"<{(t := self.pick('blockquote pre'))}>{text}</{t}>", True))
            elif kind < 0.91:
                out += [("<table>", False), *((f"<tr><td>{self.say(1, 4)}{self.end('td')}<td>{self.say(1, 4)}{self.end('td')}{self.end('tr')}", True) for _ in range(self.rng.integers(1, 4))), ("</table>", False)]
            elif kind < 0.94:
                out.append((f"<dl><dt>{self.say(1, 4, 0.1)}<dd>{self.say(3, 30)}</dl>" if self.chance(0.5) else f"<div>{text}</div>", True))
            elif not plain:
                out += self.side(self.pick("advert sidebar share notice form"))
        if self.chance(0.12):
            out += self.side("comments")
        return [*out, (f"</{tag}>", False)]

    def page(self) -> list[tuple[str, bool]]:
        self.open_ends = float(self.rng.choice([0.0, 0.0, 0.1, 0.5, 0.9]))
        style = "<style>body{color:#111}</style>" if self.chance(0.5) else ""
        script = "<script>if (1 < 2) { go('<b>'); }</script>" if self.chance(0.5) else ""
        out = [(f"{self.pick('<!doctype_html> <!DOCTYPE_html> .').replace('_', ' ').replace('.', '')}<html><head><title>{self.say(2, 12)}</title>{style}{script}</head><body>", False)]
        for kind in self.rng.permutation(["menu", "header", "notice", "advert", "form", "menu"])[: self.rng.integers(0, 5)]:
            out += self.side(kind)
        ends = []
        for _ in range(self.rng.integers(0, 3)):
            tag = self.pick("div div table")
            out.append((f"<{tag}{self.name('main', 0.1) if self.chance(0.7) else ''}>" + ("<tr>" if tag == "table" else ""), False))
            ends.insert(0, (f"</{tag}>", False))
        before = self.rng.permutation(["sidebar", "menu", "share"])[: self.rng.integers(0, 2)]
        for kind in before:
            out += self.side(kind)
        out += self.article(plain=self.chance(0.35))
        for kind in self.rng.permutation(["comments", "sidebar", "share", "advert", "menu", "form"])[: self.rng.integers(0, 4)]:
            out += self.side(kind)
        out += ends
        out += self.side("footer") if self.chance(0.85) else []
        return out if self.chance(0.1) else [*out, ("</body></html>", False)]


def labelled(pieces: list[tuple[str, bool]]) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and labels of a made page; a block is of the piece that its text begins in."""
    whole = blocks("".join(p for p, _ in pieces))
    ends = np.cumsum([len(p) for p, _ in pieces])
    main = np.array([m for _, m in pieces])
    return vectors([whole])[0], main[np.searchsorted(ends, [b.start for b in whole], "right")].astype(np.float32)


@functools.lru_cache(maxsize=1)
def train(pages: int = TRAIN_PAGES, epochs: int = EPOCHS) -> BiLSTM:
    """Adam over made pages; deterministic."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    maker, model = Maker(rng), BiLSTM(rng)
    data = [x for x in (labelled(maker.page()) for _ in range(pages)) if len(x[1])]
    m, v, step = [np.zeros_like(w) for w in model.p], [np.zeros_like(w) for w in model.p], 0
    for _ in range(epochs):
        order = sorted(rng.permutation(len(data)).tolist(), key=lambda k: len(data[k][1]) // 8)
        groups = [order[a : a + BATCH] for a in range(0, len(order), BATCH)]
        for k in rng.permutation(len(groups)).tolist():
            x, lengths = pad([data[i][0] for i in groups[k]])
            y = np.zeros(x.shape[:2], np.float32)
            for row, i in enumerate(groups[k]):
                y[row, : lengths[row]] = data[i][1]
            step += 1
            rate = RATE * (0.02 + 0.98 * (1 + np.cos(np.pi * step / (epochs * len(groups)))) / 2)
            for w, g, a, b in zip(model.p, model.gradients(x, lengths, y), m, v, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return model


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every page."""
    model = ship(pages.sparkSession).sparkContext.broadcast(train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 4 << 20):
            found = [blocks(p) for p in batch.column("html").to_pylist()]
            main = model.value.main(vectors(found))
            text = ["\n".join([b.text for b, yes in zip(p, keep.tolist(), strict=True) if yes]) for p, keep in zip(found, main, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string())], names=["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(run, "page_id long, url string, text string")


def query(pages: DataFrame) -> DataFrame:
    """The columns of op8 for every page."""
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
