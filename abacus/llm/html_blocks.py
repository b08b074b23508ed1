"""Main text of web pages: a recurrent labeller of text blocks.

A page is a sequence of leaves: runs of text with no block-level tag between. Each leaf has a
vector of its hashed tag path, one of its hashed words and a few figures. A bidirectional LSTM
in numpy reads the whole sequence, so every leaf is judged in the context of the page. The net
is trained in one task on pages composed from the leaves of a bounded sample of pages, in
varied templates whose parts are known to be article or not.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacus.llm._store import bounded_batches, share
from abacus.llm._text import SPACED, Words, text_slices

PATH_SIZE, WORD_SIZE, FIGURES = 96, 32, 7
HIDDEN = 16
# About so many pages lend their leaves to training; pages composed, passes over them.
SAMPLE_PAGES, COMPOSED, EPOCHS = 400, 900, 10
SEED = 3

# Fixed values of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea iframe".split())
# Inline elements that leave a token in the path of a leaf that lies in them altogether.
EMBEDS = frozenset("svg math object select canvas template noscript".split())
# What they hold are leaves of their own, after the block around them.
ASIDE = frozenset("svg select".split())
# Tags of HTML that end svg and math, closed or not.
BREAKS = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
                   "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
                     "hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "body": {"head", "title"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}

# What follows a tag's name up to its end; quoted values may hold a >.
_REST = r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
_TAG = re.compile(rf"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*){_REST}|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])(?:{_REST}|[^>]*>|.*)", re.I | re.S) for name in RAW}
# A / that ends an unquoted value is part of it.
_UNQUOTED = re.compile(r"""=\s*[^\s"'>]*/\Z""")
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[a-z]+")


class Path:
    """The tokens of the tags around a leaf. Paths share their beginnings, and each knows how often
    every hashed token lies on it (up to 3, beyond which its vector no longer grows)."""

    __slots__ = ("parent", "token", "counts", "kids", "known")

    def __init__(self, parent: Path | None = None, token: str = ""):
        self.parent, self.token, self.kids, self.known = parent, token, {}, None
        self.counts = bytearray(PATH_SIZE if parent is None else parent.counts)
        if parent is not None:
            code = zlib.crc32(token.encode()) % PATH_SIZE
            self.counts[code] = min(self.counts[code] + 1, 3)

    def with_token(self, token: str) -> Path:
        if token not in self.kids:
            self.kids[token] = Path(self, token)
        return self.kids[token]

    def vector(self) -> np.ndarray:
        """Counts of hashed tokens, the nearest four weighing more, up to 2."""
        if self.known is None:
            found, node = np.frombuffer(self.counts, np.uint8).astype(np.float32) * np.float32(0.7), self
            for _ in range(4):
                if node.parent is None:
                    break
                found[zlib.crc32(node.token.encode()) % PATH_SIZE] += np.float32(0.3)
                node = node.parent
            self.known = np.minimum(found, 2)
        return self.known


@dataclass
class Leaf:
    path: Path
    text: str
    linked: int  # characters inside links


def _closes_itself(rest: str) -> bool:
    """The tag of an svg or math element ends it, too."""
    return rest.endswith("/") and not _UNQUOTED.search(rest)


def leaves(page: str) -> list[Leaf]:
    """The text blocks of a page in order, white space collapsed and references decoded.

    Comments and raw text (RAW) are left out as browsers do: raw text ends at its end tag, whatever
    follows the name there, or with the page; a comment ends at --> or --!>, and at once in
    <!--> and <!--->. Other embedded elements are read; a missing end tag loses nothing:
    svg and math end at the next tag of HTML, select at the next block, others are passed over.
    References are decoded in each run of text between tags. The work is in proportion to the
    page, however deep its elements are nested.
    """
    out: list[Leaf] = []
    inside: list[tuple[str, int]] = []  # open EMBEDS and how deep the stack was
    common: tuple[str, ...] | None = None  # those around all that is held
    around: list[tuple] = []  # what was held where an ASIDE element began
    later: list[Leaf] = []
    ends: dict[str, int] = {}  # where the last end tag of an element begins
    stack: list[tuple[str, Path]] = []
    opened: Counter = Counter()  # names on the stack
    root = Path()
    held: list[str] = []
    links, linked, at = 0, 0, 0

    def flush():
        nonlocal linked, common
        if held:
            text = " ".join("".join(held).split())
            if text:
                path = stack[-1][1] if stack else root
                for name in common or ():
                    path = path.with_token(name)
                (later if around else out).append(Leaf(path, text, linked))
            held.clear()
        linked, common = 0, None
        if not around and later:
            out.extend(later)
            later.clear()

    def say(text):
        nonlocal linked, common
        if "&" in text:
            text = html.unescape(text)
        held.append(text)
        if links:
            linked += len(text)
        if (inside or common) and not text.isspace():
            names = tuple(n for n, _ in inside)
            same = sum(x == y for x, y in zip(names, common)) if common is not None else len(names)
            common = names[:same]
        elif common is None and not text.isspace():
            common = ()

    def close(i):
        """Close stack[i:]."""
        for name, _ in stack[i:]:
            opened[name] -= 1
        del stack[i:]

    def ends_after(name):
        if name not in ends:
            ends[name] = max((m.start() for m in re.finditer(rf"</{name}\b", page, re.I)), default=-1)
        return ends[name] >= at

    def leave(i):
        """Close inside[i:]."""
        nonlocal linked, common
        while len(inside) > i:
            if inside[-1][0] in ASIDE:
                flush()
                kept, linked, common = around.pop()
                held[:] = kept
            inside.pop()

    while True:
        tag = _TAG.search(page, at)
        if tag is None:
            say(page[at:])
            break
        if tag.start() > at:
            say(page[at:tag.start()])
        at = tag.end()
        closing, name, rest = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        if not name:
            continue
        name = name.lower()
        if name in RAW:
            foreign = inside and inside[-1][0] in ("svg", "math")
            if not closing and not (foreign and _closes_itself(rest)):
                end = _RAW_END[name].search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in EMBEDS:
            if closing:
                for i in range(len(inside) - 1, -1, -1):
                    if inside[i][0] == name:
                        leave(i)
                        break
            elif not (name in ("svg", "math") and _closes_itself(rest)):
                if name not in ASIDE and name != "math" and not ends_after(name):
                    continue
                if name in ASIDE:
                    if inside and inside[-1][0] == name:
                        leave(len(inside) - 1)
                    around.append((held[:], linked, common))
                    held.clear()
                    linked, common = 0, None
                inside.append((name, len(stack)))
            continue
        if inside and inside[-1][0] in ("svg", "math"):
            if name in BREAKS if not closing else name in ("p", "br") or opened[name]:
                leave(next(i for i, (n, _) in enumerate(inside) if n in ("svg", "math")))
            elif name != "a":
                if inside[-1][0] == "svg":
                    held.append(" ")
                continue
        elif around and name not in INLINE and name not in ("option", "optgroup", "hr", "br"):
            leave(next(i for i, (n, _) in enumerate(inside) if n in ASIDE))
        if name in INLINE:
            if name == "a":
                links = 0 if closing else 1
            continue
        if name == "br":
            held.append(" ")
            continue
        flush()
        links = 0
        if around:
            continue  # options
        if closing:
            for i in range(len(stack) - 1 if opened[name] else -1, -1, -1):
                if stack[i][0] == name:
                    close(i)
                    while inside and inside[-1][1] > i:
                        inside.pop()
                    break
            continue
        if name in VOID:
            continue
        if name in CLOSES_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] not in ("dd", "dt"):
                    break
        if any(opened[n] for n in CLOSES.get(name, ())):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in STOPS.get(name, ()):
                    break
                if stack[i][0] in CLOSES[name]:
                    close(i)
                    break
        path = (stack[-1][1] if stack else root).with_token(name)
        if rest:
            for k, *v in _NAMED.findall(rest):
                for w in _PART.findall("".join(v).lower()):
                    path = path.with_token(w)
        stack.append((name, path))
        opened[name] += 1
    leave(0)
    flush()
    return out


def vectors(found: list[Leaf]) -> np.ndarray:
    """One row per leaf."""
    out = np.zeros((len(found), PATH_SIZE + WORD_SIZE + FIGURES), np.float32)
    if not found:
        return out
    for i, leaf in enumerate(found):
        out[i, :PATH_SIZE] = leaf.path.vector()
    at = 0
    for _, _, data, offsets in text_slices(pa.array([leaf.text for leaf in found], pa.string())):
        words = Words(data, offsets, SPACED)
        n = len(words.count)
        code = words.rows() * WORD_SIZE + (words.hashes() >> np.uint64(59)).astype(np.int64)
        share_ = np.bincount(code, minlength=n * WORD_SIZE).reshape(n, WORD_SIZE)
        out[at:at + n, PATH_SIZE:PATH_SIZE + WORD_SIZE] = share_ / np.sqrt(np.maximum((share_ ** 2).sum(1), 1))[:, None]
        out[at:at + n, -FIGURES] = np.log1p(words.count) / 4
        at += n
    length = np.array([len(leaf.text) for leaf in found], np.float32)
    out[:, -6] = np.log1p(length) / 6
    out[:, -5] = np.minimum(np.array([leaf.linked for leaf in found]) / length, 1)
    out[:, -4] = [sum(leaf.text.count(c) for c in ".!?") for leaf in found] / length * 20
    out[:, -3] = np.array([leaf.text[-1] in ".!?:;\"”" for leaf in found])
    return out


def _placed(rows: np.ndarray) -> np.ndarray:
    """Fill in where in the page each leaf stands."""
    n = len(rows)
    rows[:, -2] = np.arange(n) / max(n - 1, 1)
    rows[:, -1] = min(np.log1p(n) / 6, 2)
    return rows


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Net:
    """A bidirectional LSTM with one output per step."""

    def __init__(self, size: int, hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.hidden, self.p = hidden, {}
        for d in "fb":
            self.p["w" + d] = rng.normal(0, size ** -0.5, (size, 4 * hidden)).astype(np.float32)
            self.p["u" + d] = rng.normal(0, hidden ** -0.5, (hidden, 4 * hidden)).astype(np.float32)
            self.p["c" + d] = np.repeat(np.array([0, 1, 0, 0], np.float32), hidden)
        self.p["v"] = rng.normal(0, hidden ** -0.5, 2 * hidden).astype(np.float32)
        self.p["o"] = np.zeros(1, np.float32)

    def _run(self, x, mask, d):
        h = self.hidden
        state, cell, kept = np.zeros((len(x), h), np.float32), np.zeros((len(x), h), np.float32), []
        given = x @ self.p["w" + d] + self.p["c" + d]
        for t in range(x.shape[1]):
            gates = given[:, t] + state @ self.p["u" + d]
            gate = _sigmoid(gates[:, :3 * h])
            new = np.tanh(gates[:, 3 * h:])
            i, f, o = gate[:, :h], gate[:, h:2 * h], gate[:, 2 * h:]
            m = mask[:, t, None]
            before = (state, cell)
            cell = m * (f * cell + i * new) + (1 - m) * cell
            squashed = np.tanh(cell)
            state = m * (o * squashed) + (1 - m) * state
            kept.append((before, i, f, o, new, squashed, state))
        return kept

    @staticmethod
    def _turned(mask):
        """Places of each row's steps in reverse; what is padded stays."""
        length = mask.sum(axis=1).astype(int)[:, None]
        place = np.arange(mask.shape[1])[None, :]
        return np.where(place < length, length - 1 - place, place)

    def forward(self, x, mask):
        turned = self._turned(mask)
        ahead = self._run(x, mask, "f")
        back = self._run(np.take_along_axis(x, turned[:, :, None], 1), mask, "b")
        hf = np.stack([k[-1] for k in ahead], 1)
        hb = np.take_along_axis(np.stack([k[-1] for k in back], 1), turned[:, :, None], 1)
        states = np.concatenate((hf, hb), 2)
        return states @ self.p["v"] + self.p["o"], states, ahead, back, turned

    def _back(self, x, mask, kept, slope, d, grads):
        h, u = self.hidden, self.p["u" + d]
        ds, dc = np.zeros((len(x), h), np.float32), np.zeros((len(x), h), np.float32)
        steps = np.zeros((len(x), x.shape[1], 4 * h), np.float32)
        for t in range(x.shape[1] - 1, -1, -1):
            (state, cell), i, f, o, new, squashed, _ = kept[t]
            m = mask[:, t, None]
            ds = ds + slope[:, t]
            own = ds * m
            dcell = dc * m + own * o * (1 - squashed ** 2)
            gates = np.concatenate((dcell * new * i * (1 - i), dcell * cell * f * (1 - f), own * squashed * o * (1 - o),
                                    dcell * i * (1 - new ** 2)), 1)
            steps[:, t] = gates
            grads["u" + d] += state.T @ gates
            ds = gates @ u.T + ds * (1 - m)
            dc = dcell * f + dc * (1 - m)
        flat = steps.reshape(-1, 4 * h)
        grads["w" + d] += x.reshape(-1, x.shape[2]).T @ flat
        grads["c" + d] += flat.sum(0)

    def grads(self, x, mask, y):
        logits, states, ahead, back, turned = self.forward(x, mask)
        error = ((_sigmoid(logits) - y) * mask / mask.sum()).astype(np.float32)
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["v"] += np.einsum("bt,bth->h", error, states)
        grads["o"] += error.sum()
        slope = error[:, :, None] * self.p["v"]
        h = self.hidden
        self._back(x, mask, ahead, slope[:, :, :h], "f", grads)
        self._back(np.take_along_axis(x, turned[:, :, None], 1), mask, back,
                   np.take_along_axis(slope[:, :, h:], turned[:, :, None], 1), "b", grads)
        return grads

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, batch: int = 30, rate: float = 0.01,
            seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), batch):
                own = [pages[i] for i in order[at:at + batch]]
                x, mask = padded([p[0] for p in own])
                y = np.zeros(mask.shape, np.float32)
                for i, (_, labels) in enumerate(own):
                    y[i, :len(labels)] = labels
                step += 1
                for k, g in self.grads(x, mask, y).items():
                    g = np.clip(g, -1, 1)
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.999 * square[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - rate * (mean[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-7)).astype(np.float32)

    def predict(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """True for each leaf of the main text. Pages of like length go together, by about 50,000 steps."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        while order:
            size = max(1, min(256, 50_000 // len(pages[order[-1]])))
            own, order = order[-size:], order[:-size]
            x, mask = padded([pages[i] for i in own])
            logits = self.forward(x, mask)[0]
            for row, i in enumerate(own):
                out[i] = logits[row, :len(pages[i])] > 0
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((len(pages), steps, pages[0].shape[1]), np.float32), np.zeros((len(pages), steps), np.float32)
    for i, rows in enumerate(pages):
        x[i, :len(rows)], mask[i, :len(rows)] = rows, 1
    return x, mask


# How training pages wrap the article and everything around it (fixed values).
ARTICLE = ("<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", '<div class="content">{}</div>',
           '<div id="content"><div class="post">{}</div></div>', '<div class="article-body">{}</div>',
           '<section class="entry-content">{}</section>', '<div role="main">{}</div>', '<div class="page"><div class="text">{}</div></div>',
           '<article class="post"><div class="body">{}</div></article>')
BEFORE = ("<nav>{}</nav>", '<div class="menu">{}</div>', '<ul class="breadcrumbs">{}</ul>', "<header>{}</header>", '<div id="header">{}</div>',
          '<div class="ad">{}</div>', '<div class="banner">{}</div>', '<div class="cookie-notice">{}</div>', '<div class="notice">{}</div>',
          '<form class="search">{}</form>', '<div role="navigation">{}</div>', '<div class="topbar">{}</div>', '<div class="alert">{}</div>')
AFTER = ("<footer>{}</footer>", '<div class="footer">{}</div>', "<aside>{}</aside>", '<div class="sidebar">{}</div>',
         '<div class="related">{}</div>', '<div class="ad">{}</div>', '<section class="comments">{}</section>',
         '<div id="comments"><div class="comment">{}</div></div>', '<ol class="comment-list">{}</ol>', '<form class="newsletter">{}</form>',
         '<div class="share">{}</div>', '<div class="widget">{}</div>', '<div class="promo">{}</div>', '<div class="copyright">{}</div>',
         '<div class="subscribe">{}</div>', '<div class="sponsored">{}</div>', '<div class="author-bio">{}</div>')
INSIDE = ('<aside>{}</aside>', '<div class="ad">{}</div>', '<div class="share">{}</div>', '<div class="related">{}</div>',
          '<form>{}</form>', '<div class="newsletter">{}</div>', '<nav class="toc">{}</nav>', '<div class="comments">{}</div>')
EMBEDDED = ("<object><p>{}</p></object>", "<noscript><p>{}</p></noscript>", "<canvas><p>{}</p></canvas>", "<template><p>{}</p></template>",
            "<p><math><mi>{}</mi></math></p>", "<p>{} <svg><title>{}</title></svg></p>", "<p>{} <select><option>{}</option></select></p>")
_MARK = "\ue000"


def compose(rng: np.random.Generator, pool: list[str], embeds: float = 0.0) -> str:
    """A training page; texts of its article begin with a mark. So large a part of the
    article's blocks, ``embeds``, has embedded elements."""
    def text() -> str:
        return html.escape(pool[rng.integers(len(pool))])

    def short() -> str:
        return " ".join(text().split()[:rng.integers(1, 7)]) or "x"

    def around(shapes) -> str:
        kind = rng.integers(4)
        if kind == 0:
            inner = "".join(f'<li><a href="#">{short()}</a></li>' for _ in range(rng.integers(1, 9)))
            inner = f"<ul>{inner}</ul>"
        elif kind == 1:
            inner = f"<p>{text()}</p>" * int(rng.integers(1, 3))
        elif kind == 2:
            inner = short() if rng.random() < 0.5 else text()
        else:
            inner = f'<h3>{short()}</h3><p>{text()}</p><a href="#">{short()}</a>'
        return str(rng.choice(shapes)).format(inner)

    def block() -> str:
        if embeds and rng.random() < embeds:
            return EMBEDDED[rng.integers(len(EMBEDDED))].format(_MARK + text(), short())
        kind = rng.random()
        if kind < 0.68:
            return f"<p>{_MARK}{text() if rng.random() < 0.8 else short()}</p>"
        if kind < 0.76:
            return f"<p>{_MARK}<b>{text()}<br>"
        if kind < 0.84:
            return f"<h2>{_MARK}{short()}</h2>"
        if kind < 0.9:
            return "<ul>" + "".join(f"<li>{_MARK}{short()}</li>" for _ in range(rng.integers(1, 5))) + "</ul>"
        if kind < 0.94:
            return f"<blockquote>{_MARK}{text()}</blockquote>"
        if kind < 0.97:
            return f"<pre>{_MARK}{text()}</pre>"
        return "<table><tr>" + "".join(f"<td>{_MARK}{short()}</td>" for _ in range(rng.integers(1, 4))) + "</tr></table>"

    body = [f"<h1>{_MARK}{short() if rng.random() < 0.5 else text()}</h1>"] if rng.random() < 0.85 else []
    for _ in range(int(rng.integers(1, 14))):
        body.append(block())
        if rng.random() < 0.06:
            body.append(around(INSIDE))
    parts = [around(BEFORE) for _ in range(rng.integers(0, 4))]
    parts += [str(rng.choice(ARTICLE)).format("".join(body)) if rng.random() < 0.97 else ""]
    parts += [around(AFTER) for _ in range(rng.integers(0, 4))]
    return f"<html><head><title>{short()}</title></head><body>{''.join(parts)}</body></html>"


def labelled(page: str) -> tuple[np.ndarray, np.ndarray]:
    found = leaves(page)
    labels = np.array([leaf.text.startswith(_MARK) for leaf in found], np.float32)
    for leaf in found:
        leaf.text = leaf.text.replace(_MARK, "").strip() or "x"
    return _placed(vectors(found)), labels


def fit(pages: list[str], composed: int = COMPOSED, seed: int = SEED) -> Net:
    """Train on pages composed from the leaves of ``pages``; without any, from one plain word."""
    pool = sorted({leaf.text.replace(_MARK, "") for page in pages for leaf in leaves(page)} - {""}) or ["word"]
    rng = np.random.default_rng(seed)
    found = [labelled(compose(rng, pool)) for _ in range(composed)]
    found += [labelled(compose(rng, pool, embeds=0.4)) for _ in range(composed // 5)]
    net = Net(PATH_SIZE + WORD_SIZE + FIGURES)
    net.fit([p for p in found if len(p[0])])
    return net


def main_text(pages: list[str], net: Net) -> list[str]:
    found = [leaves(page) for page in pages]
    flat = vectors([leaf for own in found for leaf in own])
    ends = np.cumsum([len(own) for own in found])
    kept = net.predict([_placed(flat[e - len(own):e]) for own, e in zip(found, ends, strict=True)])
    return ["\n".join(leaf.text for leaf, k in zip(own, keep, strict=True) if k) for own, keep in zip(found, kept, strict=True)]


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, html_col: str = "html") -> Net:
    """Train in one task on a sample bounded by ``sample_pages``, chosen by a hash of the page."""
    import pickle

    def run(batches):
        from pyspark import cloudpickle

        sample = sorted(p for b in batches for p in b["html"].to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(fit(sample).p)])], names=["net"])

    some = pages.select(F.col(html_col).alias("html")).where("html is not null")
    count = max(some.count(), 1)
    some = some.where(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) <= min(1.0, sample_pages / count) * (1 << 30)).distinct()
    row = some.limit(2 * sample_pages).repartition(1).mapInArrow(run, "net binary").first()
    net = Net(PATH_SIZE + WORD_SIZE + FIGURES)
    net.p = pickle.loads(row["net"]) if row else fit([]).p
    return net


def extract(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, html_col: str = "html", out: str = "text") -> DataFrame:
    """Add ``out``, the main text of each page, and n_chars, its code points.

    Null and empty pages, and pages without a block of main text, have an empty text. Pages are
    read whole but for comments and raw text (script, style, textarea, iframe) and judged one by one, repeated ones alike; columns of these names are replaced.
    """
    bounded_batches(pages.sparkSession)
    shared = share(pages.sparkSession, train(pages, sample_pages, html_col))

    @F.arrow_udf("string")
    def text_of(column: pa.Array) -> pa.Array:
        found: list[str] = []
        for at in range(0, len(column), 256):
            found += main_text([p or "" for p in column.slice(at, 256).to_pylist()], shared())
        return pa.array(found, pa.string())

    return pages.withColumn(out, text_of(F.col(html_col))).withColumn("n_chars", F.length(out).cast("long"))
