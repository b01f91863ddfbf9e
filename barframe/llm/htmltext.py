"""Main text of web pages by a recurrent block labeller.

A page is scanned into its leaf blocks in page order. Each block has the tags, classes and ids on
its path, hashed, the hashed words of its text, and a few measures such as its share of link text.
A bidirectional LSTM reads the whole sequence, so each block is judged in the context of the page,
and says whether it belongs to the article. The labeller is trained by the driver on pages that it
composes itself, from layouts with known labels and words drawn from a bounded sample of pages.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.arrays import byte_sums, lower_ascii, span_hashes, with_input, word_spans

SAMPLE_PAGES = 200  # pages whose words the training pages are made of
SAMPLE_WORDS = 200  # different words taken of each
TRAINING_PAGES = 1500
HIDDEN = 16
PATH_BUCKETS, WORD_BUCKETS, MEASURES = 1024, 64, 9
PAGES = 64  # pages labelled side by side

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = ("script", "style", "template", "svg", "math", "iframe", "object", "noscript")
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "body": {"head"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
KEEPS_OPEN = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "tbody": {"table"}}

# Quoted values may hold ">" but no "<", so the scan stays linear on broken pages.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/<>]*)((?:[^<>"']|"[^"<]*"|'[^'<]*')*+)>|<(/?)([A-Za-z][^\s/<>]*)([^<>]*)>|<[!?/][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
SKIPPED_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in (*SKIPPED, "textarea", "title")}


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int  # characters inside links


@lru_cache(maxsize=4096)
def _names(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag and the words of its class, id and role."""
    found = [tag]
    for kind, *values in ATTRIBUTE.findall(attributes):
        for word in re.findall(r"[A-Za-z][a-z]*", next((v for v in values if v), "")):
            found.append(("#" if kind.lower() == "id" else ".") + word.lower())
    return tuple(found)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page with text, in page order: character references decoded, white
    space turned into single spaces. Comments, scripts and the like have no text."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                found.append(Block(tuple(n for _, names in stack for n in names), text, linked))
            parts.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            raw = entities.unescape(raw)
            parts.append(raw)
            if links:
                linked += len(raw)

    at, end = 0, len(page)
    while at < end:
        token = TOKEN.search(page, at)
        if token is None:
            say(page[at:])
            break
        say(page[at : token.start()])
        at = token.end()
        close, name, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not name:
            continue
        name = name.lower()
        if name in INLINE:
            if name == "br":
                parts.append(" ")
            elif name == "a":
                links = 0 if close else 1
            continue
        links = 0
        flush()
        if close:
            if any(name == open_name for open_name, _ in stack):
                while stack.pop()[0] != name:
                    pass
            continue
        if stack and stack[-1][0] == "p":
            stack.pop()
        if name in CLOSED_BY:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in KEEPS_OPEN.get(name, ()):
                    break
                if stack[depth][0] in CLOSED_BY[name]:
                    del stack[depth:]
                    break
        if name in SKIPPED_END and not attributes.endswith("/"):
            stop = SKIPPED_END[name].search(page, at)
            inner = page[at : stop.start() if stop else end]
            at = stop.end() if stop else end
            if name not in SKIPPED:
                stack.append((name, _names(name, attributes)))
                say(inner)
                flush()
                stack.pop()
        elif name not in VOID:
            stack.append((name, _names(name, attributes)))
    flush()
    return found


# ---- features ---------------------------------------------------------------------------


@lru_cache(maxsize=65536)
def path_buckets(path: tuple[str, ...]) -> tuple[int, ...]:
    """Buckets of the names on a path, and of its last tag by itself."""
    last = [n for n in path if n[0] not in ".#"][-1:]
    return tuple(sorted({zlib.crc32(n.encode()) % PATH_BUCKETS for n in path} | {zlib.crc32(f"last {n}".encode()) % PATH_BUCKETS for n in last}))


def word_bags(texts: list[str]) -> np.ndarray:
    """The share of each hashed word of each text (rows x buckets)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    starts, ends, row = word_spans(data, offsets)
    hashes = span_hashes(byte_sums(lower_ascii(data)), starts, ends) if len(starts) else np.zeros(0, np.uint64)
    cells = np.bincount(row * WORD_BUCKETS + (hashes >> np.uint64(58)).astype(np.int64), minlength=len(texts) * WORD_BUCKETS)
    bags = cells.reshape(len(texts), WORD_BUCKETS).astype(np.float32)
    return bags / np.maximum(bags.sum(axis=1, keepdims=True), 1)


def measures(page: list[Block]) -> np.ndarray:
    n = len(page)
    size = np.array([len(b.text) for b in page], dtype=np.float32)
    words = np.array([b.text.count(" ") + 1 for b in page], dtype=np.float32)
    stops = np.array([sum(map(b.text.count, ".!?,;")) for b in page], dtype=np.float32)
    return np.stack(
        [
            np.log1p(size) / 5, np.log1p(words) / 4, np.array([b.linked for b in page], dtype=np.float32) / np.maximum(size, 1), stops / words,
            np.array([b.text[-1] in ".!?\"'”»…" for b in page], dtype=np.float32), np.array([len(b.path) for b in page], dtype=np.float32) / 10,
            np.arange(n, dtype=np.float32) / max(n, 1), np.cumsum(size) / max(size.sum(), 1), np.minimum(size / max(size.max(), 1), 1),
        ],
        axis=1,
    )


# ---- the labeller -----------------------------------------------------------------------


class Labeller:
    """A bidirectional LSTM over blocks with one output each; gates in the order in, forget, out, cell."""

    def __init__(self, hidden: int = HIDDEN, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.params = {
            "path": draw(PATH_BUCKETS, 8 * hidden, scale=0.1),
            "word": draw(WORD_BUCKETS, 8 * hidden, scale=0.1),
            "measure": draw(MEASURES, 8 * hidden, scale=0.2),
            "bias": np.tile(np.repeat(np.array([0, 1, 0, 0], np.float32), hidden), 2),
            "ahead": draw(hidden, 4 * hidden, scale=hidden**-0.5),
            "back": draw(hidden, 4 * hidden, scale=hidden**-0.5),
            "out": draw(2 * hidden, scale=0.3),
            "out_bias": np.zeros(1, np.float32),
        }

    @staticmethod
    def _flip(lengths: np.ndarray, steps: int) -> np.ndarray:
        """For each page, its places in reverse; places beyond its end stay."""
        t = np.arange(steps)[None, :]
        return np.where(t < lengths[:, None], lengths[:, None] - 1 - t, t)

    def _run(self, z: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, list]:
        pages, steps, _ = z.shape
        k = self.hidden
        h, c = np.zeros((pages, k), np.float32), np.zeros((pages, k), np.float32)
        hs, kept = np.empty((pages, steps, k), np.float32), []
        for t in range(steps):
            a = z[:, t] + h @ weights
            gates = 1 / (1 + np.exp(-np.clip(a[:, : 3 * k], -30, 30)))
            g = np.tanh(a[:, 3 * k :])
            c_next = gates[:, k : 2 * k] * c + gates[:, :k] * g
            squashed = np.tanh(c_next)
            kept.append((h, c, gates, g, squashed))
            h, c = gates[:, 2 * k :] * squashed, c_next
            hs[:, t] = h
        return hs, kept

    def _back(self, dh_out: np.ndarray, kept: list, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pages, steps, k = dh_out.shape
        dz, dw = np.empty((pages, steps, 4 * k), np.float32), np.zeros_like(weights)
        dh, dc = np.zeros((pages, k), np.float32), np.zeros((pages, k), np.float32)
        for t in range(steps - 1, -1, -1):
            h, c, gates, g, squashed = kept[t]
            i, f, o = gates[:, :k], gates[:, k : 2 * k], gates[:, 2 * k :]
            dh = dh + dh_out[:, t]
            dc = dc + dh * o * (1 - squashed**2)
            da = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1)
            dz[:, t] = da
            dw += h.T @ da
            dh, dc = da @ weights.T, dc * f
        return dz, dw

    def scores(self, z: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Log odds of article per block of padded pages (pages x steps) from projected inputs."""
        k, flip = self.hidden, self._flip(lengths, z.shape[1])
        rows = np.arange(len(z))[:, None]
        ahead, kept_a = self._run(z[:, :, : 4 * k], self.params["ahead"])
        back, kept_b = self._run(z[rows, flip][:, :, 4 * k :], self.params["back"])
        both = np.concatenate([ahead, back[rows, flip]], axis=2)
        s = both @ self.params["out"] + self.params["out_bias"][0]
        return (s, both, kept_a, kept_b, flip) if keep else s

    def train(self, pages: list[tuple[list[tuple[int, ...]], np.ndarray, np.ndarray, np.ndarray]], epochs: int = 16, batch: int = 32, seed: int = 4) -> None:
        """Fit to pages ``(path buckets, word bags, measures, labels)`` by Adam on the cross entropy."""
        rng = np.random.default_rng(seed)
        first = {n: np.zeros_like(p) for n, p in self.params.items()}
        second = {n: np.zeros_like(p) for n, p in self.params.items()}
        step, k = 0, self.hidden
        for _ in range(epochs):
            order = rng.permutation(len(pages))
            for b in range(0, len(order), batch):
                chosen = [pages[i] for i in order[b : b + batch]]
                lengths = np.array([len(p[3]) for p in chosen])
                steps = int(lengths.max())
                page = np.repeat(np.arange(len(chosen)), lengths)
                place = np.concatenate([np.arange(n) for n in lengths])
                paths = np.zeros((len(page), PATH_BUCKETS), np.float32)
                listed = [x for p in chosen for x in p[0]]
                paths[np.repeat(np.arange(len(listed)), [len(x) for x in listed]), np.concatenate([np.array(x, dtype=np.int64) for x in listed])] = 1
                # Some names are left out, of single blocks and along whole pages, so that no single one
                # decides, neither about a block nor about all that stand after it.
                paths *= rng.random(paths.shape) > 0.1
                paths *= (rng.random((len(chosen), PATH_BUCKETS)) > 0.1)[page]
                words, dense = np.concatenate([p[1] for p in chosen]), np.concatenate([p[2] for p in chosen])
                z = np.zeros((len(chosen), steps, 8 * k), np.float32)
                z[page, place] = paths @ self.params["path"] + words @ self.params["word"] + dense @ self.params["measure"] + self.params["bias"]
                s, both, kept_a, kept_b, flip = self.scores(z, lengths, keep=True)
                y = np.concatenate([p[3] for p in chosen]).astype(np.float32)
                ds = np.zeros_like(s)
                ds[page, place] = (1 / (1 + np.exp(-np.clip(s[page, place], -30, 30))) - y) / len(y)
                d_both = ds[:, :, None] * self.params["out"]
                rows = np.arange(len(chosen))[:, None]
                dz_a, d_ahead = self._back(d_both[:, :, :k], kept_a, self.params["ahead"])
                dz_b, d_back = self._back(d_both[:, :, k:][rows, flip], kept_b, self.params["back"])
                flat = np.concatenate([dz_a, dz_b[rows, flip]], axis=2)[page, place]
                grads = {
                    "path": paths.T @ flat + 1e-5 * self.params["path"], "word": words.T @ flat + 1e-4 * self.params["word"], "measure": dense.T @ flat, "bias": flat.sum(axis=0),
                    "ahead": d_ahead, "back": d_back, "out": (ds[:, :, None] * both).sum(axis=(0, 1)), "out_bias": np.array([ds.sum()], np.float32),
                }
                step += 1
                for n, g in grads.items():
                    first[n] = 0.9 * first[n] + 0.1 * g
                    second[n] = 0.999 * second[n] + 0.001 * g * g
                    self.params[n] -= 0.01 * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page, which of its blocks are article."""
        result: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        cache: dict[tuple[str, ...], np.ndarray] = {}
        for b in range(0, len(order), PAGES):
            chosen = order[b : b + PAGES]
            lengths = np.array([len(pages[i]) for i in chosen])
            flat = [block for i in chosen for block in pages[i]]
            for block in flat:
                if block.path not in cache:
                    cache[block.path] = self.params["path"][list(path_buckets(block.path))].sum(axis=0)
            x = np.stack([cache[block.path] for block in flat]) + word_bags([block.text for block in flat]) @ self.params["word"]
            x += np.concatenate([measures(pages[i]) for i in chosen]) @ self.params["measure"] + self.params["bias"]
            z = np.zeros((len(chosen), int(lengths.max()), 8 * self.hidden), np.float32)
            page, place = np.repeat(np.arange(len(chosen)), lengths), np.concatenate([np.arange(n) for n in lengths])
            z[page, place] = x
            s = self.scores(z, lengths)
            for row, i in enumerate(chosen):
                result[i] = s[row, : lengths[row]] > 0
        return result


# ---- training pages ---------------------------------------------------------------------

MENU = "nav menu navbar navigation breadcrumb breadcrumbs topbar toolbar tabs skip pagination pager".split()
HEAD = "header masthead banner logo branding top site-header page-header".split()
FOOT = "footer foot site-footer copyright legal imprint bottom colophon".split()
SIDE = "sidebar side aside widget related recommended popular trending most-read more tags share social rail".split()
NOTICE = "cookie cookies notice consent gdpr alert popup modal overlay newsletter subscribe disclaimer paywall warning message banner".split()
ADVERT = "ad ads advert advertisement sponsored sponsor promo promotion adsense ad-slot ad-container dfp commercial teaser".split()
FORM = "search login signup register contact feedback subscribe newsletter poll survey".split()
COMMENT = "comment comments comment-list reply replies discussion respond disqus responses reader-comments user-comments feedback".split()
MAIN = "article content main post entry story text body article-body post-content entry-content main-content page-content post-body".split()
PLAIN = "wrapper container row col inner page site layout wrap box grid block".split()


class Composer:
    """Pages with known labels: ``compose`` gives the source and the texts of its article."""

    def __init__(self, words: list[str], seed: int = 9):
        self.rng, self.words = np.random.default_rng(seed), words

    def some(self, low: int, high: int) -> str:
        return " ".join(self.words[i] for i in self.rng.integers(0, len(self.words), int(self.rng.integers(low, high + 1))))

    def sentence(self, low: int, high: int) -> str:
        said = " ".join(f"{self.some(3, 14).capitalize()}." for _ in range(int(self.rng.integers(low, high + 1))))
        return said

    def pick(self, options: list[str]) -> str:
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def named(self, names: list[str], tags: list[str]) -> tuple[str, str]:
        """An opening tag with one of the names as class or id, or bare where the tag says it."""
        tag = self.pick(tags)
        if tag not in ("div", "section", "ul", "p", "span") and self.chance(0.5):
            return f"<{tag}>", f"</{tag}>"
        kind, name = self.pick(["class", "class", "id"]), self.pick(names)
        if self.chance(0.2):
            name = f"{name} {self.pick(PLAIN)}"
        return f'<{tag} {kind}="{name}">', f"</{tag}>"

    def menu(self) -> str:
        a, z = self.named(MENU, ["nav", "nav", "div", "ul"])
        items = [f'<a href="/{i}">{self.some(1, 3)}</a>' for i in range(int(self.rng.integers(2, 9)))]
        listed = "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if self.chance(0.7) else " | ".join(items)
        return a + listed + z

    def head(self) -> str:
        a, z = self.named(HEAD, ["header", "header", "div"])
        title = f"<{(t := self.pick(['h1', 'p', 'div', 'a', 'span']))}>{self.some(1, 5)}</{t}>"
        return a + title + (f"<p>{self.sentence(1, 1)}</p>" if self.chance(0.4) else "") + (self.menu() if self.chance(0.4) else "") + z

    def foot(self) -> str:
        a, z = self.named(FOOT, ["footer", "footer", "footer", "div"])
        column = f"<{(t := self.pick(['h3', 'h4', 'h5', 'h6']))}>{self.some(1, 3)}</{t}>" + self.links("ul")
        inside = [column, self.terms(), f"&copy; {self.some(1, 3)} &middot; {self.sentence(0, 2)}", f"<p>{self.sentence(1, 2)}</p>", self.menu(), f"<div>{self.some(2, 6)}</div>"]
        return a + "".join(self.pick(inside) for _ in range(int(self.rng.integers(1, 4)))) + z

    def texts(self, names: list[str], tags: list[str], low: int = 1, high: int = 3) -> str:
        a, z = self.named(names, tags)
        if self.chance(0.4):
            return a + self.sentence(1, 3) + z
        title = f"<{(t := self.pick(['h2', 'h3', 'h4', 'h5', 'strong']))}>{self.some(1, 4)}</{t}>" if self.chance(0.5) else ""
        parts = [f"<p>{self.sentence(1, 3)}</p>" if self.chance(0.6) else f'<div><a href="#">{self.some(2, 7)}</a></div>' for _ in range(int(self.rng.integers(low, high + 1)))]
        return a + title + "".join(parts) + z

    def links(self, tag: str) -> str:
        return f"<{tag}>" + "".join(f'<li><a href="#">{self.some(1, 8)}</a></li>' for _ in range(int(self.rng.integers(1, 6)))) + f"</{tag}>"

    def terms(self, own=None) -> str:
        own = own or (lambda text: text)
        return "<dl>" + "".join(f"<dt>{own(self.some(1, 4))}</dt><dd>{own(self.sentence(1, 2))}</dd>" for _ in range(int(self.rng.integers(1, 4)))) + "</dl>"

    def picture(self, own=None) -> str:
        own = own or (lambda text: text)
        return f'<figure><img src="x.jpg"><figcaption>{own(self.some(2, 14))}</figcaption></figure>'

    def side(self) -> str:
        if self.chance(0.35):
            a, z = self.named(SIDE, ["aside", "aside", "div", "section"])
            title = f"<{(t := self.pick(['h2', 'h3', 'h4', 'h5', 'h6']))}>{self.some(1, 4)}</{t}>" if self.chance(0.8) else ""
            return a + title + self.pick([lambda: self.links("ol"), lambda: self.links("ul"), self.terms, self.picture])() + z
        return self.texts(SIDE, ["aside", "aside", "div", "section"])

    def notice(self) -> str:
        return self.texts(NOTICE, ["div", "section", "p"], 1, 2)

    def advert(self) -> str:
        return self.texts(ADVERT, ["div", "div", "aside", "section", "p"], 1, 2)

    def form(self) -> str:
        a, z = self.named(FORM, ["form", "form", "div"])
        fields = "".join(f"<label>{self.some(1, 3)}</label><input name='x'>" for _ in range(int(self.rng.integers(1, 4))))
        select = "<select>" + "".join(f"<option>{self.some(1, 2)}</option>" for _ in range(3)) + "</select>" if self.chance(0.3) else ""
        area = f"<textarea>{self.some(1, 6)}</textarea>" if self.chance(0.3) else ""
        return (a if a.startswith("<form") else a + "<form>") + f"<p>{self.sentence(1, 1)}</p>" * self.chance(0.5) + fields + select + area + f"<button>{self.some(1, 2)}</button>" + z

    def comments(self) -> str:
        a, z = self.named(COMMENT, ["div", "div", "section", "section", "ul", "ol"])
        if a in ("<ol>", "<section>"):  # bare, it could be part of any text
            a = f'<{a[1:-1]} class="{self.pick(COMMENT)}">'
        one = lambda: self.pick([f"<p>{self.sentence(1, 4)}</p>", f'<div class="comment"><b>{self.some(1, 2)}</b><p>{self.sentence(1, 4)}</p></div>', f"<li>{self.sentence(1, 3)}</li>", f"<header>{self.some(1, 3)}</header><p>{self.sentence(1, 3)}</p>", f"<blockquote>{self.sentence(1, 2)}</blockquote>"])
        return a + f"<h3>{self.some(1, 3)}</h3>" * self.chance(0.6) + "".join(one() for _ in range(int(self.rng.integers(1, 6)))) + z

    def part(self, own) -> str:
        """A part of an article: mostly paragraphs, now and then any other kind of block."""
        roll = self.rng.random()
        if roll < 0.55:
            opening = "<p><b>" if self.chance(0.15) else "<p>"
            closing = "<br>" if self.chance(0.15) else "</p>"
            return opening + own(self.sentence(1, 6)) + closing
        if roll < 0.62:
            short = self.some(1, 4) if self.chance(0.4) else f"{self.some(1, 3).capitalize()}."
            return f"<p>{own(short)}</p>" * (int(self.rng.integers(2, 16)) if self.chance(0.15) else 1)
        if roll < 0.7:
            return f"<{(t := self.pick(['h2', 'h2', 'h3', 'h4', 'h5', 'h6']))}>{own(self.some(1, 7))}</{t}>"
        if roll < 0.82:
            inner = lambda: own(self.some(1, 14)) if self.chance(0.6) else own(self.sentence(1, 2))
            tag = self.pick(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{inner()}</li>" for _ in range(int(self.rng.integers(1, 7)))) + f"</{tag}>"
        if roll < 0.85:
            return f"<blockquote><p>{own(self.sentence(1, 2))}</p></blockquote>"
        if roll < 0.88:
            return "<table>" + "".join(f"<tr><td>{own(self.some(1, 4))}</td><td>{own(self.some(1, 4))}</td></tr>" for _ in range(2)) + "</table>"
        if roll < 0.91:
            return f"<div>{own(self.sentence(1, 4))}</div>"
        if roll < 0.94:
            return self.terms(own)
        if roll < 0.97:
            return self.picture(own)
        return f"<pre>{own(self.some(2, 20))}</pre>"

    def article(self) -> tuple[str, list[str]]:
        """The source and the texts of an article; what is put in between is none of it."""
        said: list[str] = []

        def own(text: str) -> str:
            said.append(text)
            return text

        a, z = self.pick([("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), self.named(MAIN, ["div", "section", "main", "article"])])
        if self.chance(0.25):
            b, y = self.named(MAIN + PLAIN, ["div", "section"])
            a, z = a + b, y + z
        title = f"<{(t := self.pick(['h1', 'h1', 'h2']))}>{own(self.some(2, 12))}</{t}>" if self.chance(0.85) else ""
        if title and self.chance(0.3):
            more = self.pick([lambda: "", lambda: f"<p>{own(self.sentence(1, 2))}</p>", lambda: f"<h2>{own(self.some(2, 9))}</h2>", lambda: f"<div>{own(self.some(2, 5))}</div>"])()
            title = f"<{(t := self.pick(['header', 'header', 'hgroup', 'div']))}>{title}{more}</{t}>"
        parts, open_section = [], False
        for _ in range(int(self.rng.integers(1, 14))):
            if self.chance(0.08):
                parts.append("</section>" if open_section else "<section>")
                open_section = not open_section
            if self.chance(0.1):
                parts.append(self.pick([self.advert, self.notice, self.side, self.form])())
            else:
                parts.append(self.part(own))
        if open_section:
            parts.append("</section>")
        if self.chance(0.12):
            parts.append(self.comments())
        return a + title + "".join(parts) + z, said

    def compose(self) -> tuple[str, set[str]]:
        body, said = self.article()
        above = [self.pick([self.head, self.menu, self.menu, self.advert, self.notice, self.form])() for _ in range(int(self.rng.integers(0, 5)))]
        below = [self.pick([self.comments, self.side, self.foot, self.advert, self.notice, self.form, self.menu])() for _ in range(int(self.rng.integers(0, 4)))]
        if self.chance(0.8):
            below.append(self.foot())
        inside = "".join(above) + body + "".join(below)
        for _ in range(int(self.rng.integers(0, 3))):
            a, z = self.named(PLAIN, ["div", "div", "section"])
            inside = a + inside + z
        head = f"<head><title>{self.some(2, 8)}</title><style>p{{}}</style></head>" if self.chance(0.9) else ""
        return f"<html>{head}<body>{inside}</body></html>", {" ".join(s.split()) for s in said}


def training_set(words: list[str], n: int = TRAINING_PAGES) -> list[tuple[list[tuple[int, ...]], np.ndarray, np.ndarray, np.ndarray]]:
    composer, made = Composer(words), []
    for _ in range(n):
        source, said = composer.compose()
        found = blocks(source)
        if found:
            labels = np.array([entities.unescape(b.text) in said for b in found])
            made.append(([path_buckets(b.path) for b in found], word_bags([b.text for b in found]), measures(found), labels))
    return made


def fit_labeller(pages: DataFrame, html: str = "html", sample_pages: int = SAMPLE_PAGES, sample_words: int = SAMPLE_WORDS) -> Labeller:
    """Train on composed pages with words of about ``sample_pages`` pages (twice as many at most), picked
    by a hash of the source; with no words, on made-up ones. Of a page only the ``sample_words``
    words with the smallest hashes reach the driver, and of equal pages one."""
    known = pages.where(F.col(html).isNotNull())
    rate = min(1.0, 1.5 * sample_pages / max(1, known.count()))
    draw = F.pmod(F.xxhash64(html), F.lit(1 << 30)) / float(1 << 30)
    plain = F.regexp_replace(F.col("html"), r"<[^>]*>|&\w+;", " ")
    words = F.array_distinct(F.filter(F.split(plain, r"\s+"), lambda w: F.length(w).between(1, 30)))
    some = F.transform(F.slice(F.array_sort(F.transform(words, lambda w: F.struct(F.xxhash64(w).alias("h"), w.alias("w")))), 1, sample_words), lambda x: x["w"])
    drawn = known.select(draw.alias("draw"), F.col(html).alias("html")).where(F.col("draw") < rate).select("draw", some.alias("words"))
    rows = drawn.groupBy("draw").agg(F.first("words").alias("words")).orderBy("draw").limit(2 * sample_pages).collect()
    found = sorted({w for r in rows for w in r["words"] if not re.search(r"[<>&]", w)}) or [f"w{i}" for i in range(200)]
    labeller = Labeller()
    labeller.train(training_set(found))
    return labeller


def extract(df: DataFrame, labeller: Labeller, html: str = "html", text: str = "text", n_chars: str = "n_chars", kept: str | None = None) -> DataFrame:
    """Add the main text of each whole page, its length in code points, and on request how many of
    its blocks were kept. A null or empty page, and one without article blocks, has the empty
    text. Columns of these names in ``df`` are replaced, all others kept."""
    added = [text, n_chars, *([kept] if kept else [])]
    source, rest, schema = with_input(df, html, added)
    schema = schema.add(text, "string").add(n_chars, "long")
    schema = schema.add(kept, "integer") if kept else schema
    shared = df.sparkSession.sparkContext.broadcast(labeller)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for row in range(0, batch.num_rows, 4 * PAGES):
                piece = batch.slice(row, 4 * PAGES)
                pages = [blocks(p or "") for p in piece.column(0).to_pylist()]
                marks = model.label(pages)
                texts = [" ".join(b.text for b, keep in zip(p, m, strict=True) if keep) for p, m in zip(pages, marks, strict=True)]
                columns = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                if kept:
                    columns.append(pa.array([int(m.sum()) for m in marks], pa.int32()))
                yield pa.RecordBatch.from_arrays([*[piece.column(i + 1) for i in range(len(rest))], *columns], names=[*rest, *added])

    return source.mapInArrow(run, schema)
