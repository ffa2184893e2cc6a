"""Main text of web pages by a recurrent labeller over leaf blocks.

A page becomes the sequence of its leaf blocks: text between tags that break a line, with the path of open tags
(names, classes and ids). A bidirectional LSTM in numpy reads, for each block, hashed vectors of the path and of
the words and a few plain numbers, and so sees the whole page before it decides. It is trained here, by
backpropagation through time, on ``TRAINING_PAGES`` pages of a fixed layout grammar: articles in many usual
mark-ups, amid menus, headers, footers, sidebars, notices, adverts, forms and reader comments.

Scripts, styles and comments hold no text, and what lacks its end does not take the rest of the page with it; character references are decoded; white space inside a block, line
breaks among it, becomes one space; blocks follow in page order, joined by two line feeds. Null, empty and
textless pages give an empty text; repeated rows are labelled alike; other columns are ignored.
"""

import html
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.tables import raw_texts, slices

PATH_SIZE, WORD_SIZE, PLAIN_SIZE = 64, 32, 4
HIDDEN = 24
TRAINING_PAGES = 900
EPOCHS = 10
SEED = 17
EXTRACTED = "page_id long, url string, text string, n_chars long"

_MARKUP = re.compile(r"<!---?>|<!--|<!\[CDATA\[|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TOKEN = re.compile(r"[a-z]+")
#: Fixed values of HTML: elements without end tag, without text, without tags inside, within a line, and paragraphs' implied ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style title template noscript svg math iframe object canvas".split())
RAW = frozenset("script style title textarea iframe".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


@lru_cache(64)
def _end_tag(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?![\w:-])", re.I | re.A)


def leaf_blocks(page: str) -> list[tuple[tuple[str, ...], str, bool]]:
    """(path tokens, text, whether links hold most of it) of every leaf block with text."""
    blocks: list[tuple[tuple[str, ...], str, bool]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    silent: str | None = None
    foreign = False
    endless: set[str] = set()  # what has no end from here on
    linked = length = links = 0

    def flush() -> None:
        nonlocal length, links
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            path = [t for _, own in stack for t in own]
            blocks.append((tuple(path), text, 2 * links > length))
        parts.clear()
        length = links = 0

    def take(text: str) -> None:
        nonlocal length, links
        if silent is None and text:
            parts.append(text)
            n = len(text.strip())
            length += n
            links += n if linked else 0

    def end_of(name: str, start: int) -> re.Match | None:
        if name in endless:
            return None
        if not (found := _end_tag(name).search(page, start)):
            endless.add(name)
        return found

    at = 0
    while m := _MARKUP.search(page, at):
        take(page[at:m.start()])
        at = m.end()
        if not m[2]:
            if end := {"<!--": "-->", "<![CDATA[": "]]>"}.get(m[0]):
                found = -1 if end in endless else page.find(end, at)
                if found < 0:  # without its end, it ends like a tag
                    endless.add(end)
                    end, found = ">", page.find(">", at)
                at = found + len(end) if found >= 0 else at
            continue
        name = m[2].lower()
        opens = not m[1] and not m[3].rstrip().endswith("/")
        if opens and name in RAW and (found := end_of(name, at)):
            if silent is None:
                flush()
                if name not in SILENT:
                    take(page[at:found.start()])
            at = found.start()
            continue
        if silent is not None:
            foreign = (foreign or opens) and not m[1] if name in ("foreignobject", "annotation-xml") else foreign
            if m[1] and name == silent:
                silent = None
                continue
            if m[1] or silent not in ("svg", "math") or foreign or name not in CLOSES_P:
                continue
            silent = None  # page elements end a drawing or formula
        if m[1]:
            if name == "a":
                linked = max(0, linked - 1)
            if name not in INLINE:
                flush()
            if any(own == name for own, _ in stack):
                while stack and stack[-1][0] != name:
                    stack.pop()
                stack.pop()
            continue
        if name in SILENT:
            flush()
            if opens and name not in RAW and end_of(name, at):
                silent, foreign = name, False
            continue
        if name == "br":
            take(" ")
        elif name not in INLINE:
            flush()
            if name in CLOSES_P and any(own == "p" for own, _ in stack):
                while stack.pop()[0] != "p":
                    pass
            if name == "li" and stack and stack[-1][0] == "li":
                stack.pop()
        if name in VOID or name == "head" or not opens:
            continue
        if name in INLINE:
            linked += name == "a"
            continue
        names = " ".join(x for found in _NAMES.findall(m[3]) for x in found if x).lower()
        stack.append((name, (name, *(f".{t}" for t in _TOKEN.findall(names)))))
    take(page[at:])
    flush()
    return blocks


_SIGNS = np.array([1.0, -1.0])


@lru_cache(1 << 12)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    out = np.zeros(PATH_SIZE, np.float32)
    for token in path:
        h = zlib.crc32(token.encode())
        out[h % PATH_SIZE] += 1.0 if h & 0x10000 else -1.0
    return out


def vectors(blocks: list[tuple[tuple[str, ...], str, bool]]) -> np.ndarray:
    out = np.zeros((len(blocks), PATH_SIZE + WORD_SIZE + PLAIN_SIZE), np.float32)
    for row, (path, text, linked) in zip(out, blocks):
        row[:PATH_SIZE] = _path_vector(path)
        own = text.encode().lower().split()
        at = np.fromiter(map(zlib.crc32, own), np.uint32, len(own))  # half of the places count up, half count down
        row[PATH_SIZE:PATH_SIZE + WORD_SIZE] = np.bincount(at & (2 * WORD_SIZE - 1), minlength=2 * WORD_SIZE).reshape(2, -1).T @ _SIGNS / len(own)
        row[-PLAIN_SIZE:] = np.log1p(len(text)) / 6, linked, len(path) / 10, text[-1] in ".!?"
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w: dict[str, np.ndarray], side: str, x: np.ndarray, mask: np.ndarray):
    """One direction over (pages, blocks, features); masked steps leave the state at zero."""
    n, steps, _ = x.shape
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    fed = x @ w[f"x{side}"] + w[f"b{side}"]
    trace = []
    for t in range(steps):
        gates = fed[:, t] + h @ w[f"h{side}"]
        i, f, o = (_sigmoid(gates[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN:])
        m = mask[:, t, None]
        new = (f * c + i * g) * m
        tanh = np.tanh(new)
        trace.append((i, f, o, g, c, h, tanh, m))
        c, h = new, o * tanh * m
        trace[-1] += (h,)
    return np.stack([s[-1] for s in trace], axis=1), trace


def _backward(w: dict, side: str, x: np.ndarray, trace: list, dh_all: np.ndarray, grads: dict) -> None:
    dh, dc = np.zeros_like(dh_all[:, 0]), np.zeros_like(dh_all[:, 0])
    for t in range(len(trace) - 1, -1, -1):
        i, f, o, g, c, h, tanh, m, _ = trace[t]
        dh = (dh + dh_all[:, t]) * m
        dc = (dc + dh * o * (1 - tanh * tanh)) * m
        d = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tanh * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        grads[f"x{side}"] += x[:, t].T @ d
        grads[f"h{side}"] += h.T @ d
        grads[f"b{side}"] += d.sum(axis=0)
        dh, dc = d @ w[f"h{side}"].T, dc * f


def scores(w: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Probability of being main text for every block of padded pages."""
    ahead, _ = _forward(w, "f", x, mask)
    back, _ = _forward(w, "b", x[:, ::-1], mask[:, ::-1])
    return _sigmoid(np.concatenate([ahead, back[:, ::-1], x], axis=2) @ w["out"] + w["bias"])


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((len(pages), steps, pages[0].shape[1]), np.float32), np.zeros((len(pages), steps), np.float32)
    for i, p in enumerate(pages):
        x[i, :len(p)], mask[i, :len(p)] = p, 1
    return x, mask


def _grammar_page(rng: np.random.Generator) -> tuple[str, list[bool]]:
    """A page of a random layout and the label of each of its blocks."""
    def pick(options):
        return options[int(rng.integers(len(options)))]

    def sentence(low: int, high: int) -> str:
        letters = "etaoinshrdlucmfwygpbvk"
        return " ".join("".join(pick(letters) for _ in range(int(rng.integers(1, 10)))) for _ in range(int(rng.integers(low, high)))).capitalize() + pick([".", ".", "!", "?", ""])

    def passage() -> str:
        """What articles hold: sentences, single words, rows of a table, lines with symbols, repeated lines."""
        kind = rng.random()
        if kind < 0.6:
            return sentence(2, 90)
        if kind < 0.75:
            return sentence(1, 4)
        mark = pick([" | ", " ", "### ", "&amp;&amp;&amp; ", "%%% ", "*** ", " - "])
        return mark.join(sentence(1, 3) for _ in range(int(rng.integers(1, 12))))

    labels: list[bool] = []

    def say(text: str, main: bool) -> str:
        labels.append(main)
        return text

    def menu() -> str:
        links = "".join(f'<li><a href="#">{say(sentence(1, 4), False)}</a></li>' for _ in range(int(rng.integers(2, 8))))
        tag, name = pick([("nav", ""), ("nav", ' class="menu"'), ("div", ' class="nav"'), ("div", ' id="menu"'), ("div", ' class="navbar"'), ("div", ' class="breadcrumb"')])
        return f"<{tag}{name}><ul>{links}</ul></{tag}>"

    def boxed(options: list[tuple[str, str]], low: int = 3, high: int = 25) -> str:
        tag, name = pick(options)
        inner = [pick(["p", "div", "li", "h3"]) for _ in range(int(rng.integers(1, 4)))] if rng.random() < 0.6 else []
        body = "".join(f"<{x}>{say(sentence(low, high), False)}</{x}>" for x in inner) or say(sentence(low, high), False)
        return f"<{tag}{name}>{body}</{tag}>"

    advert = [("div", f' class="{c}"') for c in ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "teaser")]
    notice = [("div", f' class="{c}"') for c in ("cookie", "cookie-banner", "notice", "consent", "alert", "popup", "modal", "newsletter", "subscribe")]
    head = [("header", ""), ("div", ' id="header"'), ("div", ' class="site-header"'), ("div", ' class="masthead"')]
    foot = [("footer", ""), ("div", ' id="footer"'), ("div", ' class="site-footer"'), ("div", ' class="copyright"')]
    side = [("aside", ""), ("div", ' class="sidebar"'), ("div", ' id="sidebar"'), ("div", ' class="related"'), ("div", ' class="widget"'), ("section", ' class="recommended"'), ("div", ' class="share"'), ("div", ' class="social"')]
    talk = [("div", f' class="{c}"') for c in ("comments", "comment", "replies", "discussion")] + [("section", ' id="comments"'), ("ol", ' class="comment-list"'), ("div", ' id="disqus"')]
    form = [("form", ""), ("form", ' class="search"'), ("form", ' class="login"')]

    def article() -> str:
        body = [f"<h1>{say(sentence(2, 12), True)}</h1>"] if rng.random() < 0.8 else []
        for _ in range(int(rng.integers(1, 24))):
            kind = rng.random()
            if kind < 0.72:
                body.append(f"<p>{say(passage(), True)}</p>")
            elif kind < 0.8:
                body.append(f"<{(tag := pick(['h2', 'h3', 'blockquote', 'pre', 'div', 'figcaption', 'td', 'dd']))}>{say(sentence(1, 14), True)}</{tag}>")
            elif kind < 0.86:
                body.append("<ul>" + "".join(f"<li>{say(sentence(1, 15), True)}</li>" for _ in range(int(rng.integers(1, 5)))) + "</ul>")
            elif kind < 0.9:
                body.append(boxed(advert))
            elif kind < 0.92:
                body.append(boxed(side))
            else:
                body.append(f"<p><b>{say(passage(), True)}<br>")
        inner = "".join(body)
        opening, closing = pick([
            ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ('<article class="post">', "</article>"),
            ('<div class="content">', "</div>"), ('<div id="content">', "</div>"), ('<div class="article">', "</div>"), ('<div class="post">', "</div>"),
            ('<div class="entry">', "</div>"), ('<div class="story">', "</div>"), ('<div id="main">', "</div>"), ('<div class="article-body">', "</div>"),
            ('<section class="text">', "</section>"), ('<div role="main">', "</div>"), ("<div>", "</div>"), ("<section>", "</section>"), ("", "")])
        return opening + inner + closing

    def maybe(chance: float, make) -> str:
        return make() if rng.random() < chance else ""

    page = "".join([
        maybe(0.3, lambda: boxed(notice)), maybe(0.4, lambda: boxed(head, 1, 8)), maybe(0.8, menu), maybe(0.15, lambda: boxed(form, 1, 5)),
        maybe(0.5, lambda: boxed(advert)), maybe(0.2, lambda: boxed(side)), article(), maybe(0.3, lambda: boxed(advert)), maybe(0.4, lambda: boxed(side)),
        maybe(0.35, lambda: "".join(boxed(talk, 1, 40) for _ in range(int(rng.integers(1, 4))))), maybe(0.25, lambda: boxed(form, 1, 5)),
        maybe(0.2, menu), maybe(0.15, lambda: boxed(notice)), maybe(0.85, lambda: boxed(foot, 1, 15))])
    return f"<html><head><title>x</title></head><body>{page}</body></html>", labels


def train(pages: int = TRAINING_PAGES, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Weights, the same in every run: Adam on pages of the grammar."""
    rng = np.random.default_rng(SEED)
    data = []
    while len(data) < pages:
        page, labels = _grammar_page(rng)
        blocks = leaf_blocks(page)
        if len(blocks) == len(labels) and blocks:
            data.append((vectors(blocks), np.array(labels, np.float32)))
    wide = data[0][0].shape[1]
    w = {k: rng.normal(0, s, shape).astype(np.float32) for k, s, shape in (
        ("xf", 0.15, (wide, 4 * HIDDEN)), ("xb", 0.15, (wide, 4 * HIDDEN)), ("hf", 0.2, (HIDDEN, 4 * HIDDEN)), ("hb", 0.2, (HIDDEN, 4 * HIDDEN)),
        ("bf", 0, (4 * HIDDEN,)), ("bb", 0, (4 * HIDDEN,)), ("out", 0.1, (2 * HIDDEN + wide,)), ("bias", 0, (1,)))}
    first, second, turn = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), 20):
            batch = [data[i] for i in order[at:at + 20]]
            x, mask = padded([b[0] for b in batch])
            y = padded([b[1][:, None] for b in batch])[0][:, :, 0]
            ahead, trace_f = _forward(w, "f", x, mask)
            back, trace_b = _forward(w, "b", x[:, ::-1], mask[:, ::-1])
            joint = np.concatenate([ahead, back[:, ::-1], x], axis=2)
            d = (_sigmoid(joint @ w["out"] + w["bias"]) - y) * mask / mask.sum()
            grads = {k: np.zeros_like(v) for k, v in w.items()}
            grads["out"], grads["bias"] = np.einsum("nt,ntk->k", d, joint), d.sum(keepdims=True).ravel()
            dj = d[:, :, None] * w["out"]
            _backward(w, "f", x, trace_f, dj[:, :, :HIDDEN], grads)
            _backward(w, "b", x[:, ::-1], trace_b, dj[:, ::-1, HIDDEN:2 * HIDDEN], grads)
            turn += 1
            for k in w:
                first[k] = 0.9 * first[k] + 0.1 * grads[k]
                second[k] = 0.999 * second[k] + 0.001 * grads[k] ** 2
                w[k] = (w[k] - 0.01 * (first[k] / (1 - 0.9 ** turn)) / (np.sqrt(second[k] / (1 - 0.999 ** turn)) + 1e-8)).astype(np.float32)
    return w


def main_texts(pages: list[str], w: dict[str, np.ndarray]) -> list[str]:
    """The main text of every page; pages of like length are labelled together."""
    blocks = [leaf_blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i, b in enumerate(blocks) if b), key=lambda i: len(blocks[i]))
    at = 0
    while at < len(order):
        many = max(1, min(64, 4096 // len(blocks[order[at]])))
        own = order[at:at + many]
        at += many
        x, mask = padded([vectors(blocks[i]) for i in own])
        for i, score in zip(own, scores(w, x, mask)):
            out[i] = "\n\n".join(b[1] for b, s in zip(blocks[i], score) if s >= 0.5)
    return out


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    w = train()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = main_texts([t.decode(errors="replace") for t in raw_texts(batch, "html")], w)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(run, EXTRACTED)
