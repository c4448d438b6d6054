"""Main text of web pages: a recurrent labeller over the sequence of text blocks.

A page is cut into leaf blocks. Each block is a vector: the mean of learned vectors of its
hashed tag path (names, classes and ids of all open elements), the mean of learned vectors of
its hashed words, and a few figures. A bidirectional LSTM in numpy reads the whole sequence of
the page, so that every block is judged in the context of the document.

The labeller is trained here, on a bounded sample of pages labelled by their sectioning
elements, and on pages put together from the same texts in many customary layouts. Parts of
the path are hidden at random in training, so that it leans on text and context as well.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import (
    IS_SPACE,
    Batches,
    fused,
    joined_bytes,
    lowered,
    pieces,
    prefix_hash,
    sample_ids,
    span_hash,
    words,
)

#: Pages of the sample, and pages that are put together for training.
SAMPLE_PAGES = 240
MADE_PAGES = 700
#: Blocks of a training page at most (labelling reads whole pages).
TRAIN_BLOCKS = 80
PATH_SLOTS, WORD_SLOTS = 2048, 2048
VECTOR, HIDDEN, FIGURES = 12, 16, 8
EPOCHS = 10

# Fixed values of HTML: elements within a line, elements without content or text for readers,
# and elements that an element of the same group ends.
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_ELEMENTS = set("head script style noscript template svg math iframe object select textarea title".split())
# Start tags that end foreign content (HTML standard, parsing of foreign content).
FOREIGN = {"svg", "math"}
ENDS_FOREIGN = (
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var"
).split()
_ENDS_FOREIGN = rf"|<(?:{'|'.join(ENDS_FOREIGN)})(?=[\s/>])"
ENDS = {"li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
ENDS |= {"dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
ENDS |= {name: {"p"} for name in "div ul ol table section article aside nav footer header form h1 h2 h3 h4".split()}
BOUNDS = set("ul ol table body html div section article aside nav footer header form td dl main".split())

_MARKUP = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|!\[CDATA\[|[!?][^>]*(?:>|\Z)"
    r"|(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^'\">]|\"[^\"]*\"|'[^']*')*>|[^>]*(?:>|\Z)))",
    re.S,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PARTS = re.compile(r"[a-z]+")


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int


def leaf_blocks(page: str) -> list[Block]:
    """The text blocks of a page in order; white space is one blank, references are decoded.

    Elements within a line do not end a block, all other tags do. Comments, scripts, styles
    and what a browser never shows are left out. Open ends and stray tags are tolerated.
    """
    out: list[Block] = []
    stack: list[str] = []
    names: list[tuple[str, ...]] = []
    parts: list[str] = []
    linked = 0
    links = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(tuple(x for own in names for x in own), text, linked))
            parts.clear()
        linked = 0

    end = 0
    size = len(page)
    while end < size:
        found = _MARKUP.search(page, end)
        start = found.start() if found else size
        if start > end:
            parts.append(page[end:start])
            if links:
                linked += start - end
        if not found:
            break
        end = found.end()
        name = found["name"]
        if name is None:
            continue
        name = name.lower()
        if found["close"]:
            if name in INLINE:
                if name == "a":
                    links = max(0, links - 1)
                continue
            flush()
            links = 0
            if name in stack:
                at = len(stack) - 1 - stack[::-1].index(name)
                del stack[at:], names[at:]
            continue
        if name in INLINE:
            if name == "br":
                parts.append(" ")
            elif name == "a":
                links += 1
            continue
        flush()
        if name in HIDDEN_ELEMENTS and not found[0].endswith("/>"):
            # the body ends an open head, and an ordinary start tag a drawing or a formula
            more = r"|<body\b" if name == "head" else _ENDS_FOREIGN if name in FOREIGN else ""
            over = re.compile(rf"</{re.escape(name)}\s*>{more}", re.I).search(page, end)
            if over is None:
                if name != "head":
                    break
            else:
                end = over.end() if over[0].startswith("</") else over.start()
            continue
        if name in VOID or found[0].endswith("/>"):
            continue
        closing = ENDS.get(name)
        if closing:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at] in closing:
                    del stack[at:], names[at:]
                    break
                if stack[at] in BOUNDS:
                    break
        stack.append(name)
        own = [name]
        rest = found["rest"]
        if "=" in rest:
            for groups in _NAMES.findall(rest):
                own += ["." + x for x in _PARTS.findall("".join(groups).lower())]
        names.append(tuple(own))
    flush()
    return out


def _slot(text: str, slots: int) -> int:
    value = 2166136261
    for byte in text.encode():
        value = ((value ^ byte) * 16777619) & 0xFFFFFFFF
    return (value ^ (value >> 15)) % slots


_PATH_SLOT: dict[str, int] = {}


def path_slot(name: str) -> int:
    """The slot of a path element; elements of pages met so far are kept (emptied when many)."""
    found = _PATH_SLOT.get(name)
    if found is None:
        if len(_PATH_SLOT) > 100_000:
            _PATH_SLOT.clear()
        found = _PATH_SLOT[name] = _slot(name, PATH_SLOTS)
    return found


@dataclass
class Sheet:
    """The blocks of some pages as arrays: bags of path and word slots, figures, page borders."""

    path: np.ndarray
    path_at: np.ndarray
    word: np.ndarray
    word_at: np.ndarray
    figures: np.ndarray
    first: np.ndarray


def sheet(pages: list[list[Block]]) -> Sheet:
    """Arrays of all blocks of the pages."""
    blocks = [b for page in pages for b in page]
    first = np.cumsum([0, *map(len, pages)])
    path = [path_slot(x) for b in blocks for x in b.path or ("none",)]
    path_at = np.cumsum([0, *(max(len(b.path), 1) for b in blocks)])
    data, offsets = joined_bytes(pa.array([b.text for b in blocks], pa.string()))
    starts, ends, word_at = words(data, offsets, ~IS_SPACE)
    low = lowered(data)
    word = (span_hash(prefix_hash(low), starts, np.minimum(ends, starts + 64)) % np.uint64(WORD_SLOTS)).astype(np.int64)
    n_words = np.diff(word_at)
    n_chars = np.maximum(np.diff(offsets), 1)
    total = np.concatenate([[0], np.cumsum(_IS_MARK[data])])
    marks = total[offsets[1:]] - total[offsets[:-1]] if len(blocks) else np.zeros(0)
    page = np.repeat(np.arange(len(pages)), np.diff(first))
    inside = (np.arange(len(blocks)) - first[page]) / np.maximum(np.diff(first)[page], 1)
    linked = np.array([b.linked for b in blocks], dtype=float)
    figures = np.column_stack(
        [
            np.log1p(n_words) / 4,
            np.minimum(linked / n_chars, 1),
            np.minimum(marks / np.maximum(n_words, 1), 2),
            inside,
            [b.text[-1] in ".!?\"" for b in blocks],
            [any(x in _HEADINGS for x in b.path[-1:]) for b in blocks],
            np.log1p(n_chars / np.maximum(n_words, 1)) / 2,
            np.ones(len(blocks)),
        ]
    ).astype(np.float32) if blocks else np.zeros((0, FIGURES), np.float32)
    return Sheet(np.array(path, np.int64), path_at, word, word_at, figures, first)


_IS_MARK = np.zeros(256, dtype=np.int64)
_IS_MARK[[*b".,;:!?"]] = 1
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def _bags(table: np.ndarray, slots: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Mean vector of every bag of slots; an empty bag is zero."""
    total = np.zeros((len(slots) + 1, table.shape[1]), dtype=np.float64)
    np.cumsum(table[slots], axis=0, out=total[1:])
    return ((total[at[1:]] - total[at[:-1]]) / np.maximum(np.diff(at), 1)[:, None]).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Labeller:
    """The weights, and the passes forward and backward."""

    def __init__(self, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        width = 2 * VECTOR + FIGURES

        def draw(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.w = {
            "path": draw(PATH_SLOTS, VECTOR, scale=0.3),
            "word": draw(WORD_SLOTS, VECTOR, scale=0.1),
            "out": draw(2 * HIDDEN + width, scale=0.2),
            "bias": np.zeros(1, np.float32),
        }
        for way in ("ahead", "back"):
            self.w[f"{way}_x"] = draw(width, 4 * HIDDEN, scale=width**-0.5)
            self.w[f"{way}_h"] = draw(HIDDEN, 4 * HIDDEN, scale=HIDDEN**-0.5)
            self.w[f"{way}_b"] = np.zeros(4 * HIDDEN, np.float32)

    def inputs(self, s: Sheet) -> np.ndarray:
        return np.hstack([_bags(self.w["path"], s.path, s.path_at), _bags(self.w["word"], s.word, s.word_at), s.figures])

    def _run(self, way: str, x: np.ndarray, first: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states of one direction; all pages go in step, the longest first."""
        sizes = np.diff(first)
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        origin = first[:-1][order] if way == "ahead" else first[1:][order] - 1
        sign = 1 if way == "ahead" else -1
        gates = x @ self.w[f"{way}_x"] + self.w[f"{way}_b"]
        out = np.zeros((len(x), HIDDEN), np.float32)
        h = np.zeros((len(order), HIDDEN), np.float32)
        c = np.zeros_like(h)
        longest = int(sizes[0]) if len(sizes) else 0
        live_at = np.searchsorted(-sizes, -np.arange(longest), side="left")
        for t in range(longest):
            n = int(live_at[t])
            at = origin[:n] + sign * t
            z = gates[at] + h[:n] @ self.w[f"{way}_h"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN] + (k == 1)) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            before = c[:n].copy()
            h_before = h[:n].copy()
            c[:n] = f * before + i * g
            top = np.tanh(c[:n])
            h[:n] = o * top
            out[at] = h[:n]
            if keep is not None:
                keep.append((n, at, i, f, o, g, before, h_before, top))
        return out

    def scores(self, s: Sheet) -> np.ndarray:
        """The log-odds of every block to be main text."""
        x = self.inputs(s)
        return np.hstack([self._run("ahead", x, s.first), self._run("back", x, s.first), x]) @ self.w["out"] + self.w["bias"]

    def gradient(self, s: Sheet, gold: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the weighted log loss, by backpropagation through both directions."""
        x = self.inputs(s)
        kept: dict[str, list] = {"ahead": [], "back": []}
        states = [self._run(way, x, s.first, kept[way]) for way in kept]
        full = np.hstack([*states, x])
        error = ((_sigmoid(full @ self.w["out"] + self.w["bias"]) - gold) * weight / max(weight.sum(), 1)).astype(np.float32)
        grad = {"out": full.T @ error, "bias": error.sum(keepdims=True)}
        d_full = error[:, None] * self.w["out"]
        d_x = d_full[:, 2 * HIDDEN :].copy()
        for k, way in enumerate(kept):
            d_out = d_full[:, k * HIDDEN : (k + 1) * HIDDEN]
            d_gates = np.zeros((len(x), 4 * HIDDEN), np.float32)
            grad_h = np.zeros_like(self.w[f"{way}_h"])
            pages = len(s.first) - 1
            d_h, d_c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
            for n, at, i, f, o, g, before, h_before, top in reversed(kept[way]):
                d_own = d_out[at] + d_h[:n]
                d_cell = d_c[:n] + d_own * o * (1 - top**2)
                z = np.hstack(
                    [d_cell * g * i * (1 - i), d_cell * before * f * (1 - f), d_own * top * o * (1 - o), d_cell * i * (1 - g**2)]
                )
                d_gates[at] = z
                grad_h += h_before.T @ z
                d_h[:n] = z @ self.w[f"{way}_h"].T
                d_c[:n] = d_cell * f
            grad[f"{way}_h"] = grad_h
            grad[f"{way}_x"] = x.T @ d_gates
            grad[f"{way}_b"] = d_gates.sum(axis=0)
            d_x += d_gates @ self.w[f"{way}_x"].T
        for name, slots, at, part in (("path", s.path, s.path_at, 0), ("word", s.word, s.word_at, 1)):
            sizes = np.diff(at)
            share = d_x[:, part * VECTOR : (part + 1) * VECTOR] / np.maximum(sizes, 1)[:, None]
            grad[name] = np.zeros_like(self.w[name])
            np.add.at(grad[name], slots, np.repeat(share, sizes, axis=0))
        return grad


def train(pages: list[tuple[list[Block], list[int]]], epochs: int = EPOCHS, seed: int = 9) -> Labeller:
    """A labeller fitted by Adam on labelled pages; path parts are hidden at random."""
    model = Labeller()
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    steps = 0
    pages = [(b[:TRAIN_BLOCKS], y[:TRAIN_BLOCKS]) for b, y in pages if b]
    for _ in range(epochs):
        for pick in np.array_split(rng.permutation(len(pages)), max(1, len(pages) // 24)):
            batch, gold = [], []
            for k in pick:
                hide = rng.random() < 0.3
                own = []
                for block in pages[k][0]:
                    path = block.path
                    if hide:
                        path = tuple(x for x in path if rng.random() > 0.4)
                    own.append(Block(path, block.text, block.linked))
                batch.append(own)
                gold += pages[k][1]
            if not gold:
                continue
            y = np.array(gold, np.float32)
            grad = model.gradient(sheet(batch), y, np.ones(len(y), np.float32))
            steps += 1
            for name, g in grad.items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                rate = 0.01 * np.sqrt(1 - 0.99**steps) / (1 - 0.9**steps)
                model.w[name] -= rate * first[name] / (np.sqrt(second[name]) + 1e-7)
    return model


# Customary names of page parts, from which training pages are put together.
MAIN_PARTS = "article|main|div.content|div.post|div.entry-content|div.article-body|section.story|div#main-content|div.text|div.post-body"
SIDE_PARTS = (
    "nav|nav.menu|div.menu|ul.nav|div.navbar|header|header.site-header|div.header|div.topbar|div.breadcrumb|footer|footer.site-footer|"
    "div.footer|div.copyright|div.legal|aside|aside.sidebar|div.sidebar|div.widget|div.related|div.recommended|div.share|div.social|"
    "div.ad|div.ads|div.advert|div.advertisement|div.banner|div.sponsored|div.promo|div.cookie-notice|div.consent|div.notice|div.alert|"
    "div.popup|div.newsletter|div.subscribe|form|form.search|div.login|div.comments|section.comments|div.comment|ol.comment-list|"
    "div.reply|div.discussion|div.pagination|div.tags|div.byline-links|div.disclaimer|div.warning|div.modal"
)
SIDE_WORDS = (
    "home about contact login register search menu share tweet subscribe newsletter cookies accept privacy terms policy copyright "
    "rights reserved advertisement sponsored buy now offer reply comment comments says wrote posted related more popular tags next previous"
).split()


def _part(rng: np.random.Generator, names: str) -> tuple[str, ...]:
    name, _, marks = str(rng.choice(names.split("|"))).replace("#", ".").partition(".")
    return (name, *("." + x for x in _PARTS.findall(marks)))


def _made(rng: np.random.Generator, texts: list[str]) -> tuple[list[Block], list[int]]:
    """A page of customary parts around, and sometimes within, a main part with given texts."""
    blocks: list[Block] = []
    gold: list[int] = []
    base = ("html", "body") + (("div", *(f".{x}" for x in ("page", "wrapper", "container") if rng.random() < 0.3)) if rng.random() < 0.5 else ())

    def any_text() -> str:
        return texts[int(rng.integers(len(texts)))]

    def line() -> str:
        words = any_text().split()
        short = words[: int(rng.integers(1, 14))]
        if rng.random() < 0.5:
            short += [str(x) for x in rng.choice(SIDE_WORDS, int(rng.integers(1, 4)))]
        return " ".join(short)

    def side(path: tuple[str, ...]) -> None:
        own = path + _part(rng, SIDE_PARTS)
        as_list = rng.random() < 0.45
        as_text = not as_list and rng.random() < 0.35
        for _ in range(int(rng.integers(1, 8 if as_list else 4))):
            text = any_text() if as_text else line()
            inner = ("ul", "li") if as_list else tuple(x for x in ("p", "div") if rng.random() < 0.3)
            blocks.append(Block(own + inner, text, len(text) if as_list and rng.random() < 0.9 else 0))
            gold.append(0)

    for _ in range(int(rng.integers(0, 4))):
        side(base)
    main = base + _part(rng, MAIN_PARTS)
    if rng.random() < 0.3:
        main += ("div",) + (_part(rng, MAIN_PARTS)[1:] if rng.random() < 0.5 else ())
    if rng.random() < 0.8:
        head = main + (("header",) if rng.random() < 0.2 else ()) + (str(rng.choice(["h1", "h2"])),)
        blocks.append(Block(head, " ".join(any_text().split()[:9]) or "title", 0))
        gold.append(1)
    for _ in range(int(rng.integers(1, 14))):
        kind = rng.random()
        text = any_text()
        if rng.random() < 0.25:
            text = " ".join(text.split()[: int(rng.integers(1, 8))]) or text
        inner = ("p",) if kind < 0.75 else ("ul", "li") if kind < 0.85 else ("blockquote", "p") if kind < 0.9 else (str(rng.choice(["h2", "h3", "pre", "div"])),)
        blocks.append(Block(main + inner, text, 0))
        gold.append(1)
        if rng.random() < 0.06:
            side(main)
    for _ in range(int(rng.integers(0, 4))):
        side(base if rng.random() < 0.8 else main)
    return blocks, gold


_MAIN = {"article", "main"}
_SIDE = {"nav", "aside", "footer", "form", "header"} | {
    f".{x}" for x in "ad ads advert menu sidebar comments comment cookie notice banner share related newsletter promo".split()
}


def _marked(blocks: list[Block]) -> list[int]:
    """Labels by the innermost sectioning element; what none encloses is no main text."""
    out = []
    for block in blocks:
        label = 0
        for x in block.path:
            label = 1 if x in _MAIN else 0 if x in _SIDE else label
        out.append(label)
    return out


def fit(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", sample_pages: int = SAMPLE_PAGES) -> Labeller:
    """The labeller, trained on at most `sample_pages` pages, the first by hash of the id."""
    ids = sample_ids(pages, id_column, sample_pages)
    chosen = pages.select(F.col(id_column).alias("_id"), F.substring(html_column, 1, 60_000).alias("_html"))
    rows = chosen.join(F.broadcast(ids), "_id", "left_semi").orderBy("_id", F.xxhash64("_html")).limit(2 * sample_pages)
    real = [leaf_blocks(row["_html"] or "") for row in rows.collect()]
    real = [blocks for blocks in real if blocks]
    texts = [b.text for blocks in real for b in blocks][:20_000] or ["text"]
    rng = np.random.default_rng(17)
    made = [_made(rng, texts) for _ in range(MADE_PAGES)]
    return train([*((blocks, _marked(blocks)) for blocks in real if any(_marked(blocks))), *made])


def _extracting(model: Broadcast, html_column: str):
    def step(batches: Batches) -> Batches:
        labeller: Labeller = model.value
        for batch in pieces(batches, html_column):
            pages = [leaf_blocks(page or "") for page in batch.column(html_column).to_pylist()]
            s = sheet(pages)
            main = labeller.scores(s) > 0
            texts = [
                "\n".join(b.text for b, own in zip(page, main[s.first[k] :], strict=False) if own)
                for k, page in enumerate(pages)
            ]
            names = [c for c in batch.schema.names if c != html_column]
            yield pa.record_batch(
                [*(batch.column(c) for c in names), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*names, "text", "n_chars"],
            )

    return step


def extract(
    pages: DataFrame, labeller: Labeller, keep: tuple[str, ...] = ("page_id", "url"), html_column: str = "html"
) -> DataFrame:
    """The kept columns, `text` (blocks of main text, one per line) and its length, for every page.

    A null or empty page, and one without main text, has an empty text. Rows are independent.
    """
    sent = pages.sparkSession.sparkContext.broadcast(labeller)
    kept = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return fused(pages, [*keep, html_column], [_extracting(sent, html_column)], f"{kept}, text string, n_chars long")
