"""Main text of web pages: a bidirectional LSTM labels every text block from its tag path, words and neighbours."""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import bounded_batches, pieces

#: Pages that the model is fitted on, at most, and layouts drawn for each.
SAMPLE, LAYOUTS = 300, 3
#: Blocks of a sequence that the model is fitted on.
LONGEST, CHARACTERS = 200, 2000
#: Bound of the cells, which keeps the states of long pages among those of the fitted ones.
CELL = 3.0
#: Entries of the tag-path vector and of the word vector; further figures; units in either direction.
PATH, WORDS, FIGURES, UNITS = 64, 32, 8, 16

# fixed values: elements of HTML by the part they play
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template head svg iframe object canvas select option textarea button".split())
RAW = frozenset("script style textarea title noscript iframe".split())
HEAD = frozenset("html head base basefont bgsound link meta title style script noscript template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split()
)
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = frozenset("html body div article section main aside nav header footer table ul ol dl form blockquote td th".split())

# fixed values: names of elements, classes and ids that say what a container holds
BOILERPLATE = frozenset(
    "nav header footer aside form menu navbar sidebar side banner ad ads advert advertisement sponsor sponsored promo cookie consent notice alert "
    "popup modal newsletter subscribe share social related breadcrumb breadcrumbs comment comments reply replies disqus login search copyright pager "
    "pagination widget toolbar".split()
)
MAIN = frozenset("article main content post entry story".split())
LAYOUT_MAIN = [
    "article", "main article", "main", "div .content", "div #main div .post body", "section .entry content", "div .article body", "div .story",
    "div #content", "article div .post content", "div div", "div .page div .text",
]
LAYOUT_BOILERPLATE = [
    "nav ul li", "div .menu ul li", "header", "header nav", "div .header", "footer", "div .footer", "aside", "aside ul li", "div .sidebar", "div .ad", "div .advert",
    "div .ads banner", "div .cookie notice", "div .notice", "div .alert", "form", "form div", "div .newsletter subscribe", "div .share social", "div .related ul li",
    "div .breadcrumbs", "section .comments div .comment", "div #comments div .comment", "ol .comment list li .comment", "div .login form", "div .copyright",
    "div .promo", "div .pagination",
]

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)>?|[^<]+|<", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z]+")


class Block(NamedTuple):
    path: tuple[str, ...]
    text: str
    linked: int


def names_of(attributes: str) -> list[str]:
    """Words of class, id and role, marked by a dot."""
    if "=" not in attributes:
        return []
    found = []
    for m in _NAMES.finditer(attributes):
        found += ["." + w for w in _PARTS.findall((m[2] or m[3] or m[4] or "").lower())]
    return found


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order: runs of text between the tags of block elements.

    Unclosed elements end where HTML ends them; text of scripts, styles, the head and controls is
    no block. Character references are decoded, white space becomes single spaces.
    """
    stack: list[tuple[str, list[str]]] = []
    out: list[Block] = []
    run: list[str] = []
    linked = hidden = links = 0
    path: tuple[str, ...] | None = None
    raw = ""

    def flush() -> None:
        nonlocal linked, run, path
        text = " ".join(html.unescape("".join(run)).split()) if run else ""
        if text:
            out.append(Block(path or (), text, linked))
        run, linked, path = [], 0, None

    def pop(to: int) -> None:
        nonlocal hidden, links
        while len(stack) > to:
            name = stack.pop()[0]
            hidden -= name in HIDDEN
            links -= name == "a"

    def leave_head() -> None:
        """An open head ends with text or an element that cannot stand in it."""
        while stack and stack[-1][0] == "head":
            pop(len(stack) - 1)

    for m in _TOKEN.finditer(page):
        name = m[2]
        if name is None:
            piece = m[0]
            if not raw and hidden and not piece.isspace() and not piece.startswith(("<!", "<?")):
                leave_head()
            if raw or hidden or piece.startswith(("<!", "<?")):
                continue
            if path is None and not piece.isspace():
                path = tuple(w for n, names in stack for w in (n, *names))
            run.append(piece)
            if links:
                linked += len(piece)
            continue
        name = name.lower()
        if raw:
            if not (m[1] and name == raw):
                continue
            raw = ""
        if name not in INLINE:
            flush()
        elif name == "br" and run:
            run.append(" ")
        if m[1]:
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if at is not None:
                pop(at)
            continue
        if hidden and name not in HEAD:
            leave_head()
        if name in CLOSES or name in SCOPE:
            ends = CLOSES.get(name, {"p"})
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    pop(k)
                    break
                if stack[k][0] in SCOPE:
                    break
        if name in VOID or m[3].endswith("/"):
            continue
        stack.append((name, names_of(m[3])))
        hidden += name in HIDDEN
        links += name == "a"
        if name in RAW:
            raw = name
    flush()
    return out


class Slots(dict):
    """Entry and sign of hashed words, remembered up to a bound."""

    def __init__(self, size: int, most: int = 100_000):
        super().__init__()
        self.size, self.most = size, most

    def __missing__(self, word: str) -> tuple[int, float]:
        if len(self) >= self.most:
            self.clear()
        code = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        found = self[word] = code % self.size, 1.0 if code >> 20 & 1 else -1.0
        return found


def inputs(blocks: list[Block], names: Slots | None = None, words_at: Slots | None = None) -> np.ndarray:
    """A vector per block: hashed tag path, hashed words, and figures about length, links, marks and place."""
    names, words_at = names if names is not None else Slots(PATH), words_at if words_at is not None else Slots(WORDS)
    out = np.zeros((len(blocks), PATH + WORDS + FIGURES), np.float32)
    paths: dict[tuple[str, ...], np.ndarray] = {}
    for k, b in enumerate(blocks):
        vector = paths.get(b.path)
        if vector is None:
            vector = paths[b.path] = np.zeros(PATH, np.float32)
            for name in {n for n in b.path if n not in INLINE}:
                at, sign = names[name]
                vector[at] += sign
        out[k, :PATH] = vector
        words = b.text.split()
        slots = [words_at[w] for w in words]
        n = len(words)
        out[k, PATH : PATH + WORDS] = np.bincount([s for s, _ in slots], [x for _, x in slots], WORDS) / n**0.5
        size = len(b.text)
        out[k, PATH + WORDS :] = (
            np.log1p(n) / 3, min(1.0, b.linked / size), b.text.count(".") * 5 / size, sum(map(b.text.count, "©|·•»")) > 0,
            len(b.path) / 10, k / len(blocks), 1.0 if n < 4 else 0.0, sum(map(b.text.count, ",;:")) * 5 / size,
        )
    return out


class Labeller:
    """A bidirectional LSTM with a logistic output per block, in numpy."""

    def __init__(self, seed: int = 5):
        rng, d = np.random.default_rng(seed), PATH + WORDS + FIGURES
        new = lambda a, b: (rng.standard_normal((a, b)) / a**0.5).astype(np.float32)
        self.weights = [new(d, 4 * UNITS), new(UNITS, 4 * UNITS), np.zeros(4 * UNITS, np.float32)] * 2
        self.weights = [w.copy() for w in self.weights] + [new(2 * UNITS, 1), np.zeros(1, np.float32)]
        for k in (2, 5):
            self.weights[k][UNITS : 2 * UNITS] = 1

    @staticmethod
    def _run(x, mask, wx, wh, b):
        """Hidden states over time (steps, rows, units) and what the gradient needs; padded steps keep the state."""
        steps, rows = mask.shape
        ahead = x @ wx + b
        h, c, states, kept = np.zeros((rows, UNITS), np.float32), np.zeros((rows, UNITS), np.float32), [], []
        for t in range(steps):
            z = ahead[t] + h @ wh
            gates = 1 / (1 + np.exp(-z[:, : 3 * UNITS]))
            i, f, o, g = gates[:, :UNITS], gates[:, UNITS : 2 * UNITS], gates[:, 2 * UNITS :], np.tanh(z[:, 3 * UNITS :])
            free = f * c + i * g
            new = np.clip(free, -CELL, CELL)
            bent = np.tanh(new)
            m = mask[t][:, None]
            kept.append((h, c, i, f, o, g, bent, m, new == free))
            h, c = np.where(m, o * bent, h), np.where(m, new, c)
            states.append(h)
        return np.stack(states), kept

    @staticmethod
    def _back(x, kept, up, wx, wh):
        steps = len(kept)
        dwh, dz = np.zeros_like(wh), np.zeros((steps, x.shape[1], 4 * UNITS), np.float32)
        dh, dc = np.zeros_like(up[0]), np.zeros_like(up[0])
        for t in range(steps - 1, -1, -1):
            h, c, i, f, o, g, bent, m, free = kept[t]
            dh = dh + up[t]
            own = dh * m
            d = (dc * m + own * o * (1 - bent**2)) * free
            dz[t] = np.concatenate([d * g * i * (1 - i), d * c * f * (1 - f), own * bent * o * (1 - o), d * i * (1 - g**2)], 1)
            dwh += h.T @ dz[t]
            dh, dc = dz[t] @ wh.T + dh * ~m, d * f + dc * ~m
        return np.tensordot(x, dz, ((0, 1), (0, 1))), dwh, dz.sum((0, 1))

    def _forward(self, x, mask):
        w = self.weights
        ahead, kept = self._run(x, mask, *w[:3])
        back, kept2 = self._run(x[::-1], mask[::-1], *w[3:6])
        both = np.concatenate([ahead, back[::-1]], 2)
        return 1 / (1 + np.exp(-(both @ w[6] + w[7])[..., 0])), both, kept, kept2

    @staticmethod
    def _padded(sequences):
        steps = max(map(len, sequences))
        x, mask = np.zeros((steps, len(sequences), sequences[0].shape[1]), np.float32), np.zeros((steps, len(sequences)), bool)
        for k, s in enumerate(sequences):
            x[: len(s), k], mask[: len(s), k] = s, True
        return x, mask

    def fit(self, sequences: list[np.ndarray], labels: list[np.ndarray], epochs: int = 14, rows: int = 32, rate: float = 0.01) -> Labeller:
        """Adam on the cross-entropy of the blocks; labels are 0, 1 or -1 for unknown.

        Half of the word vectors, drawn anew in each step, are left out, so that a few words alone
        don't decide against the containers and neighbours.
        """
        rng = np.random.default_rng(3)
        first, second, step = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights], 0
        for _ in range(epochs):
            order = sorted(rng.permutation(len(sequences)), key=lambda k: len(sequences[k]))
            for at in rng.permutation(range(0, len(order), rows)):
                own = order[at : at + rows]
                x, mask = self._padded([sequences[k] for k in own])
                y, known = np.zeros(mask.shape, np.float32), np.zeros(mask.shape, bool)
                for j, k in enumerate(own):
                    y[: len(labels[k]), j], known[: len(labels[k]), j] = labels[k] > 0, labels[k] >= 0
                x[..., PATH : PATH + WORDS] *= rng.random((*mask.shape, 1)) < 0.5
                p, both, kept, kept2 = self._forward(x, mask)
                d = np.where(known, p - y, 0)[..., None] / max(1, known.sum())
                up = (d @ self.weights[6].T).astype(np.float32)
                grads = [
                    *self._back(x, kept, up[..., :UNITS], *self.weights[:2]),
                    *self._back(x[::-1], kept2, up[::-1, :, UNITS:], *self.weights[3:5]),
                    np.tensordot(both, d, ((0, 1), (0, 1))), d.sum((0, 1)),
                ]
                step += 1
                for k, g in enumerate(grads):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.weights[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def probabilities(self, sequences: list[np.ndarray], rows: int = 64) -> list[np.ndarray]:
        """The probability of main text for each block; sequences of similar length are run together."""
        out = [np.zeros(0, np.float32)] * len(sequences)
        order = sorted((k for k in range(len(sequences)) if len(sequences[k])), key=lambda k: len(sequences[k]))
        at = 0
        while at < len(order):
            own = order[at : at + rows]
            while len(own) > 1 and len(own) * len(sequences[own[-1]]) > 20_000:  # bounds the padded array
                own = own[: len(own) // 2]
            p = self._forward(*self._padded([sequences[k] for k in own]))[0]
            for j, k in enumerate(own):
                out[k] = p[: len(sequences[k]), j]
            at += len(own)
        return out


def marked(path: tuple[str, ...]) -> int:
    """What the names of the containers say: 0 for boilerplate, 1 for main text, -1 if nothing."""
    names = [n.removeprefix(".") for n in path]
    if any(n in BOILERPLATE for n in names):
        return 0
    return 1 if any(n in MAIN for n in names) else -1


def _path(layout: str) -> tuple[str, ...]:
    """Container names of a layout; words after a class or id belong to it."""
    out, own = ["html", "body"], False
    for word in layout.split():
        own = word[0] in ".#" or own and word not in SCOPE and word != "li"
        out.append("." + word.lstrip(".#") if own else word)
    return tuple(out)


def layouts(blocks: list[Block], rng: np.random.Generator, n: int) -> list[tuple[list[Block], np.ndarray]]:
    """The page as it is, with labels from its container names, and its texts in drawn layouts with known labels."""
    marks = np.array([marked(b.path) for b in blocks])
    out = [(blocks, marks)]
    main = [b.text for b, m in zip(blocks, marks) if m == 1] or [b.text for b in blocks]
    short = [b.text for b, m in zip(blocks, marks) if m == 0] or [" ".join(t.split()[:4]) for t in main]
    for _ in range(n if main else 0):
        found: list[tuple[Block, int]] = []
        body = _path(LAYOUT_MAIN[rng.integers(len(LAYOUT_MAIN))])

        def boilerplate(inside: bool) -> None:
            path = _path(LAYOUT_BOILERPLATE[rng.integers(len(LAYOUT_BOILERPLATE))])
            long = rng.random() < 0.5
            for _ in range(rng.integers(1, 7)):
                text = main[rng.integers(len(main))] if long else short[rng.integers(len(short))]
                full = (body + path[2:] if inside else path) + (("p",) if long and rng.random() < 0.6 else ())
                found.append((Block(full, text, len(text) if not long and rng.random() < 0.6 else 0), 0))

        for _ in range(rng.integers(1, 4)):
            boilerplate(False)
        if rng.random() < 0.7:
            found.append((Block(body + ("h1",), main[0], 0), 1))
        size = rng.integers(1, 40) if rng.random() < 0.9 else rng.integers(40, LONGEST)
        for text in (main * (size // len(main) + 1))[:size]:
            found.append((Block(body + (("p",) if rng.random() < 0.9 else ("ul", "li")), text, 0), 1))
            if rng.random() < 0.04:
                boilerplate(True)
        if rng.random() < 0.3:
            boilerplate(True)
        for _ in range(rng.integers(1, 4)):
            boilerplate(False)
        out.append(([b for b, _ in found], np.array([m for _, m in found])))
    return out


def fit(pages: DataFrame, sample: int = SAMPLE) -> Labeller:
    """A labeller from a bounded sample of different pages, those with the smallest hash of their html.

    Container names of a page that tell main text from boilerplate are its labels; further
    sequences set its texts into layouts drawn from lists of usual names, some without any, where
    only words, figures and neighbours tell. Sequences are cut to LONGEST blocks of CHARACTERS
    characters for fitting alone, by the tasks that read the pages. One task fits the model.
    """
    filled = pages.where("html IS NOT NULL AND html <> ''").select(F.xxhash64("html").alias("h"), "html")
    first = filled.select("h").distinct().orderBy("h").limit(sample)
    chosen = filled.join(F.broadcast(first), "h").dropDuplicates(["h"])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"path": b.path, "text": b.text[:CHARACTERS], "linked": b.linked} for b in blocks_of(page)[:LONGEST]] for page in batch.column("html").to_pylist()]
            kind = pa.list_(pa.struct([("path", pa.list_(pa.string())), ("text", pa.string()), ("linked", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(found, kind)], names=["h", "blocks"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng, sequences, labels = np.random.default_rng(1), [], []
        rows = [r for batch in batches for r in zip(batch.column("h").to_pylist(), batch.column("blocks").to_pylist())]
        for _, held in sorted(rows, key=lambda r: r[0]):
            blocks = [Block(tuple(b["path"]), b["text"], b["linked"]) for b in held]
            for found, marks in layouts(blocks, rng, LAYOUTS) if blocks else []:
                sequences.append(inputs(found[:LONGEST]))
                labels.append(marks[:LONGEST])
        fitted = (Labeller().fit(sequences, labels) if sequences else Labeller()).weights
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes() for w in fitted], pa.binary())], names=["weights"])

    labeller = Labeller()
    parsed = chosen.mapInArrow(parse, "h long, blocks array<struct<path:array<string>,text:string,linked:int>>")
    found = [r.weights for r in parsed.coalesce(1).mapInArrow(train, "weights binary").collect()]
    labeller.weights = [np.frombuffer(f, np.float32).reshape(w.shape) for f, w in zip(found, labeller.weights)] or labeller.weights
    return labeller


def extracted(pages: DataFrame, labeller: Labeller, least: float = 0.5) -> DataFrame:
    """(page_id, url, text, n_chars) of every page: the blocks labelled main text, joined by spaces in page order.

    Every block of the whole page is labelled. Null and empty pages, and pages without a block of
    main text, have an empty text. Repeated rows get equal texts; extra columns are ignored.
    """
    bounded_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, words_at = Slots(PATH), Slots(WORDS)
        for batch in pieces(batches, "html", 2 << 20):
            found = [blocks_of(page or "") for page in batch.column("html").to_pylist()]
            labels = labeller.probabilities([inputs(b, names, words_at) for b in found])
            texts = [" ".join(b.text for b, p in zip(blocks, own) if p >= least) for blocks, own in zip(found, labels)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    schema = pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
