"""Main text of HTML pages: a bidirectional LSTM in numpy labels every leaf block of a page.

A block is read as hashed vectors of the elements around it and of its words, with a few numbers. One chain of
states runs down the page and one up, so every label is made from the whole page. The network is fitted on pages
laid out from templates, whose labels are known, and on a bounded sample of pages with semantic elements, which tell
their main text themselves.

A null or empty page has an empty text; so has a page of which no block is main text. Repeated rows are answered one
by one; columns that are not asked for are dropped.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre.llm.html_blocks import Block, blocks
from lumbre.llm.samples import bounded_sample
from lumbre.llm.texts import words

PATH, WORDS, NUMBERS, HIDDEN = 48, 16, 7, 16
INPUTS = PATH + WORDS + NUMBERS
#: Pages of the table that the network is fitted on, at most, and pages laid out from templates.
SAMPLE, TEMPLATES = 200, 800
#: Pages labelled at once, and blocks of a page that a fit looks at.
PAGES, FIT_BLOCKS = 96, 60


@lru_cache(maxsize=20_000)
def path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Signed hashes of the names around a block; the inner ones count more."""
    out = np.zeros(PATH, np.float32)
    for depth, name in enumerate(path):
        code = zlib.crc32(name.encode())
        weight = 1.0 if name[0] == "." or depth >= len(path) - 4 else 0.7
        for k in range(3):
            out[(code >> (8 * k)) % PATH] += weight if (code >> (24 + k)) & 1 else -weight
    return np.clip(out, -3, 3)


def features(pages: list[list[Block]]) -> list[np.ndarray]:
    """One row of inputs per block, for each page."""
    flat = [b for page in pages for b in page]
    if not flat:
        return [np.zeros((0, INPUTS), np.float32) for _ in pages]
    raw = [b.text.encode() for b in flat]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    hashes, first = words(offsets, np.frombuffer(b"".join(raw), np.uint8))
    owner = np.repeat(np.arange(len(flat)), np.diff(first))
    bags = np.zeros((len(flat), WORDS), np.float32)
    sign = np.where((hashes >> np.uint64(40)) & np.uint64(1), 1.0, -1.0).astype(np.float32)
    np.add.at(bags, (owner, (hashes % np.uint64(WORDS)).astype(np.int64)), sign)
    bags /= np.sqrt(np.maximum(np.diff(first), 1))[:, None]
    out, at = [], 0
    for page in pages:
        n = len(page)
        rows = np.zeros((n, INPUTS), np.float32)
        for k, b in enumerate(page):
            rows[k, :PATH] = path_vector(b.path)
            size = len(b.text)
            rows[k, PATH + WORDS :] = (
                math.log1p(size) / 5 - 1, b.linked, b.text[-1] in ".!?…", k / n, 1 - k / n, size < 40, not b.path,
            )
        rows[:, PATH : PATH + WORDS] = bags[at : at + n] * 0.3
        out.append(rows)
        at += n
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Weights of both chains (``down``, ``up``) and of the output."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        scale = 1 / math.sqrt(INPUTS + HIDDEN)
        self.weights = {}
        for name in ("down", "up"):
            self.weights[name] = (rng.standard_normal((INPUTS + HIDDEN, 4 * HIDDEN)) * scale).astype(np.float32)
            offset = np.zeros(4 * HIDDEN, np.float32)
            offset[HIDDEN : 2 * HIDDEN] = 1
            self.weights[f"{name}_offset"] = offset
        self.weights["out"] = (rng.standard_normal(2 * HIDDEN) * 0.3).astype(np.float32)
        self.weights["out_offset"] = np.zeros(1, np.float32)

    def _chain(self, name: str, x: np.ndarray, live: np.ndarray, keep: bool):
        """States of a chain over x (steps, pages, inputs); ``live`` marks steps that are blocks."""
        steps, n, _ = x.shape
        w, offset = self.weights[name], self.weights[f"{name}_offset"]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        ahead = x.reshape(-1, INPUTS) @ w[:INPUTS] + offset
        ahead = ahead.reshape(steps, n, -1)
        states, tape = np.zeros((steps, n, HIDDEN), np.float32), []
        for t in range(steps) if name == "down" else range(steps - 1, -1, -1):
            z = ahead[t] + h @ w[INPUTS:]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            now = live[t][:, None]
            before = (h, c)
            c = np.where(now, f * c + i * g, c)
            h = np.where(now, o * np.tanh(c), h)
            states[t] = h
            if keep:
                tape.append((t, i, f, o, g, c, *before))
        return states, tape

    def _padded(self, pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        steps = max(len(p) for p in pages)
        x = np.zeros((steps, len(pages), INPUTS), np.float32)
        live = np.zeros((steps, len(pages)), bool)
        for k, page in enumerate(pages):
            x[: len(page), k] = page
            live[: len(page), k] = True
        return x, live

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page the probability of each block to be main text."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        for begin in range(0, len(order), PAGES):
            own = order[begin : begin + PAGES]
            x, live = self._padded([pages[k] for k in own])
            both = np.concatenate([self._chain(name, x, live, False)[0] for name in ("down", "up")], -1)
            p = _sigmoid(both @ self.weights["out"] + self.weights["out_offset"][0])
            for place, k in enumerate(own):
                out[k] = p[: len(pages[k]), place]
        return out

    def gradients(self, pages: list[np.ndarray], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Gradients of the mean logistic loss over all blocks."""
        x, live = self._padded(pages)
        y = np.zeros(live.shape, np.float32)
        for k, own in enumerate(labels):
            y[: len(own), k] = own
        chains = {name: self._chain(name, x, live, True) for name in ("down", "up")}
        both = np.concatenate([chains["down"][0], chains["up"][0]], -1)
        w = self.weights
        error = np.where(live, _sigmoid(both @ w["out"] + w["out_offset"][0]) - y, 0).astype(np.float32) / live.sum()
        grads = {"out": np.einsum("tn,tnh->h", error, both), "out_offset": error.sum(keepdims=True)[0]}
        for k, (name, (_, tape)) in enumerate(chains.items()):
            to_states = error[:, :, None] * w["out"][k * HIDDEN : (k + 1) * HIDDEN]
            grads[name], grads[f"{name}_offset"] = np.zeros_like(w[name]), np.zeros_like(w[f"{name}_offset"])
            dh, dc = np.zeros((len(pages), HIDDEN), np.float32), np.zeros((len(pages), HIDDEN), np.float32)
            for t, i, f, o, g, c, h0, c0 in reversed(tape):
                now = live[t][:, None]
                dh = dh + to_states[t]
                squeezed = np.tanh(c)
                inner = dc + np.where(now, dh * o * (1 - squeezed**2), 0)
                dz = np.concatenate(
                    [inner * g * i * (1 - i), inner * c0 * f * (1 - f), dh * squeezed * o * (1 - o), inner * i * (1 - g**2)], 1
                )
                dz = np.where(now, dz, 0)
                grads[name] += np.concatenate([x[t], h0], 1).T @ dz
                grads[f"{name}_offset"] += dz.sum(0)
                dh = np.where(now, dz @ w[name][INPUTS:].T, dh)
                dc = np.where(now, inner * f, dc)
        return grads


def fit_pages(pages: list[list[Block]], labels: list[list[bool]], epochs: int = 10, batch: int = 24, seed: int = 5) -> Labeller:
    """Fit on pages with a label for every block; of a long page a stretch is taken anew in each epoch."""
    model, rng = Labeller(), np.random.default_rng(seed)
    known = [(x, np.array(y, np.float32)) for x, y in zip(features(pages), labels, strict=True) if len(x)]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.weights.items()}
    steps = 0
    for epoch in range(epochs):
        order = rng.permutation(len(known))
        for begin in range(0, len(order), batch):
            own = []
            for k in order[begin : begin + batch]:
                x, y = known[k]
                at = int(rng.integers(0, max(1, len(x) - FIT_BLOCKS + 1)))
                own.append((x[at : at + FIT_BLOCKS], y[at : at + FIT_BLOCKS]))
            steps += 1
            for name, grad in model.gradients([x for x, _ in own], [y for _, y in own]).items():
                one, two = moments[name]
                one += 0.1 * (grad - one)
                two += 0.01 * (grad**2 - two)
                scale = 0.02 * (1 - epoch / epochs) * math.sqrt(1 - 0.99**steps) / (1 - 0.9**steps)
                model.weights[name] -= (scale * one / (np.sqrt(two) + 1e-7)).astype(np.float32)
    return model


_MAIN = frozenset(("article", "main", ".main"))
_ASIDE = frozenset(
    ("nav", "header", "footer", "aside", "form", "button", ".ad", ".ads", ".advert", ".comment", ".comments", ".sidebar",
     ".menu", ".cookie", ".notice", ".banner", ".share", ".related", ".newsletter", ".promo")
)


def told(page: list[Block]) -> list[bool] | None:
    """Labels that a page with an article or main element gives itself; None for other pages."""
    if not any(_MAIN & set(b.path) for b in page):
        return None
    return [bool(_MAIN & set(b.path)) and not _ASIDE & set(b.path) for b in page]


def templates(sentences: Sequence[str], count: int = TEMPLATES, seed: int = 3) -> tuple[list[str], list[list[bool]]]:
    """Pages put together from sentences, with the label of every block, in layouts of many kinds."""
    rng = np.random.default_rng(seed)
    sentences = list(sentences) or ["Nothing has been written here so far."]

    def say(least: int, most: int) -> str:
        return " ".join(sentences[k] for k in rng.integers(0, len(sentences), rng.integers(least, most + 1)))

    def few(most: int) -> str:
        return " ".join(say(1, 1).split()[: rng.integers(1, most + 1)])

    def pick(options: str) -> str:
        return str(rng.choice(options.split("|")))

    def box(tags: str, names: str, inner: list[tuple[str, bool | None]]) -> list[tuple[str, bool | None]]:
        tag, name = pick(tags), pick(names)
        mark = f' {pick("class|id")}="{name}"' if name != "-" else ""
        return [(f"<{tag}{mark}>", None), *inner, (f"</{tag}>", None)]

    def p(text: str, label: bool, tags: str = "p") -> list[tuple[str, bool | None]]:
        return box(tags, "-", [(text, label)])

    def links(n: int) -> list[tuple[str, bool | None]]:
        rows = [x for k in range(n) for x in box("li", "-", [(f'<a href="/{k}">{few(3)}</a>', False)])]
        return box("ul|ol", "-|menu|nav-list|links", rows)

    def side() -> list[tuple[str, bool | None]]:
        kind = rng.integers(0, 8)
        if kind == 0:
            return box("nav|div", "nav|menu|navbar|main-menu|breadcrumb", links(int(rng.integers(2, 9))))
        if kind == 1:
            return box("div|section|aside", "ad|ads|advert|ad-banner|sponsored|promo", p(say(1, 2), False, "p|div"))
        if kind == 2:
            return box("aside|div", "sidebar|side|related|widget|right-column", p(few(4), False, "h2|h3|h4") + links(4) + p(say(1, 3), False))
        if kind == 3:
            return box("div|section", "cookie-notice|notice|cookie|gdpr|alert|banner", p(say(1, 2), False, "p|div|span") + box("button", "-", [(few(2), False)]))
        if kind == 4:
            return box("form", "-|search|login|newsletter|subscribe", box("label|div", "-", [(few(3), False)]) + box("button", "-", [(few(2), False)]) + p(say(1, 1), False))
        if kind == 5:
            rows = [x for _ in range(rng.integers(1, 6)) for x in box("div|li|article", "comment|reply|comment-body", p(few(2), False, "span|h4|div") + p(say(1, 4), False))]
            return box("section|div|ol", "comments|comment-list|discussion|reader-comments", p(few(2), False, "h2|h3") + rows)
        if kind == 6:
            return box("div", "share|social|share-buttons|tags", [(f"<a>{few(2)}</a> <a>{few(2)}</a>", False)])
        return box("div|section", "related|recommended|more-news|read-more", p(few(3), False, "h3|h4") + links(3))

    def article() -> list[tuple[str, bool | None]]:
        rows = p(few(12), True, "h1|h1|h2") if rng.random() < 0.9 else []
        brief = rng.random() < 0.2
        for _ in range(rng.integers(1, 4 if brief else 14)):
            kind = rng.integers(0, 12)
            if kind == 0:
                rows += p(few(6), True, "h2|h3")
            elif kind == 1:
                rows += box("ul|ol", "-", [x for _ in range(3) for x in p(say(1, 1), True, "li")])
            elif kind == 2:
                rows += box("blockquote", "-", p(say(1, 2), True))
            elif kind == 3 and rng.random() < 0.5:
                rows += side()
            elif kind == 4:
                rows += p(few(3), True)
            else:
                rows += p(few(6) if brief else say(1, 6), True, "p|p|p|p|div")
        return box("article|article|article|main|div|section", "-|content|article-body|post|entry-content|main|story", rows)

    def wrapped(rows: list[tuple[str, bool | None]]) -> list[tuple[str, bool | None]]:
        return box("div|main|section", "-|wrapper|container|page|row", rows) if rng.random() < 0.4 else rows

    pages, labels = [], []
    for k in range(count):
        if k % 10 == 0:
            rows = [x for _ in range(rng.integers(1, 5)) for x in p(say(1, 5) if k % 20 else few(8), True)]
        elif k % 10 == 1:
            rows = [(say(1, 3) if k % 20 == 1 else few(8), True)]
        else:
            rows = []
            if rng.random() < 0.6:
                rows += box("header|div", "header|top|masthead|-", p(few(3), False, "h1|div|p|span") + (links(3) if rng.random() < 0.5 else []))
            for _ in range(rng.integers(0, 4)):
                rows += side()
            rows += wrapped(article())
            for _ in range(rng.integers(0, 4)):
                rows += side()
            if rng.random() < 0.8:
                rows += box("footer|div", "footer|bottom|site-footer|-" if rng.random() < 0.2 else "footer|bottom|site-footer", p("© " + few(3) + " · " + say(1, 1), False, "p|div|span"))
        page = "\n".join(t for t, _ in rows)
        if rng.random() < 0.8:
            page = f"<!DOCTYPE html><html><head><title>{few(5)}</title></head><body>{page}</body></html>"
        known = [y for _, y in rows if y is not None]
        if len(blocks(page)) == len(known):
            pages.append(page)
            labels.append(known)
    return pages, labels


def fit(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", rows: int = SAMPLE) -> Labeller:
    """Fit on at most ``rows`` pages, those with the lowest hashes of their ids, and on templates of their sentences."""
    chosen = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    seen = [blocks(r["html"]) for r in bounded_sample(chosen, "id", rows).collect()]
    sentences = [b.text for page in seen for b in page if 20 <= len(b.text) <= 400][:4000]
    made, labels = templates(sentences)
    known = [(page, y) for page in seen if (y := told(page)) is not None]
    return fit_pages([*map(blocks, made), *(page for page, _ in known)], [*labels, *(y for _, y in known)])


def main_texts(pages: list[str | None], model: Labeller) -> list[str]:
    """Main text of each page: its blocks joined by single spaces."""
    found = [blocks(p) for p in pages]
    chosen = model.probabilities(features(found))
    return [
        " ".join(b.text for b, p in zip(own, ps.tolist(), strict=True) if p >= 0.5)
        for own, ps in zip(found, chosen, strict=True)
    ]


def extract(pages: DataFrame, model: Labeller, html_col: str = "html", keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` of every row and the main text of its page as ``text``."""
    fields = [T.StructField(c, pages.schema[c].dataType) for c in keep if c != "text"]
    schema = T.StructType([*fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 8 * PAGES):
                part = batch.slice(begin, 8 * PAGES)
                texts = main_texts(part.column(len(fields)).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(fields)], pa.array(texts, pa.string())], schema.names)

    return pages.select(*(F.col(f.name) for f in fields), F.col(html_col).alias("__html")).mapInArrow(run, schema)
