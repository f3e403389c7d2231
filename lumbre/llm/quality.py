"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into chunks of bytes; each chunk is read with the first bytes of the next one, so the windows of
neighbouring chunks overlap and cover the whole text. Learned filters run over byte embeddings and a channel that
says whether the four bytes here also stood a few bytes before. A filter's maximum is taken in each chunk; the
maxima and means of these over all chunks are combined by a small hidden layer into one probability.

Null and empty texts have no window and get the score of an empty text. Every row is scored by its text alone, so
repeated rows have equal scores; other columns are not read. With no labelled row of one class fitting fails.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre.llm.samples import bounded_sample
from lumbre.llm.texts import slices, utf8

EMBEDDING, WIDTH, STRIDE, FILTERS, HIDDEN, CHUNK = 7, 12, 4, 24, 16, 4096
#: A byte counts as repeated if the four bytes from it on also stood at most so many bytes before.
LAGS = range(2, 33)
SLICE = 1_000_000
#: Labelled rows that the network is fitted on, at most, half of them of each class.
SAMPLE = 4000
#: For so many good texts one short piece of a good text is added.
SHORT_SHARE = 5


def _layout(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts behind each other with room between: codes (byte + 1, 0 for none), repeats, and for each chunk its
    first window and its text."""
    sizes = np.diff(offsets)
    windows = -(-sizes // STRIDE)
    room = windows * STRIDE + -(-WIDTH // STRIDE) * STRIDE
    starts = np.cumsum(room) - room
    codes = np.zeros(int(room.sum()) + WIDTH, np.int16)
    for at, begin, size in zip(starts.tolist(), offsets[:-1].tolist(), sizes.tolist(), strict=True):
        codes[at : at + size] = data[begin : begin + size]
        codes[at : at + size] += 1
    raw = codes.astype(np.uint8)
    grams = np.zeros(len(raw), np.uint32)
    for k in range(4):
        grams[: len(raw) - 3] |= raw[k : len(raw) - 3 + k].astype(np.uint32) << np.uint32(8 * k)
    repeat = np.zeros(len(raw), bool)
    for lag in LAGS:
        repeat[lag:] |= grams[lag:] == grams[:-lag]
    repeat &= codes > 0
    chunks = -(-windows * STRIDE // CHUNK)
    owner = np.repeat(np.arange(len(sizes)), chunks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    first = starts[owner] // STRIDE + nth * (CHUNK // STRIDE)
    last = np.minimum(first + CHUNK // STRIDE, starts[owner] // STRIDE + windows[owner])
    return codes, repeat, np.stack([first, last], 1), owner


@dataclass
class Network:
    """Weights, and what of them a text's score needs."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        inputs = WIDTH * (EMBEDDING + 1)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return cls(
            {
                "embedding": normal(257, EMBEDDING, scale=0.5),
                "filters": normal(inputs, FILTERS, scale=1 / np.sqrt(inputs)),
                "offset": np.zeros(FILTERS, np.float32),
                "hidden": normal(2 * FILTERS, HIDDEN, scale=0.3),
                "hidden_offset": np.zeros(HIDDEN, np.float32),
                "out": normal(HIDDEN, scale=0.3),
                "out_offset": np.zeros(1, np.float32),
            }
        )

    def pooled(self, codes: np.ndarray, repeat: np.ndarray, chunks: np.ndarray, where: bool = False):
        """Maxima of every filter in every chunk, and with ``where`` also their windows."""
        w = self.weights
        best = np.zeros((len(chunks), FILTERS), np.float32)
        at = np.zeros((len(chunks), FILTERS), np.int64)
        table = w["embedding"].copy()
        table[0] = 0
        for k, (first, last) in enumerate(chunks.tolist()):
            begin, end = first * STRIDE, (last - 1) * STRIDE + WIDTH
            planes = np.empty((end - begin, EMBEDDING + 1), np.float32)
            planes[:, :EMBEDDING] = table[codes[begin:end]]
            planes[:, EMBEDDING] = repeat[begin:end]
            step = planes.strides[0]
            view = np.lib.stride_tricks.as_strided(planes, (last - first, WIDTH * (EMBEDDING + 1)), (step * STRIDE, 4))
            out = view @ w["filters"]
            best[k] = out.max(0)
            if where:
                at[k] = out.argmax(0) + first
        best = np.maximum(best + w["offset"], 0)
        return (best, at) if where else best

    def combine(self, best: np.ndarray, owner: np.ndarray, n_texts: int):
        """Chunk maxima to (features, hidden values, probability) of each text."""
        w = self.weights
        features = np.zeros((n_texts, 2 * FILTERS), np.float32)
        count = np.bincount(owner, minlength=n_texts)
        full = np.flatnonzero(count)
        if len(full):
            cuts = np.cumsum(count[full]) - count[full]
            features[full, :FILTERS] = np.maximum.reduceat(best, cuts)
            features[full, FILTERS:] = np.add.reduceat(best, cuts) / count[full, None]
        hidden = np.tanh(features @ w["hidden"] + w["hidden_offset"])
        return features, hidden, 1 / (1 + np.exp(-(hidden @ w["out"] + w["out_offset"][0])))

    def scores(self, column: pa.Array) -> np.ndarray:
        offsets, data = utf8(column)
        out = [np.zeros(0, np.float32)]
        for i, j in slices(offsets, SLICE):
            codes, repeat, chunks, owner = _layout(offsets[i : j + 1], data)
            out.append(self.combine(self.pooled(codes, repeat, chunks), owner, j - i)[2])
        return np.concatenate(out).astype(np.float64)

    def step(self, codes, repeat, chunks, owner, labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted logistic loss over some texts."""
        w = self.weights
        best, at = self.pooled(codes, repeat, chunks, where=True)
        features, hidden, probability = self.combine(best, owner, len(labels))
        error = ((probability - labels) * weight / weight.sum()).astype(np.float32)
        to_hidden = error[:, None] * w["out"] * (1 - hidden**2)
        to_features = to_hidden @ w["hidden"].T
        grads = {"out": hidden.T @ error, "out_offset": error.sum(keepdims=True), "hidden": features.T @ to_hidden,
                 "hidden_offset": to_hidden.sum(0)}
        count = np.bincount(owner, minlength=len(labels))
        top = best == features[owner, :FILTERS]
        to_best = to_features[owner, :FILTERS] * top / np.maximum(1, _sum_by(top, owner, count))[owner]
        to_best = (to_best + to_features[owner, FILTERS:] / count[owner, None]) * (best > 0)
        place = at[:, :, None] * STRIDE + np.arange(WIDTH)
        seen, again = codes[place], repeat[place]
        planes = np.concatenate([w["embedding"][seen] * (seen > 0)[..., None], again[..., None]], -1, dtype=np.float32)
        grads["filters"] = np.einsum("kf,kfx->xf", to_best, planes.reshape(*at.shape, -1))
        grads["offset"] = to_best.sum(0)
        back = to_best[:, :, None, None] * w["filters"].T.reshape(FILTERS, WIDTH, -1)[None, :, :, :EMBEDDING]
        grads["embedding"] = np.zeros_like(w["embedding"])
        np.add.at(grads["embedding"], seen.reshape(-1), back.reshape(-1, EMBEDDING))
        return grads


def _sum_by(values: np.ndarray, owner: np.ndarray, count: np.ndarray) -> np.ndarray:
    out = np.zeros((len(count), values.shape[1]), np.float32)
    full = np.flatnonzero(count)
    if len(full):
        out[full] = np.add.reduceat(values.astype(np.float32), np.cumsum(count[full]) - count[full])
    return out


def _plain(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    return (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.string())


def _stretch(text: str, rng: np.random.Generator) -> str:
    """A few whole words of a text, from its beginning: short texts are rare among labelled rows."""
    return " ".join(text.split()[: rng.integers(1, 12)])


def fit_arrays(texts: pa.Array, labels: np.ndarray, epochs: int = 6, batch: int = 24, seed: int = 7) -> Network:
    """Fit on texts with labels 0 and 1; both classes weigh the same."""
    labels = np.asarray(labels, np.float32)
    if len(set(labels.tolist())) < 2:
        raise ValueError("both classes need labelled rows")
    network, rng = Network.new(seed), np.random.default_rng(seed)
    good = np.flatnonzero(labels == 1)
    pieces = [_stretch(texts[int(k)].as_py() or "", rng) for k in rng.choice(good, len(good) // SHORT_SHARE)]
    labels = np.concatenate([labels, np.ones(len(pieces), np.float32)])
    offsets, data = utf8(pa.concat_arrays([_plain(texts), pa.array(pieces, pa.string())]))
    share = labels.mean()
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.weights.items()}
    steps = 0
    rate = 0.01
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        for begin in range(0, len(order), batch):
            own = order[begin : begin + batch]
            sizes = np.diff(offsets)[own]
            part = np.concatenate([data[offsets[k] : offsets[k + 1]] for k in own])
            laid = _layout(np.concatenate([[0], np.cumsum(sizes)]), part)
            weight = np.where(labels[own] == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
            steps += 1
            for name, grad in network.step(*laid, labels[own], weight).items():
                one, two = moments[name]
                one += 0.1 * (grad - one)
                two += 0.01 * (grad**2 - two)
                scale = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.99**steps) / (1 - 0.9**steps)
                network.weights[name] -= (scale * one / (np.sqrt(two) + 1e-7)).astype(np.float32)
    return network


def fit(docs: DataFrame, labelled: DataFrame, id_col="doc_id", text_col="text", label_col="label", rows=SAMPLE) -> Network:
    """Fit on at most ``rows`` of the labelled ids, those with the lowest hashes, half of each class."""
    known = labelled.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropDuplicates(["id"])
    halves = [bounded_sample(known.where(F.col("label") == k), "id", rows // 2) for k in (0, 1)]
    chosen = halves[0].unionByName(halves[1])
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    table = text.join(F.broadcast(chosen), "id").toArrow().sort_by("id")
    return fit_arrays(table.column("text"), table.column("label").to_numpy())


def score(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(network.scores(batch.column(1)))], schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def passing(docs: DataFrame, network: Network, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose text scores at least ``least``, with their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(network.scores(batch.column(text_col)) >= least))

    return docs.mapInArrow(run, docs.schema)
