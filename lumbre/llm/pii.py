"""Personal data: wide candidate patterns, boosted trees over format and surroundings, calibrated thresholds.

Generators propose spans that may overlap: what the fixed rules find (base spans), and spelled-out addresses, IPv6,
card and phone numbers inside longer rows of digits. One set of boosted trees per kind gives every candidate a
probability, calibrated on held-out samples. Base spans are always taken; of the others those whose probability
reaches the kind's threshold, the likeliest first, as long as they overlap none that is taken.

Positions are code points, ends exclusive. Null texts are empty; rows are judged one by one, so repeated rows have
equal spans; other columns are not read, or kept as they are. A corpus of no text is fitted on made-up samples alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre.llm import boosting
from lumbre.llm.pii_candidates import KINDS, Span, candidates, matrix
from lumbre.llm.pii_samples import ordinary, rendered
from lumbre.llm.samples import bounded_sample

#: Texts that surroundings are taken from, and characters of each, at most; made-up strings to fit on.
SAMPLE, PIECE, MADE = 600, 400, 10_000
#: Share of the added spans (those that are no base spans) that must be right on held-out samples.
PRECISION = 0.99

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("kind", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("base", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
)


@dataclass(frozen=True)
class Detector:
    """Trees and threshold of each kind."""

    models: tuple[boosting.Boosted, ...]
    least: tuple[float, ...]

    def spans(self, text: str) -> list[tuple[int, int, int, bool, float]]:
        """Chosen spans by start, then kind, with their probabilities."""
        found = candidates(text)
        if not found:
            return []
        x, scores = matrix(text, found), np.zeros(len(found))
        kinds = np.array([s.kind for s in found])
        for kind in np.unique(kinds):
            own = kinds == kind
            scores[own] = self.models[kind].probability(x[own])
        return _chosen(found, scores, self.least)


def _chosen(found: list[Span], scores: np.ndarray, least: tuple[float, ...]) -> list[tuple]:
    """Base spans, and the likeliest of the others that reach their threshold and overlap none taken before.

    Candidates are looked at in groups that overlap in a chain, so that taken ones need not be searched for.
    """
    out = [(s.start, s.kind, s.end, True, float(p)) for s, p in zip(found, scores, strict=True) if s.base]
    wide = [(s, float(p)) for s, p in zip(found, scores, strict=True) if not s.base and p >= least[s.kind]]
    group, end = [], 0
    for s, p in [*wide, (None, 0.0)]:
        if group and (s is None or s.start >= end):
            taken: list[Span] = []
            for one, score in sorted(group, key=lambda g: (-g[1], g[0].start - g[0].end, g[0])):
                if all(one.end <= t.start or one.start >= t.end for t in taken):
                    taken.append(one)
                    out.append((one.start, one.kind, one.end, False, score))
            group = []
        if s is not None:
            end = max(end, s.end) if group else s.end
            group.append((s, p))
    return sorted(out)


def fit_samples(pieces: list[str], made: int = MADE, precision: float = PRECISION, seed: int = 11) -> Detector:
    """Fit on made-up strings between pieces of text; thresholds on others between other pieces."""
    parts = []
    for half in (0, 1):
        own = pieces[half::2]
        rows = rendered(own, made // 2, seed + half) + ordinary(own)
        x = np.concatenate([matrix(text, [span]) for text, span, _ in rows])
        about = [np.array(c) for c in zip(*((s.kind, s.base, y) for _, s, y in rows), strict=True)]
        parts.append((x, *about))
    (x, kind, _, y), (held_x, held_kind, held_base, held_y) = parts
    models, least = [], []
    for k in range(len(KINDS)):
        model, own = boosting.fit(x[kind == k], y[kind == k]), held_kind == k
        boosting.calibrate(model, held_x[own], held_y[own])
        added = own & ~held_base
        models.append(model)
        least.append(boosting.threshold(model.probability(held_x[added]), held_y[added], precision))
    return Detector(tuple(models), tuple(least))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, piece: int = PIECE, made: int = MADE) -> Detector:
    """Fit with surroundings from at most ``sample`` rows, ``piece`` characters of each from a place that its hash names."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    place = F.pmod(F.xxhash64(text), F.greatest(F.length(text) - piece, F.lit(1)).cast("bigint")).cast("int") + 1
    slim = docs.select(F.col(id_col).alias("id"), F.substring(text, place, F.lit(piece)).alias("piece")).where("piece <> ''")
    rows = bounded_sample(slim, "id", sample).collect()
    return fit_samples(sorted(r["piece"] for r in rows), made)


def scan(docs: DataFrame, detector: Detector, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every row."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("spans", SPANS)])
    kind = _arrow_spans()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [detector.spans(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def redacted(docs: DataFrame, detector: Detector, text_col: str = "text") -> DataFrame:
    """The rows with every span replaced by the name of its kind in brackets; overlapping spans by that of the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [None if t is None else _masked(t, detector.spans(t)) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def _masked(text: str, spans: list[tuple]) -> str:
    out, done = [], 0
    for start, kind, end, *_ in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind]}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def _arrow_spans() -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(SPANS)


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
