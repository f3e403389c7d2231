"""I-Match fingerprints over a band of document frequencies, with many random lexicon subsets.

The lexicon holds the terms that stand in a share of documents between two bounds; rare terms and very common ones
say little. Of a document the distinct lexicon terms are kept, in sorted order. A random subset of the lexicon takes
part of them, and their hash is one digit pair of the fingerprint; a pair is equal in two documents only if the
subset finds the same terms in both. Subsets come in families of levels, each half the size of the one before, and
a fingerprint holds the levels at which a document of its number of terms has about one term left. ``likeness`` is
the share of equal pairs.

Shares are taken over rows and over different texts, and a term is in the lexicon if either lies between the bounds:
copies of one text, however many, do not push its terms out. As the lower bound is a share of all documents, the
lexicon has at most twice (mean distinct terms) / (lower bound) terms however many documents there are, so it can be
sent to every task.

A null text is empty. A text with few lexicon terms among its own has its subsets drawn from all its terms, and one
without words has "-" as fingerprint. Rows of one id follow each other in the order of a hash of their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre.llm.texts import mixed, slices, utf8, words

#: Share of documents a lexicon term stands in, at least and at most.
BAND = (0.001, 0.2)
#: Share of its terms that a text has in the lexicon at least, or all its terms are used.
ENOUGH = 0.2
#: Slots in which hashes of texts with copies are marked; a power of two. The driver holds at most so many numbers.
SLOTS = 1 << 22
FAMILIES, LEVELS = 64, 3
#: Terms that a task holds before it hands their counts on.
HELD = 1_000_000
_SEEDS = mixed(np.arange(1, FAMILIES + 1, dtype=np.uint64) << np.uint64(20))


def _distinct(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct terms of each text, and the text of each."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, owner))
    terms, owner = hashes[order], owner[order]
    new = np.ones(len(terms), bool)
    new[1:] = (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])
    return terms[new], owner[new]


def _named(docs: DataFrame, text_col: str) -> DataFrame:
    """(h1, h2, text): 128 bits that tell texts apart, null as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), text.alias("text"))


def _slots(hashes: pa.Array) -> np.ndarray:
    return hashes.to_numpy().view(np.uint64) & np.uint64(SLOTS - 1)


def _sizes(docs: DataFrame, text_col: str) -> tuple[int, int, np.ndarray]:
    """Rows, different texts, and by slot whether a text with copies may be in it."""
    each = _named(docs, text_col).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    rows, texts = each.agg(F.sum("n"), F.count("n")).first()
    slot = F.col("h1").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot")
    marked = np.zeros(SLOTS, bool)
    marked[each.where("n > 1").select(slot).distinct().toArrow().column("slot").to_numpy()] = True
    return rows or 0, texts, marked


def _once(named: DataFrame, marked: np.ndarray) -> DataFrame:
    """The texts in marked slots, one row each. A task sends a text once, so copies hardly move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            batch = batch.filter(pa.array(marked[_slots(batch.column(0))]))
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            new = []
            for key in keys:
                new.append(key not in seen)
                seen.add(key)
            if any(new):
                yield batch.filter(pa.array(new))
            if len(seen) > HELD:
                seen.clear()

    return named.mapInArrow(run, named.schema).dropDuplicates(["h1", "h2"])


def document_frequencies(docs: DataFrame, marked: np.ndarray, text_col: str = "text") -> DataFrame:
    """(term, documents, texts): in how many rows and how many different texts a term stands; terms are 64-bit hashes."""

    def summed(found: list[np.ndarray], times: list[np.ndarray]) -> pa.RecordBatch:
        terms, place = np.unique(np.concatenate(found), return_inverse=True)
        times = np.concatenate(times, axis=1)
        counts = [pa.array(np.bincount(place, t, len(terms)).astype(np.int64)) for t in times]
        return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), *counts], ["term", "n", "m"])

    def counter(once: bool):
        """Of rows, each counts, and as a text where its slot is not marked; ``once``, as a text only."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: list[np.ndarray] = []
            times: list[np.ndarray] = []
            for batch in batches:
                offsets, data = utf8(batch.column(2))
                single = np.ones(len(batch), bool) if once else ~marked[_slots(batch.column(0))]
                for i, j in slices(offsets):
                    terms, owner = _distinct(*words(offsets[i : j + 1], data))
                    terms, place = np.unique(terms, return_inverse=True)
                    rows = np.bincount(place, minlength=len(terms))
                    texts = np.bincount(place, single[i:j][owner], len(terms))
                    found.append(terms)
                    times.append(np.stack([0 * rows if once else rows, texts]))
                if sum(map(len, found)) > HELD:
                    yield summed(found, times)
                    found, times = [], []
            if found:
                yield summed(found, times)

        return run

    named = _named(docs, text_col)
    schema = "term long, n long, m long"
    counted = named.mapInArrow(counter(False), schema).union(_once(named, marked).mapInArrow(counter(True), schema))
    return counted.groupBy("term").agg(F.sum("n").alias("documents"), F.sum("m").alias("texts"))


def lexicon(docs: DataFrame, text_col: str = "text", band: tuple[float, float] = BAND) -> np.ndarray:
    """Sorted hashes of the terms whose share of the rows, or of the different texts, is in the band."""
    rows, texts, marked = _sizes(docs, text_col)
    inside = F.col("documents").between(F.lit(band[0] * rows), F.lit(band[1] * rows))
    inside |= F.col("texts").between(F.lit(band[0] * texts), F.lit(band[1] * texts))
    terms = document_frequencies(docs, marked, text_col).where(inside).select("term").toArrow()
    return np.sort(terms.column("term").to_numpy().view(np.uint64))


def fingerprints(column: pa.Array, known: np.ndarray) -> list[str]:
    """The fingerprint of each text: ``level:digits``, two digits per subset."""
    offsets, data = utf8(column)
    out: list[str] = []
    for i, j in slices(offsets):
        hashes, first = words(offsets[i : j + 1], data)
        terms, owner = _distinct(hashes, first)
        if len(known):
            inside = known[np.minimum(np.searchsorted(known, terms), len(known) - 1)] == terms
            kept, place = terms[inside], owner[inside]
        else:
            kept, place = terms[:0], owner[:0]
        edge = np.searchsorted(place, np.arange(j - i + 1))
        begin = np.searchsorted(owner, np.arange(j - i + 1))
        for k in range(j - i):
            own, full = kept[edge[k] : edge[k + 1]], terms[begin[k] : begin[k + 1]]
            own = own if len(own) >= ENOUGH * len(full) else full
            out.append(_digits(own) if len(own) else "-")
    return out


def _digits(terms: np.ndarray) -> str:
    """Digits at ``LEVELS`` levels around the one at which a subset has one or two of the terms."""
    lowest = max(0, len(terms).bit_length() - 2)
    drawn = mixed(terms[:, None] ^ _SEEDS)
    rows = []
    for level in range(lowest, lowest + LEVELS):
        chosen = drawn & np.uint64((1 << level) - 1) == 0
        total = mixed(np.where(chosen, drawn, np.uint64(0)).sum(0, dtype=np.uint64)) % np.uint64(255) + np.uint64(1)
        rows.append(np.where(chosen.any(0), total, np.uint64(0)))
    return f"{lowest}:{np.concatenate(rows).astype(np.uint8).tobytes().hex()}"


def likeness(one: str, two: str) -> float:
    """Share of equal digit pairs among those where either document has a term, over the levels both have."""
    if one == two:
        return 1.0
    if ":" not in one or ":" not in two:
        return 0.0
    (low, a), (other, b) = (x.split(":") for x in (one, two))
    low, other = int(low), int(other)
    first, last = max(low, other), min(low, other) + LEVELS
    if first >= last:
        return 0.0
    a = np.frombuffer(bytes.fromhex(a), np.uint8).reshape(LEVELS, -1)[first - low : last - low]
    b = np.frombuffer(bytes.fromhex(b), np.uint8).reshape(LEVELS, -1)[first - other : last - other]
    either = ((a > 0) | (b > 0)).sum()
    return float(((a == b) & (a > 0)).sum() / either) if either else 0.0


def fingerprinted(docs: DataFrame, known: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array(fingerprints(batch.column(1), known), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def _in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(part, last, id, text): rows in ranges of ids, and in each range, last of all, the first row of the next one.

    Only ids are looked at to lay out the ranges, and the driver holds two of them per range.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    shares = [k / parts for k in range(1, parts)] or [0.5]
    bounds = named.agg(F.percentile_approx("id", shares, 100 * parts)).first()[0] or []
    bounds = np.unique(np.array(bounds, np.int64))

    def part_of(ids: pa.Array) -> np.ndarray:
        """Null ids come first of all."""
        own = np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False), "right")
        return np.where(ids.is_null().to_numpy(zero_copy_only=False), 0, own).astype(np.int32)

    def only_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(part_of(batch.column(0))), *batch.columns], ["part", "id", "tie"])

    tie = F.xxhash64("text")
    firsts = named.select("id", tie.alias("tie")).mapInArrow(only_parts, "part int, id long, tie long")
    firsts = firsts.groupBy("part").agg(F.min(F.struct(F.col("id").isNotNull().alias("known"), "id", "tie")).alias("first"))
    heads = sorted((r["part"], r["first"]["id"], r["first"]["tie"]) for r in firsts.collect())
    goes_to = {(i, t): heads[k - 1][0] for k, (_, i, t) in enumerate(heads)}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "last", "id", "tie", "text"]
        for batch in batches:
            part = part_of(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.zeros(len(part), bool)), *batch.columns], names)
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            at = [(k, goes_to[key]) for k, key in enumerate(keys) if key in goes_to]
            if at:
                extra = batch.take(pa.array([k for k, _ in at]))
                to = pa.array([p for _, p in at], pa.int32())
                yield pa.RecordBatch.from_arrays([to, pa.array(np.ones(len(at), bool)), *extra.columns], names)

    rows = named.select("id", tie.alias("tie"), "text").mapInArrow(
        dealt, "part int, last boolean, id long, tie long, text string"
    )
    return rows.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("part", "last", "id", "tie")


def edited(own: str, following: str) -> str:
    """The last half of a text replaced by the beginning of the following one."""
    half = len(own) // 2
    return own[: len(own) - half] + following[:half]


COMPARED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def compared(docs: DataFrame, known: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's fingerprint, and how like it is to that of its edited text and of the next document.

    The next document is the one with the next higher id, after the last the first. Texts are shuffled once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the row whose next one has not been seen: part, id, text, fingerprint
        for batch in batches:
            offsets = utf8(batch.column(4))[0]
            for i, j in slices(offsets):
                piece = batch.slice(i, j - i)
                prints = fingerprints(piece.column(4), known)
                parts, lasts, ids = (piece.column(k).to_pylist() for k in (0, 1, 2))
                pairs = []
                texts = ["" if t is None else t for t in piece.column(4).to_pylist()]
                for part, last, key, text, print_ in zip(parts, lasts, ids, texts, prints, strict=True):
                    if waiting is not None and waiting[0] == part:
                        pairs.append((*waiting[1:], text, print_))
                        waiting = None
                    if not last:
                        waiting = (part, key, text, print_)
                if pairs:
                    yield _compare(pairs, known)

    return _in_order(docs, id_col, text_col).mapInArrow(run, COMPARED)


def _compare(pairs: list[tuple], known: np.ndarray) -> pa.RecordBatch:
    """Result rows for (id, text, fingerprint, next text, next fingerprint)."""
    texts = [edited(text, following) for _, text, _, following, _ in pairs]
    prints = fingerprints(pa.array(texts, pa.string()), known)
    columns = [
        [p[0] for p in pairs],
        [len(p[1]) for p in pairs],
        [hashlib.sha256(t.encode()).hexdigest() for t in texts],
        [p[2] for p in pairs],
        prints,
        [likeness(p[2], e) for p, e in zip(pairs, prints, strict=True)],
        [likeness(p[2], p[4]) for p in pairs],
    ]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], COMPARED.names)
