"""N-gram Jaccard join with Bayesian candidate pruning.

Documents with the same words in the same order are one class, and only one text of a class is compared. Bands of
MinHash values put classes into buckets; classes that share buckets, directly or in a chain, make a candidate group.
In a group the MinHash values of pairs are compared a few at a time. From the matches so far follows the posterior
probability that the similarity reaches the threshold; pairs for which it falls below a tolerance are dropped. The
rest is verified on the shingle sets themselves.

A group is compared in cells of bounded size, so no task holds a large group; pairs are counted where they are
compared and never become rows. Copies are counted through the sizes of their classes.

A text with fewer words than a shingle is one shingle; one without words is a shingle of its characters, so null and
empty texts are copies of each other. Repeated rows are copies like any others. At a similarity of exactly 0.8 the
bands miss a pair with a chance of 3e-6, and each pruning step with one of 1e-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbre.llm.components import components
from lumbre.llm.texts import mixed, slices, utf8, words
from lumbre.sources.tables import save_scratch

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
#: MinHash values compared in one step, and the posterior below which a pair is dropped.
STEP, TOLERANCE = 16, 1e-8
#: Shingles (and a constant for each text) that one side of a cell holds, about.
CELL, PER_TEXT = 1_500_000, 200
_A, _B = (mixed(np.arange(k, HASHES + k, dtype=np.uint64)).astype(np.uint32) for k in (1, 1001))
_A |= np.uint32(1)
_WORD_POWERS = [pow(0xD6E8FEB86659FD93, k, 1 << 64) for k in range(64)]


def shingles(offsets: np.ndarray, data: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Hashes of the shingles of a slice of texts in order (repeats stay), where each text's begin, and a digest of
    each text's words."""
    hashes, first = words(offsets, data)
    count = np.diff(first)
    size = np.where(count >= n, count - n + 1, 1)
    start = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(int(start[-1]), np.uint64)
    full = np.flatnonzero(count >= n)
    if len(full):
        at = np.repeat(first[:-1][full] - (np.cumsum(size[full]) - size[full]), size[full]) + np.arange(size[full].sum())
        total = np.zeros(len(at), np.uint64)
        for k in range(n):
            total += hashes[at + k] * np.uint64(_WORD_POWERS[n - k])
        to = np.repeat(start[:-1][full] - (np.cumsum(size[full]) - size[full]), size[full]) + np.arange(len(at))
        out[to] = mixed(total)
    digests = []
    for k in range(len(count)):
        own = hashes[first[k] : first[k + 1]].tobytes() or b"-" + data[offsets[k] : offsets[k + 1]].tobytes()
        digest = hashlib.md5(own).digest()
        digests.append(digest)
        if count[k] < n:
            out[start[k]] = np.frombuffer(digest, np.uint64)[0]
    return out, start, digests


def signatures(hashes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """MinHash values (texts, HASHES) of texts whose shingles begin at ``start``."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(start) - 1, HASHES), np.uint32)
    for k in range(HASHES):
        drawn = (short ^ _B[k]) * _A[k]
        drawn ^= drawn >> np.uint32(16)
        out[:, k] = np.minimum.reduceat(drawn, start[:-1])
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band and text."""
    out = np.zeros((len(signature), BANDS), np.uint64)
    for k in range(ROWS):
        out = mixed(out ^ (signature[:, k::ROWS].astype(np.uint64) + np.uint64(k << 40)))
    return out


@lru_cache
def least_matches(threshold: float, tolerance: float) -> np.ndarray:
    """For each number of compared values the matches a pair needs to stay: with a uniform prior the posterior that
    the similarity reaches the threshold is the chance of at most so many successes in one trial more."""
    out = np.zeros(HASHES + 1, np.int64)
    for n in range(1, HASHES + 1):
        posterior, m = 0.0, -1
        while posterior < tolerance and m < n:
            m += 1
            posterior += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def _signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, tie, h1, h2, n_shingles, bands) of every row; h1 and h2 name the class."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = utf8(batch.column(3))
            for i, j in slices(offsets):
                hashes, start, digests = shingles(offsets[i : j + 1], data)
                names = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                keys = band_keys(signatures(hashes, start)).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(i, j - i) for c in batch.columns[:3]), pa.array(names[:, 0].copy()), pa.array(names[:, 1].copy()),
                     pa.array(np.diff(start)), lists],
                    ["row", "id", "tie", "h1", "h2", "n_shingles", "bands"],
                )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text")
    )
    return rows.mapInArrow(run, f"row long, id {kind}, tie long, h1 long, h2 long, n_shingles long, bands array<long>")


def _candidate_groups(classes: DataFrame) -> DataFrame:
    """(class, grp) of all classes that share a bucket with another one, directly or in a chain."""
    keys = classes.select("class", F.posexplode("bands").alias("band", "key"))
    buckets = keys.groupBy("band", "key").agg(F.min("class").alias("hub"), F.max("class").alias("other"))
    shared = buckets.where("hub <> other").select("band", "key", "hub")
    edges = keys.join(shared, ["band", "key"]).select(F.col("class").alias("u"), F.col("hub").alias("v"))
    return components(edges).select(F.col("node").alias("class"), F.col("component").alias("grp"))


def _cells(members: DataFrame) -> DataFrame:
    """Each class of a group with the cells it takes part in: (grp, cell, left, right). A group of more than one
    cell's size is cut into blocks, and every two blocks share a cell."""
    weight = F.sum(F.col("n_shingles") + PER_TEXT)
    blocks = members.groupBy("grp").agg(F.ceil(weight / CELL).cast("int").alias("blocks"))
    blocks = save_scratch(blocks, "blocks")  # so that the join may split the rows of one group
    placed = members.join(blocks, "grp").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select(
        "class", "n_docs", "id", "tie", "grp", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block"
    )


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows with the same (grp, one, two), which come one after another."""
    open_: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not len(batch):
            continue
        cell = np.stack([batch.column(k).to_numpy() for k in range(3)], 1)
        cuts = [0, *(np.flatnonzero((cell[1:] != cell[:-1]).any(1)) + 1).tolist(), len(batch)]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            if key is not None and key != tuple(cell[begin]):
                yield pa.Table.from_batches(open_)
                open_ = []
            key = tuple(cell[begin])
            open_.append(batch.slice(begin, end - begin))
    if open_:
        yield pa.Table.from_batches(open_)


class _Cell:
    """The texts of one cell: sets of shingles as numbers within the cell, and MinHash values."""

    def __init__(self, table: pa.Table):
        offsets, data = utf8(table.column("text"))
        parts, marks, digests = [], [], []
        for i, j in slices(offsets):
            hashes, start, own = shingles(offsets[i : j + 1], data)
            parts.append((hashes, start))
            marks.append(signatures(hashes, start))
            digests += own
        self.signature = np.concatenate(marks)
        hashes = np.concatenate([h for h, _ in parts])
        count = np.concatenate([np.diff(s) for _, s in parts])
        owner = np.repeat(np.arange(len(count)), count)
        _, number = np.unique(hashes, return_inverse=True)
        pair = np.unique(owner.astype(np.int64) * (int(number.max()) + 1) + number)
        owner, self.flat = np.divmod(pair, int(number.max()) + 1)
        self.start = np.searchsorted(owner, np.arange(len(count) + 1))
        self.size = np.diff(self.start)
        self.flag = np.zeros(int(number.max()) + 1, bool)

    def linked(self, row: int, others: np.ndarray, threshold: float, tolerance: float) -> np.ndarray:
        """Those of ``others`` whose similarity to ``row`` reaches the threshold."""
        need = least_matches(threshold, tolerance)
        low, high = threshold * self.size[row], self.size[row] / threshold
        left = others[(self.size[others] >= low - 1e-9) & (self.size[others] <= high + 1e-9)]
        matches = np.zeros(len(left), np.int64)
        for begin in range(0, HASHES, STEP):
            if not len(left):
                return left
            own = slice(begin, begin + STEP)
            matches += (self.signature[left, own] == self.signature[row, own]).sum(1)
            stay = matches >= need[begin + STEP]
            left, matches = left[stay], matches[stay]
        if not len(left):
            return left
        mine = self.flat[self.start[row] : self.start[row + 1]]
        self.flag[mine] = True
        size = self.size[left]
        at = np.repeat(self.start[left] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        common = np.add.reduceat(self.flag[self.flat[at]].astype(np.int64), np.cumsum(size) - size)
        self.flag[mine] = False
        return left[common >= threshold * (size + self.size[row] - common) - 1e-9]


def _find(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = int(parent[x])
    return x


def _compared(cells: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(class, root, links) for each class of each cell: documents of other classes linked to it there, and the
    lowest class that links lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_cell(batches):
            cell = _Cell(table)
            classes, n_docs, block = (table.column(c).to_numpy() for c in ("class", "n_docs", "block"))
            n = len(classes)
            links, parent = np.zeros(n, np.int64), np.arange(n)
            across = table.column("one")[0].as_py() != table.column("two")[0].as_py()
            for row in range(n):
                others = np.arange(row + 1, n)
                if across:
                    others = others[block[others] != block[row]]
                found = cell.linked(row, others, threshold, tolerance)
                links[row] += n_docs[found].sum()
                links[found] += n_docs[row]
                for other in found.tolist():
                    a, b = _find(parent, row), _find(parent, other)
                    if a != b:
                        parent[a if classes[a] > classes[b] else b] = b if classes[a] > classes[b] else a
            roots = classes[[_find(parent, k) for k in range(n)]]
            yield pa.RecordBatch.from_arrays([pa.array(classes), pa.array(roots), pa.array(links)], ["class", "root", "links"])

    ordered = cells.repartition("grp", "one", "two").sortWithinPartitions("grp", "one", "two", "class")
    ordered = ordered.select("grp", "one", "two", "class", "n_docs", "block", "text")
    return ordered.mapInArrow(run, "class long, root long, links long")


def _labelled(
    docs: DataFrame, id_col: str, text_col: str, threshold: float, tolerance: float
) -> DataFrame:
    """(id, tie, grp, n_links) of every row: the rows of one ``grp`` are linked, directly or in a chain."""
    signed = save_scratch(_signed(docs, id_col, text_col), "signed")
    named = signed.groupBy("h1", "h2").agg(F.min("row").alias("class"), F.count(F.lit(1)).alias("n_docs"))
    named = save_scratch(named, "classes")  # so that the join may split the copies of one text
    members = save_scratch(
        signed.select("row", "id", "tie", "h1", "h2").join(named, ["h1", "h2"]).drop("h1", "h2"), "members"
    )
    sizes = members.where("row = class").select("class", "n_docs", "id", "tie")
    heads = signed.select(F.col("row").alias("class"), "n_shingles", "bands").join(sizes, "class")
    groups = save_scratch(_candidate_groups(heads), "groups")
    cells = _cells(heads.drop("bands").join(groups, "class"))
    texts = docs.select(F.col(id_col).alias("id_"), F.xxhash64(text_col).alias("tie_"), F.col(text_col).alias("text"))
    same = F.col("id").eqNullSafe(F.col("id_")) & (F.col("tie") == F.col("tie_"))
    one_text = cells.select("id", "tie").distinct().join(texts, same).dropDuplicates(["id", "tie"]).select("id", "tie", "text")
    again = F.col("id").eqNullSafe(F.col("id_")) & (F.col("tie") == F.col("tie_"))
    cells = cells.join(one_text.withColumnsRenamed({"id": "id_", "tie": "tie_"}), again)
    compared = save_scratch(_compared(cells, threshold, tolerance), "compared")
    links = compared.groupBy("class").agg(F.sum("links").alias("links"))
    linked = components(compared.where("class <> root").select(F.col("class").alias("u"), F.col("root").alias("v")))
    found = save_scratch(links.join(linked.withColumnRenamed("node", "class"), "class", "left"), "found")  # so that the join may split a class
    out = members.join(found, "class", "left")
    return out.select(
        "row", "id", "tie",
        F.coalesce("component", "class").alias("grp"),
        (F.col("n_docs") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )


def jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE
) -> DataFrame:
    """(id, class_id, n_links) of every row: rows linked directly or in a chain have one class, named by its lowest
    id; ``n_links`` counts the other rows whose similarity reaches the threshold."""
    rows = save_scratch(_labelled(docs, id_col, text_col, threshold, tolerance), "labelled")
    names = save_scratch(rows.groupBy("grp").agg(F.min("id").alias("class_id")), "names")
    return rows.join(names, "grp").select("id", "class_id", "n_links")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE
) -> DataFrame:
    """The rows of ``docs`` with one row left of each class: the one with the lowest id, nulls last."""
    rows = save_scratch(_labelled(docs, id_col, text_col, threshold, tolerance), "labelled")
    best = rows.groupBy("grp").agg(F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "tie")).alias("best"))
    chosen = best.select(F.col("best.id").alias("__id"), F.col("best.tie").alias("__tie"))
    tied = docs.withColumn("__own", F.xxhash64(text_col))
    kept = tied.join(chosen, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__tie")), "left_semi")
    return kept.dropDuplicates([id_col, "__own"]).drop("__own")
