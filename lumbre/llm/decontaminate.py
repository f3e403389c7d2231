"""Benchmark decontamination with a distributed positional inverted index.

The training documents are indexed in blocks: a block holds the postings of all terms of some documents, so
every document is in one block and no posting is ever shuffled. Test windows go to every block. There the
postings of a window's terms are intersected from the rarest on, each list shifted by its term's offset. What is
left are the places of the exact phrase. ``proximity`` asks instead that all terms stand near the rarest one.

Nulls: a null text has no words; an item without words has no window; an item with a null id marks words but is
not listed. Repeated rows are indexed and answered one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre.llm.texts import slices, utf8, words
from lumbre.sources.tables import save_scratch

#: Bytes of text in a block of the index.
BLOCK = 2_000_000
#: Bytes of test text that are sent to the tasks at once; a larger set is asked in several turns.
QUERY_BYTES = 32_000_000

_INDEX = T.StructType(
    [
        T.StructField("block", T.StringType()),
        T.StructField("first", T.BinaryType()),
        T.StructField("terms", T.BinaryType()),
        T.StructField("starts", T.BinaryType()),
        T.StructField("postings", T.BinaryType()),
    ]
)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per block: ids, first word number of each document, sorted terms and their postings.

    A posting is the number of a word, counted through the block. ``rows`` has the ids as an array.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType([*_INDEX.fields, T.StructField("rows", T.ArrayType(kind))])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(batches):
            offsets, data = utf8(batch.column(1))
            part = batch.column(2)[0].as_py() if len(batch) else 0
            for i, j in slices(offsets, block):
                hashes, first = words(offsets[i : j + 1], data)
                order = np.argsort(hashes, kind="stable")
                ranked = hashes[order]
                new = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else order
                row = {
                    "block": [f"{part}-{number}-{i}"],
                    "first": [first.astype(np.uint32).tobytes()],
                    "terms": [ranked[new].tobytes()],
                    "starts": [np.append(new, len(ranked)).astype(np.uint32).tobytes()],
                    "postings": [order.astype(np.uint32).tobytes()],
                }
                ids = batch.column(0).slice(i, j - i)
                rows = pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), ids)
                yield pa.RecordBatch.from_arrays([*map(pa.array, row.values()), rows], [*row, "rows"])

    read = docs.select(F.col(id_col), F.col(text_col), F.spark_partition_id().alias("part"))
    return read.mapInArrow(index, schema)


class Windows:
    """Windows of ``n`` consecutive item words (all of a shorter item), each with the items that hold it."""

    def __init__(self, ids: list, texts: pa.Array, n: int):
        found: dict[tuple, set] = {}
        offsets, data = utf8(texts)
        hashes, first = words(offsets, data)
        for k, item in enumerate(ids):
            own = tuple(hashes[first[k] : first[k + 1]].tolist())
            for at in range(max(1, len(own) - n + 1) if own else 0):
                found.setdefault(own[at : at + n], set()).add(item)
        self.items = [sorted(s - {None}) for s in found.values()]
        self.vocabulary = np.unique(np.array([w for key in found for w in key], np.uint64))
        self.keys = [np.searchsorted(self.vocabulary, np.array(key, np.uint64)) for key in found]
        sizes = np.array([len(k) for k in self.keys], np.int64)
        self._by_size = [
            (own, np.stack([self.keys[k] for k in own])) for own in (np.flatnonzero(sizes == n) for n in np.unique(sizes))
        ]

    def possible(self, count: np.ndarray) -> list[int]:
        """The windows all of whose terms have postings."""
        found = [own[(count[keys] > 0).all(1)] for own, keys in self._by_size]
        return np.sort(np.concatenate(found)).tolist() if found else []

    def __len__(self) -> int:
        return len(self.keys)


class _Block:
    """One row of the index, unpacked."""

    def __init__(self, row: dict):
        self.first = np.frombuffer(row["first"], np.uint32).astype(np.int64)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.starts = np.frombuffer(row["starts"], np.uint32).astype(np.int64)
        self.postings = np.frombuffer(row["postings"], np.uint32)

    def lists(self, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the postings of each term of the vocabulary are, and how many there are."""
        if not len(self.terms):
            return np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
        at = np.minimum(np.searchsorted(self.terms, vocabulary), len(self.terms) - 1)
        found = self.terms[at] == vocabulary
        return self.starts[at], np.where(found, self.starts[at + 1] - self.starts[at], 0)

    def document(self, word: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, word, "right") - 1

    def phrases(self, windows: Windows) -> Iterator[tuple[int, np.ndarray]]:
        """Windows with the word numbers at which they begin, ascending."""
        start, count = self.lists(windows.vocabulary)
        for k in windows.possible(count):
            key = windows.keys[k]
            rare = np.argsort(count[key], kind="stable")
            left = self._postings(start, count, key[rare[0]]) - rare[0]
            for offset in rare[1:]:
                shifted = self._postings(start, count, key[offset])
                at = np.searchsorted(shifted, left + offset)
                left = left[shifted[np.minimum(at, len(shifted) - 1)] == left + offset]
                if not len(left):
                    break
            left = left[left >= 0]
            left = left[self.document(left) == self.document(left + len(key) - 1)]
            if len(left):
                yield k, left

    def near(self, windows: Windows, within: int) -> Iterator[tuple[int, np.ndarray]]:
        """Windows with the places of their rarest term that have every other term at most ``within`` words off."""
        start, count = self.lists(windows.vocabulary)
        for k in windows.possible(count):
            terms = np.unique(windows.keys[k])
            terms = terms[np.argsort(count[terms], kind="stable")]
            left = self._postings(start, count, terms[0])
            for term in terms[1:]:
                other = self._postings(start, count, term)
                home = self.document(left)
                low = np.maximum(self.first[home], left - within)
                high = np.minimum(self.first[home + 1] - 1, left + within)
                at = np.searchsorted(other, low)
                left = left[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] <= high)]
                if not len(left):
                    break
            if len(left):
                yield k, left

    def _postings(self, start: np.ndarray, count: np.ndarray, term: int) -> np.ndarray:
        return self.postings[start[term] : start[term] + count[term]].astype(np.int64)


def _turns(items: DataFrame, id_col: str, text_col: str, n: int, limit: int) -> Iterator[Windows]:
    """The test set in parts of about ``limit`` bytes: each is small enough for every task."""
    size = items.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    turns = -(-size // limit) or 1
    for k in range(turns):
        part = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
        if turns > 1:
            part = part.where(F.pmod(F.xxhash64("id", "text"), F.lit(turns)) == k)
        table = part.toArrow()
        yield Windows(table.column("id").to_pylist(), table.column("text"), n)


def _places(index: DataFrame, items: DataFrame, id_col: str, text_col: str, n: int, limit: int, within: int | None):
    """Rows (id, item, position, n_words) of phrase or proximity matches."""
    kind = index.schema["rows"].dataType.elementType
    schema = T.StructType(
        [T.StructField("id", kind), T.StructField("item", T.StringType()), T.StructField("position", T.LongType()),
         T.StructField("n_words", T.IntegerType())]
    )
    out = None
    for windows in _turns(items, id_col, text_col, n, limit):

        def search(batches, windows=windows):
            for batch in batches:
                for row in range(len(batch)):
                    block = _Block({c: batch.column(c)[row].as_py() for c in _INDEX.names[1:]})
                    ids, docs, found, at, size = batch.column("rows")[row].values, [], [], [], []
                    for k, places in block.phrases(windows) if within is None else block.near(windows, within):
                        own = block.document(places)
                        for item in windows.items[k]:
                            docs.append(own)
                            at.append(places - block.first[own])
                            found += [item] * len(own)
                            size += [len(windows.keys[k])] * len(own)
                    docs = np.concatenate(docs) if docs else np.zeros(0, np.int64)
                    at = np.concatenate(at) if at else docs
                    arrays = [ids.take(pa.array(docs)), pa.array(found, pa.string()), pa.array(at, pa.int64()),
                              pa.array(size, pa.int32())]
                    yield pa.RecordBatch.from_arrays(arrays, schema.names)

        part = index.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return out


def phrases(index: DataFrame, items: DataFrame, id_col="item_id", text_col="text", n=10, limit=QUERY_BYTES):
    """Every place (id, item, position, n_words) at which a window of an item stands word by word."""
    return _places(index, items, id_col, text_col, n, limit, None)


def proximity(index, items, id_col="item_id", text_col="text", n=10, within=20, limit=QUERY_BYTES):
    """Places of a window's rarest word that have all its other words at most ``within`` words away, in any order."""
    return _places(index, items, id_col, text_col, n, limit, within)


def contamination(
    index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = 10,
    limit: int = QUERY_BYTES,
) -> DataFrame:
    """One row per indexed document: id, n_words, spans of hit words (merged, end exclusive), items, n_hit."""
    kind = index.schema["rows"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("block", T.StringType()),
            T.StructField("row", T.IntegerType()),
            T.StructField("id", kind),
            T.StructField("n_words", T.LongType()),
            T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )
    out, turns = None, 0
    for windows in _turns(items, id_col, text_col, n, limit):

        def search(batches, windows=windows):
            for batch in batches:
                for row in range(len(batch)):
                    block = _Block({c: batch.column(c)[row].as_py() for c in _INDEX.names[1:]})
                    ids = batch.column("rows")[row].values
                    spans, found = _hits(block, windows, len(ids))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([batch.column("block")[row].as_py()] * len(ids), pa.string()),
                            pa.array(np.arange(len(ids)), pa.int32()),
                            ids,
                            pa.array(np.diff(block.first), pa.int64()),
                            pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                            pa.array(found, pa.list_(pa.string())),
                        ],
                        schema.names,
                    )

        part, turns = index.mapInArrow(search, schema), turns + 1
        out = part if out is None else out.unionByName(part)
    if turns > 1:
        out = out.groupBy("block", "row").agg(
            F.first("id").alias("id"),
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
        out = out.withColumn("spans", F.expr(_MERGE))
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s[1] - s[0])
    return out.select("id", "n_words", "spans", "items", covered.alias("n_hit"))


#: Sorted spans, those that touch made one.
_MERGE = """aggregate(array_sort(spans), cast(array() as array<array<bigint>>), (done, s) ->
  if(size(done) > 0 and element_at(done, -1)[1] >= s[0],
     concat(slice(done, 1, size(done) - 1),
            array(array(element_at(done, -1)[0], greatest(element_at(done, -1)[1], s[1])))),
     concat(done, array(s))))"""


def _hits(block: _Block, windows: Windows, n_docs: int) -> tuple[list, list]:
    """For each document of a block the merged spans of hit words and the sorted items."""
    edge = np.zeros(int(block.first[-1]) + 1, np.int32)
    found: list[set] = [set() for _ in range(n_docs)]
    for k, places in block.phrases(windows):
        np.add.at(edge, places, 1)
        np.add.at(edge, places + len(windows.keys[k]), -1)
        for doc in np.unique(block.document(places)).tolist():
            found[doc].update(windows.items[k])
    hit = np.cumsum(edge[:-1]) > 0
    spans: list[list] = [[] for _ in range(n_docs)]
    for doc in np.unique(block.document(np.flatnonzero(hit))).tolist():
        own = np.concatenate([[False], hit[block.first[doc] : block.first[doc + 1]], [False]])
        change = np.flatnonzero(own[1:] != own[:-1])
        spans[doc] = change.reshape(-1, 2).tolist()
    return spans, [sorted(s) for s in found]


def stored_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``build_index`` written to the shared folder and read from there, to be searched more than once."""
    return save_scratch(build_index(docs, id_col, text_col, block), "postings")
