"""Removal of long repeated strings with run-compressed Burrows-Wheeler indexes.

A string of ``least`` bytes contains one anchor: of its shorter windows the one with the lowest hash. Neighbouring
strings with the same anchor make up a piece of a text, and equal strings always stand in pieces of equal anchors.
Anchors that stand in one place only are dropped. Where all pieces of an anchor are equal, each repeats whole. The
other pieces, one of each kind with the number of its copies, are cut out of the texts and dealt to buckets by their
anchors. A run index over a bucket gives the matching statistics of its pieces; every string whose match reaches
``least`` is marked. An anchor with more pieces than a bucket may hold is resolved string by string instead.

Texts are handled by content: copies of a text have the same marks, and each counts as an occurrence. Null texts are
empty; texts shorter than ``least`` bytes keep all. Hashes of 128 bits stand for anchors with pieces, and 96 for texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbre.llm.runs import merged, repeated_stretches
from lumbre.llm.texts import byte_values, mixed, slices, stretch, sums, utf8
from lumbre.sources.tables import save_scratch

LEAST, ANCHOR = 400, 96
#: Bytes of pieces in a bucket, about, and of one anchor's pieces from which strings are counted instead.
BUCKET, HOT = 500_000, 8_000_000
_SLICE = 500_000


def _doc(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def pieces(offsets: np.ndarray, data: np.ndarray, least: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(key, content, text, begin, size) of all pieces of a slice of texts: hashes of anchor and bytes, and where."""
    base = int(offsets[0])
    data, offsets = data[base : int(offsets[-1])], offsets - base
    none = np.zeros(0, np.int64)
    if len(data) < least:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    running = sums(byte_values(data))
    at = np.arange(len(data) - anchor + 1)
    hashes = stretch(running, at, at + anchor)
    value = (hashes >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
    width = least - anchor + 1
    begin = np.arange(len(data) - least + 1)
    lowest = (_lowest(value, width)[begin] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.searchsorted(offsets, begin, "right") - 1
    whole = begin + least <= offsets[text + 1]
    begin, lowest, text = begin[whole], lowest[whole], text[whole]
    new = np.ones(len(begin), bool)
    new[1:] = (lowest[1:] != lowest[:-1]) | (begin[1:] != begin[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(begin)) - 1
    start, end = begin[first], begin[last] + least
    key = hashes[lowest[first]]
    return key, stretch(running, start, end), text[first], start - offsets[text[first]], end - start


def _lowest(value: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values."""
    blocks = -(-len(value) // width)
    full = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    full[: len(value)] = value
    grid = full.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, 1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].reshape(-1)
    n = len(value) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _found(docs: DataFrame, text_col: str, least: int, anchor: int) -> DataFrame:
    """(doc, n, start, size, key, content) of every piece of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = utf8(batch.column(1))
            docs_ = batch.column(0).to_numpy()
            sizes = np.diff(offsets).astype(np.int32)
            for i, j in slices(offsets, _SLICE):
                key, content, text, start, size = pieces(offsets[i : j + 1], data, least, anchor)
                arrays = [docs_[i:j][text], sizes[i:j][text], start.astype(np.int32), size.astype(np.int32),
                          key.view(np.int64), content.view(np.int64)]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), ["doc", "n", "start", "size", "key", "content"])

    text = docs.select(_doc(F.col(text_col)).alias("doc"), F.col(text_col).alias("text"))
    return text.mapInArrow(run, "doc long, n int, start int, size int, key long, content long")


def _packed(docs: DataFrame, text_col: str) -> DataFrame:
    """(doc, n, packed): the texts compressed for the shuffle, copies within a task left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, seen = pa.Codec("zstd"), set()
        for batch in batches:
            offsets, data = utf8(batch.column(1))
            own = [k for k, d in enumerate(batch.column(0).to_pylist()) if d not in seen and not seen.add(d)]
            packed = [codec.compress(data[offsets[k] : offsets[k + 1]].tobytes(), asbytes=True) for k in own]
            sizes = np.diff(offsets).astype(np.int32)[own]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(own, pa.int64())), pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())],
                ["doc", "n", "packed"],
            )

    text = docs.select(_doc(F.col(text_col)).alias("doc"), F.col(text_col).alias("text"))
    return text.mapInArrow(run, "doc long, n int, packed binary")


def _cut(kinds: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, content, times, hot, bytes): one of each kind of pieces, cut out of a text that has it."""
    asked = kinds.groupBy("doc", "n").agg(F.collect_list(F.struct("start", "size", "key", "content", "times", "hot")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            n, packed, asked_ = batch.column("n").to_pylist(), batch.column("packed"), batch.column("asked")
            for k in range(len(batch)):
                text = codec.decompress(packed[k].as_py(), n[k], asbytes=True) if n[k] else b""
                rows = pa.RecordBatch.from_struct_array(asked_[k].values)
                cuts = zip(rows.column("start").to_pylist(), rows.column("size").to_pylist(), strict=True)
                body = pa.array([text[a : a + b] for a, b in cuts], pa.binary())
                arrays = [rows.column(c) for c in ("key", "content", "times", "hot")]
                yield pa.RecordBatch.from_arrays([*arrays, body], ["key", "content", "times", "hot", "body"])

    joined = texts.join(asked, ["doc", "n"]).select("n", "packed", "asked")
    return joined.mapInArrow(run, "key long, content long, times long, hot boolean, body binary")


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one bucket, which come one after another."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        bucket = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(batch)] if len(batch) else [0]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            if held and now != bucket[begin]:
                yield pa.Table.from_batches(held)
                held = []
            now = bucket[begin]
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


_MATCHED = "key long, content long, spans array<int>"


def _matched(cut: DataFrame, least: int, total: int) -> DataFrame:
    """(key, content, spans): what of each piece repeats, as begin, end, begin, end and so on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_bucket(batches):
            key, content, times = (table.column(c).to_numpy() for c in ("key", "content", "times"))
            names = np.stack([key, content], 1)
            _, once = np.unique(names, axis=0, return_index=True)  # a text may have come from several tasks
            bodies = table.column("body").take(pa.array(once)).combine_chunks()
            offsets, data = utf8(bodies)
            spans = repeated_stretches(data[offsets[0] : offsets[-1]], np.diff(offsets), least)
            for k, (size, several) in enumerate(zip(np.diff(offsets).tolist(), (times[once] > 1).tolist(), strict=True)):
                if several:
                    spans[k] = np.array([[0, size]])
            lists = pa.array([s.reshape(-1).astype(np.int32) for s in spans], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(key[once]), pa.array(content[once]), lists], ["key", "content", "spans"])

    buckets = max(1, -(-total // BUCKET))
    dealt = cut.withColumn("bucket", F.pmod("key", F.lit(buckets)))
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket").select("bucket", "key", "content", "times", "body")
    return dealt.mapInArrow(run, _MATCHED)


def _counted(cut: DataFrame, least: int) -> DataFrame:
    """The same for pieces of anchors with too many kinds: every string of ``least`` bytes is counted by its hash."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                body = np.frombuffer(batch.column("body")[k].as_py(), np.uint8)
                at = np.arange(len(body) - least + 1)
                one = stretch(sums(byte_values(body)), at, at + least)
                two = stretch(sums(mixed(byte_values(body))), at, at + least)
                same = [pa.array(np.full(len(at), batch.column(c)[k].as_py(), np.int64)) for c in ("key", "content", "times")]
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(at.astype(np.int32)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))],
                    ["key", "content", "times", "at", "one", "two"],
                )

    rows = cut.dropDuplicates(["key", "content"]).select("key", "content", "times", "body")
    rows = rows.mapInArrow(strings, "key long, content long, times long, at int, one long, two long")
    twice = rows.groupBy("one", "two").agg(F.sum("times").alias("t")).where("t > 1").select("one", "two")
    hits = rows.join(twice, ["one", "two"]).groupBy("key", "content").agg(F.sort_array(F.collect_list("at")).alias("at"))
    pairs = F.flatten(F.transform("at", lambda a: F.array(a, a + least)))
    return hits.select("key", "content", pairs.alias("spans"))


def marks(docs: DataFrame, text_col: str = "text", least: int = LEAST, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """(doc, n, spans) of every text that repeats something: hash, bytes, and stretches that may touch or overlap."""
    found = save_scratch(_found(docs, text_col, least, anchor), "pieces")
    keys = found.groupBy("key").agg(F.count(F.lit(1)).alias("total"), F.min("content").alias("a"), F.max("content").alias("b"))
    keys = keys.where("total > 1").select("key", F.expr("a <> b").alias("various"))
    keys = save_scratch(keys, "keys")  # so that the join below may split the rows of one anchor
    shared = save_scratch(found.join(keys, "key"), "shared")
    kinds = shared.where("various").groupBy("key", "content").agg(
        F.count(F.lit(1)).alias("times"), *(F.first(c).alias(c) for c in ("doc", "n", "start", "size"))
    )
    kinds = save_scratch(kinds, "kinds")
    sizes = kinds.groupBy("key").agg(F.sum("size").alias("bytes"))
    many = save_scratch(sizes.where(F.col("bytes") > hot).select("key", F.lit(True).alias("many")), "many")
    asked = kinds.join(many, "key", "left").withColumn("hot", F.coalesce("many", F.lit(False)))
    cut = save_scratch(_cut(asked, _packed(docs, text_col)), "cut")
    total = kinds.agg(F.sum("size")).first()[0] or 0
    matched = _matched(cut.where("not hot"), least, total)
    if not many.isEmpty():
        matched = matched.unionByName(_counted(cut.where("hot"), least))
    matched = save_scratch(matched, "matched")
    places = shared.select("doc", "n", "start", "size", "key", "content", "various").distinct()
    spans = places.join(matched, ["key", "content"], "left").select(
        "doc", "n", F.expr("transform(if(various, spans, array(0, size)), x -> x + start)").alias("spans")
    )
    return spans.where("size(spans) > 0").groupBy("doc", "n").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def per_text(docs: DataFrame, text_col: str = "text", least: int = LEAST, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """(doc, n, spans, n_removed, kept) of every distinct text: the maximal stretches to remove, and the bytes left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        names = ["doc", "n", "spans", "n_removed", "kept"]
        for batch in batches:
            sizes, packed, marked = batch.column("n").to_pylist(), batch.column("packed"), batch.column("spans")
            spans, removed, kept = [], [], []
            for k, n in enumerate(sizes):
                text = codec.decompress(packed[k].as_py(), n, asbytes=True) if n else b""
                own = np.zeros((0, 2), np.int64)
                if marked[k].is_valid:
                    pairs = marked[k].values.to_numpy().astype(np.int64).reshape(-1, 2)
                    own = merged(pairs[:, 0], pairs[:, 1])
                edges = [0, *own.reshape(-1).tolist(), n]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                spans.append(own.tolist())
                removed.append(int((own[:, 1] - own[:, 0]).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("n"), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                 pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], names,
            )

    joined = _packed(docs, text_col).join(marks(docs, text_col, least, anchor, hot), ["doc", "n"], "left")
    schema = "doc long, n int, spans array<array<long>>, n_removed long, kept binary"
    return joined.select("doc", "n", "packed", "spans").mapInArrow(run, schema)


def for_rows(docs: DataFrame, texts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``per_text`` (or what was made of them) for every row, with its id as ``id``."""
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).alias("n")
    rows = docs.select(F.col(id_col).alias("id"), _doc(F.col(text_col)).alias("doc"), size)
    return rows.join(texts.dropDuplicates(["doc", "n"]), ["doc", "n"]).drop("doc")
