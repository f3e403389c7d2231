"""Length-delimited binary records of token ids, with an offset index beside each file.

A record is ``length (u64) | masked CRC-32C of the length (u32) | sequence | masked CRC-32C of the sequence (u32)``,
little-endian: the framing of common record readers. A sequence is ``flags (u8) | key (i64) | ids``; bit 0 of the
flags: the key is null, bit 1: ids have 4 bytes, else 2. The index of a file is an array of (byte offset, number of
ids before) as u64, one pair per record and one for the end, so that any record can be read alone.

Files are written by the tasks under names of their own, and only those of tasks that succeeded come into the
manifest; a task that runs twice leaves an unused file behind. The folder must be one that all executors reach.

Null texts are empty sequences, which hold the end id alone. Rows with one key stand next to each other. An empty
table has an empty manifest. Other columns of the input are not written.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre.llm.crc32c import crc32c, masked
from lumbre.llm.texts import slices, utf8
from lumbre.sources.tables import save_scratch

MANIFEST = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("path", T.StringType()),
        T.StructField("n_records", T.LongType()),
        T.StructField("n_ids", T.LongType()),
    ]
)
_HEAD, _FRAME, _TAIL = 9, 12, 4
#: Records that one reading task takes from a file, and bytes it holds at once.
RECORDS_PER_READ, BYTES_PER_READ = 20_000, 8_000_000
#: Tasks that read, at most; each takes its ranges one by one.
READ_TASKS = 20_000


class BadRecord(ValueError):
    """A length or checksum does not fit."""


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def frame(keys: list, ids: list[np.ndarray], wide: bool) -> tuple[bytes, np.ndarray]:
    """Framed records of the sequences, and the byte offset of each (one more for the end).

    Without ``wide`` an id takes two bytes; one that does not fit is an error.
    """
    unit = 4 if wide else 2
    if not wide and any(len(x) and x.max() > 0xFFFF for x in ids):
        raise ValueError("an id does not fit in two bytes; write with wide=True")
    sizes = np.array([_HEAD + unit * len(x) for x in ids], np.int64)
    ends = np.cumsum(sizes + _FRAME + _TAIL)
    starts = ends - sizes - _TAIL
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    lengths = sizes.astype("<u8").view(np.uint8).reshape(-1, 8)
    length_crc = masked(crc32c(lengths.reshape(-1), np.arange(len(ids)) * 8, np.arange(1, len(ids) + 1) * 8))
    for k, (key, own, start) in enumerate(zip(keys, ids, starts.tolist(), strict=True)):
        out[start - _FRAME : start - 4] = lengths[k]
        out[start] = (key is None) | (wide << 1)
        out[start + 1 : start + _HEAD] = np.frombuffer((key or 0).to_bytes(8, "little", signed=True), np.uint8)
        out[start + _HEAD : start + _HEAD + unit * len(own)] = own.astype("<u4" if wide else "<u2").view(np.uint8)
    _put(out, starts - 4, length_crc)
    _put(out, starts + sizes, masked(crc32c(out, starts, starts + sizes)))
    return out.tobytes(), np.concatenate([[0], ends])


def _put(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    out[at[:, None] + np.arange(4)] = values.astype("<u4").view(np.uint8).reshape(-1, 4)


def unframe(data: bytes, offsets: np.ndarray) -> tuple[list, list[np.ndarray]]:
    """Keys and ids of the records between the offsets; raises BadRecord where a length or checksum is wrong."""
    raw = np.frombuffer(data, np.uint8)
    begins, ends = offsets[:-1], offsets[1:]
    starts, stops = begins + _FRAME, ends - _TAIL
    told = raw[begins[:, None] + np.arange(8)].copy().view("<u8").reshape(-1)
    sums = [(begins, begins + 8, begins + 8), (starts, stops, stops)]
    if (told.astype(np.int64) != stops - starts).any():
        raise BadRecord("a length is wrong")
    for first, last, at in sums:
        if (raw[at[:, None] + np.arange(4)].copy().view("<u4").reshape(-1) != masked(crc32c(raw, first, last))).any():
            raise BadRecord("a checksum is wrong")
    keys, ids = [], []
    for start, stop in zip(starts.tolist(), stops.tolist(), strict=True):
        flags = raw[start]
        keys.append(None if flags & 1 else int.from_bytes(data[start + 1 : start + _HEAD], "little", signed=True))
        ids.append(np.frombuffer(data[start + _HEAD : stop], "<u4" if flags & 2 else "<u2"))
    return keys, ids


def write(
    df: DataFrame, folder: str, tokenizer: Callable[[], Callable[[pa.Array], Iterator[np.ndarray]]],
    id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, wide: bool = False,
) -> DataFrame:
    """Write the ids of all rows in ascending key order below ``folder``; returns the manifest, one row per file.

    ``tokenizer`` makes, in each task, the function that turns a text column into ids. ``wide``: ids need 4 bytes.
    """
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = tokenizer(), TaskContext.get().partitionId()
        path = f"{uri}/part-{part:06d}-{uuid.uuid4().hex}"
        store, local = _open(path)
        store.create_dir(local.rsplit("/", 1)[0], recursive=True)
        at, records, total = 0, 0, 0
        with store.open_output_stream(f"{local}.rec") as out, store.open_output_stream(f"{local}.idx") as index:
            for batch in batches:
                for i, j in slices(utf8(batch.column(1))[0], BYTES_PER_READ):
                    keys = batch.column(0).slice(i, j - i).to_pylist()
                    ids = [np.append(x, end_id) for x in encode(batch.column(1).slice(i, j - i))]
                    data, offsets = frame(keys, ids, wide)
                    before = total + np.cumsum([0, *map(len, ids)])
                    out.write(data)
                    index.write(np.stack([at + offsets[:-1], before[:-1]], 1).astype("<u8").tobytes())
                    at, records, total = at + len(data), records + len(ids), int(before[-1])
            index.write(np.array([at, total], "<u8").tobytes())
        row = [[part], [path], [records], [total]]
        if records:
            yield pa.RecordBatch.from_arrays([pa.array(v, f) for v, f in zip(row, _ARROW, strict=True)], MANIFEST.names)

    read = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = read.repartitionByRange("id", tie).sortWithinPartitions("id", tie)
    return save_scratch(ordered.mapInArrow(run, MANIFEST), "manifest")


_ARROW = (pa.int32(), pa.string(), pa.int64(), pa.int64())


def placed(manifest: DataFrame) -> DataFrame:
    """The manifest with the ids before each file; one row per file, so one task can order it."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read(manifest: DataFrame, shuffle_seed: int | None = None, with_ids: bool = True) -> DataFrame:
    """(key, start, n_tokens, ids_crc32, ids) of every record of the files, checked against the checksums.

    Without ``with_ids`` the ids are read and checked, but the column is left out.

    ``start``: ids of all records before it. Files are read in ranges of records, found with the offset index. With
    ``shuffle_seed`` each range is of records in a random order fixed by the seed: every record is read alone.
    """
    steps = F.sequence(F.lit(0).cast("long"), F.col("n_records") - 1, F.lit(RECORDS_PER_READ).cast("long"))
    reads = placed(manifest).withColumn("first", F.explode(steps)).select("path", "n_records", "before", "first")
    if shuffle_seed is not None:
        reads = reads.orderBy(F.xxhash64("path", "first", F.lit(shuffle_seed)))
    else:
        reads = reads.repartition(min(READ_TASKS, max(1, reads.count())))
    schema = T.StructType(
        [
            T.StructField("key", T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            *[T.StructField("ids", T.ArrayType(T.IntegerType()))][: int(with_ids)],
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _range(row, shuffle_seed, schema.names)

    return reads.mapInArrow(run, schema)


def _range(row: dict, seed: int | None, names: list[str]) -> Iterator[pa.RecordBatch]:
    store, local = _open(row["path"])
    first, last = row["first"], min(row["first"] + RECORDS_PER_READ, row["n_records"])
    with store.open_input_file(f"{local}.idx") as file:
        file.seek(16 * first)
        index = np.frombuffer(file.read(16 * (last - first + 1)), "<u8").astype(np.int64).reshape(-1, 2)
    offsets, before = index[:, 0], index[:, 1]
    with store.open_input_file(f"{local}.rec") as file:
        if seed is None:
            groups = [list(range(i, j)) for i, j in slices(offsets, BYTES_PER_READ)]
        else:
            order = np.random.default_rng([seed, first, zlib.crc32(local.encode())]).permutation(last - first)
            groups = [[k] for k in order.tolist()]
        for own in groups:
            file.seek(int(offsets[own[0]]))
            data = file.read(int(offsets[own[-1] + 1] - offsets[own[0]]))
            keys, ids = unframe(data, offsets[own[0] : own[-1] + 2] - offsets[own[0]])
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            sums = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
            arrays = [
                pa.array(keys, pa.int64()),
                pa.array(before[own] + row["before"]),
                pa.array(np.diff(ends).astype(np.int64)),
                pa.array(sums, pa.int64()),
            ]
            if "ids" in names:
                flat = pa.array(np.concatenate(ids).astype(np.int32))
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), flat))
            yield pa.RecordBatch.from_arrays(arrays, names)
