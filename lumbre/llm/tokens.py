"""Token ids of a text column, encoded and decoded inside Arrow batches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre.llm.bpe import Bpe
from lumbre.llm.chunks import Chunks, other_space
from lumbre.llm.texts import slices, utf8

#: Bytes of text whose new chunks are merged in one index.
SLICE = 24_000_000

_CODERS: dict[str, Bpe] = {}


def coder(source: str) -> tuple[Bpe, Chunks]:
    """The vocabulary, made once per worker process, with a store of chunks for one task; ``source`` is the text of
    the tokenizer file."""
    key = hashlib.md5(source.encode()).hexdigest()
    bpe = _CODERS[key] = _CODERS.get(key) or Bpe(source)
    return bpe, Chunks(bpe.encode, tuple(bpe.specials))


def token_ids(column: pa.Array, chunks: Chunks, limit: int = SLICE) -> Iterator[np.ndarray]:
    """The ids of each text of a column; a null is an empty text."""
    offsets, data = utf8(column)
    for i, j in slices(offsets, limit):
        texts = ["" if t is None else t for t in column.slice(i, j - i).to_pylist()]
        yield from chunks.ids(texts, other_space(offsets[i : j + 1], data))


def encode(df: DataFrame, source: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) of every row."""
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = coder(source)[1]
        for batch in batches:
            ids = [x.astype(np.int32) for x in token_ids(batch.column(1), chunks)]
            ends = np.cumsum([0, *map(len, ids)])
            for i, j in slices(ends, SLICE):
                flat = np.concatenate(ids[i:j])
                lists = pa.ListArray.from_arrays(pa.array((ends[i : j + 1] - ends[i]).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lists], schema.names)

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def decode(df: DataFrame, source: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of every row of ids; null ids give a null text."""
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(source)[0]
        for batch in batches:
            lists = batch.column(1)
            texts = [bpe.decode(x.values.to_numpy()).decode() if x.is_valid else None for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], schema.names)

    return df.select(F.col(id_col), F.col(ids_col)).mapInArrow(run, schema)


def digests(df: DataFrame, source: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, text) of every row: encoded, and decoded again from the ids."""
    schema = T.StructType(
        [
            T.StructField("id", df.schema[id_col].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, chunks = coder(source)
        for batch in batches:
            counts, one, two = [], [], []
            for ids in token_ids(batch.column(1), chunks):
                counts.append(len(ids))
                one.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                two.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(one, pa.string()), pa.array(two, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
