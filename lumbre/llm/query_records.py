"""Query of the token records."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from lumbre.llm.chunks import Chunks
from lumbre.llm.query_bpe import vocabulary
from lumbre.llm.records import read, write
from lumbre.llm.tokens import token_ids
from lumbre.session import scratch_path
from lumbre.sources.tables import scan

END = 0
#: Chunks that are encoded in one call.
JOINED = 500
_CODERS: dict[str, Chunks] = {}


def library(source: str) -> Chunks:
    """The tokenizers library with this file, made once per worker process."""
    key = hashlib.md5(source.encode()).hexdigest()
    if key not in _CODERS:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(source)

        specials = {t.content: number for number, t in tokenizer.get_added_tokens_decoder().items()}
        mark = next(iter(specials), None)

        def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            """Many texts are joined by a special token, at which the library cuts them apart again."""
            flat, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            step = JOINED if mark and not any(mark in t for t in texts) else 1
            for begin in range(0, len(texts), step):
                joined = mark.join(texts[begin : begin + step]) if step > 1 else texts[begin]
                found = tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0]
                ids = np.array(found.ids, np.int32)
                cuts = np.flatnonzero(ids == specials[mark]) if step > 1 else np.zeros(0, np.int64)
                counts.append(np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - (step > 1 or 0))
                flat.append(np.delete(ids, cuts))
            return np.concatenate(flat), np.concatenate(counts)

        _CODERS[key] = Chunks(encode, tuple(specials))
    return _CODERS[key]


def op4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, written in key order and read back: place, number and checksum of its ids."""
    source = vocabulary()

    def tokenizer():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        chunks = library(source)
        return lambda column: token_ids(column, chunks)

    manifest = write(scan(spark, sf_dir, "documents"), scratch_path(spark, "records"), tokenizer, end_id=END)
    return read(manifest, with_ids=False).withColumnRenamed("key", "doc_id")


SQL: dict[str, str] = {}
QUERIES = {"op4_records": op4_records}
