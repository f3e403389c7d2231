import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumbre.llm.bpe import Bpe
from lumbre.llm.query_bpe import op9_bpe, vocabulary
from lumbre.llm.tokens import coder, decode, digests, encode, token_ids
from tests.llm.conftest import SF, TEXTS

PARTS = [
    " ", "  ", "   ", "\n", "\n\n", "\t", "\r\n", "a", "aaaa", "the", "'s", "'ll", "1", "23", "é", "ß", "中文", "🙂", " ",
    "\u0085", "\x1c", "!", "...", "<|endoftext|>", "<|", "​", "　", "don't", "İ", "²", "٣", "́",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_str(vocabulary())


def test_as_the_library_encodes_and_decodes(library):
    random.seed(3)
    texts = ["".join(random.choices(PARTS, k=random.randint(0, 12))) for _ in range(3000)]
    texts += ["a" * 20_000, " " * 500 + "x", "", "ab" * 3000]
    bpe, chunks = coder(vocabulary())
    got = list(token_ids(pa.array(texts), chunks))
    for text, ids in zip(texts, got, strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected, text[:50]
        assert bpe.decode(ids) == library.decode(expected, skip_special_tokens=False).encode()


def test_pair_index_as_merging_one_by_one():
    bpe = Bpe(vocabulary())
    table = {(a, b): (r, c) for r, (a, b, c) in enumerate(bpe.merges.tolist())}
    random.seed(4)
    pieces = ["".join(random.choices("aabehntsi", k=random.randint(0, 25))).encode() for _ in range(400)]
    flat, sizes = bpe.encode_pieces(pieces)
    at = 0
    for piece, size in zip(pieces, sizes.tolist(), strict=True):
        ids = [int(bpe.byte_ids[b]) for b in piece]
        while True:
            ranked = [(table[p][0], k) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in table]
            if not ranked:
                break
            k = min(ranked)[1]
            ids[k : k + 2] = [table[ids[k], ids[k + 1]][1]]
        assert flat[at : at + size].tolist() == ids
        at += size


def test_bytes_that_are_no_text_are_replaced():
    bpe = Bpe(vocabulary())
    ids = np.array([int(bpe.byte_ids[0xE4])])
    assert bpe.decode(ids).decode() == "�"


def test_store_of_chunks_forgets_without_harm(library, monkeypatch):
    from lumbre.llm import chunks as C

    monkeypatch.setattr(C, "KEPT", 20)
    store = C.Chunks(Bpe(vocabulary()).encode, ("<|endoftext|>",))
    for k in range(6):
        texts = [f"word{k} other{k * j} the the {j}" for j in range(30)]
        for text, ids in zip(texts, token_ids(pa.array(texts), store), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_query(spark, documents, library):
    rows = {r.doc_id: r for r in op9_bpe(spark, SF).collect()}
    for r in documents.collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        got = rows[r.doc_id]
        assert got.n_tokens == len(ids)
        assert got.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_odd_and_empty_tables(odd, none):
    assert digests(none, vocabulary()).count() == 0
    back = decode(encode(odd, vocabulary()), vocabulary()).collect()
    assert sorted(((r.id, r.text) for r in back), key=str) == sorted(((i, t or "") for i, t in TEXTS), key=str)
    assert digests(odd, vocabulary()).where(F.col("n_tokens") == 0).count() == 3
