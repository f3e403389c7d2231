import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lumbre.llm.crc32c import crc32c, masked
from lumbre.llm.query_bpe import vocabulary
from lumbre.llm.query_records import library, op4_records
from lumbre.llm.records import BadRecord, frame, read, unframe, write
from lumbre.llm.tokens import token_ids
from tests.llm.conftest import SF, TEXTS


def plain_crc(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksums():
    digits = np.frombuffer(b"123456789", np.uint8)
    assert crc32c(digits, [0], [9])[0] == 0xE3069283
    data = np.random.default_rng(0).integers(0, 256, 6000, dtype=np.uint8)
    starts, ends = [0, 5, 5, 100, 1000, 3000], [0, 6, 600, 100, 2024, 6000]
    assert crc32c(data, starts, ends).tolist() == [plain_crc(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
    assert masked(np.array([0], np.uint32))[0] == 0xA282EAD8


def test_frames_go_back_and_damage_is_found():
    ids = [np.array([1, 2, 3]), np.zeros(0, np.int64), np.arange(700)]
    for wide in (False, True):
        data, offsets = frame([1, None, -5], ids, wide)
        keys, back = unframe(data, offsets)
        assert keys == [1, None, -5] and [x.tolist() for x in back] == [x.tolist() for x in ids]
        for at in (3, 9, 20, len(data) - 1):
            broken = bytearray(data)
            broken[at] ^= 1
            with pytest.raises(BadRecord):
                unframe(bytes(broken), offsets)


def test_query(spark, documents):
    tokenizer, start = Tokenizer.from_str(vocabulary()), 0
    rows = {r.doc_id: r for r in op4_records(spark, SF).collect()}
    for r in sorted(documents.collect(), key=lambda r: r.doc_id):
        ids = np.array([*tokenizer.encode(r.text, add_special_tokens=False).ids, 0], "<u4")
        got = rows[r.doc_id]
        assert (got.start, got.n_tokens, got.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def make():
    source = vocabulary()

    def tokenizer():
        return lambda column: token_ids(column, library(source))

    return tokenizer


def test_odd_and_empty_tables(odd, none, tmp_path):
    manifest = write(odd, str(tmp_path / "a"), make())
    rows = read(manifest).orderBy("start").collect()
    keys = [r.key for r in rows]
    assert keys == sorted((i for i, _ in TEXTS), key=lambda i: (i is not None, i))
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    assert all(r["ids"][-1] == 0 for r in rows) and sum(r.n_tokens == 1 for r in rows) == 3
    mixed = read(manifest, shuffle_seed=1).collect()
    assert sorted(map(str, mixed)) == sorted(map(str, rows))
    assert read(write(none, str(tmp_path / "b"), make())).count() == 0


def test_an_id_that_does_not_fit_is_an_error():
    import numpy as np

    from lumbre.llm.records import frame, unframe

    ids = [np.array([1, 70_000], np.uint32), np.zeros(0, np.uint32)]
    with pytest.raises(ValueError):
        frame([1, 2], ids, wide=False)
    data, offsets = frame([1, 2], ids, wide=True)
    assert [x.tolist() for x in unframe(data, offsets)[1]] == [[1, 70_000], []]
    data, offsets = frame([1], [np.array([65_535], np.uint32)], wide=False)
    assert unframe(data, offsets)[1][0].tolist() == [65_535]
