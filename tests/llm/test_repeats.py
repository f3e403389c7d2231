import collections
import hashlib

import numpy as np
import pytest

from lumbre.llm import repeats as R
from lumbre.llm.query_repeats import op2_repeats
from lumbre.llm.runs import RunIndex, merged, repeated_stretches
from tests.llm.conftest import SF, TEXTS


def brute(texts, least):
    times = collections.Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1))
    out = []
    for t in texts:
        at = np.array([i for i in range(len(t) - least + 1) if times[t[i : i + least]] > 1], np.int64)
        out.append(merged(at, at + least).tolist())
    return out


def texts_of(rng, count, size):
    texts = []
    for _ in range(count):
        t = bytes(rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(0, size))).astype(np.uint8))
        if texts and rng.random() < 0.5:
            o = texts[int(rng.integers(0, len(texts)))]
            t = t[:5] + o[: int(rng.integers(0, len(o) + 1))] + t[:3]
        texts.append(t)
    return texts


def test_run_index_as_by_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(200):
        texts, least = texts_of(rng, int(rng.integers(1, 8)), 60), int(rng.integers(1, 12))
        got = repeated_stretches(np.frombuffer(b"".join(texts), np.uint8), [len(t) for t in texts], least)
        assert [g.tolist() for g in got] == brute(texts, least)


def test_matching_statistics_and_runs():
    text = b"abcabcabcabcxabcabc\x00\xff\x00\xff"
    index = RunIndex(np.frombuffer(text, np.uint8), [len(text)])
    for at, length in enumerate(index.matching_statistics()[: len(text)].tolist()):
        longest = max(n for n in range(len(text) - at + 1) if n == 0 or any(text[k : k + n] == text[at : at + n] and k != at for k in range(len(text) - n + 1)))
        assert length == longest
    many = RunIndex(np.frombuffer(b"banana and bandana " * 300, np.uint8), [5700])
    assert len(many.heads) < 200


@pytest.mark.parametrize("hot", [R.HOT, 200])
def test_small_texts_as_by_brute_force(spark, hot):
    rng = np.random.default_rng(6)
    texts = texts_of(rng, 60, 300) + [b"", b"", b"same text twice " * 3, b"same text twice " * 3]
    df = spark.createDataFrame([(k, t.decode()) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = {r.id: r for r in R.for_rows(df, R.per_text(df, least=30, anchor=12, hot=hot)).collect()}
    for k, spans in enumerate(brute(texts, 30)):
        assert rows[k].spans == spans
        edges = [0, *(x for s in spans for x in s), len(texts[k])]
        assert bytes(rows[k].kept) == b"".join(texts[k][a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def test_query(spark, documents):
    docs = {r.doc_id: r.text.encode() for r in documents.collect()}
    expected = dict(zip(docs, brute(list(docs.values()), 400), strict=True))
    rows = op2_repeats(spark, SF).collect()
    assert len(rows) == len(docs) and sum(r.n_removed for r in rows) > 0
    for r in rows:
        text, spans = docs[r.doc_id], expected[r.doc_id]
        edges = [0, *(x for s in spans for x in s), len(text)]
        kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(text), len(text) - len(kept), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_odd_and_empty_tables(odd, none):
    rows = R.for_rows(odd, R.per_text(odd)).collect()
    assert len(rows) == len(TEXTS)
    assert all(r.n_removed == 0 and bytes(r.kept).decode() in {t or "" for _, t in TEXTS} for r in rows)
    assert R.for_rows(none, R.per_text(none)).count() == 0
    twice = odd.unionByName(odd)
    removed = {(r.id, r.n_removed > 0) for r in R.for_rows(twice, R.per_text(twice)).collect()}
    assert {i for i, gone in removed if gone} == {6}
