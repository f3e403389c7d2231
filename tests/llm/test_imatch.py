import collections
import hashlib
import statistics

import pyarrow as pa

from lumbre.llm import imatch as I
from lumbre.llm.query_imatch import op3_imatch
from lumbre.llm.texts import utf8, words
from tests.llm.conftest import SF, TEXTS
from tests_llm_words import tokens


def test_query(spark, documents):
    docs = sorted((r.doc_id, r.text) for r in documents.collect())
    rows = {r.doc_id: r for r in op3_imatch(spark, SF).collect()}
    known = I.lexicon(documents)
    prints = dict(zip([i for i, _ in docs], I.fingerprints(pa.array([t for _, t in docs]), known), strict=True))
    assert len(rows) == len(docs)
    for k, (key, text) in enumerate(docs):
        following, after = docs[(k + 1) % len(docs)][1], docs[(k + 1) % len(docs)][0]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        got = rows[key]
        assert (got.n_chars, got.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert got.fingerprint == prints[key]
        assert got.edited_fingerprint == I.fingerprints(pa.array([changed]), known)[0]
        assert got.near_edited == I.likeness(got.fingerprint, got.edited_fingerprint)
        assert got.near_next == I.likeness(got.fingerprint, prints[after])
    edited = [r.near_edited for r in rows.values()]
    other = [r.near_next for r in rows.values()]
    assert statistics.mean(edited) > 0.08 > 0.03 > statistics.mean(other)
    equal = collections.defaultdict(set)
    for key, text in docs:
        equal[text].add(prints[key])
    assert all(len(s) == 1 for s in equal.values())


def test_lexicon_is_the_band(documents):
    texts = [r.text for r in documents.collect()]
    times = collections.Counter(w for t in texts for w in set(tokens(t)))
    band = (0.05, 0.3)
    expected = [w for w, n in times.items() if band[0] * len(texts) <= n <= band[1] * len(texts)]
    hashes = words(*utf8(pa.array(expected)))[0]
    assert sorted(hashes.tolist()) == I.lexicon(documents, band=band).tolist()


def test_likeness_follows_the_share_of_terms():
    known = words(*utf8(pa.array([f"t{k}" for k in range(3000)])))[0]
    known.sort()
    say = lambda a, b: " ".join(f"t{k}" for k in range(a, b))
    one, near, far, other = I.fingerprints(pa.array([say(0, 100), say(2, 102), say(50, 150), say(500, 600)]), known)
    assert I.likeness(one, one) == 1 and I.likeness(one, near) > 0.8 > I.likeness(one, far) > 0.05 > I.likeness(one, other)


def test_odd_and_empty_tables(odd, none):
    rows = I.compared(odd, I.lexicon(odd)).collect()
    assert sorted((r.id for r in rows), key=str) == sorted((i for i, _ in TEXTS), key=str)
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0))
    by_id = {i: t or "" for i, t in order}
    following = {1: by_id[2], 2: by_id[3], 4: by_id[5], 6: by_id[7], 7: by_id[8]}
    for r in rows:
        if r.id in following:
            assert r.edited_sha256 == hashlib.sha256(I.edited(by_id[r.id], following[r.id]).encode()).hexdigest()
    assert {r.fingerprint for r in rows if r.id in (1, 2, 3, 8)} == {"-"}
    assert len({r.fingerprint for r in rows if r.id in (4, 5)}) == 1
    assert I.compared(none, I.lexicon(none)).count() == 0
    assert I.fingerprinted(odd, I.lexicon(odd)).count() == odd.count()


def test_copies_of_one_text_keep_its_terms(spark):
    say = lambda k: " ".join(f"w{k}x{i}" for i in range(200))
    rows = [(k, say(k % 300 if k % 3 else 0)) for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = I.lexicon(docs)
    hashes = words(*utf8(pa.array([say(0)])))[0]
    assert set(hashes.tolist()) <= set(known.tolist())
    got = [r for r in I.compared(docs, known).collect() if r.id % 3 == 0]
    assert len(got) == 300 and all(0.1 < r.near_edited < 0.9 for r in got)


def test_texts_counted_once_and_rows_each(spark):
    texts = ["a b", "a b", "a c", None, None, "", "c"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    n, m, marked = I._sizes(docs, "text")
    assert (n, m) == (7, 4)
    found = {r.term: (r.documents, r.texts) for r in I.document_frequencies(docs, marked).collect()}
    name = lambda w: int(words(*utf8(pa.array([w])))[0].view("int64")[0])
    assert found == {name("a"): (3, 2), name("b"): (2, 1), name("c"): (2, 2)}
    # every slot marked, as with many copies: the same counts
    found_all = {r.term: (r.documents, r.texts) for r in I.document_frequencies(docs, marked | True).collect()}
    assert found_all == found


def test_text_without_lexicon_terms_is_like_its_near_copy():
    known = words(*utf8(pa.array(["other"])))[0]
    say = lambda a, b: " ".join(f"t{k}" for k in range(a, b))
    for lexicon in (known, known[:0]):
        one, near, far = I.fingerprints(pa.array([say(0, 100), say(2, 102), say(500, 600)]), lexicon)
        assert I.likeness(one, near) > 0.8 > 0.05 > I.likeness(one, far)
