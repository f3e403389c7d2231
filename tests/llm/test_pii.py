"""Base spans against the plain patterns, and the added ones on strings that the fit has not seen."""

import hashlib
import random
import re

import numpy as np
import pytest

from lumbre.llm import boosting, pii
from lumbre.llm.pii_candidates import KINDS, Span, base_spans, candidates, luhn, matrix
from lumbre.llm.pii_samples import MAKERS, _lookalike, rendered
from lumbre.llm.query_pii import op11_pii

SF = "/root/testdata/sf0.001"
PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain(text):
    """The rules as they are written."""
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(digits[::-1])) % 10 == 0):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


@pytest.fixture(scope="module")
def pieces(spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").orderBy("doc_id").collect()]
    return [t[100:400] for t in texts if len(t) > 400]


@pytest.fixture(scope="module")
def detector(pieces):
    return pii.fit_samples(pieces[::2])


def test_base_spans_by_the_patterns():
    rng = random.Random(4)
    alphabet = "a.Z9@@..--+ 0123456789()_%\n"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(20_000)]
    made += [" ".join(MAKERS[rng.randrange(4)](rng) for _ in range(3)) for _ in range(3000)]
    made += ["x@y@z.com a@b.c@d.e", "1.2.3.4.5.6.7.8", "300.1.2.3.4", "0000000001.2.3.0255", "+1 (2)--3 456789 012", "é" * 9 + "a@b.c.", "a@b..c", "@b.c"]
    made += ["٣٤٥٦٧٨٩٠١٢٣٤٥٦٧٨ 1٣.1.1.1"]
    for text in made:
        assert [(s.start, s.kind, s.end) for s in base_spans(text)] == plain(text), text


@pytest.mark.parametrize("piece", ["a", "1", "1.", "1 ", "+1", "a@", "a@b.", "(", "1-(", "f:", "a.b", "@", " at ", "0 at b dot "])
def test_long_runs_take_linear_time(piece):
    text = piece * (300_000 // len(piece))
    base_spans(text)
    if piece not in ("1 ", "1.", "1-("):
        candidates(text)


def test_added_spans_on_unseen_strings(detector, pieces):
    """Whole made-up strings between pieces that the fit has not seen; look-alikes must be left alone."""
    rng, others = random.Random(77), pieces[1::2]
    found, wrong = {k: [] for k in MAKERS}, []
    for n in range(1600):
        before, after = rng.choice(others) + " ", " " + rng.choice(others)
        own = MAKERS[n % 4](rng) if n % 8 < 4 else _lookalike(rng)
        spans = [s for s in detector.spans(before + own + after) if s[2] > len(before) and s[0] < len(before) + len(own)]
        if n % 8 < 4:
            found[n % 4].append((len(before), n % 4, len(before) + len(own)) in [s[:3] for s in spans])
        else:
            wrong.append(any(not s[3] for s in spans))
    assert all(np.mean(v) > 0.9 for v in found.values()), {KINDS[k]: np.mean(v) for k, v in found.items()}
    assert np.mean(wrong) < 0.02


def test_chosen_spans_do_not_overlap_and_base_ones_stay(detector):
    text = "pay 7536784127813050 4845168114407329 or call +1 (826) 555-4081 190.137.2.55 or mail a.b at c dot org or d@e.fr"
    spans = detector.spans(text)
    assert {(s[0], s[1], s[2]) for s in spans if s[3]} == set(plain(text))
    assert text[4:20] in [text[s[0] : s[2]] for s in spans] and "4845168114407329" in [text[s[0] : s[2]] for s in spans]
    added = [s for s in spans if not s[3]]
    assert all(a[2] <= b[0] for a, b in zip(sorted(added), sorted(added)[1:], strict=False))
    assert pii._masked("a@b.c x", [(0, 0, 5, True, 1.0)]) == "[email] x"


def test_choice_is_the_likeliest_first():
    spans = [Span(0, 2, 10, False), Span(5, 3, 15, False), Span(12, 2, 20, False), Span(30, 0, 40, True), Span(50, 3, 60, False)]
    got = pii._chosen(spans, np.array([0.6, 0.9, 0.8, 0.1, 0.4]), (0.5,) * 4)
    assert [s[:2] for s in got] == [(5, 3), (30, 0)]


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = boosting.fit(x[:2000], y[:2000])
    boosting.calibrate(model, x[2000:3000], y[2000:3000])
    p = model.probability(x[3000:])
    assert np.mean((p > 0.5) == y[3000:]) > 0.97
    assert abs(p[y[3000:] == 1].mean() - 1) < 0.1
    assert boosting.threshold(np.array([0.9, 0.8, 0.7, 0.6]), np.array([1, 1, 0, 1.0]), 0.99) == 0.8
    assert boosting.threshold(np.array([0.9]), np.array([0.0]), 0.99) == 2.0
    assert boosting.threshold(np.zeros(0), np.zeros(0), 0.99) == 2.0


def test_query_by_the_patterns(spark):
    rows = {r.doc_id: r for r in op11_pii(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        base, r = plain(d.text or ""), rows[d.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in base) for k in range(4)]
        named = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(named.encode()).hexdigest()
        assert set(filter(None, named.split(","))) <= set(r.spans.split(","))


def test_odd_and_empty_tables(spark, odd, none, detector):
    rows = pii.scan(odd, detector).collect()
    assert len(rows) == odd.count() and all(not r.spans for r in rows if r.id in (1, 2, 3, 7, 8))
    assert pii.scan(none, detector).count() == 0
    assert pii.fit(none, made=400).least
    masked = pii.redacted(odd, detector)
    assert masked.columns == odd.columns and masked.count() == odd.count()
    assert masked.where("text is null").count() == odd.where("text is null").count()


def test_samples_hold_both_classes(pieces):
    rows = rendered(pieces, 800, 1)
    labels = {(s.kind, y) for _, s, y in rows}
    assert labels == {(k, y) for k in range(4) for y in (0, 1)}
    assert matrix(*[(t, [s]) for t, s, _ in rows][0]).shape[0] == 1 and luhn("4111111111111111")
