import random

import pytest

from lumbre.llm import decontaminate as D
from tests_llm_words import tokens


def brute(docs, items, n):
    windows = {}
    for item, text in items:
        own = tokens(text)
        for k in range(max(1, len(own) - n + 1) if own else 0):
            windows.setdefault(tuple(own[k : k + n]), set()).add(str(item))
    out = []
    for key, text in docs:
        own, hit, found = tokens(text), set(), set()
        for window, names in windows.items():
            for k in range(len(own) - len(window) + 1):
                if tuple(own[k : k + len(window)]) == window:
                    hit |= set(range(k, k + len(window)))
                    found |= names
        out.append((key, len(own), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def small(spark):
    random.seed(2)
    say = lambda n: " ".join(random.choice("the of and cat dog Bird é 42".split()) for _ in range(n))
    items = [(k, say(random.randint(1, 9))) for k in range(12)] + [(90, None), (91, ""), (92, "..."), (93, "zebra the")]
    items.append((94, items[0][1]))
    docs = [(k, say(random.randint(0, 60))) for k in range(40)] + [(70, None), (71, ""), (72, items[3][1] or ""), (72, items[3][1])]
    make = lambda rows, names: spark.createDataFrame(rows, names)
    return docs, items, make(docs, "doc_id long, text string"), make(items, "item_id long, text string")


@pytest.mark.parametrize("limit", [D.QUERY_BYTES, 60])
def test_contamination_as_by_brute_force(small, limit):
    docs, items, d, i = small
    index = D.stored_index(d, block=300)
    got = D.contamination(index, i, n=4, limit=limit).collect()
    assert sorted(((r.id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in got), key=str) == brute(docs, items, 4)
    for r in got:
        assert sum(b - a for a, b in r.spans) == r.n_hit


def test_phrases_are_every_place(small):
    docs, items, d, i = small
    got = {(r.id, r.item, r.position) for r in D.phrases(D.build_index(d), i, n=4).collect()}
    expected = set()
    for key, text in docs:
        own = tokens(text)
        for item, asked in items:
            other = tokens(asked)
            for w in range(max(1, len(other) - 3) if other else 0):
                window = other[w : w + 4]
                expected |= {(key, str(item), k) for k in range(len(own) - len(window) + 1) if own[k : k + len(window)] == window}
    assert got == expected


def test_proximity_takes_words_in_any_order(spark):
    d = spark.createDataFrame([(1, "gamma x alpha y beta"), (2, "gamma x x x x x alpha beta"), (3, "alpha beta"), (4, "gamma")], "doc_id long, text string")
    i = spark.createDataFrame([(5, "alpha beta gamma")], "item_id long, text string")
    got = {(r.id, r.item) for r in D.proximity(D.build_index(d), i, n=3, within=4).collect()}
    assert got == {(1, "5")}


def test_odd_and_empty_tables(odd, none, spark):
    items = spark.createDataFrame([(1, "two three"), (None, "x")], "item_id long, text string")
    got = D.contamination(D.build_index(odd), items).collect()
    assert len(got) == odd.count()
    assert sorted((r.id, r.n_hit) for r in got if r.n_hit) == [(4, 2), (5, 2), (5, 2), (7, 1)]
    assert [r["items"] for r in got if r.id == 7] == [[]]
    assert D.contamination(D.build_index(none), items).count() == 0
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(D.build_index(odd), no_items).where("n_hit > 0").count() == 0
