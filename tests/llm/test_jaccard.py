import collections
import random

import pytest
from pyspark.sql import functions as F

from lumbre.llm import jaccard as J
from lumbre.llm.components import components
from tests.llm.conftest import TEXTS
from tests_llm_words import tokens


def brute(docs, threshold=0.8):
    sets = []
    for _, text in docs:
        own = tokens(text)
        full = [tuple(own[k : k + 5]) for k in range(len(own) - 4)]
        sets.append(frozenset(full or [tuple(own) or ("-", text or "")]))
    links, home = [0] * len(docs), list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-12:
                links[a] += 1
                links[b] += 1
                low, high = sorted((home[a], home[b]))
                home = [low if h == high else h for h in home]
    names = collections.defaultdict(list)
    for k, h in enumerate(home):
        names[h].append(docs[k][0])
    least = {h: min((i for i in own if i is not None), default=None) for h, own in names.items()}
    return sorted(((docs[k][0], least[home[k]], links[k]) for k in range(len(docs))), key=str)


@pytest.fixture(scope="module")
def made():
    random.seed(8)
    word = lambda: random.choice("abcdefgh") + str(random.randint(0, 40))
    texts = []
    for _ in range(25):
        own = [word() for _ in range(random.randint(3, 120))]
        texts.append(own)
        for _ in range(random.randint(0, 6)):
            near = list(own)
            for _ in range(random.randint(0, 4)):
                near[random.randrange(len(near))] = word()
            texts.append(near)
    return [(k, " ".join(t)) for k, t in enumerate(texts)]


@pytest.mark.parametrize("cell", [J.CELL, 900])
def test_as_by_brute_force(spark, made, cell, monkeypatch):
    monkeypatch.setattr(J, "CELL", cell)
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(4)
    got = [(r.id, r.class_id, r.n_links) for r in J.jaccard_join(df).collect()]
    assert sorted(got, key=str) == brute(made)


def test_given_documents_one_of_each(documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    expected = brute(docs)
    kept = J.one_of_each(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _ in expected})


def test_posterior_drops_only_what_cannot_reach():
    need = J.least_matches(0.8, J.TOLERANCE)
    assert (need[1:] >= 0).all() and (need[16], need[96]) < (16, 96) and need[96] > 40
    assert (need[1:] <= 0.8 * J.np.arange(1, 97)).all()


def test_odd_and_empty_tables(odd, none):
    assert sorted(((r.id, r.class_id, r.n_links) for r in J.jaccard_join(odd).collect()), key=str) == brute(TEXTS)
    left = J.one_of_each(odd)
    assert left.columns == odd.columns and left.count() == len({str(r[1]) for r in brute(TEXTS) if r[1] is not None}) + 1
    assert J.jaccard_join(none).count() == 0 and J.one_of_each(none).count() == 0


def test_components(spark):
    chain = [(k + 1, k) for k in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = components(spark.createDataFrame(chain, "u long, v long")).collect()
    assert {(r.node, r.component) for r in got} == {(k, 0) for k in range(41)} | {(k, 100) for k in (100, 101, 102)}
    assert components(spark.createDataFrame([], "u long, v long")).agg(F.count("*")).first()[0] == 0
