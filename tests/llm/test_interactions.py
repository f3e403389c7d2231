"""Filter interactions against walking every order document by document."""

import math
import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from check import connect, rows_of
from lumbre.llm.interactions import audit, failures, lattice
from lumbre.llm.query_interactions import SQL, label_flags, op13_interactions, with_failures

FOLDER = "/root/testdata/sf0.001"


def failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        "D": any(c in text for c in "#$%&*|"),
    }


def walked(docs, labels):
    """Every order over every document; docs are (doc_id, text, source)."""
    fails, good, toxic = [], {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    for i, text, source in docs:
        f = failed(text or "")
        f["E"] = i is not None and any(j is not None and j < i and (other or "") == (text or "") for j, other, _ in docs)
        fails.append((source or "", {k for k, v in f.items() if v}, i is not None and i in good, i is not None and i in toxic))
    out, shapley = {}, {}
    for part in {p for p, *_ in fails}:
        own = [x for x in fails if x[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                lost = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                shapley[part, letter] = shapley.get((part, letter), 0) + len(lost)
                all_failed = sum(letter in x[1] for x in own)
                out[part, "".join(order), step] = (len(left), len(lost), all_failed - len(lost), sum(x[1] == {letter} for x in own),
                                                   sum(x[2] for x in lost), sum(x[3] for x in lost), letter)
    return {(*k, *v[:-1], shapley[k[0], v[-1]]) for k, v in out.items()}


def computed(spark, docs, labels):
    rows = with_failures(spark.createDataFrame(docs, "doc_id long, text string, source string"))
    flags = label_flags(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = rows.join(flags, rows["id"] == flags["label_id"], "left")
    out = audit(rows, F.col("part"), F.col("mask"), "ABCDE", {"good": F.col("good"), "toxic": F.col("toxic")})
    return {tuple(r) for r in out.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_as_by_walking_every_order(spark, seed):
    rng = random.Random(seed)
    docs = [(None, None, None), (None, "x", ""), (3, "", None), (3, "", None), (4, "", "b")]
    for i in range(80):
        vocabulary = [f"w{k}" for k in range(rng.choice([3, 400]))]
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 199, 200, 260]))]
        words += rng.choice([[], ["#"], ["ABCDEFGHIJKLMNOPQRSTUVWXYZ"], ["Ünï\x85cöde x"]])
        text = rng.choice([" ", "\n", "\t\x0b "]).join(words)
        docs.append((rng.choice([i, i, rng.randrange(20)]), docs[-1][1] if rng.random() < 0.3 else text, rng.choice(["a", "b", None, "long part"])))
    labels = [(rng.randrange(80), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(90)] + [(None, 1, 1)]
    assert computed(spark, docs, labels) == walked(docs, labels)


def test_lattice_counts_all_orders():
    for n in (1, 3, 5):
        edges = lattice(n)
        assert len(edges) == n * 2 ** (n - 1)
        for f in range(n):
            assert sum(e.reach * e.leave for e in edges if e.filter == f) == math.factorial(n)


def test_query_as_sql(spark):
    cur = connect(FOLDER).execute(SQL["op13_interactions"])
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    df = op13_interactions(spark, FOLDER)
    assert df.schema["step"].dataType.simpleString() == "int"
    assert rows_of(df.columns, df.collect()) == want


def test_odd_and_empty_tables(spark, odd, none):
    assert with_failures(odd, part_col="key").count() == odd.count()
    masked = with_failures(none, part_col="key")
    assert audit(masked, F.col("part"), F.col("mask"), "ABCDE", {}).count() == 0
    with pytest.raises(ValueError):
        audit(masked, F.col("part"), F.col("mask"), "ABCDEFGH", {})


def test_other_numbers_of_filters(spark):
    rows = spark.createDataFrame([(True, None), (True, True), (False, True), (False, False)], "a boolean, b boolean")
    out = audit(rows, F.lit("p"), failures([F.col("a"), F.col("b")]), "XY", {})
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in out.collect()}
    assert got == {("XY", 1): (2, 2, 0, 1, 3), ("XY", 2): (1, 1, 1, 1, 3), ("YX", 1): (2, 2, 0, 1, 3), ("YX", 2): (1, 1, 1, 1, 3)}
