"""List literals against Python's own reading of them."""

import ast
import random
import warnings

import pytest
from pyspark.sql import functions as F

from lumbre.functions import sets

PIECES = ["a", "ñ", "中", "🙂", " ", ",", "[", "]", "'", '"', "\\'", '\\"', "\\\\", "\\n", "\\t", "\\x41", "\\xe9", "\\u00f1", "\\U0001F642", "\\101", "\\0", "\\q",
          "\\x4", "\\u12", "\\N{DASH}", "\\\n", "None", "(", "{", "#", "it's"]


def one(rng):
    """A member as somebody may write it, mostly well."""
    if rng.random() < 0.15:
        return rng.choice(["None", "True", "False", "7", "-3", "0", "1.5", "07", "name", "b'x'", "['x']", "1e3", "{}", "Nonex"])
    parts = []
    for _ in range(rng.choice([1, 1, 1, 1, 2, 3])):
        quote = rng.choice(["'", "'", '"', "\'\'\'", '"""'])
        body = "".join(rng.choice(PIECES) for _ in range(rng.randrange(4)))
        parts.append(rng.choice(["", "", "", "u", "r", "R", "U"]) + quote + body + quote)
    return rng.choice(["", " ", "\n "]).join(parts)


def literal(rng):
    opened, closed = rng.choice(["[]", "[]", "[]", "()", "{}", "[)"])
    body = rng.choice([",", ", ", " , ", ",\n"]).join(one(rng) for _ in range(rng.choice([0, 1, 1, 2, 3])))
    return rng.choice(["", " "]) + opened + body + rng.choice(["", "", ",", " ", ",,"]) + closed + rng.choice(["", " ", "", "x"])


def by_python(text):
    """What Python reads, as far as it is a flat list of texts, None, truth values and whole numbers; sets in order."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        try:
            value = ast.literal_eval(text)
            if isinstance(value, set):
                value = ast.literal_eval("(" + text.strip()[1:-1].rstrip(" ,") + ",)") if text.strip() != "set()" else []
        except (ValueError, SyntaxError, TypeError):
            return None
    if not isinstance(value, (list, tuple)) or isinstance(value, list) and text.strip()[0] == "(":
        return None
    if not all(v is None or isinstance(v, str) or type(v) in (bool, int) for v in value):
        return None
    return [v if v is None else str(v) for v in value]


@pytest.mark.parametrize("seed", [1, 2])
def test_as_python_reads_it(spark, seed):
    rng = random.Random(seed)
    texts = [literal(rng) for _ in range(3000)]
    texts += ["['a', 'b',]", "[None, 'a']", "('a', 'b')", "('a',)", "('a')", "['\\xe9']", "['a' 'b', 'c']", "set()", "{}", "[]", "()", "[,]", "['a' 7]"]
    expected = [by_python(t) for t in texts]
    rows = [(k, t) for k, (t, e) in enumerate(zip(texts, expected, strict=True)) if not e or not any(v and "\0" in v for v in e)]
    df = spark.createDataFrame(rows, "k int, t string").select("k", sets.parse_list_literal(F.col("t")).alias("got"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    wrong = [(texts[r.k], r.got, expected[r.k]) for r in df.collect() if r.got != expected[r.k]]
    assert not wrong, wrong[:5]
    assert sum(e is not None and len(e) > 0 for e in expected) > 500


def test_long_literals(spark):
    long = "'" + "x\\'y" * 20_000 + "'"
    texts = ["[" + ", ".join(f"'m{k}'" for k in range(20_000)) + "]", f"[{long}]", "[" + "(" * 50_000, "[" + "'a' " * 2000 + "]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(sets.parse_list_literal(F.col("t"))).collect()]
    assert [len(got[0]), got[1], got[2], got[3]] == [20_000, ["x'y" * 20_000], None, ["a" * 2000]]


@pytest.mark.parametrize("text,members", [("['b', 'a',]", ["a", "b"]), ("[None, 'a']", ["a"]), ("('a', 'b')", ["('a', 'b')"]), ("['\\xe9']", ["é"])])
def test_sets_of_literals(spark, text, members):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(sets.normalize_to_set(F.col("t"))).first()[0] == members
