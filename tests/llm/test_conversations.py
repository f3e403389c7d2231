"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import sys
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from check import connect, rows_of
from lumbre.llm import roles as R
from lumbre.llm.conversations import repair, repaired_messages
from lumbre.llm.query_conversations import SQL, damaged, op12_conversations

sys.setrecursionlimit(20_000)
FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id string, turn long, role string, text string, row int, result string, part int"


def faults(rows):
    """Fault of each (turn, role, text), the first that applies."""
    seen, out = set(), []
    for _, role, text in rows:
        real = re.findall(r"[^\x20\x09-\x0D]", text)
        if not real:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("sound" if real[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """(cost, audit, messages) of the least of all cheapest ways, with up to three inserts before each row."""
    memo = {}

    def add(cost, letter, message, rest):
        return cost + rest[0], letter + rest[1], ((message,) if message else ()) + rest[2]

    def search(i, last, inserts):
        if (i, last, inserts) not in memo:
            due = "assistant" if last == "u" else "user"
            options = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
            if i < len(rows):
                _, role, text = rows[i]
                extra = int(marks[i] == "truncated")
                options.append(add(3, "D", None, search(i + 1, last, 0)))
                if marks[i] not in ("blank", "duplicate"):
                    if role and last + role[0] in ("s", "u", "su", "ua", "au"):
                        options.append(add(extra, "K", (role, text), search(i + 1, role[0], 0)))
                    options.append(add(2 + extra, "R", (due, text), search(i + 1, due[0], 0)))
            if inserts < 3:
                options.append(add(2, "I", (due, ""), search(i, due[0], inserts + 1)))
            memo[i, last, inserts] = min(options) if options else (10**9, "~", ())
        return memo[i, last, inserts]

    return search(0, "", 0)


def expected(rows):
    """Report of one conversation, its rows (turn, role, text) in order."""
    marks = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    cost, audit, messages = cheapest(rows, marks)
    text = "\n".join(f"{r}:{t}" for r, t in messages)
    counts = [marks.count(m) for m in ("blank", "duplicate", "truncated")]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), list(messages)


def plain(rows):
    """Reports by conversation; rows are (conv, turn, role, text)."""
    order = sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2], r[3]))
    return {k: expected([r[1:] for r in part]) for k, part in groupby(order, key=lambda r: r[0])}


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        turn = 0
        for _ in range(rng.randrange(longest)):
            turn += rng.choice([1, 1, 1, 0, 4])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "ape"])
            text = rng.choice(["Hello.", "Well?", "No end", " \t\n", "", f"Number {turn}!", f"Odd {rng.randrange(9)}", "é…", "a.\n\n"])
            rows.append((f"c{c}", rng.choice([turn, turn, turn, None]), role, text))
    return rows


@pytest.mark.parametrize("seed,longest,range_bytes", [(1, 9, 1 << 24), (2, 9, 300), (3, 60, 500), (4, 200, 4000)])
def test_as_by_search(spark, seed, longest, range_bytes):
    """Also with ranges far shorter than conversations, so that most of them go on in several ranges."""
    rows = random_rows(seed, 12, longest)
    df = spark.createDataFrame([(*r, 0, "x", 1) for r in rows], SCHEMA).repartition(5)
    want = plain(rows)
    got = {r[0]: tuple(r)[1:] for r in repair(df, range_bytes=range_bytes).collect()}
    assert got == {k: v[0] for k, v in want.items()}
    edits = repaired_messages(df, range_bytes=range_bytes).where("place is not null").orderBy("conv_id", "place").collect()
    by_conv = {k: [(r.role, r.text) for r in part] for k, part in groupby(edits, key=lambda r: r.conv_id)}
    assert by_conv == {k: v[1] for k, v in want.items() if v[1]}


def test_one_conversation_over_many_ranges_with_hot_repeats(spark):
    rows = [("big", None if k % 3 else k, ("user", "assistant")[k % 2], "Same." if k % 4 else f"Own {k}") for k in range(1500)]
    rows += [("small", 1, "user", "Hi.")]
    df = spark.createDataFrame([(*r, 0, "x", 1) for r in rows], SCHEMA)
    got = {r[0]: tuple(r)[1:] for r in repair(df, range_bytes=4000).collect()}
    assert got == {k: v[0] for k, v in plain(rows).items()}


def test_runs_as_row_by_row():
    rng = random.Random(5)
    for _ in range(300):
        runs = [(rng.randrange(9), rng.choice([1, 2, 3, 7, 40])) for _ in range(rng.randrange(8))]
        flat = [(s, 1) for s, n in runs for _ in range(n)]
        assert R.cheapest(runs) == R.cheapest(flat)
    assert R.cheapest([(R.GONE, 10**5)]) == (3 * 10**5, "D" * 10**5)


def test_query_as_sql_and_by_search(spark):
    cur = connect(FOLDER).execute(SQL["op12_conversations"])
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    df = op12_conversations(spark, FOLDER)
    assert rows_of(df.columns, df.collect()) == want


def test_damage_by_the_rule(spark):
    rows = [(c, t, r, x) for c in (1, 2, None) for t in (*range(40), None) for r, x in (("user", "A. B? C!"), (None, None))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(map(str, damaged(df).collect()))
    want = []
    for c, t, r, x in rows:
        r, x = r if r is not None else " ", x if x is not None else " "
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if kind in (0, 1) else re.sub("[.!?]", "", x) if kind == 2 else x
        want.append((c, t, "user" if kind == 4 else r, x, {0: 0, 3: 2}.get(kind, 1)))
    names = ("conv_id", "turn", "role", "text", "copies")
    from pyspark.sql import Row

    assert got == sorted(str(Row(**dict(zip(names, w, strict=True)))) for w in want)


def test_nulls_empty_and_conversations_without_rows(spark):
    rows = [(None, None, None, None, 0, None, None), (None, 2**62, "user", "Hm", 0, None, None), (None, -(2**62), "user", "x" * 50000, 0, None, None)]
    rows += [("gone", 1, "user", "x.", 1, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.when(F.col("conv_id") == "gone", 0).otherwise(1))
    got = {r[0]: tuple(r)[1:] for r in repair(df, copies_col="n").collect()}
    assert got["gone"] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[None][:5] == (2**63 - 1, 1, 0, 2, 2)
    empty = spark.createDataFrame([], SCHEMA)
    assert repair(empty).count() == 0 and repaired_messages(empty).count() == 0
    assert repair(df).columns[0] == "conv_id"


def test_many_equal_rows_are_spread(spark):
    rows = [("a", 1, "user", "Same.", 0, "", 0)] * 900 + [("b", 1, "user", "Other.", 0, "", 0)]
    got = {r.conv_id: r for r in repair(spark.createDataFrame(rows, SCHEMA), range_bytes=6000).collect()}
    assert got["a"].duplicate == 899 and got["a"].audit.count("D") == 899 and got["b"].cost == 2
