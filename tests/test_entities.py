"""Sets, merging, engagement, splits, centres."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from split_soon import SPLIT_SOON

from lumbre.functions import engagement as E
from lumbre.functions import sets
from lumbre.operators import entities, geo, joins, split
from lumbre.plans import poi as plan
from lumbre.sources.files import POI_SCHEMA, read_csv, write_csv


@pytest.mark.parametrize(
    "text,parsed,normalized",
    [
        ("['a', 'b']", ["a", "b"], ["a", "b"]),
        ("[]", [], []),
        ("{'b', 'a'}", ["b", "a"], ["{'b', 'a'}"]),
        ("set()", [], ["set()"]),
        ('["L\'H"]', ["L'H"], ["L'H"]),
        ("['it\\'s']", ["it's"], ["it's"]),
        ("['ñ, x', 'y']", ["ñ, x", "y"], ["y", "ñ, x"]),
        ("plain", None, ["plain"]),
        ("[broken", None, ["[broken"]),
        (None, None, []),
    ],
)
def test_list_literals(spark, text, parsed, normalized):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(sets.parse_list_literal(F.col("t")), sets.normalize_to_set(F.col("t"))).first()
    assert got[0] == parsed and got[1] == normalized


def test_sets(spark):
    df = spark.createDataFrame([(["b", "a", "b", None],), (None,), ([],)], "x array<string>")
    got = df.select(sets.to_set(F.col("x")), sets.size_or_zero(F.col("x"))).collect()
    assert [tuple(r) for r in got] == [(["a", "b"], 4), ([], 0), ([], 0)]


MERGE = "ord int, id string, xps int, categories array<string>, tags array<string>, Visits long"


def test_merge_duplicates(spark):
    rows = [
        (3, "a", 100, ["q"], ["t2"], 3),
        (1, "a", 50, ["p"], ["t1"], 2),
        (1, "b", 70, ["r"], ["z", "y"], 3),
        (2, "b", 70, ["r"], ["x"], 4),
        (1, "c", 10, [], [], 9),
        (1, "d", 10, ["s"], ["u"], 1),
        (2, "d", 10, ["s"], ["u"], 1),
        (3, "d", 10, ["s"], ["v"], 2),
    ]
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, MERGE).repartition(3)
        merged = entities.merge_duplicates(df, "id", "ord", "tags", ["Visits"]).drop("ord").collect()
        got = {r["id"]: (r["xps"], r["categories"], r["tags"], r["Visits"]) for r in merged}
        assert got == {
            "a": (50, ["p"], ["t1", "t2"], 2),
            "b": (70, ["r"], ["x", "y", "z"], 4),
            "c": (10, [], [], 9),
            "d": (10, ["s"], ["u", "v"], 1),
        }


def test_duplicated_and_keep_first(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "o int, k string")
    assert sorted(r["o"] for r in entities.duplicated(df, ["k"]).collect()) == [1, 2, 3, 4]
    assert sorted(r["o"] for r in entities.keep_first(df, ["k"], ["o"]).collect()) == [1, 3, 5]


def test_one_hot_key_is_merged_and_limited_before_the_shuffle(spark):
    df = spark.range(30_000).select((F.col("id") % 3 == 0).cast("string").alias("k"), F.col("id").alias("o"))
    plan_text = entities.keep_first(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan_text and "Partial" in plan_text
    assert sorted(r["o"] for r in entities.keep_first(df, ["k"], ["o"]).collect()) == [0, 1]


@pytest.mark.parametrize(
    "likes,dislikes,bookmarks,label",
    [(50, 50, 20, 2), (50, 50, 19, -1), (49, 51, 20, 1), (49, 51, 19, 0), (0, 0, 0, 2), (0, 0, 5, 2)],
)
def test_engagement_label(spark, likes, dislikes, bookmarks, label):
    df = spark.createDataFrame([(likes, dislikes, bookmarks)], "Likes long, Dislikes long, Bookmarks long")
    row = plan.add_engagement(df).first()
    assert row["engagement_label"] == label
    if likes + dislikes == 0:
        assert row["C"] is None and row["S"] is None and row["E"] is None and not math.isnan(row["V"])
    else:
        v = 2 / (1 + math.exp(-0.0002 * (likes + dislikes + bookmarks))) - 1
        expected = 0.35 * bookmarks / (likes + dislikes) + 0.45 * likes / (likes + dislikes) + 0.2 * v
        assert row["E"] == pytest.approx(expected, abs=1e-12)


def test_label_class(spark):
    df = spark.createDataFrame([(-1,), (0,), (1,), (2,), (7,), (None,)], "l int")
    assert [r[0] for r in df.select(E.label_class(F.col("l"))).collect()] == [0, 1, 2, 3, None, None]


def test_multi_hot(spark):
    df = spark.createDataFrame([(1, ["b", "a"]), (2, []), (3, ["c"])], "id int, categories array<string>")
    got = plan.multi_hot(df, "categories")
    assert got.columns[2:] == ["a", "b", "c"]
    for r in got.collect():
        assert r["a"] + r["b"] + r["c"] == len(r["categories"])
    with pytest.raises(ValueError):
        plan.multi_hot(df, "categories", limit=2)


def allocate(counts, share):
    """Sizes per stratum, the plain way."""
    whole = sum(counts.values())
    take = math.ceil(share * whole)
    exact = {k: take * n / whole for k, n in counts.items()}
    out = {k: math.floor(x) for k, x in exact.items()}
    for k in sorted(exact, key=lambda k: (out[k] - exact[k], str(k)))[: take - sum(out.values())]:
        out[k] += 1
    return out


def test_split_sizes_of_the_known_case(spark):
    counts = {-1: 500, 0: 392, 2: 600}
    df = spark.createDataFrame(list(counts.items()), "label int, n long")
    sizes = split.allocated(split.allocated(df, F.col("n"), 0.15, "test"), F.col("n") - F.col("test"), 0.15, "val").collect()
    test, val = {r["label"]: r["test"] for r in sizes}, {r["label"]: r["val"] for r in sizes}
    rest = {k: n - test[k] for k, n in counts.items()}
    assert test == allocate(counts, 0.15) and val == allocate(rest, 0.15)
    assert (sum(test.values()), sum(val.values())) == (224, 191)
    assert sum(rest.values()) - 191 == 1077
    assert all(abs(test[k] - 224 * counts[k] / 1492) < 1 for k in counts)


def test_split_is_a_stable_partition(spark):
    rows = [(f"id{i}", i % 3 if i % 50 else None) for i in range(1, 1001)]
    df = spark.createDataFrame(rows, "id string, label int")
    first = {r["id"]: r["split"] for r in split.stratified_split(df, "id", "label").collect()}
    assert len(first) == 1000
    random.Random(1).shuffle(rows)
    again = split.stratified_split(spark.createDataFrame(rows, "id string, label int").repartition(5), "id", "label")
    assert {r["id"]: r["split"] for r in again.collect()} == first
    other = split.stratified_split(df, "id", "label", seed=7).collect()
    assert {r["id"]: r["split"] for r in other} != first
    counts, label_of = {}, dict(rows)
    for key, part in first.items():
        counts[part, label_of[key]] = counts.get((part, label_of[key]), 0) + 1
    per_label = {}
    for v in label_of.values():
        per_label[v] = per_label.get(v, 0) + 1
    test = allocate(per_label, 0.15)
    val = allocate({k: n - test[k] for k, n in per_label.items()}, 0.15)
    for label in per_label:
        assert counts.get(("test", label), 0) == test[label]
        assert counts.get(("val", label), 0) == val[label]


def test_train_statistics_only(spark):
    rows = [(f"p{i}", 1 + i % 4, float(i % 7), float(i % 11), 50 * (i % 13)) for i in range(80)]
    df = spark.createDataFrame(rows, "id string, tier int, locationLon double, locationLat double, xps int")
    train = df.where("locationLon < 5")
    stats = plan.fit_stats(train, [[0.0, 0.0], [3.0, 4.0]])
    done = plan.preprocess(train, stats)
    for c in ("locationLon_norm", "locationLat_norm", "dist_centroid_0", "dist_centroid_1"):
        mean, std = done.agg(F.avg(c), F.stddev_samp(c)).first()
        assert mean == pytest.approx(0, abs=1e-9) and std == pytest.approx(1, abs=1e-9)
    assert plan.preprocess(done, stats).collect() == done.collect()


def test_nearest_centre_ties_go_low(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (None, 1.0)], "locationLon double, locationLat double")
    got = geo.nearest_centre(df, [[0.0, 0.0], [2.0, 0.0]]).collect()
    assert [r["geo_cluster"] for r in got] == [0, 0, None]


def test_csv_keeps_line_breaks_and_quotes(spark, tmp_path):
    rows = [("a", 'one\ntwo, "three"\n'), ("b", "\n"), ("c", 'plain "q"'), ("d", "it's"), ("e", None)]
    df = spark.createDataFrame(rows, "id string, name string")
    write_csv(df.repartition(2), str(tmp_path / "breaks"))
    again = read_csv(spark, str(tmp_path / "breaks"), df.schema, escaped=True).collect()
    assert sorted((r["id"], r["name"]) for r in again) == sorted(rows)


def test_text_that_is_no_list_is_one_member(spark):
    df = spark.createDataFrame([("['b', 'a', 'b']",), ("museum",), ("{'x'}",), ("set()",), (None,)], "c string")
    got = [r["c"] for r in entities.parse_sets(df, "c").collect()]
    assert got == [["a", "b"], ["museum"], ["x"], [], []]


def test_no_spread_gives_zero(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    for std in (0.0, None):
        assert [r[0] for r in df.select(E.z_score(F.col("x"), 1.0, F.lit(std).cast("double"))).collect()] == [0.0, None]


def test_csv_round_trip_and_input_order(spark, tmp_path):
    text = 'id,name,shortDescription,categories,tags,main_image_path,tier,locationLon,locationLat,xps,Visits,Likes,Dislikes,Bookmarks\n'
    text += '''a,"Say ""hi"", all",d,"['Cine', ""L'H""]",['x'],img/a.png,1,-3.7,40.4,50,10001,5,5,1\n'''
    text += "b,B,,[],[],img/b.png,2,-3.6,40.5,100,10002,0,0,0\n"
    (tmp_path / "poi.csv").write_text(text)
    raw = entities.with_ordinal(read_csv(spark, str(tmp_path / "poi.csv"), POI_SCHEMA))
    rows = raw.orderBy("ord").collect()
    assert [r["id"] for r in rows] == ["a", "b"] and rows[0]["name"] == 'Say "hi", all' and rows[1]["shortDescription"] is None
    cleaned = plan.clean(raw)
    write_csv(cleaned, str(tmp_path / "out"))
    again = entities.parse_sets(read_csv(spark, str(tmp_path / "out"), POI_SCHEMA, escaped=True), "categories", "tags")
    assert sorted(again.collect()) == sorted(cleaned.collect())
    assert sorted(again.collect())[0]["categories"] == ["Cine", "L'H"]


@pytest.mark.parametrize("limit", [None, "-1"])
def test_rows_of_a_key_set(spark, conf, limit):
    """By bitmaps first, or straight away where nothing may be broadcast; both give the same rows, and a hot key is split."""
    if limit:
        for key, value in SPLIT_SOON.items():
            conf(f"spark.sql.{key}", value)
    names = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("n"), F.col("id").cast("string")))
    rows = spark.range(0, 60_000, 1, 16).select(names.alias("k"), (F.col("id") % 2).cast("int").alias("j"), "id", F.sha2(F.col("id").cast("string"), 256).alias("more"))
    keys = rows.where("id % 5 = 0 or id < 3").select("k", "j", F.lit(1).alias("other")).unionAll(rows.where("id < 100").select("k", "j", F.lit(2)))
    out = joins.keep_matching(rows, keys, ["k", "j"])
    got = {r.id for r in out.collect()}
    pairs = {(r.k, r.j) for r in keys.collect() if r.k is not None}
    assert got == {r.id for r in rows.collect() if (r.k, r.j) in pairs} and out.columns == rows.columns
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    if limit:
        assert "skew=true" in plan
    else:
        assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    assert joins.keep_matching(rows, keys.limit(0), ["k"]).count() == 0


def test_a_merged_row_travels_once(spark):
    df = spark.createDataFrame([(1, "a", 1, [], [f"t{k}" for k in range(50)], 3)], MERGE)
    merged = entities.merge_duplicates(df, "id", "ord", "tags", ["Visits"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Generate inline" in plan
    assert len(merged.first()["tags"]) == 50


def test_allocation_of_very_many_labels(spark):
    """The labels that get a row more are found without a window over all of them."""
    n = 30_000
    counts = spark.range(n).select(F.col("id").alias("label"), (F.col("id") % 3 + 1).cast("bigint").alias("n"))
    plans = split.allocated(counts, F.col("n"), 0.15, "test")
    plan = plans._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    got = {r.label: (r.n, r.test) for r in plans.collect()}
    total = sum(v[0] for v in got.values())
    take = -(-total * 15 // 100)
    exact = {k: v[0] * take / total for k, v in got.items()}
    base = {k: int(x) for k, x in exact.items()}
    first = sorted(exact, key=lambda k: (base[k] - exact[k], str(k)))[: take - sum(base.values())]
    assert {k: v[1] for k, v in got.items()} == {k: b + (k in set(first)) for k, b in base.items()}


def test_csv_with_breaks_is_split(spark, tmp_path):
    texts = ["a\nb", "back\\slash", "\\n", "\\\n", "\r\n", 'quote " and, comma', "ñ", "end\\"]
    df = spark.createDataFrame([(t, [t, "x"], k) for k, t in enumerate(texts)], "t string, l array<string>, k int")
    write_csv(df, str(tmp_path / "own"))
    schema = T.StructType([T.StructField("t", T.StringType()), T.StructField("l", T.StringType()), T.StructField("k", T.IntegerType())])
    rows = read_csv(spark, str(tmp_path / "own"), schema, escaped=True)
    back = rows.select("k", "t", sets.parse_list_literal(F.col("l")).alias("l")).orderBy("k").collect()
    assert [(r.t, r.l) for r in back] == [(t, [t, "x"]) for t in texts]
    assert all(len(p.read_text().splitlines()) - 1 == len(spark.read.text(str(p)).collect()) - 1 for p in (tmp_path / "own").glob("*.csv"))
    write_csv(df, str(tmp_path / "plain"), escaped=False)
    plain = read_csv(spark, str(tmp_path / "plain"), schema).orderBy("k").collect()
    assert [r.t for r in plain if r.t != "\r\n"] == [t for t in texts if t != "\r\n"]


def test_sets_and_merges_are_compiled_and_send_a_row_once(spark):
    """Sets are made without lambdas around the parsed text, and a row with one member is one row of the merge."""
    df = spark.createDataFrame([("['b', \"a\", 'b']",), ("[]",), ("['x']\n",), ("['it\\'s']",), (None,)], "t string")
    made = df.select("t", sets.to_set(sets.parse_list_literal(F.col("t"))).alias("s"))
    assert [r.s for r in made.collect()] == [["a", "b"], [], ["x"], ["it's"], []]
    text = made._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in text and "array_sort" not in text
    rows = [(k, f"k{k}", 1, ["c"], ["t"] if k else [], 3) for k in range(100)]
    merged = entities.merge_duplicates(spark.createDataFrame(rows, MERGE), "id", "ord", "tags", ["Visits"])
    assert merged.count() == 100
    found = merged.select("Visits", "xps", F.size("tags").alias("n")).groupBy("n").agg(F.sum("Visits"), F.sum("xps")).orderBy("n").collect()
    assert [tuple(r) for r in found] == [(0, 3, 1), (1, 297, 99)]
    assert "inline" in merged._jdf.queryExecution().executedPlan().toString()
    assert "transform" not in merged._jdf.queryExecution().executedPlan().toString()
