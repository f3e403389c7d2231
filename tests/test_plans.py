"""Plans that must stay as they are for large data."""

import re

import pytest
from pyspark.sql import functions as F

from lumbre import session
from lumbre.plans import ivr
from lumbre.sources.tables import replace_table, save_bucketed, save_scratch, scratch
from lumbre.workloads import calls
from lumbre.workloads.standins import ivr_calls, ivr_detail, ivr_modules, ivr_steps

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def saved(spark):
    return save_scratch(ivr_detail(spark, FOLDER), "detail")


def test_fields_read_only_their_columns(saved):
    plan = plan_of(ivr.call_flag(saved, "masiva_lg"))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == ["calls_ivr_id:bigint,module_name:string"]
    assert plan.count("Exchange") == 1 and "HashAggregate" in plan


def test_known_document_filter_reaches_the_scan(saved):
    plan = plan_of(ivr.known_documents(saved))
    assert "PushedFilters: [Not(In(document_identification" in plan or "IsNotNull(document_identification)" in plan
    assert "WindowGroupLimit" in plan


def test_flags_over_joined_detail_do_not_read_steps(spark):
    calls, modules, steps = (f(spark, FOLDER) for f in (ivr_calls, ivr_modules, ivr_steps))
    plan = plan_of(ivr.call_flag(ivr.detail(calls, modules, steps), "masiva_lg"))
    assert "l_partkey" not in plan


@pytest.mark.parametrize("build", [ivr.recall_24h, ivr.summary])
def test_recall_builds_no_pairs(saved, build):
    plan = plan_of(build(saved))
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    near = [line for line in plan.splitlines() if re.search(r"Join \[.*phone#\d+, sec#", line)]
    assert len(near) == 1
    assert "RangeFrame" not in plan


def test_summary_joins_the_detail_once(spark):
    calls, modules, steps = (f(spark, FOLDER) for f in (ivr_calls, ivr_modules, ivr_steps))
    plan = plan_of(ivr.summary(ivr.detail(calls, modules, steps), calls))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert sum("l_returnflag" in line for line in scans) == 1
    keys = re.findall(r"(?:Sort|ObjectHash|Hash)Aggregate\(keys=\[([^\]]*)\]", plan)
    assert max(k.count("#") for k in keys) <= 3


def test_summary_of_the_named_table_does_not_shuffle_it(spark):
    detail = replace_table(ivr_detail(spark, FOLDER), "detail_of_test", "calls_ivr_id")
    again = replace_table(detail.limit(10), "other_of_test", "calls_ivr_id")
    assert replace_table(ivr_detail(spark, FOLDER), "detail_of_test", "calls_ivr_id").count() > again.count() == 10
    plan = plan_of(ivr.document_known_row(spark.table("detail_of_test")))
    assert "Exchange" not in plan


def files_of(df):
    return [f for f in df.inputFiles() if f.endswith(".parquet")]


def test_named_tables_have_one_file_a_bucket(spark, conf):
    for name in ("autoBroadcastJoinThreshold", "adaptive.autoBroadcastJoinThreshold"):
        conf(f"spark.sql.{name}", "-1")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b")  # small shuffles keep their parts
    rows = spark.range(0, 1000, 1, 8).select((F.col("id") % 100).alias("k"), "id")
    assert len(files_of(replace_table(rows, "files_of_test", "k"))) == 4
    for sink in (calls.sink_ctas_detail, calls.sink_ctas_summary):
        assert len(files_of(sink(spark, FOLDER))) == 4
    assert len(files_of(spark.table("ivr_summary_source"))) == 4


def test_steps_first_gives_the_same_detail(spark):
    calls, modules, steps = (f(spark, FOLDER) for f in (ivr_calls, ivr_modules, ivr_steps))
    some = F.when(F.col("ivr_id") > 50, F.col("ivr_id")).alias("ivr_id")
    odd = modules.unionAll(modules.select(some, *modules.columns[1:]))
    for salt in (False, True):
        one, other = (save_scratch(ivr.detail(calls, odd, steps, salt, 0.001, 2, steps_first=w), "ways") for w in (False, True))
        assert one.columns == other.columns and one.count() == other.count() > 0
        assert one.exceptAll(other).isEmpty()


def test_steps_are_shuffled_once_and_without_their_texts(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(ivr_detail(spark, FOLDER, steps_first=True))
    assert plan.count("Exchange") == 4
    below = plan[plan.index("Window [row_number()") :]
    assert "OTHER.TX" not in below


def test_lines_dealt_by_call_are_shuffled_once_each(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    with ivr.dealt_by_call(spark):
        detail = ivr_detail(spark, FOLDER, steps_first=True, by_call=True)
        plan = plan_of(detail)
        saved = save_scratch(detail, "by-call")
    assert re.findall(r"Exchange hashpartitioning\(([^,]*)#", plan) == ["ivr_id"] * 3 and plan.count("Exchange") == 3
    other = ivr_detail(spark, FOLDER)
    assert saved.columns == other.columns and saved.count() == other.count() > 0 and saved.exceptAll(other).isEmpty()


def test_texts_of_steps_of_odd_keys(spark, tmp_path):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").limit(8).drop("l_suppkey", "l_partkey", "l_linenumber").collect()
    rows = [(k, k, 1 + i, *r) for i, (k, r) in enumerate(zip((-3, None, 0, 1, 2, 3, 4, 5), lines))]
    schema = "l_suppkey bigint, l_partkey bigint, l_linenumber int, l_orderkey bigint, l_quantity double, l_extendedprice double, "
    schema += "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {(r.document_identification, r.document_type, r.customer_phone) for r in ivr_steps(spark, str(tmp_path)).collect()}
    unknown, other = ("UNKNOWN",) * 2, ("DESCONOCIDO",) * 2
    assert got == {
        (None, None, "UNKNOWN"), (None, None, None), (*unknown, "UNKNOWN"), (*other, "P1"), ("D3", "DNI", "UNKNOWN"), (*unknown, "P4"), (*other, None)
    }


def test_summary_comes_dealt_by_bucket(spark, saved, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    bucket = F.pmod(F.hash("calls_ivr_id"), F.lit(4))
    tasks = ivr.summary(saved).select(bucket.alias("bucket"), F.spark_partition_id().alias("task")).distinct().collect()
    assert len({r.task for r in tasks}) == len({r.bucket for r in tasks}) == len(tasks) == 4


def test_dealt_rows_of_more_buckets_than_open_files(spark):
    rows = spark.range(0, 5000, 1, 1).withColumn("text", F.sha2(F.col("id").cast("string"), 256))
    table = save_bucketed(rows, "many_buckets_of_test", 100, "id", dealt=True)
    assert len(files_of(table)) == 100 and table.count() == 5000 and table.exceptAll(rows).isEmpty()


def test_a_replaced_table_keeps_its_readers_and_survives_a_failed_write(spark):
    def rows(n):
        return spark.range(n).select(F.col("id").alias("k"))

    open_reader = replace_table(rows(100), "versions_of_test", "k")
    assert replace_table(rows(7), "versions_of_test", "k").count() == 7
    assert open_reader.count() == 100 and spark.table("versions_of_test").count() == 7
    bad = rows(5).withColumn("k", F.when(F.col("k") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("k")).cast("bigint"))
    with pytest.raises(Exception):
        replace_table(bad, "versions_of_test", "k")
    assert spark.table("versions_of_test").count() == 7
    # a table may be made from what it holds now
    assert replace_table(spark.table("versions_of_test").unionAll(rows(2)), "versions_of_test", "k").count() == 9
    versions = [t.name for t in spark.catalog.listTables() if t.name.startswith("versions_of_test__")]
    assert len(versions) == 2
    spark.sql("CREATE TABLE plain_of_test (k BIGINT) USING parquet")
    assert replace_table(rows(3), "plain_of_test", "k").count() == 3


def test_scratch_ends_with_its_scope(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_dir", lambda spark: f"file://{tmp_path}/shared")

    def left():
        return {p.name.rsplit("-", 1)[0] for p in (tmp_path / "shared").iterdir()}

    with scratch(spark) as outer:
        with scratch(spark) as inner:
            first = save_scratch(spark.range(10), "first")
            second = save_scratch(first.where("id > 2"), "second")
            result = inner.keep(second.join(save_scratch(spark.range(5), "third"), "id"))
        assert left() == {"second", "third"} and result.count() == 2
        with pytest.raises(ZeroDivisionError), scratch(spark) as failed:
            failed.keep(save_scratch(spark.range(1), "fourth"))
            raise ZeroDivisionError
        assert left() == {"second", "third"}
        more = save_scratch(spark.range(3), "fifth")
        outer.drop(more)
        assert left() == {"second", "third"}
    assert left() == set()
    kept = save_scratch(spark.range(3), "sixth")
    assert left() == {"sixth"} and kept.count() == 3


def test_operators_leave_what_their_result_reads(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))

    def left():
        return sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir())

    calls = ivr.prefix_calls(ivr_calls(spark, FOLDER))
    ivr.recall_24h(calls).count()
    assert left() == ["recall-local", "starts"]


def test_references_read_each_table_once(spark):
    from lumbre.operators import audit
    from lumbre.sources.tables import scan

    keys = [audit.Reference("lineitem", "l_partkey", "part", "p_partkey"), audit.Reference("lineitem", "l_orderkey", "orders", "o_orderkey")]
    plan = plan_of(audit.references({n: scan(spark, FOLDER, n) for n in ("lineitem", "part", "orders")}, keys))
    assert plan.count("FileScan parquet") == 3 and "Join" not in plan


def test_no_scratch_on_one_machine_of_a_cluster():
    from lumbre.session import shared_dir

    class Session:
        def __init__(self, **conf):
            self.conf = {k.replace("_", "."): v for k, v in conf.items()}

    assert shared_dir(Session(spark_checkpoint_dir="hdfs:///x/")) == "hdfs:///x"
    assert shared_dir(Session(spark_master="local[4]")).endswith("lumbre-shared")
    assert shared_dir(Session(spark_master="yarn", spark_hadoop_fs_defaultFS="hdfs://n")) == "hdfs://n/tmp/lumbre-shared"
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_dir(Session(spark_master=master))


#: So that a few thousand rows of one id count as skewed, and nothing is broadcast.
SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.mark.parametrize("field", ["with_document", "summary"])
def test_an_id_of_many_calls_is_not_gathered(spark, field):
    from pyspark.sql import functions as F

    old = {k: spark.conf.get(k, None) for k in SPLIT}
    hot = F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 7 == 0, None).otherwise(F.col("id"))
    rows = spark.range(0, 30_000, 1, 64).select(hot.alias("calls_ivr_id"), "id")
    names = [*ivr.SUMMARY_KEYS[1:], "calls_vdn_label", *ivr.MODULE_COLUMNS, *ivr.STEP_COLUMNS]
    text = {n: F.concat(F.lit(n), F.col("id").cast("string")) for n in names if n != "vdn_aggregation"}
    text |= {"calls_start_date": F.timestamp_seconds(F.col("id")), "module_sequece": F.col("id"), "step_sequence": F.lit(1)}
    detail = save_scratch(rows.withColumns(text), f"many_calls_{field}").drop("id")
    try:
        for k, v in SPLIT.items():
            spark.conf.set(k, v)
        out = getattr(ivr, field)(detail)
        got = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(got) == 30_000 and "skew=true" in plan and "collect_set" not in plan
    last = {r.document_identification for r in got if r.calls_ivr_id == -1}
    assert last == {"document_identification29997"}
    known = [r for r in got if r.calls_ivr_id is not None]
    assert all(r.document_identification == f"document_identification{max(r.calls_ivr_id, 29997 * (r.calls_ivr_id < 0))}" for r in known)


def test_the_package_can_be_shipped(spark, tmp_path):
    """From another folder, without the library on the path of the workers."""
    import subprocess
    import sys

    archive = session.ship(spark)
    code = "import lumbre.operators.kmeans as k; print(k.__file__)"
    shown = subprocess.run([sys.executable, "-c", f"import sys; sys.path.insert(0, {archive!r}); {code}"], cwd=tmp_path, capture_output=True, text=True)
    assert archive in shown.stdout, shown.stderr


def test_queries_without_the_packages_of_the_training_data_operators(monkeypatch):
    import sys

    import __spark_entry__ as entry

    from lumbre.workloads import CASES

    for name in [m for m in sys.modules if m.startswith("lumbre.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "regex", None)
    assert set(entry.queries()) == set(CASES)
