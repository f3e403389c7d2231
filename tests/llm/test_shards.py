import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from lumbre.llm.query_shards import SHARDS, _best, op6_rendezvous
from lumbre.llm.shards import numbered, shard_of
from tests.llm.conftest import SF


def test_query_as_plainly_computed(spark, documents):
    rows = op6_rendezvous(spark, SF).collect()
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
    sql = f"SELECT doc_id, {_best(SHARDS)}, {_best(SHARDS + 1)} FROM '{SF}/documents.parquet'"
    assert {(r.doc_id, r.shard, r.grown_shard) for r in rows} == set(duckdb.sql(sql).fetchall())
    for shard in range(SHARDS):
        own = sorted((r.slot, r.doc_id) for r in rows if r.shard == shard)
        assert [s for s, _ in own] == list(range(len(own)))
        assert [d for _, d in own] == sorted(d for _, d in own)


def test_a_new_shard_only_takes(spark):
    rows = spark.range(5000).select(shard_of(F.col("id"), [1.0] * 5).alias("a"), shard_of(F.col("id"), [1.0] * 6).alias("b")).collect()
    assert all(r.a == r.b or r.b == 5 for r in rows)
    assert 600 < sum(r.b == 5 for r in rows) < 1100


def test_weights_share_out_the_rows(spark):
    counts = dict(spark.range(20000).groupBy(shard_of(F.col("id"), [1.0, 3.0]).alias("s")).count().collect())
    assert 0.72 < counts[1] / 20000 < 0.78
    with pytest.raises(ValueError):
        shard_of(F.col("id"), [1.0, 0.0])


def test_odd_and_empty_tables(odd, none):
    for df in (odd, none):
        placed = numbered(df.withColumn("shard", shard_of(F.col("doc_id"), [1.0] * 3)), "shard", ["doc_id"]).collect()
        assert len(placed) == df.count()
        for shard in range(3):
            slots = sorted(r.slot for r in placed if r.shard == shard)
            assert slots == list(range(len(slots)))
        for key in (5, None):
            assert len({r.shard for r in placed if r.doc_id == key}) <= 1
