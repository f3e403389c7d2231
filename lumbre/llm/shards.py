"""Weighted rendezvous hashing of record keys over shards.

Every shard draws a number from the record's key; with the shard's weight it gives a score, and the best score takes
the record. A further shard only takes records it wins, so no record moves between the others, and a shard of twice
the weight gets twice the records.

Keys are compared as text. A null key is a key of its own (all such rows share a shard). Rows without a text count
as empty. Repeated rows get the same shard and different slots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbre.sources.tables import save_scratch

#: Rows that one task numbers.
ROWS_PER_TASK = 500_000


def score(key: Column, shard: int, weight: float) -> Column:
    """weight / -ln(u) with u in (0, 1) from the MD5 of key and shard: the rendezvous score."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{shard}")).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    return F.lit(float(weight)) / -F.ln(u)


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard with the highest score; of equal scores the lower number."""
    if not weights or min(weights) <= 0:
        raise ValueError("shards need positive weights")
    text = F.coalesce(key.cast("string"), F.lit(""))
    scores = [F.struct(score(text, k, w).alias("score"), F.lit(-k).alias("shard")) for k, w in enumerate(weights)]
    best = F.array_max(F.array(*scores)) if len(scores) > 1 else scores[0]
    return -best["shard"]


def numbered(df: DataFrame, group: str, order: Sequence[str], slot: str = "slot") -> DataFrame:
    """Gapless numbers from 0 within each group, in the given order, without one task per group.

    Rows are range-partitioned by group and order, written, counted per partition and numbered from the count
    of the partitions before. Ties get any order among themselves, fixed by the written table.
    """
    spark = df.sparkSession
    tie, part = "__row", "__part"
    keyed = save_scratch(df.withColumn(tie, F.monotonically_increasing_id()), "rows")
    tasks = max(1, -(-keyed.count() // ROWS_PER_TASK), int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [group, *order, tie]
    ranged = keyed.repartitionByRange(tasks, *keys).withColumn(part, F.spark_partition_id())
    ranged = save_scratch(ranged, "ranged")
    sizes = ranged.groupBy(group, part).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(group, part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy(group, part).orderBy(*order, tie)
    out = ranged.withColumn(slot, F.row_number().over(within) - 1).join(sizes, [group, part])
    return out.withColumn(slot, (F.col(slot) + F.col("__before")).cast("long")).drop(tie, part, "__before")
