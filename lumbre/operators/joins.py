"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre.sources.tables import save_scratch, scratch

#: A key is hot when it holds more than this share of the rows, so there are at most 1000 of them ...
HOT_SHARE = 0.001
#: ... and more than this many rows; below it one task copes and no salting is wanted.
HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE, min_rows: int = HOT_ROWS) -> DataFrame:
    """Keys that dominate ``df`` with the number of parts to cut each into.

    A mergeable top-k sketch over hashes of the keys names at most ``1 / share`` candidates whatever the size of
    ``df``; only their rows are counted, under their own types, so every key listed here is in ``df``. A key the
    sketch misses is merely not salted.
    """
    limit = int(1 / share)
    hashed = df.dropna(subset=keys).select(*keys, F.xxhash64(*keys).alias("_hash"))
    top = hashed.agg(F.expr(f"approx_top_k(_hash, {limit}, {limit * 20})").alias("top"), F.count(F.lit(1)).alias("total"))
    floor = F.greatest(F.col("total") * F.lit(share), F.lit(float(min_rows)))
    likely = top.select(F.explode("top").alias("t"), floor.alias("_floor")).where(F.col("t.count") > F.col("_floor"))
    likely = F.broadcast(likely.select(F.col("t.item").alias("_hash"), "_floor"))
    return (
        hashed.join(likely, "_hash")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.max("_floor").alias("_floor"))
        .where(F.col("_n") > F.col("_floor"))
        .select(*keys, F.ceil(F.col("_n") / F.col("_floor")).cast("int").alias("_parts"))
    )


def left_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    salt: bool = False,
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left outer equi-join whose right side may be dominated by a few keys.

    Spark's adaptive skew join can cut the preserved (left) side of an outer join but never the
    other one. With ``salt`` the rows of hot right keys are therefore spread over parts by a hash of the row, and
    left rows with such a key are repeated once per part. A hot key has matches by definition, so a
    repeated left row that finds none in its part is dropped, which keeps the result exact.

    Whether to salt is the caller's choice: it costs a pass over the right side, and both ways give the same rows.
    """
    if not salt:
        return left.join(right, keys, "left")
    hot = F.broadcast(hot_keys(right, keys, share, min_rows))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    spread = (
        left.join(hot, keys, "left")
        .withColumn("_parts", parts)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    )
    cut = (
        right.dropna(subset=keys)
        .join(hot, keys, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*right.columns), parts.cast("bigint")).cast("int"))
        .drop("_parts")
        .withColumn("_hit", F.lit(True))
    )
    joined = spread.join(cut, [*keys, "_salt"], "left").where(F.col("_hit").isNotNull() | (F.col("_parts") == 1))
    return joined.drop("_salt", "_parts", "_hit")


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Join condition in which NULL keys equal each other."""
    return functools.reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


#: Bits per key of the bitmaps that rows are looked up in first; one in so many of the other rows passes.
BITS_PER_KEY = 16
#: Bits of one bitmap, as Spark's bitmap functions have it.
_BITMAP_BITS = 32768


def key_bitmaps(keys: DataFrame, on: list[str], n: int) -> tuple[DataFrame, Column, Column]:
    """Bitmaps of hashed keys by bucket, and for a row its bucket and its place in the bucket's bitmap."""
    bits = max(_BITMAP_BITS, 1 << math.ceil(math.log2(max(1, n) * BITS_PER_KEY)))
    spot = F.pmod(F.xxhash64(*on), F.lit(bits)) + 1
    bucket, place = F.bitmap_bucket_number(spot), F.bitmap_bit_position(spot)
    maps = keys.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(place).alias("_bitmap"))
    return maps, bucket, place


def _bit(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int"))


def keep_matching(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys`` (NULL keys match nothing), each as often as it is there.

    The distinct keys are written, so that their size is known and, where the join shuffles, adaptive execution can
    split the rows of a hot key. Hashed keys also make bitmaps, two bytes a key; while these fit under the session's
    broadcast threshold, rows are looked up in them before anything is shuffled, and only those that may match are
    joined. Larger key sets are joined straight away.
    """
    spark = df.sparkSession
    with scratch(spark) as scope:
        known = save_scratch(keys.select(*on).dropna().distinct(), "keys")
        n = known.count()
        rows = df
        if 0 < n * BITS_PER_KEY / 8 * 2 <= _broadcast_limit(spark):
            maps, bucket, place = key_bitmaps(known, on, n)
            maps = F.broadcast(save_scratch(maps, "bitmaps"))
            rows = df.withColumn("_at", bucket).join(maps, F.col("_at") == F.col("_bucket")).where(_bit(F.col("_bitmap"), place) == 1)
            rows = rows.drop("_at", "_bucket", "_bitmap")
        renamed = known.withColumnsRenamed({k: f"_key_{k}" for k in on})
        same = functools.reduce(lambda a, b: a & b, (F.col(k) == F.col(f"_key_{k}") for k in on))
        return scope.keep(rows.join(renamed, same, "left_semi"))


def _broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes; 0 where it is off."""
    return max(0, int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()))


def update_from(df: DataFrame, updates: DataFrame, on: str, columns: list[str]) -> DataFrame:
    """Left join by key and take the update where there is one, else the original value.

    Float updates of whole-number columns are rounded half to even and cast back.
    """
    renamed = updates.select(on, *[F.col(c).alias(f"{c}_agg") for c in columns])
    joined = df.join(renamed, on, "left")
    merged = {}
    for c in columns:
        new = F.col(f"{c}_agg")
        if isinstance(df.schema[c].dataType, T.IntegralType) and isinstance(updates.schema[c].dataType, T.FractionalType):
            new = F.rint(new).cast(df.schema[c].dataType)
        merged[c] = F.coalesce(new, F.col(c))
    return joined.withColumns(merged).select(*df.columns)
