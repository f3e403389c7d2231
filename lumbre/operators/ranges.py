"""Rows dealt into numbered ranges of about equal size, so that no key decides how much one task gets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ranges per shuffle partition, so that tasks that get several of them come out even.
RANGES_PER_TASK = 16


def ranged(df: DataFrame, order: list[str], part: str = "part") -> DataFrame:
    """``df`` dealt into ranges in the given order, with the number of each row's range.

    Their bounds come from Spark's sample of the rows. Equal keys share a range. Numbers hold for one run of the plan:
    write what is to be read twice.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(tasks * RANGES_PER_TASK, *order).withColumn(part, F.spark_partition_id()).coalesce(tasks)
