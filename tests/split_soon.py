"""Settings for tests of plans."""

#: Settings under which joins of small tables are split, so that a test can see it.
SPLIT_SOON = {
    "adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "adaptive.advisoryPartitionSizeInBytes": "16k",
    "adaptive.coalescePartitions.enabled": "false",
    "shuffle.partitions": "16",
    "autoBroadcastJoinThreshold": "-1",
    "adaptive.autoBroadcastJoinThreshold": "-1",
}
