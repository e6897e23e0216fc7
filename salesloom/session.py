"""Session settings that fit a cluster and the data it shuffles."""

from __future__ import annotations

import math

MIB = 1024 * 1024
# Shuffled bytes per task: several tasks of this size fit in one executor without spilling.
TASK_BYTES = 200 * MIB


def settings_for(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings for jobs that shuffle about ``shuffle_bytes`` on ``cores`` executor cores.

    Spark's adaptive execution merges small shuffle partitions but never adds any, so their
    number has to fit the largest shuffle. Where ``spark.checkpoint.dir`` points is up to the
    cluster.
    """
    partitions = max(2 * cores, math.ceil(shuffle_bytes / TASK_BYTES))
    # Larger scan tasks once there are many times more blocks than cores.
    block = 128 if shuffle_bytes / (128 * MIB) < 20 * cores else 512
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(block * MIB),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
