"""Join helpers: a broadcast only behind a size check.

The lookup answers (the directory) are usually far smaller than the stream of
codes, but nothing bounds them in general. ``broadcast_if_small`` asks the
optimizer for the side's estimated size and hints a broadcast only under a
bound (``postalspark.broadcastMaxBytes``, default 32 MiB, far below any driver's heap); above it the join
has no hint: AQE picks from measured sizes and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_KEY = "postalspark.broadcastMaxBytes"
DEFAULT_BROADCAST_MAX = 32 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a frame (file sizes scaled through the plan)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its estimated size is within the bound, else ``df``."""
    limit = max_bytes if max_bytes is not None else int(
        df.sparkSession.conf.get(BROADCAST_MAX_KEY, str(DEFAULT_BROADCAST_MAX)))
    return F.broadcast(df) if estimated_bytes(df) <= limit else df
