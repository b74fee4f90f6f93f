"""Small results that are computed once."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def kept(frame: DataFrame) -> DataFrame:
    """Compute a small result once for everything that reads it.

    It stands for scans over whole tables, so on a cluster it is checkpointed to the
    shared folder the session names: losing an executor must not repeat those scans.
    Without a checkpoint folder it is cached.
    """
    context = frame.sparkSession.sparkContext._jsc.sc()
    if frame.sparkSession.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir().isDefined():
        return frame.checkpoint()
    return frame.persist(StorageLevel.MEMORY_AND_DISK)
