"""Parallelism for small inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(scan: DataFrame, partitions: int | None = None) -> DataFrame:
    """Redistribute the rows of a file scan over a number of partitions that the caller names.

    Rules cost far more per byte than reading, so a file that fits one split would keep one
    core busy. Without a number the scan passes unchanged, which is right for all large inputs.
    Call it on a scan, before texts are composed.
    """
    return scan.repartition(partitions) if partitions else scan
