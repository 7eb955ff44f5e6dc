"""Where jobs put checkpoints and intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder the session names in ``spark.checkpoint.dir`` or,
    where that is unset, below the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
