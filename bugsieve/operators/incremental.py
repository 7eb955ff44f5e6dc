"""Batches over growing inputs: only what no earlier batch has written is normalized and appended."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bugsieve.plans.normalize import content_id, normalize
from bugsieve.schema import RECORD
from bugsieve.sources.inventory import list_folder
from bugsieve.sources.staging import as_staging

_IDS = "content_id string"


def _batches(out: str, part: str) -> list[str]:
    """The finished batches of a table, by name: one folder each, which the driver lists."""
    found = []
    for path, _, _, is_folder in list_folder(f"{out}/{part}"):
        name = path.rsplit("/", 1)[-1]
        if is_folder and name.startswith("batch=") and any(
            p.rsplit("/", 1)[-1] == "_SUCCESS" for p, *_ in list_folder(path)
        ):
            found.append(name.removeprefix("batch="))
    return sorted(found)


def processed_ids(spark: SparkSession, out: str, but: str | None = None) -> DataFrame:
    """(content_id, batch): what the finished batches below ``out`` have written."""
    folders = [f"{out}/ids/batch={b}" for b in _batches(out, "ids") if b != but]
    if not folders:
        return spark.createDataFrame([], f"{_IDS}, batch string")
    return spark.read.schema(f"{_IDS}, batch string").option("basePath", f"{out}/ids").parquet(*folders)


def new_rows(staging: DataFrame, processed: DataFrame) -> DataFrame:
    """The staging rows whose content no batch has, each content once, with their ``content_id``.

    Contents are equal in source id and text. The ids alone are joined: those of the rows against
    those of the batches, on both sides without texts, and a row meets its text again only if its id
    is new. Spark broadcasts the new ids if they are few; otherwise both sides are shuffled by id.
    """
    rows = as_staging(staging).withColumn("content_id", content_id())
    fresh = rows.select("content_id").distinct().join(processed.select("content_id"), "content_id", "left_anti")
    return rows.join(fresh, "content_id", "left_semi").dropDuplicates(["content_id"])


def append_new(staging: DataFrame, out: str, batch: str, **options) -> DataFrame:
    """Normalize the accepted rows that no earlier batch has, and append their records as ``batch``.

    Below ``out``, ``records/batch=...`` holds the records and ``ids/batch=...`` their content ids; the
    ids are written last, and a batch without them does not count. So a batch that failed, or is run
    again under its name, replaces itself, and the same input under another name adds no row. One
    batch runs at a time. Rejects are left out (they are no content and come again). Returns the
    batch's records.
    """
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError("a batch is named by letters, digits, '_', '.' and '-'")
    spark = staging.sparkSession
    options = {**options, "id_mode": "content"}
    rows = new_rows(as_staging(staging).where("reject_reason IS NULL"), processed_ids(spark, out, but=batch))
    path = f"{out}/records/batch={batch}"
    bugs = normalize(rows, **options)
    bugs.write.mode("overwrite").parquet(path)
    written = spark.read.schema(bugs.schema).parquet(path)
    written.select(F.col("bug_id").alias("content_id")).write.mode("overwrite").parquet(f"{out}/ids/batch={batch}")
    return written


def read_batches(spark: SparkSession, out: str, schema: object = RECORD) -> DataFrame:
    """The records of all finished batches, with the column ``batch``."""
    folders = [f"{out}/records/batch={b}" for b in _batches(out, "ids")]
    if not folders:
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(""))
    frame = spark.read.option("basePath", f"{out}/records").schema(schema).parquet(*folders)
    return frame.withColumn("batch", F.regexp_extract("_metadata.file_path", "/batch=([^/]+)/", 1))
