"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared folder that ``spark.checkpoint.dir`` names or, where that is
    unset, as in a session on one machine, in the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    shared = shared or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: its lineage ends there and survives executors."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def free_names(frame: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them where the frame has such columns."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def columns_of(frame: DataFrame, but: tuple[str, ...] = ()) -> list[Column]:
    """The frame's columns, less those of the given names."""
    return [F.col(f"`{c}`") for c in frame.columns if c.lower() not in but]


def per_worker(name: str, make: Callable[[], object]) -> object:
    """A value that a Python worker makes once and keeps for its later tasks."""
    module = sys.modules.setdefault("_bugsieve_worker", types.ModuleType("_bugsieve_worker"))
    if not hasattr(module, name):
        setattr(module, name, make())
    return getattr(module, name)


def release_memory() -> None:
    """Give freed memory back to the system: a Python worker waits for its next task idle."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def appended(
    frame: DataFrame, inputs: list[str], fields: list[T.StructField],
    work: Callable[..., list[pa.Array]], rows: int = 1_000,
) -> DataFrame:
    """The frame with columns more, made by ``work`` from the input columns, ``rows`` at a time."""
    places = [frame.columns.index(c) for c in inputs]
    names = [*frame.columns, *(f.name for f in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                made = work(*(part.column(i) for i in places))
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=names)
        release_memory()

    return frame.mapInArrow(run, T.StructType([*frame.schema.fields, *fields]))
