"""Run in a process of its own: a stack overflow in a task takes the whole JVM down."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import bugsieve as bs  # noqa: E402
from bugsieve.functions.text import redact_pii, strip_html  # noqa: E402

spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.driver.memory", "4g").getOrCreate()
)
n = 100_000
texts = [
    "".join(f"[2024-01-01T00:00:00Z] WARN [svc] line {i}\n" for i in range(n)),
    "".join(f"{i % 10}. step number {i}\n" for i in range(1, n)),
    "x-" * n + "service error",
    "a-" * 3000 + "b status. WARN [" + "a-" * 3000 + "b c",
    "[x] " + "2024-01-01 ERROR no bracket here\n" * n + "]" + "ERROR again\n" * n + "done.",
    "a" * n + "-service unavailable " + "\n" * 200,
]
df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(2)
rows = {r["i"]: r for r in bs.extract_all_fields(df).collect()}
assert rows[0]["trigger_repro_steps"]["rule_id"] == "RS-L04"
assert rows[0]["component_module"]["raw_confidence"] == 1.0
assert rows[1]["trigger_repro_steps"]["rule_id"] == "RS-S04"
assert rows[3]["component_module"]["value"] == ("a-" * 3000 + "b")[:997] + "..."
assert rows[5]["component_module"]["rule_id"] == "CM-S10"
assert rows[4]["observed_behavior"] is None
# Long runs that fail must take linear time.
runs = [
    "order-service " + "a-" * 500_000 + "z unavailable", "a-" * 500_000 + " x@y", "x@" + "a." * 500_000, "a-" * 500_000,
]
for text in runs:
    began = time.perf_counter()
    one = spark.createDataFrame([(text,)], "text string")
    bs.extract_field(one, "component_module").select(F.length(redact_pii(F.col("text"))), "component_module").collect()
    assert time.perf_counter() - began < 12, (text[:20], time.perf_counter() - began)
tags = spark.createDataFrame([("<b>x</b>" + "< y " * n,)], "t string")
assert tags.select(F.length(strip_html(F.col("t")))).first()[0] == 4 * n
print("large logs ok")
