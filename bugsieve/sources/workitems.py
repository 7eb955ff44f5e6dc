"""Issue-tracker work items: JSON objects composed into labelled texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bugsieve.functions import text as tx
from bugsieve.sources.staging import metadata

_ITEM = "id string, fields map<string,string>, _bad string"


def read_ado(df: DataFrame, json_col: str = "json", keep: tuple[str, ...] = ()) -> DataFrame:
    """One staging row per work item given as JSON text.

    Values that are not strings are taken as their JSON text.
    """
    raw = F.col(json_col)
    item = F.from_json(raw, _ITEM, {"columnNameOfCorruptRecord": "_bad"})
    # The one-row generator keeps a filter on rejects above the parser, which would run twice.
    parsed = df.select(
        *[F.col(c).alias(f"__keep_{c}") for c in keep],
        F.inline(
            F.array(
                F.struct(
                    raw.alias("__raw"),
                    F.when(F.ltrim(raw).startswith("{"), item).alias("__item"),
                )
            )
        ),
    )
    is_item = F.col("__item").isNotNull() & F.col("__item._bad").isNull()
    # An id that is present but null is written as the text None, an absent one as unknown.
    null_id = F.coalesce(
        F.array_contains(F.json_object_keys("__raw"), "id"), F.lit(False)
    )
    composed = parsed.select(
        F.when(
            is_item,
            F.coalesce(F.col("__item.id"), F.when(null_id, F.lit("None")).otherwise(F.lit("unknown"))),
        ).alias("__id"),
        F.when(is_item, tx.compose_work_item(F.col("__item.fields"))).alias("composed"),
        F.when(~is_item, F.lit("ADO source must be a dictionary")).alias("reject_reason"),
        *[f"__keep_{c}" for c in keep],
    )
    stripped = composed.withColumn("text", tx.strip_html(F.col("composed")))
    return stripped.select(
        "text",
        metadata(
            "ado_bug",
            F.concat(F.lit("ado_"), F.col("__id")),
            F.col("text"),
            work_item_id=F.col("__id"),
        ).alias("source_metadata"),
        "reject_reason",
        *[F.col(f"__keep_{c}").alias(c) for c in keep],
    )
