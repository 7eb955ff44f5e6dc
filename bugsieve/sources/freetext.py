"""Free text: a string column cleaned into a staging frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bugsieve.functions import text as tx
from bugsieve.sources.staging import metadata

MAX_CHARS = 10_000


def read_freetext(
    df: DataFrame, text_col: str = "text", max_len: int = MAX_CHARS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One staging row per text. The length is checked before cleaning.

    The id is a hash of the cleaned text, so equal texts share it and replays repeat it.
    """
    if not isinstance(df.schema[text_col].dataType, T.StringType):
        raise ValueError(f"column {text_col!r} must be a string column")
    raw = F.col(text_col)
    reason = F.when(raw.isNull(), F.lit("Source must be a string")).when(
        F.length(raw) > max_len,
        F.concat(
            F.lit("Text length ("),
            F.length(raw).cast("string"),
            F.lit(f") exceeds maximum ({max_len})"),
        ),
    )
    cleaned = df.select(
        reason.alias("reject_reason"),
        F.when(reason.isNull(), tx.clean_freetext(raw)).alias("text"),
        *[F.col(c).alias(f"__keep_{c}") for c in keep],
    )
    source_id = F.concat(F.lit("freetext_"), F.xxhash64("text").cast("string"))
    return cleaned.select(
        "text",
        metadata("freetext", source_id, F.col("text")).alias("source_metadata"),
        "reject_reason",
        *[F.col(f"__keep_{c}").alias(c) for c in keep],
    )
