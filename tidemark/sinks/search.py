"""Search-index documents: one per key, the key as document id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def documents(df: DataFrame, keys: Sequence[str], separator: str = "_") -> DataFrame:
    """``(doc_id, json)`` for an index that replaces documents of the same id.

    Rows without a complete key have no id and cannot be indexed; they are an error.
    """
    texts = [F.col(key).cast("string") for key in keys]
    complete = F.lit(True)
    for text in texts:
        complete = complete & text.isNotNull()
    doc_id = F.when(complete, F.concat_ws(separator, *texts)).otherwise(
        F.raise_error(F.lit("a document needs its whole key"))
    )
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return df.select(doc_id.alias("doc_id"), body.alias("json"))
