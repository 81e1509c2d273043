"""Content-addressed raw documents: one row per content, and the winner's identifier for every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import content_hash


def get_or_create(df: DataFrame, text: str, row_id: str, existing: DataFrame | None = None) -> DataFrame:
    """Adds content_hash, winner_id and created: the first row of each content, or the stored one, wins.

    ``existing``: content_hash and id of stored documents. A null text has no content and no winner.
    The smallest identifier comes from a partial aggregate, so a text with a third of all rows costs no more.
    """
    hashed = df.withColumn("content_hash", content_hash(F.col(text)))
    first = hashed.filter("content_hash is not null").groupBy("content_hash").agg(F.min(row_id).alias("first_id"))
    if existing is not None:
        first = first.join(existing.select("content_hash", F.col("id").alias("stored_id")), "content_hash", "left")
        first = first.select("content_hash", F.coalesce("stored_id", "first_id").alias("winner_id"), F.col("stored_id").isNotNull().alias("stored"))
    else:
        first = first.select("content_hash", F.col("first_id").alias("winner_id"), F.lit(False).alias("stored"))
    joined = hashed.join(first, "content_hash", "left")
    return joined.withColumn("created", F.coalesce(~F.col("stored") & (F.col("winner_id") == F.col(row_id)), F.lit(False))).drop("stored")
