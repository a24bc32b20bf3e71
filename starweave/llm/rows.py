"""A stable key for every row of a document table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def keyed_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, text): ``row`` is the id where ids are unique and not null;
    otherwise the rows are numbered and written once, so that each row keeps
    its number however often a lost task is run again."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    odd = docs.groupBy("id").count().filter("id is null or count > 1")
    if odd.isEmpty():
        return docs.select(F.col("id").alias("row"), "id", "text")
    return cut_lineage(docs.select(F.monotonically_increasing_id().alias("row"), "id", "text"))
