"""JSON path access on the ``properties`` column (F15): text, Variant or landed field."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType


def json_text(c, field: str) -> Column:
    """Top-level field as text: missing key, JSON null and unreadable text give null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.get_json_object(col, f"$.{field}")


def variant_text(c, field: str) -> Column:
    """Top-level field of a Variant as text: missing key, JSON null and null give null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_variant_get(col, f"$.{field}", "string")


def field_text(df: DataFrame, c: str, field: str) -> Column:
    """A field of the JSON column ``c`` in the cheapest form that ``df`` has: a
    column ``<c>_<field>`` written at landing, a Variant's field, or parsed text."""
    if f"{c}_{field}" in df.columns:
        return F.col(f"{c}_{field}")
    if isinstance(df.schema[c].dataType, VariantType):
        return variant_text(c, field)
    return json_text(c, field)
