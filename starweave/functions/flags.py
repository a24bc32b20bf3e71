"""0/1 integer flags and booleans."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(cond: Column) -> Column:
    """1 when cond is true, 0 when false or null (``iff`` semantics)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def bool_flag(cond: Column) -> Column:
    """true when cond is true, false when false or null."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def is_in_flag(c, values) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return flag(col.isin(list(values)))


def notnull_flag(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.isNotNull().cast("int")
