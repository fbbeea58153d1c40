"""Display formatting of result cells (X19): NULL -> 'NULL', floats with two
decimals, everything else as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType


def display_rows(df: DataFrame) -> DataFrame:
    """Every cell of ``df`` as its display text, under the same column names."""
    return df.select(*[display_value(f.name, f.dataType).alias(f.name) for f in df.schema.fields])


def display_value(name: str, dtype: DataType) -> Column:
    c = F.col(name)
    if isinstance(dtype, (DoubleType, FloatType, DecimalType)):
        # format_string renders a NULL argument as a cut-off 'null'; test first
        text = F.when(c.isNotNull(), F.format_string("%.2f", c.cast("double")))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit("NULL"))
