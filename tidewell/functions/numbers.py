"""Number helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.text import quoted


def trade_total(quantity: Column, price: Column) -> Column:
    """Quantity times price, exact to cents."""
    return (quantity.cast("decimal(18,2)") * price.cast("decimal(18,2)")).cast("decimal(28,2)")


def cash_total(quantity: Column, price: Column, commission: Column) -> Column:
    """Quantity times price plus commission, exact to cents."""
    return (trade_total(quantity, price) + commission.cast("decimal(18,2)")).cast("decimal(28,2)")


def megabytes(size: Column) -> Column:
    return F.round(size / F.lit(1024 * 1024), 2)


def decimals_to_text(df: DataFrame) -> DataFrame:
    """Every decimal column as text; the other columns and the order stay."""
    return df.select(
        *[
            F.col(quoted(f.name)).cast("string").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )
