"""Salted hashes of key columns."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.keyed import join_many_to_one

SALT_VARIABLE = "TIDEWELL_MASK_SALT"


def salt_from_environment() -> str:
    """The secret salt; it never has a default."""
    salt = os.environ.get(SALT_VARIABLE)
    if not salt:
        raise RuntimeError(f"set {SALT_VARIABLE} to the secret salt")
    return salt


def masked(value: Column, salt: str) -> Column:
    """SHA-256 of salt and value in hex; NULL stays NULL, so NULL keys never match each other."""
    return F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)


def mask_column(df: DataFrame, column: str, salt: str) -> DataFrame:
    """The frame with one column replaced by its hash."""
    return df.withColumn(column, masked(F.col(column), salt))


def mask_tables(tables: dict[str, tuple[DataFrame, str]], salt: str) -> dict[str, DataFrame]:
    """Mask a key column in several tables with one salt, so that joins on it still hold."""
    return {name: mask_column(df, key, salt) for name, (df, key) in tables.items()}


def join_masked(left: DataFrame, right: DataFrame, key: str, hot_share: float | None = None):
    """Inner join of two masked tables on the masked key.

    With ``hot_share``, ``right`` must hold each key once, and keys of ``left`` beyond that share
    of its rows are split over several tasks; without it AQE's skew join is relied on.
    """
    if hot_share is not None:
        return join_many_to_one(left, right, key, hot_share)
    return left.join(right, key, "inner")
