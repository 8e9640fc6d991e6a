"""Flattening nested columns, and wall-clock conversion at any depth."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.clock import wall_clock
from tidewell.functions.text import quoted

# Column metadata that marks a text field as a date-time with offset.
ZONED = {"logical": "zoned_timestamp"}


def columns_of_type(df: DataFrame, *kinds: type) -> list[str]:
    """Names of the columns with one of the given Spark types."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def _checked(names: list[str]) -> None:
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"flattening gives equal column names: {clashes}")


def flatten_structs(df: DataFrame, columns=None) -> DataFrame:
    """Fields of each struct as ``parent_child`` columns after the other columns."""
    columns = list(columns or columns_of_type(df, T.StructType))
    kept = [c for c in df.columns if c not in columns]
    fields = [(s, f) for s in columns for f in df.schema[s].dataType.fieldNames()]
    _checked(kept + [f"{s}_{f}" for s, f in fields])
    return df.select(
        *[F.col(quoted(c)) for c in kept],
        *[F.col(f"{quoted(s)}.{quoted(f)}").alias(f"{s}_{f}") for s, f in fields],
    )


def explode_arrays(df: DataFrame, columns=None, mode: str = "explode") -> DataFrame:
    """One row per element, array by array; two arrays multiply.

    ``explode`` drops rows whose array is NULL or empty, ``outer`` keeps them with NULL.
    """
    if mode not in ("explode", "outer"):
        raise ValueError(f"unknown mode {mode}")
    generate = F.explode if mode == "explode" else F.explode_outer
    for c in columns or columns_of_type(df, T.ArrayType):
        df = df.withColumn(c, generate(F.col(quoted(c))))
    return df


def explode_maps(df: DataFrame, columns=None, mode: str = "explode") -> DataFrame:
    """One row per map entry, as ``<c>_key`` and ``<c>_value``; one map at a time."""
    generate = F.explode if mode == "explode" else F.explode_outer
    for c in columns or columns_of_type(df, T.MapType):
        kept = [x for x in df.columns if x != c]
        _checked([*kept, f"{c}_key", f"{c}_value"])
        df = df.select(
            *[F.col(quoted(x)) for x in kept],
            generate(F.col(quoted(c))).alias(f"{c}_key", f"{c}_value"),
        )
    return df


def distinct_map_keys(df: DataFrame, column: str) -> DataFrame:
    """The keys that occur in a map column."""
    return df.select(F.explode(F.map_keys(F.col(quoted(column)))).alias("key")).distinct()


def map_keys_as_columns(
    df: DataFrame, keys: dict[str, list] | None = None, columns=None, max_keys: int | None = None
) -> DataFrame:
    """Each map key as a column named by it, after the other columns.

    Give ``keys``, or say with ``max_keys`` how many columns the caller is ready for: more keys than
    that are an error, none is left out. Maps with any number of keys go to ``explode_maps``.
    """
    keys = dict(keys or {})
    columns = list(columns or columns_of_type(df, T.MapType))
    for c in columns:
        if c not in keys:
            if max_keys is None:
                raise ValueError(f"give the keys of map {c}, or max_keys")
            found = distinct_map_keys(df, c).limit(max_keys + 1).collect()
            if len(found) > max_keys:
                raise ValueError(f"map {c} has more than {max_keys} keys; use explode_maps")
            keys[c] = sorted(r["key"] for r in found)
    kept = [c for c in df.columns if c not in columns]
    _checked(kept + [str(k) for c in columns for k in keys[c]])
    return df.select(
        *[F.col(quoted(c)) for c in kept],
        *[
            F.try_element_at(F.col(quoted(c)), F.lit(k)).alias(str(k))
            for c in columns
            for k in keys[c]
        ],
    )


def flatten(
    df: DataFrame, maps: str = "columns", mode: str = "explode", max_keys: int | None = None
) -> DataFrame:
    """Flatten until no array, struct or map is left; each round takes them in that order.

    ``maps`` is ``columns`` (a column per key, at most ``max_keys``) or ``rows`` (a row per entry).
    Two arrays of one row multiply.
    """
    while columns_of_type(df, T.ArrayType, T.StructType, T.MapType):
        if columns_of_type(df, T.ArrayType):
            df = explode_arrays(df, mode=mode)
        if columns_of_type(df, T.StructType):
            df = flatten_structs(df)
        if columns_of_type(df, T.MapType):
            df = (
                map_keys_as_columns(df, max_keys=max_keys)
                if maps == "columns"
                else explode_maps(df, mode=mode)
            )
    return df


def tag_zoned(df: DataFrame, columns) -> DataFrame:
    """Mark text columns as date-times with offset."""
    for c in columns:
        df = df.withMetadata(c, {**df.schema[c].metadata, **ZONED})
    return df


def _is_zoned(field: T.StructField, path: str, declared: set[str]) -> bool:
    tagged = field.metadata.get("logical") == ZONED["logical"]
    return (tagged or path in declared) and isinstance(field.dataType, T.StringType)


def _converter(data_type, path: str, declared: set[str]) -> Callable[[Column], Column] | None:
    """A function that converts a value of this type, or None if nothing below is zoned."""
    if isinstance(data_type, T.StructType):
        parts = {}
        for f in data_type.fields:
            below = f"{path}.{f.name}" if path else f.name
            found = (
                wall_clock
                if _is_zoned(f, below, declared)
                else _converter(f.dataType, below, declared)
            )
            if found:
                parts[f.name] = found
        if not parts:
            return None

        def convert(value: Column) -> Column:
            fields = [
                (parts[f.name](value.getField(f.name)) if f.name in parts else value.getField(f.name))
                .alias(f.name, metadata=_untagged(f.metadata))
                for f in data_type.fields
            ]
            return F.when(value.isNotNull(), F.struct(*fields))

        return convert
    if isinstance(data_type, T.ArrayType):
        element = _element_converter(data_type.elementType, path, declared)
        return (lambda v: F.transform(v, element)) if element else None
    if isinstance(data_type, T.MapType):
        element = _element_converter(data_type.valueType, path, declared)
        return (lambda v: F.transform_values(v, lambda _, x: element(x))) if element else None
    return None


def _element_converter(data_type, path: str, declared: set[str]):
    inner = f"{path}[]"
    if isinstance(data_type, T.StringType):
        return wall_clock if inner in declared else None
    return _converter(data_type, inner, declared)


def _untagged(metadata: dict) -> dict:
    return {k: v for k, v in metadata.items() if k != "logical"}


def convert_wall_clock(df: DataFrame, columns=(), enabled: bool = True) -> DataFrame:
    """Zoned date-time texts to their local time as TIMESTAMP_NTZ, at any depth.

    A field is zoned if its metadata says so or its path is listed, such as ``after.changed_at``
    or ``items[].at``. Other fields, and the metadata of all, stay as they are; a field that is
    already a timestamp passes through.
    """
    if not enabled:
        return df
    declared = set(columns)
    out = []
    for f in df.schema.fields:
        value = F.col(quoted(f.name))
        if _is_zoned(f, f.name, declared):
            out.append(wall_clock(value).alias(f.name, metadata=_untagged(f.metadata)))
            continue
        convert = _converter(f.dataType, f.name, declared)
        out.append(convert(value).alias(f.name, metadata=f.metadata) if convert else value)
    return df.select(*out)


def decode_wide_decimal(column: Column, scale: int) -> Column:
    """Bytes of a decimal beyond 38 digits (big-endian two's complement) as exact text.

    No built-in goes past 38 digits, so this one expression uses an Arrow-batched function.
    """

    @F.pandas_udf(T.StringType())
    def decode(values: pd.Series) -> pd.Series:
        return values.map(lambda raw: _unscaled_text(bytes(raw), scale), na_action="ignore")

    return decode(column)


def _unscaled_text(raw: bytes, scale: int) -> str:
    number = int.from_bytes(raw, "big", signed=True)
    digits = str(abs(number)).rjust(scale + 1, "0")
    sign = "-" if number < 0 else ""
    return sign + (f"{digits[:-scale]}.{digits[-scale:]}" if scale else digits)
