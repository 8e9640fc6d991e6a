"""Change events: envelope, image choice, op codes, applying a log, audit, schema changes."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.clock import wall_literal
from tidewell.functions.codes import operation_code
from tidewell.functions.text import quoted
from tidewell.operators.keyed import absent_by_key, as_list, latest_per_key, split_null_keys, upsert_by_key

# Offsets of commit number and log position from the row id, and what later
# operations add to them.
CSN_BASE = 100000000
POS_BASE = "20000000000000000000"
OPERATION_OFFSET = {"I": 0, "U": 1000, "D": 2000}


def image_struct(df: DataFrame, columns=None) -> Column:
    """A row image from columns of ``df``."""
    return F.struct(*[F.col(quoted(c)) for c in (columns or df.columns)])


def changed_image(image: Column, changes: dict[str, Column]) -> Column:
    """``image`` with some fields replaced."""
    for name, value in changes.items():
        image = image.withField(quoted(name), value)
    return image


def commit_number(key: Column, op: Column | None = None) -> Column:
    """Commit number as text: the base plus the key, plus the offset of the operation if given."""
    number = key.cast("long") + F.lit(CSN_BASE).cast("long")
    if op is not None:
        number = number + _operation_offset(op)
    return number.cast("string")


def log_position(key: Column, op: Column | None = None) -> Column:
    """Log position as text; it outgrows a long, so the sum is a decimal."""
    number = key.cast("decimal(37,0)") + F.expr(f"{POS_BASE}BD")
    if op is not None:
        number = number + _operation_offset(op)
    return number.cast("decimal(38,0)").cast("string")


def _operation_offset(op: Column) -> Column:
    pairs = [F.lit(x) for item in OPERATION_OFFSET.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), op), F.lit(0))


def build_envelope(
    df: DataFrame,
    table: str,
    op: Column,
    before: Column,
    after: Column,
    op_ts: Column,
    current_ts: Column,
    csn: Column,
    pos: Column,
) -> DataFrame:
    """Change events: an insert has no before image, a delete has no after image."""
    return df.select(
        op.alias("op_type"),
        F.lit(table).alias("table"),
        current_ts.alias("current_ts"),
        op_ts.alias("op_ts"),
        F.when(op != "I", before).alias("before"),
        F.when(op != "D", after).alias("after"),
        csn.alias("csn"),
        pos.alias("pos"),
    )


def normalise_operations(df: DataFrame, column: str = "op_type") -> tuple[DataFrame, DataFrame]:
    """Rows with a known operation, recoded to I/U/D/R, and the rows to quarantine."""
    code = operation_code(F.col(column))
    known = df.withColumn(column, code).where(F.col(column).isNotNull())
    return known, df.where(code.isNull())


def split_tombstones(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events with an image, and the records that carry none; the latter pass through unchanged."""
    empty = F.col("before").isNull() & F.col("after").isNull()
    return df.where(~empty), df.where(empty)


def _image_fields(df: DataFrame, image: str) -> list[str]:
    return df.schema[image].dataType.fieldNames()


def field_union(first: T.StructType, second: T.StructType) -> list[str]:
    """Field names of both structs: those of the first in order, then the new ones of the second."""
    return list(dict.fromkeys([*first.fieldNames(), *second.fieldNames()]))


def final_values(df: DataFrame, fields=None, op_column: str = "op_type") -> DataFrame:
    """Business columns of each event, then the other envelope columns.

    Inserts, updates and snapshot reads give the after image, deletes the before image; any other
    operation gives NULLs.
    """
    others = [c for c in df.columns if c not in ("before", "after")]
    before, after = _image_fields(df, "before"), _image_fields(df, "after")
    fields = list(fields or field_union(df.schema["after"].dataType, df.schema["before"].dataType))
    op = F.col(op_column)

    def value(name: str) -> Column:
        chosen = None
        if name in after:
            chosen = F.when(op.isin("I", "U", "R"), F.col(f"after.{quoted(name)}"))
        if name in before:
            old = F.col(f"before.{quoted(name)}")
            chosen = F.when(op == "D", old) if chosen is None else chosen.when(op == "D", old)
        if chosen is None:
            raise ValueError(f"no image has the field {name}")
        return chosen.alias(name)

    return df.select(*[value(f) for f in fields], *[F.col(quoted(c)) for c in others])


def final_values_for(df: DataFrame, op: str, fields) -> DataFrame:
    """The same choice for a frame that holds one operation; an unknown one changes nothing."""
    image = {"I": "after", "U": "after", "R": "after", "D": "before"}.get(op)
    if image is None:
        return df
    others = [c for c in df.columns if c not in ("before", "after")]
    return df.select(
        *[F.col(f"{image}.{quoted(f)}").alias(f) for f in fields],
        *[F.col(quoted(c)) for c in others],
    )


def merge_images(df: DataFrame, policy: str = "by_op", op_column: str = "op_type") -> DataFrame:
    """One value per field of either image.

    ``after_wins``: the after image for every field it has, even when NULL there;
    ``coalesce``: after, or before where after is NULL;
    ``by_op``: before for deletes, after otherwise.
    """
    before, after = df.schema["before"].dataType, df.schema["after"].dataType
    names = field_union(before, after)

    def value(name: str) -> Column:
        old = F.col(f"before.{quoted(name)}")
        new = F.col(f"after.{quoted(name)}")
        if name not in after.fieldNames():
            return old
        if name not in before.fieldNames() or policy == "after_wins":
            return new
        if policy == "coalesce":
            return F.coalesce(new, old)
        return F.when(F.col(op_column) == "D", old).otherwise(new)

    if policy not in ("after_wins", "coalesce", "by_op"):
        raise ValueError(f"unknown policy {policy}")
    return df.select(*[value(n).alias(n) for n in names])


def position_number(pos: Column) -> Column:
    """Log position as a number: text of unequal width does not sort."""
    return pos.cast("decimal(38,0)")


def latest_changes(log: DataFrame, keys, order) -> DataFrame:
    """The last event of each key. Events with a NULL key concern no row: see ``split_null_keys``."""
    return latest_per_key(split_null_keys(log, keys)[0], keys, order)


def apply_changes(
    table: DataFrame, log: DataFrame, keys, order, op_column: str = "op"
) -> DataFrame:
    """The table after a change log: untouched rows, and the last event of each key if no delete.

    Only operation D deletes; events with unknown operations belong in ``normalise_operations``.
    One plan, so no reader sees upserts without deletes. The table is read once and, when the log
    is small enough for AQE to broadcast its keys, not shuffled.
    """
    last = latest_changes(log, keys, order)
    kept = absent_by_key(table, log, keys)
    written = live_rows(last, op_column).select(*table.columns)
    return kept.unionByName(written)


def merge_with_markers(
    state: DataFrame, log: DataFrame, keys, order, op_column: str = "op"
) -> DataFrame:
    """Newest event per key over stored events and new ones, deletes kept as markers.

    A late older upsert then cannot bring back a deleted row. ``live_rows`` drops the markers.
    """
    return upsert_by_key(state, log, keys, order)


def live_rows(state: DataFrame, op_column: str = "op") -> DataFrame:
    """The rows that are no delete marker."""
    return state.where(~F.col(op_column).eqNullSafe(F.lit("D")))


def reconcile_snapshot(
    snapshot: DataFrame, changes: DataFrame, keys, order, op_column: str = "op"
) -> DataFrame:
    """Rows after a re-read of the source while changes kept flowing: newest position wins."""
    events = snapshot.unionByName(changes, allowMissingColumns=True)
    return live_rows(latest_per_key(events, keys, order), op_column)


def audit_changes(
    before: DataFrame, after: DataFrame, keys, columns
) -> DataFrame:
    """``(keys, column, old, new)`` for every tracked value that differs; NULL equals NULL."""
    keys = as_list(keys)
    old = before.select(*keys, *[F.col(c).cast("string").alias(f"_old_{c}") for c in columns])
    new = after.select(*keys, *[F.col(c).cast("string").alias(f"_new_{c}") for c in columns])
    return _long_differences(old.join(new, keys, "inner"), keys, columns)


def audit_envelope(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The same from updates that carry both images; no join is needed."""
    both = df.where(F.col("op_type") == "U").select(
        *[F.col(f"after.{quoted(k)}").alias(k) for k in keys],
        *[F.col(f"before.{quoted(c)}").cast("string").alias(f"_old_{c}") for c in columns],
        *[F.col(f"after.{quoted(c)}").cast("string").alias(f"_new_{c}") for c in columns],
    )
    return _long_differences(both, keys, columns)


def _long_differences(pairs: DataFrame, keys, columns) -> DataFrame:
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(quoted(f"_old_{c}")).alias("old"),
                F.col(quoted(f"_new_{c}")).alias("new"),
            )
            for c in columns
        ]
    )
    return (
        pairs.select(*keys, F.inline(entries))
        .where(~F.col("old").eqNullSafe(F.col("new")))
    )


def schema_changes(spark, table: str, old: T.StructType, new: T.StructType) -> DataFrame:
    """Added, removed and retyped columns between two schemas; as many rows as changed columns."""
    was = {f.name: f.dataType.simpleString() for f in old.fields}
    now = {f.name: f.dataType.simpleString() for f in new.fields}
    rows = [
        (table, name, kind, was.get(name), now.get(name))
        for name in field_union(old, new)
        for kind in [
            "added" if name not in was else "removed" if name not in now else "retyped"
        ]
        if was.get(name) != now.get(name)
    ]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, change string, old_type string, new_type string"
    )


def log_schema_change(changes: DataFrame, at: dt.datetime) -> DataFrame:
    """One open log row per changed table."""
    return changes.select("table_name").distinct().select(
        "table_name", wall_literal(at).alias("change_time"), F.lit(0).alias("processed")
    )


def snapshot_signals(log: DataFrame, on: dt.date, schema: str = "dbo") -> DataFrame:
    """One signal per table with an open log row, asking for a new snapshot."""
    document = F.to_json(
        F.struct(F.array(F.concat(F.lit(f"{schema}."), F.col("table_name"))).alias("data-collections"))
    )
    return (
        log.where(F.col("processed") == 0)
        .select("table_name")
        .distinct()
        .select(
            F.concat(F.col("table_name"), F.lit(f"_snap_{on:%Y%m%d}")).alias("id"),
            F.lit("execute-snapshot").alias("type"),
            document.alias("data"),
        )
    )


def mark_processed(log: DataFrame) -> DataFrame:
    """The log with every row of a signalled table closed."""
    open_tables = log.where(F.col("processed") == 0).select("table_name").distinct()
    flagged = open_tables.withColumn("_open", F.lit(1)).withColumnRenamed("table_name", "_t")
    return log.join(flagged, F.col("table_name") == F.col("_t"), "left").select(
        *[
            F.when(F.col("_open") == 1, F.lit(1)).otherwise(F.col("processed")).alias("processed")
            if c == "processed"
            else F.col(c)
            for c in log.columns
        ]
    )


def decode_typed_json(
    df: DataFrame, column: str, fields: dict[str, str], into: str = "event"
) -> DataFrame:
    """Decode a text column whose every JSON value is wrapped as ``{"type": value}``.

    ``fields`` maps business columns to Spark types. ``into`` becomes a struct of the header, of
    both images with those columns, and of ``malformed``; what the text does not carry is NULL. A value
    that is not of its column's type is NULL and makes the event malformed. The text is parsed
    in a projection of its own, so that it is parsed once and not once per field.
    """
    header = ("table", "op_type", "op_ts", "current_ts", "pos")
    wrapped = T.MapType(T.StringType(), T.StringType())
    row = T.StructType([T.StructField(name, wrapped) for name in fields])
    image = T.StructType([T.StructField("row", row)])
    shape = T.StructType(
        [T.StructField(name, wrapped) for name in header]
        + [T.StructField("before", image), T.StructField("after", image)]
        + [T.StructField("_corrupt", T.StringType())]
    )
    parsed = df.withColumn(
        "_json", F.from_json(F.col(column), shape, {"columnNameOfCorruptRecord": "_corrupt"})
    )

    def unwrapped(path: str) -> Column:
        return F.try_element_at(F.map_values(F.col(f"_json.{path}")), F.lit(1))

    def image_values(name: str) -> Column:
        values = [
            unwrapped(f"{name}.row.{quoted(field)}").try_cast(kind).alias(field)
            for field, kind in fields.items()
        ]
        return F.when(F.col(f"_json.{name}").isNotNull(), F.struct(*values)).alias(name)

    bad_values = [
        unwrapped(path).isNotNull() & unwrapped(path).try_cast(kind).isNull()
        for name in ("before", "after")
        for field, kind in fields.items()
        for path in [f"{name}.row.{quoted(field)}"]
    ]
    malformed = reduce(lambda a, b: a | b, bad_values, F.col("_json._corrupt").isNotNull())
    event = F.struct(
        *[unwrapped(name).alias(name) for name in header],
        image_values("before"),
        image_values("after"),
        malformed.alias("malformed"),
    )
    return parsed.withColumn(into, event).drop("_json")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
