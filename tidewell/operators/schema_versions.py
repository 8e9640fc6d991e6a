"""A change log whose schema changes on the way: versions in force by position, and one schema that takes them all.

Each version of a table's schema holds from a log position on, until the next one begins. An event is decoded by the version in
force at its position; its values are then widened to the target schema, which every version's fields fit: types are
promoted along a lattice, fields that a version lacks are NULL, and fields that were dropped stay, NULL from then on.
All versions are applied in one plan and one pass over the log.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.text import quoted
from tidewell.operators.cdc import apply_changes, schema_changes
from tidewell.operators.ranges import range_number

MOST_VERSIONS = 1_000  # of one table: each is a branch of the plan

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
DIGITS = dict(zip(WHOLE, (3, 5, 10, 20)))
MOST_DIGITS = 38


def promoted(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both; text holds every scalar.

    Whole numbers widen to each other, to decimals and to doubles, decimals to decimals with room for both sides of the point
    or, beyond 38 digits, to text; dates to timestamps; structs field by field, arrays and maps by their parts.
    """
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return union_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(promoted(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(promoted(a.keyType, b.keyType), promoted(a.valueType, b.valueType))
    if any(isinstance(t, (T.StructType, T.ArrayType, T.MapType, T.BinaryType)) for t in (a, b)):
        raise ValueError(f"no type holds both {a.simpleString()} and {b.simpleString()}")
    if isinstance(a, WHOLE) and isinstance(b, WHOLE):
        return max(a, b, key=lambda t: WHOLE.index(type(t)))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        fractions = [t for t in (a, b) if isinstance(t, T.FractionalType)]
        others = [t for t in (a, b) if not isinstance(t, T.FractionalType)]
        if all(isinstance(t, (T.DecimalType, *WHOLE)) for t in (a, b)):
            sizes = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (DIGITS[type(t)], 0) for t in (a, b)]
            before, after = max(s[0] for s in sizes), max(s[1] for s in sizes)
            return T.DecimalType(before + after, after) if before + after <= MOST_DIGITS else T.StringType()
        # A double holds whole numbers of 53 bits: longs and decimals would lose digits.
        exact = all(isinstance(t, WHOLE[:3]) for t in others) and not any(isinstance(t, T.DecimalType) for t in fractions)
        return T.DoubleType() if exact else T.StringType()
    times = (T.DateType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampNTZType()
    if isinstance(a, (T.DateType, T.TimestampType)) and isinstance(b, (T.DateType, T.TimestampType)):
        return T.TimestampType()
    return T.StringType()


def union_schema(schemas) -> T.StructType:
    """Every field of the schemas, in the order in which they come up, with its promoted type."""
    kinds: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema.fields:
            kinds[field.name] = promoted(kinds[field.name], field.dataType) if field.name in kinds else field.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def widened(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` in a promoted type, at any depth; struct fields that it lacks are NULL."""
    if have == want:
        return value
    if isinstance(want, T.StructType):
        fields = [widened_field(value, have, f).alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: widened(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType):
        keys = F.transform(F.map_keys(value), lambda x: widened(x, have.keyType, want.keyType))
        values = F.transform(F.map_values(value), lambda x: widened(x, have.valueType, want.valueType))
        return F.map_from_arrays(keys, values)
    return value.cast(want)


def widened_field(value: Column, have: T.StructType, field: T.StructField) -> Column:
    if field.name not in have.fieldNames():
        return F.lit(None).cast(field.dataType)
    return widened(value.getField(field.name), have[field.name].dataType, field.dataType)


@dataclass(frozen=True)
class Versions:
    """Schemas of one table by the log position from which each is in force, rising."""

    begins: tuple[int, ...]
    schemas: tuple[T.StructType, ...]

    @property
    def target(self) -> T.StructType:
        return union_schema(self.schemas)

    def in_force(self, position: Column) -> Column:
        """The number of the version in force, from 1; 0 before the first one, NULL without a position."""
        number = range_number(position, [b - 1 for b in self.begins])
        return F.when(position.isNotNull(), number)

    def changes(self, spark, table: str) -> DataFrame:
        """``version, begins`` and what ``cdc.schema_changes`` says of each step to the next version."""
        steps = [
            schema_changes(spark, table, a, b).select(F.lit(i).alias("version"), F.lit(at).cast("long").alias("begins"), "*")
            for i, (at, a, b) in enumerate(zip(self.begins[1:], self.schemas, self.schemas[1:]), 2)
        ]
        if not steps:
            nothing = schema_changes(spark, table, self.schemas[0], self.schemas[0])
            return nothing.select(F.lit(1).alias("version"), F.lit(self.begins[0]).cast("long").alias("begins"), "*")
        return reduce(DataFrame.unionByName, steps)


def versions_of(log: DataFrame) -> Versions:
    """The versions in a log of schema changes ``(position, schema)``, schemas as DDL text. Of equal positions the last by text
    holds; a change that changes nothing begins no version."""
    rows = log.where(F.col("position").isNotNull()).groupBy("position").agg(F.max("schema").alias("schema"))
    found = rows.orderBy("position").limit(MOST_VERSIONS + 1).collect()
    if not 0 < len(found) <= MOST_VERSIONS:
        raise ValueError(f"a table has 1 to {MOST_VERSIONS} schema versions, not {len(found)}")
    begins, schemas = [], []
    for row in found:
        schema = T.StructType.fromDDL(row["schema"])
        if not schemas or schema != schemas[-1]:
            begins.append(row["position"])
            schemas.append(schema)
    return Versions(tuple(begins), tuple(schemas))


def _fitted_to(target: T.StructType, schema: T.StructType):
    """What makes the target's fields of a value parsed by ``schema``, with ``_bad``."""
    return lambda p: F.struct(
        *[widened_field(p, schema, f).alias(f.name) for f in target.fields], p.getField("_corrupt").isNotNull().alias("_bad")
    )


def decode_by_version(events: DataFrame, versions: Versions, payload: str, position: str) -> DataFrame:
    """The events with the payload's fields in the target schema, ``version``, and ``malformed``.

    The payload is JSON text. Text that is no JSON object, a value that is not of its version's type, or an event before the
    first version make the event malformed; a missing payload gives NULLs and is not malformed, as for deletes.
    """
    number = F.col("_version")
    target = versions.target
    rows = None
    for i, schema in enumerate(versions.schemas, 1):
        checked = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
        parsed = F.from_json(F.col(payload), checked, {"columnNameOfCorruptRecord": "_corrupt"})
        # Text is parsed once for all fields: they are taken from the one value of an array.
        wide = F.transform(F.array(parsed), _fitted_to(target, schema))
        rows = F.when(number == i, wide) if rows is None else rows.when(number == i, wide)
    # A generated column is evaluated once, whatever reads it; without a version it is NULL.
    decoded = events.withColumn("_version", versions.in_force(F.col(position))).select("*", F.explode_outer(rows).alias("_row"))
    given = F.col(payload).isNotNull()
    bad = given & F.coalesce(F.col("_row._bad"), F.lit(True))
    rest = [c for c in events.columns if c != payload and c not in target.fieldNames()]
    return decoded.select(
        *[F.col(quoted(c)) for c in rest],
        *[F.when(~bad, F.col(f"_row.{quoted(f.name)}")).alias(f.name) for f in target.fields],
        number.alias("version"), bad.alias("malformed"),
    )


def apply_versioned(
    table: DataFrame, events: DataFrame, versions: Versions, key: str, payload: str, position: str, op_column: str = "op"
) -> DataFrame:
    """The table after a log of several schema versions, in the target schema.

    ``events`` carry the key beside the payload. The table's own fields are promoted with those of the versions. Malformed
    events are passed over: ``decode_by_version`` tells them.
    """
    decoded = decode_by_version(events.withColumn("_key", F.col(key)), versions, payload, position).where("NOT malformed")
    schema = union_schema([table.schema, versions.target])
    wanted = [f for f in schema.fields]

    def fitted(df: DataFrame, have: T.StructType, *others: str) -> DataFrame:
        whole = F.struct(*[F.col(quoted(c)) for c in have.fieldNames()])
        values = df.withColumn("_whole", whole)
        return values.select(*[widened_field(F.col("_whole"), have, f).alias(f.name) for f in wanted], *others)

    log = decoded.select(*[F.col(quoted(c)) for c in versions.target.fieldNames()], "_key", F.col(position).alias("_at"),
                         F.col(op_column).alias("_op"))
    log = fitted(log, versions.target, "_key", "_at", "_op")
    log = log.withColumn(key, F.col("_key").cast(schema[key].dataType)).drop("_key")
    return apply_changes(fitted(table, table.schema), log, key, "_at", "_op")
