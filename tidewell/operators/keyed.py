"""Keyed tables: latest row per key, upsert, delete, anti and semi joins.

Record keys must not be NULL in a keyed table. Where a NULL key can occur, each function says what
happens to it. No function hints a broadcast: AQE broadcasts a side it has measured as small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.text import quoted


def as_list(names) -> list:
    return [names] if isinstance(names, (str, Column)) else list(names)


def _hashable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _hashable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_hashable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def content_hash(df: DataFrame) -> Column:
    """Hash of a row's columns; breaks ties the same way on every run.

    Maps and variants have no hash of their own and go in as JSON text.
    """
    return F.xxhash64(
        *[
            F.col(quoted(f.name))
            if _hashable(f.dataType)
            else F.to_json(F.struct(F.col(quoted(f.name)).alias("v")))
            for f in df.schema.fields
        ]
    )


def _descending(order) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in as_list(order)]


def _ascending(order) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in as_list(order)]


def _top_row(df: DataFrame, keys, order: list[Column], unique_order: bool) -> DataFrame:
    # rank = 1 lets Spark keep one row per key in every map task before the shuffle, so a key that
    # holds a third of the rows still sends one row per task.
    ties = [] if unique_order else [content_hash(df)]
    ranked = Window.partitionBy(*as_list(keys)).orderBy(*order, *ties)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, keys, order, unique_order: bool = False) -> DataFrame:
    """One row per key: the one with the greatest ``order`` columns.

    Ties are broken by the content of the whole row, which therefore is read whole. A caller who
    knows that no two rows of a key share their order says ``unique_order``; then only the columns in
    use are read.
    """
    return _top_row(df, keys, _descending(order), unique_order)


def first_per_key(df: DataFrame, keys, order, unique_order: bool = False) -> DataFrame:
    """One row per key: the one with the smallest ``order`` columns; ties as in ``latest_per_key``."""
    return _top_row(df, keys, _ascending(order), unique_order)


def pick_survivor(df: DataFrame, keys, preference: list[Column]) -> DataFrame:
    """One row per key by a declared preference, such as ``[F.col("is_new").asc()]``."""
    return _top_row(df, keys, list(preference), False)


def combined(df: DataFrame, keys, *aggregates: Column) -> DataFrame:
    """One row per key, for a join on the key that can split a hot key of the other side.

    Repeats are combined before the shuffle, so a hot key of ``df`` arrives once per task. Grouped by
    the keys alone, the result would be joined as it lies, and AQE splits a join only between two
    exchanges of its own; the hash in the grouping makes Spark exchange the few combined rows anew.
    """
    keys = as_list(keys)
    grouped = df.groupBy(*keys, F.xxhash64(*keys).alias("_place"))
    return (grouped.agg(*aggregates) if aggregates else grouped.agg(F.count("*").alias("_n")).drop("_n")).drop("_place")


def split_null_keys(df: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """The rows whose key columns are all set, and the others, for quarantine."""
    whole = reduce(lambda a, b: a & b, [F.col(quoted(k)).isNotNull() for k in as_list(keys)])
    return df.where(whole), df.where(~whole)


def _match(left: DataFrame, right: DataFrame, left_keys, right_keys):
    """The right side's distinct keys, renamed out of the way, and the join condition."""
    left_keys = as_list(left_keys)
    right_keys = as_list(right_keys) if right_keys is not None else left_keys
    names = [f"_r{i}" for i in range(len(right_keys))]
    side = combined(right.select(*[F.col(r).alias(n) for r, n in zip(right_keys, names)]), names)
    condition = reduce(
        lambda a, b: a & b,
        [F.col(quoted(k)) == F.col(f"_r{i}") for i, k in enumerate(left_keys)],
    )
    return side, condition


def absent_by_key(df: DataFrame, other: DataFrame, keys, other_keys=None) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``. Rows with a NULL key stay."""
    side, condition = _match(df, other, keys, other_keys)
    return df.join(side, condition, "left_anti")


def present_by_key(df: DataFrame, other: DataFrame, keys, other_keys=None) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``. Rows with a NULL key go."""
    side, condition = _match(df, other, keys, other_keys)
    return df.join(side, condition, "left_semi")


def hot_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Keys that hold more than ``share`` of the rows: there are fewer than ``1 / share`` of them."""
    total = df.select(F.count("*")).scalar()
    return _key_counts(df, key).where(F.col("_n") > total * F.lit(share)).select(key)


def _key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))


MOST_HOT_KEYS = 10_000  # rows of the one broadcast: a few hundred kilobytes


def join_many_to_one(
    many: DataFrame, one: DataFrame, key: str, hot_share: float | None = None, salts: int | None = None,
    task_rows: int = 1_000_000,
) -> DataFrame:
    """Inner join on a key that ``one`` holds once and of which ``many`` may hold any number.

    A key with more than ``task_rows`` rows is dealt over as many groups as it holds that many rows,
    and the one matching row is copied to each, so no task gets a whole hot key, whatever the
    session's skew settings are. Beyond ``MOST_HOT_KEYS`` times ``task_rows`` rows a group grows
    with the table instead, so the broadcast of the hot keys stays bounded. ``hot_share`` (a share of the
    rows in place of ``task_rows``) and ``salts`` (one number of groups for every hot key) set them
    by hand. A row's group comes from its content and its input partition: equal copies are spread
    too, and a retried task deals alike.
    """
    total = many.count()
    reach = max(task_rows, -(-total // MOST_HOT_KEYS)) if hot_share is None else max(total * hot_share, 1)
    groups = F.ceil(F.col("_n") / F.lit(reach)).cast("int") if salts is None else F.lit(salts)
    hot = F.broadcast(
        _key_counts(many, key).where(F.col("_n") > reach).select(F.col(key).alias("_hot"), groups.alias("_salts"))
    )
    place = F.xxhash64(content_hash(many), F.spark_partition_id())
    deal = F.pmod(place, F.col("_salts")).cast("int")
    dealt = many.join(hot, F.col(quoted(key)) == F.col("_hot"), "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull(), deal).otherwise(0)
    )
    copies = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.col("_salts") - 1)).otherwise(
        F.array(F.lit(0))
    )
    copied = one.join(hot, F.col(quoted(key)) == F.col("_hot"), "left").withColumn(
        "_salt", F.explode(copies)
    )
    return dealt.drop("_hot", "_salts").join(copied.drop("_hot", "_salts"), [key, "_salt"]).drop("_salt")


def either_key_absent(df: DataFrame, existing: DataFrame, keys) -> DataFrame:
    """Rows that clash with ``existing`` on none of several unique keys.

    One anti join per key: an OR in a single join could not be hashed.
    """
    for key in as_list(keys):
        df = absent_by_key(df, existing, key)
    return df


def upsert_by_key(target: DataFrame, changes: DataFrame, keys, order) -> DataFrame:
    """Insert or replace rows by key. A change older than the stored row leaves it as it is.

    Changes with a NULL key concern no row and are passed over, so applying them again changes nothing;
    ``split_null_keys`` gives them for quarantine. Stored rows with a NULL key stay as they are.

    The target is read once whole and once for its key columns. With a small change set AQE
    broadcasts the changes both times, so the target is not shuffled.
    """
    keys, order = as_list(keys), as_list(order)
    changes, _ = split_null_keys(changes.select(*target.columns), keys)
    fresh = latest_per_key(changes, keys, order)
    rest = [c for c in target.columns if c not in keys]
    incoming = fresh.select(
        *[F.col(quoted(k)).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.struct(*[F.col(quoted(c)) for c in rest]).alias("_new"),
    )
    same_key = reduce(
        lambda a, b: a & b,
        [F.col(quoted(k)) == F.col(f"_k{i}") for i, k in enumerate(keys)],
    )
    newer = F.struct(*[F.col(f"_new.{quoted(c)}") for c in order]) >= F.struct(
        *[F.col(quoted(c)) for c in order]
    )
    replace = F.col("_new").isNotNull() & newer
    merged = target.join(incoming, same_key, "left").select(
        *[
            F.col(quoted(c))
            if c in keys
            else F.when(replace, F.col(f"_new.{quoted(c)}")).otherwise(F.col(quoted(c))).alias(c)
            for c in target.columns
        ]
    )
    matched = present_by_key(target.select(*keys), changes, keys)
    return merged.unionByName(absent_by_key(fresh, matched, keys))


def delete_by_key(target: DataFrame, doomed: DataFrame, keys) -> DataFrame:
    """The target without the rows whose key occurs in ``doomed``."""
    return absent_by_key(target, doomed, keys)


def update_by_key(target: DataFrame, changes: DataFrame, keys, columns, order=None) -> DataFrame:
    """Set ``columns`` from ``changes`` where the key matches; a NULL in a change is written.

    Give ``order`` to take the latest of several changes of one key; without it a key that is
    changed twice fails the query, and never multiplies rows.
    """
    keys, columns = as_list(keys), as_list(columns)
    if order is not None:
        changes = latest_per_key(changes, keys, order)
    once = F.when(
        F.count("*") > 1, F.raise_error(F.lit("a key is changed twice: give an order"))
    ).otherwise(F.first(F.struct(*[F.col(quoted(c)) for c in columns])))
    incoming = split_null_keys(changes, keys)[0].groupBy(
        *[F.col(quoted(k)).alias(f"_k{i}") for i, k in enumerate(keys)]
    ).agg(once.alias("_new"))
    same_key = reduce(
        lambda a, b: a & b,
        [F.col(quoted(k)) == F.col(f"_k{i}") for i, k in enumerate(keys)],
    )
    return target.join(incoming, same_key, "left").select(
        *[
            F.when(F.col("_new").isNotNull(), F.col(f"_new.{quoted(c)}"))
            .otherwise(F.col(quoted(c)))
            .alias(c)
            if c in columns
            else F.col(quoted(c))
            for c in target.columns
        ]
    )


def replace_rows(df: DataFrame, replacements: DataFrame, keys) -> DataFrame:
    """``df`` with the rows of the replaced keys taken from ``replacements``."""
    return absent_by_key(df, replacements, keys).unionByName(replacements)


def append_dedupe(existing: DataFrame, incoming: DataFrame, key: str, order) -> DataFrame:
    """The incoming rows to append: first of each key, and only keys not stored yet.

    Stored rows without a key block nothing. Incoming rows without a key count as one key.
    """
    known = existing.where(F.col(key).isNotNull())
    return absent_by_key(first_per_key(incoming, key, order), known, key)


def unmatched_keys(a: DataFrame, b: DataFrame, a_key: str, b_key: str | None = None) -> DataFrame:
    """Keys on one side only, as ``(key, side)`` with side ``a`` or ``b``; NULL keys are ignored.

    Both directions come from one grouping that combines before the shuffle.
    """
    sides = [(a, a_key, "a"), (b, b_key or a_key, "b")]
    tagged = reduce(
        DataFrame.unionByName,
        [
            df.where(F.col(key).isNotNull()).select(
                F.col(key).alias("key"),
                F.lit(name == "a").alias("in_a"),
                F.lit(name == "b").alias("in_b"),
            )
            for df, key, name in sides
        ],
    )
    seen = tagged.groupBy("key").agg(F.bool_or("in_a").alias("in_a"), F.bool_or("in_b").alias("in_b"))
    return seen.where(F.col("in_a") != F.col("in_b")).select(
        "key", F.when(F.col("in_a"), "a").otherwise("b").alias("side")
    )


def unmatched_rows(a: DataFrame, b: DataFrame, a_key: str, b_key: str | None = None):
    """Whole rows of each side whose non-NULL key is missing on the other; repeats are kept."""
    b_key = b_key or a_key
    only_a = absent_by_key(a.where(F.col(a_key).isNotNull()), b, a_key, b_key)
    only_b = absent_by_key(b.where(F.col(b_key).isNotNull()), a, b_key, a_key)
    return only_a, only_b


def duplicate_groups(df: DataFrame, keys) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*as_list(keys)).agg(F.count("*").alias("n")).where("n > 1")


def differing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with both counts; empty means equal content."""
    columns = a.columns
    both = a.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    counted = both.groupBy(*[F.col(quoted(c)) for c in columns]).agg(
        F.sum("_a").alias("copies_a"), F.sum("_b").alias("copies_b")
    )
    return counted.where("copies_a <> copies_b")
