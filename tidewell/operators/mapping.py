"""Stable key-to-UUID mappings, sampled copies, and loads under unique keys."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.graph import components
from tidewell.operators.keyed import (
    absent_by_key,
    as_list,
    combined,
    duplicate_groups,
    either_key_absent,
    present_by_key,
)
from tidewell.operators.sampling import sample_exact, sample_fraction
from tidewell.session import staged


def derived_uuid(key: Column, salt: str, attempt=0) -> Column:
    """A UUID in version 4 layout from salt, attempt and key: the same on every evaluation."""
    digest = F.sha2(F.concat_ws("|", F.lit(salt), F.lit(attempt).cast("string"), key.cast("string")), 256)
    variant = F.substr(
        F.lit("89ab"), (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1), F.lit(1)
    )
    text = F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-4"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )
    return F.when(key.isNotNull(), text)


@dataclass
class MappingResult:
    """The mapping after an update, with the counts that led to it."""

    mapping: DataFrame
    total: int
    target: int
    existing: int
    added: int


def update_uuid_mapping(
    source: DataFrame,
    mapping: DataFrame,
    key: str,
    salt: str,
    fraction: float = 0.5,
    seed: int = 0,
    max_attempts: int = 5,
) -> MappingResult:
    """Grow a ``(key, uuid)`` mapping to ``floor(fraction * distinct keys)`` keys.

    Keys that have an id keep it. New ids are derived from the key, so the ids that are checked
    are the ids that are written; a clash is repaired with the next attempt number. A mapping that
    already holds one id twice is refused.
    """
    if not duplicate_groups(mapping, "uuid").isEmpty():
        raise ValueError("the mapping holds one uuid for several keys")
    sides = source.select(key, F.lit(True).alias("_source")).unionByName(
        mapping.select(key, F.lit(False).alias("_source"))
    )
    # One grouping gives the distinct keys of both sides and where each occurs. It is staged, as
    # the counts and the passes of the sample all read it.
    seen = staged(
        sides.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.bool_or("_source").alias("sourced"), F.bool_or(~F.col("_source")).alias("mapped")),
        "keys",
    )
    counts = seen.agg(F.count_if("sourced").alias("total"), F.count_if("mapped").alias("mapped")).first()
    total, existing = counts["total"], counts["mapped"]
    target = math.floor(fraction * total)
    if target <= existing:
        return MappingResult(mapping, total, target, existing, 0)
    missing = seen.where("sourced and not mapped").select(key)
    picked = sample_exact(missing, key, target - existing, seed)
    new = assign_unique_uuids(picked, mapping, key, salt, max_attempts)
    grown = staged(mapping.select(key, "uuid").unionByName(new), "mapping")
    return MappingResult(grown, total, target, existing, new.count())


def assign_unique_uuids(
    keys: DataFrame, mapping: DataFrame, key: str, salt: str, max_attempts: int = 5
) -> DataFrame:
    """``(key, uuid)`` for new keys, free of clashes with the mapping and among themselves."""
    drawn = keys.select(key).withColumn("uuid", derived_uuid(F.col(key), salt))
    fixed, report = repair_unique(
        drawn,
        mapping,
        "uuid",
        order=[key],
        redraw=lambda attempt: derived_uuid(F.col(key), salt, attempt),
        max_attempts=max_attempts,
    )
    if report["skipped"]:
        raise RuntimeError(f"{report['skipped']} keys got no unique uuid")
    return fixed.select(key, "uuid")


@dataclass
class Repair:
    """Rows with unique values, the rows that got none, and how many draws each column took."""

    accepted: DataFrame
    rejected: DataFrame
    regenerated: dict[str, int]
    skipped: int


def repair_unique_columns(
    df: DataFrame, existing: DataFrame, redraws: dict, order, max_attempts: int = 5
) -> Repair:
    """Make several columns unique at once, against ``existing`` and within ``df``, by drawing anew.

    ``redraws`` names the columns and gives each a function of the attempt's number. The first row
    of a value by ``order``, which must give every row its own place, keeps it unless it is stored
    already; a row draws anew only in the columns that clash, up to ``max_attempts`` times. What
    still clashes then is returned as ``rejected``, with its last values.

    Each attempt reads the rows that still clash and writes them once; the others are written once.
    """
    columns = df.columns
    taken = {c: existing.select(c).where(F.col(c).isNotNull()) for c in redraws}
    pending, accepted, regenerated = df, None, dict.fromkeys(redraws, 0)
    for attempt in range(max_attempts + 1):
        judged = pending
        for i, column in enumerate(redraws):
            stored = combined(taken[column], column).select(
                F.col(column).alias(f"_s{i}"), F.lit(True).alias(f"_stored{i}")
            )
            judged = _first_of_value(judged, column, order, f"_first{i}")
            judged = judged.join(stored, F.col(column) == F.col(f"_s{i}"), "left").withColumn(
                f"_bad{i}", ~F.col(f"_first{i}") | F.col(f"_stored{i}").isNotNull()
            )
        bad = [f"_bad{i}" for i in range(len(redraws))]
        judged = staged(judged.select(*columns, *bad), "repair")
        free = reduce(lambda a, b: a & b, [~F.col(b) for b in bad])
        good = judged.where(free).select(*columns)
        accepted = good if accepted is None else accepted.unionByName(good)
        clashing = judged.where(~free)
        counts = clashing.agg(F.count("*").alias("n"), *[F.count_if(b).alias(b) for b in bad]).first()
        if counts["n"] == 0 or attempt == max_attempts:
            return Repair(accepted, clashing.select(*columns), regenerated, counts["n"])
        for i, (column, redraw) in enumerate(redraws.items()):
            regenerated[column] += counts[f"_bad{i}"]
            taken[column] = taken[column].unionByName(good.select(column))
            clashing = clashing.withColumn(
                column, F.when(F.col(f"_bad{i}"), redraw(attempt + 1)).otherwise(F.col(column))
            )
        pending = clashing.select(*columns)


def repair_unique(df: DataFrame, existing: DataFrame, column: str, order, redraw, max_attempts=5):
    """``repair_unique_columns`` for one column: the rows that got a value, and the counts
    ``regenerated`` (draws made) and ``skipped`` (rows left without a value)."""
    done = repair_unique_columns(df, existing, {column: redraw}, order, max_attempts)
    return done.accepted, {"regenerated": done.regenerated[column], "skipped": done.skipped}


def _first_of_value(df: DataFrame, column: str, order, name: str = "_first") -> DataFrame:
    """``name`` marks the first row of each value; a row without a value clashes with none.

    The minimum is combined before the shuffle, and the join back is one that AQE can split.
    """
    rank = F.struct(*[F.col(c) for c in order])
    least = combined(df.where(F.col(column).isNotNull()), column, F.min(rank).alias("_least"))
    least = least.withColumnRenamed(column, "_value")
    joined = df.join(least, F.col(column) == F.col("_value"), "left")
    first = F.col(column).isNull() | rank.eqNullSafe(F.col("_least"))
    return joined.withColumn(name, first).drop("_value", "_least")


ONE_TASK = 200_000  # rows of a clash component that one task may decide in order


def load_skipping_duplicates(existing: DataFrame, incoming: DataFrame, unique_keys, order, one_task: int = ONE_TASK):
    """Rows to load and rows to reject under several unique keys, as one-by-one inserts decide.

    A row is loaded if no stored row and no row loaded before it shares any unique key. ``order``
    must give every row its own place. Rows that share no key are decided at once. The others form components of rows
    that share keys, directly or through others; each component is decided in order by one pass over its rows,
    whatever the length of a chain of rows that wait for one another. What a task keeps are the keys of one
    component's loaded rows. Components of more than ``one_task`` rows are cut in order into blocks of so many rows, decided
    one after the other; what a block hands on are those keys of its loaded rows that come up again in a later block.
    """
    columns, unique_keys = incoming.columns, as_list(unique_keys)
    candidates = staged(either_key_absent(incoming, existing, unique_keys), "load")
    refused = [incoming.join(candidates.select(*order), list(order), "left_anti")]
    # Rows whose every key value occurs once are loaded at once and never looked at again.
    alone = candidates
    for i, k in enumerate(unique_keys):
        counts = combined(candidates.where(F.col(k).isNotNull()), k, F.count("*").alias(f"_n{i}"))
        alone = alone.join(counts.withColumnRenamed(k, f"_k{i}"), F.col(k) == F.col(f"_k{i}"), "left")
    clashes = reduce(
        lambda a, b: a | b, [F.coalesce(F.col(f"_n{i}") > 1, F.lit(False)) for i in range(len(unique_keys))]
    )
    # Numbers depend on how rows are dealt, so they are written down.
    marked = alone.withColumn("_clash", clashes).withColumn("_row", F.monotonically_increasing_id())
    marked = staged(marked.select(*columns, "_clash", "_row"), "load")
    loaded = [marked.where("not _clash").select(*columns)]
    pending = marked.where("_clash").drop("_clash")
    if not pending.isEmpty():
        placed = staged(_clash_components(pending, unique_keys), "load")
        sizes = combined(placed, "_component", F.count("*").alias("_size"))
        placed = placed.join(sizes, "_component")
        decided = staged(_decided_in_order(placed.where(F.col("_size") <= one_task), unique_keys, order), "load")
        for won, part in ((True, loaded), (False, refused)):
            rows = decided.where(F.col("_win") == won).select(F.col("_row").alias("_r"))
            part.append(pending.join(rows, F.col("_row") == F.col("_r"), "left_semi").select(*columns))
        large = placed.where(F.col("_size") > one_task).drop("_size")
        if not large.isEmpty():
            large = staged(large, "load")
            won = _decided_in_blocks(large, unique_keys, order, one_task).withColumnRenamed("_row", "_r")
            for how, part in (("left_semi", loaded), ("left_anti", refused)):
                part.append(large.join(won, F.col("_row") == F.col("_r"), how).select(*columns))
    return reduce(DataFrame.unionByName, loaded), reduce(
        DataFrame.unionByName, [part.select(*columns) for part in refused]
    )


def _clash_components(rows: DataFrame, unique_keys) -> DataFrame:
    """The rows with the component of rows that share keys; each row is linked to the least one of each of its keys."""
    links = []
    for k in unique_keys:
        keyed = rows.where(F.col(k).isNotNull()).select(F.col(k).alias("_k"), "_row")
        least = combined(keyed, "_k", F.min("_row").alias("v")).withColumnRenamed("_k", "_of")
        links.append(keyed.join(least, F.col("_k") == F.col("_of")).select(F.col("_row").alias("u"), "v"))
    parts = components(reduce(DataFrame.unionByName, links)).withColumnRenamed("component", "_component")
    return rows.join(parts, F.col("_row") == F.col("node"), "left").drop("node").withColumn(
        "_component", F.coalesce("_component", "_row")
    )


def _decided_in_order(placed: DataFrame, unique_keys, order) -> DataFrame:
    """``(_row, _win)``: within each component, in order, whether no row before shares a key and is loaded.

    Rows stream through a task component by component; keys are compared by their text.
    """
    width = len(unique_keys)

    def run(batches):
        current, taken = None, [set() for _ in range(width)]
        for batch in batches:
            wins = []
            for component, *keys in zip(batch.column(1).to_pylist(), *(c.to_pylist() for c in batch.columns[2:])):
                if component != current:
                    current, taken = component, [set() for _ in range(width)]
                win = not any(k in t for k, t in zip(keys, taken))
                if win:
                    for k, t in zip(keys, taken):
                        if k is not None:
                            t.add(k)
                wins.append(win)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(wins, pa.bool_())], ["_row", "_win"])

    dealt = placed.repartition("_component").sortWithinPartitions("_component", *order)
    keys = [F.col(k).cast("string").alias(f"_k{i}") for i, k in enumerate(unique_keys)]
    return dealt.select("_row", "_component", *keys).mapInArrow(run, "_row long, _win boolean")


def _in_blocks(placed: DataFrame, order, rows: int) -> DataFrame:
    """``_block``: the number of a row's block, where each component is cut in order into blocks of ``rows`` rows.

    A row's rank is its place in a sorted range and the rows of its component in the ranges before, of which there is
    one count for each range.
    """
    by = ["_component", *order, "_row"]
    at = F.monotonically_increasing_id()
    ranged = staged(placed.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", at), "load")
    part = F.shiftright("_at", 33)
    counts = ranged.groupBy("_component", part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_at").alias("_low"))
    before = F.sum("_n").over(Window.partitionBy("_component").orderBy("_part")) - F.col("_n")
    starts = counts.select(F.col("_component").alias("_c"), "_part", (F.col("_low") - before).alias("_zero"))
    joined = ranged.join(F.broadcast(starts), (F.col("_component") == F.col("_c")) & (part == F.col("_part")))
    block = F.floor((F.col("_at") - F.col("_zero")) / rows).cast("int")
    return joined.withColumn("_block", block).drop("_c", "_part", "_zero", "_at")


def _decided_in_blocks(placed: DataFrame, unique_keys, order, one_task: int) -> DataFrame:
    """``_row`` of the rows that are loaded, decided block by block: at most ``one_task`` rows of a component at a time.

    A block's rows that share a key with a row loaded from a block before are left out; the others are decided in order.
    """
    held = _in_blocks(placed, order, one_task)
    last = [f"_last{i}" for i in range(len(unique_keys))]
    for k, name in zip(unique_keys, last):
        keyed = held.where(F.col(k).isNotNull())
        ends = combined(keyed, k, F.max("_block").alias(name)).withColumnRenamed(k, "_k")
        held = held.join(ends, F.col(k) == F.col("_k"), "left").drop("_k")
    # A block's rows lie together, so that a round reads few files beside its own.
    held = staged(held.repartitionByRange("_block", "_component", "_row"), "load")
    won, taken = [], None
    for number in range(held.agg(F.max("_block")).first()[0] + 1):
        block = held.where(F.col("_block") == number)
        rest = block
        if taken is not None:
            for i, k in enumerate(unique_keys):
                known = taken.where(F.col(last[i]) >= number).select(F.col(k).alias("_k"))
                rest = rest.join(known, F.col(k) == F.col("_k"), "left_anti")
        wins = _decided_in_order(rest, unique_keys, order).where("_win").select(F.col("_row").alias("_r"))
        wins = staged(block.join(wins, F.col("_row") == F.col("_r"), "left_semi").select("_row", *unique_keys, *last), "load")
        won.append(wins.select("_row"))
        handed = wins if taken is None else wins.drop("_row").unionByName(taken)
        later = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) > number, F.lit(False)) for c in last])
        taken = staged(handed.where(later).select(*unique_keys, *last), "load")
    return reduce(DataFrame.unionByName, won)


def sync_sampled_copy(
    source: DataFrame,
    copy: DataFrame | None,
    key: str,
    salt: str,
    initial_fraction: float = 0.5,
    incremental_fraction: float = 1.0,
    seed: int = 0,
) -> DataFrame:
    """Rows to add to a copy that carries a uuid per row.

    The first run (``copy`` is None) takes ``floor(initial_fraction * rows)`` rows; later runs take
    the rows whose key the copy lacks, all of them unless ``incremental_fraction`` says less.
    """
    if copy is None:
        rows = sample_fraction(source, key, initial_fraction, seed)
    else:
        rows = absent_by_key(source, copy.select(key).distinct(), key)
        if incremental_fraction < 1.0:
            rows = sample_fraction(rows, key, incremental_fraction, seed)
    return rows.withColumn("uuid", derived_uuid(F.col(key), salt))


def mapping_duplicates(mapping: DataFrame) -> DataFrame:
    """Every mapping row whose id is held by several keys."""
    return present_by_key(mapping, duplicate_groups(mapping, "uuid"), "uuid")
