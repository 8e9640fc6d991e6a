"""Comparing two tables by fingerprints of key ranges, in place of moving both.

A range's fingerprint is its number of rows and two order-free sums over 64-bit hashes of whole rows. Equal ranges have
equal fingerprints; ranges that differ keep the same ones once in 2**128 cases. What is shuffled is one row for each
range and task, whatever the tables hold. Ranges form a tree: where a pair of fingerprints differs, and
only there, the range is cut into finer ones, until few enough rows are left to compare row by row. Each
step reads the key ranges that are still open, by bounds that reach the scan.

Fingerprints may be stored, or be made where a table lives and sent: with the same cuts, ``differing_ranges``
compares them without either table.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.text import quoted
from tidewell.operators.keyed import differing_rows
from tidewell.operators.ranges import in_range, key_cuts, range_number

NULL_RANGE = -1  # rows without a key
BOUNDS = 64  # ranges that a scan is given one by one; beyond it their hull, and the rest by range number


def row_hash(columns, seed: int) -> Column:
    """64 bits of a row's values; NULLs are told apart by their column, which a plain hash passes over."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.isnull(quoted(c)), F.col(quoted(c)))])


def fingerprints(df: DataFrame, key: str, cuts: list, columns=None) -> DataFrame:
    """``(range, rows, sum_a, sum_b)`` of every key range that has rows. Sums are exact, so order does not matter."""
    columns = list(columns or df.columns)
    number = F.when(F.col(quoted(key)).isNull(), NULL_RANGE).otherwise(range_number(F.col(quoted(key)), cuts))
    rows = df.select(number.alias("range"), *[row_hash(columns, seed).alias(f"h{seed}") for seed in (1, 2)])
    return rows.groupBy("range").agg(
        F.count("*").alias("rows"),
        *[F.sum(F.col(f"h{seed}").cast("decimal(20,0)")).cast("decimal(38,0)").alias(f"sum_{name}")
          for seed, name in ((1, "a"), (2, "b"))],
    )


def rolled_up(prints: DataFrame, fan: int) -> DataFrame:
    """The fingerprints one level up: ``fan`` neighbouring ranges are one. The NULL range stays by itself."""
    parent = F.when(F.col("range") == NULL_RANGE, NULL_RANGE).otherwise(F.floor(F.col("range") / fan).cast("int"))
    sums = [F.sum(c).cast("decimal(38,0)").alias(c) for c in ("sum_a", "sum_b")]
    return prints.groupBy(parent.alias("range")).agg(F.sum("rows").alias("rows"), *sums)


def differing_ranges(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(range, rows_a, rows_b)`` where two sets of fingerprints differ; a missing range has no rows."""
    tagged = a.withColumn("_side", F.lit("a")).unionByName(b.withColumn("_side", F.lit("b")))

    def of(side: str, column: str) -> Column:
        return F.max(F.when(F.col("_side") == side, F.col(column)))

    names = ["rows", "sum_a", "sum_b"]
    laid = tagged.groupBy("range").agg(*[of(s, c).alias(f"{c}_{s}") for c in names for s in "ab"])
    same = reduce(lambda x, y: x & y, [F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b")) for c in names])
    zero = F.lit(0).cast("long")
    return laid.where(~same).select(
        "range", F.coalesce("rows_a", zero).alias("rows_a"), F.coalesce("rows_b", zero).alias("rows_b")
    )


def _runs(numbers: list[int]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for n in sorted(numbers):
        if out and out[-1][1] == n - 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return [tuple(r) for r in out]


def within(key: str, cuts: list, numbers) -> Column:
    """Whether a row's key lies in one of the numbered ranges."""
    numbers = set(numbers)
    keyed = sorted(numbers - {NULL_RANGE})
    runs = _runs(keyed)
    if not runs:
        inside = F.lit(False)
    elif len(runs) <= BOUNDS:
        inside = reduce(lambda x, y: x | y, [in_range(key, cuts, first, last) for first, last in runs])
    else:
        hull = in_range(key, cuts, keyed[0], keyed[-1])
        inside = hull & F.array_contains(F.lit(keyed), range_number(F.col(key), cuts))
    return inside | F.col(key).isNull() if NULL_RANGE in numbers else inside


@dataclass
class Comparison:
    """``rows``: what differs, with both numbers of copies. ``levels``: per level its ranges, those that differed, and the
    rows of both sides in them. ``cuts`` and ``ranges``: the key ranges whose rows were compared."""

    rows: DataFrame
    cuts: list
    ranges: list[int]
    levels: list[tuple[int, int, int]] = field(default_factory=list)


def compare_by_ranges(
    a: DataFrame, b: DataFrame, key: str, fan: int = 256, leaf_rows: int = 100_000, depth: int = 4
) -> Comparison:
    """Rows of two tables whose number of copies differs, found by descent into differing key ranges.

    Each level cuts what is open into about ``fan`` ranges, or ``fan`` for each open range of the level before but no more than
    ``fan * fan``; a range with at most ``leaf_rows`` rows a side is not cut further. A key that alone holds more stays
    whole: its rows are compared by one grouping, which combines before the shuffle. Where a finer level leaves open more than
    half of what the level before did, differences lie everywhere, and the open rows are compared as they are: a further
    level would read them all again to spare few. The driver sees fingerprints of differing ranges only.
    """
    if a.columns != b.columns or [f.dataType for f in a.schema] != [f.dataType for f in b.schema]:
        raise ValueError("both tables need the same columns of the same types")
    if any(isinstance(f.dataType, T.MapType) for f in a.schema):
        raise ValueError("maps have no order-free hash: give them as sorted arrays of entries")
    side_a, side_b, parts, levels = a, b, fan, []
    cuts: list = []
    for level in range(depth):
        bounds = key_cuts(side_a.select(key).unionByName(side_b.select(key)), key, parts)
        finer = sorted({*cuts, *bounds})
        if level and finer == cuts:
            break
        cuts = finer
        found = differing_ranges(fingerprints(side_a, key, cuts), fingerprints(side_b, key, cuts)).collect()
        ranges = sorted(r["range"] for r in found)
        levels.append((len(cuts) + 1, len(found), sum(r["rows_a"] + r["rows_b"] for r in found)))
        inside = within(key, cuts, ranges)
        side_a, side_b = a.where(inside), b.where(inside)
        if all(max(r["rows_a"], r["rows_b"]) <= leaf_rows for r in found) or level and 2 * levels[-1][2] > levels[-2][2]:
            break
        parts = min(fan * len(found), fan * fan)
    return Comparison(differing_rows(side_a, side_b), cuts, ranges, levels)
