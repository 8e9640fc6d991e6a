"""Exact, repeatable samples without a global sort."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.keyed import as_list, content_hash
from tidewell.operators.ranges import key_cuts, range_number

# Hashes are cut into digits of 16 bits where rows are counted or told apart digit by digit.
_DIGIT_BITS = 16
_DIGITS = 1 << _DIGIT_BITS

CELL = 65_536  # values that the driver may be given around the cut
SKETCH = 4_000  # size of the quantile sketch
MARGIN = 6 / SKETCH  # of the rank on either side of the cut: over twice the sketch's error


def sample_order(keys, seed: int) -> Column:
    """A hash that depends on the key and the seed only, so any run picks the same rows."""
    return F.xxhash64(F.lit(seed), *[F.col(k) for k in as_list(keys)])


def digest_order(keys, seed: int) -> Column:
    """The same as a number that other engines can form: the first 60 bits of an MD5 digest."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in as_list(keys)])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _digit(hashed: Column, index: int) -> Column:
    """The ``index``-th 16 bits of the signed hash, so that digits sort as the hash does."""
    if index == 0:
        return F.shiftright(hashed, 64 - _DIGIT_BITS) + F.lit(_DIGITS // 2)
    return F.shiftright(hashed, 64 - (index + 1) * _DIGIT_BITS).bitwiseAND(F.lit(_DIGITS - 1).cast("long"))


def _boundary(df: DataFrame, digit: Column, n: int) -> tuple[int, int, int]:
    """The digit that the n-th row falls on, the rows before that digit, and the rows on it."""
    counts = df.groupBy(digit.alias("d")).agg(F.count("*").alias("n")).collect()
    before = 0
    for row in sorted(counts):
        if before + row["n"] >= n:
            return row["d"], before, row["n"]
        before += row["n"]
    return _DIGITS, before, 0


def _around(spark, sketch: bytes, rank: float, margin: float) -> tuple[int, int]:
    """Values ``margin`` below and above a relative rank, by a quantile sketch; the driver reads them off it."""
    ranks = [F.lit(min(1.0, max(0.0, r))) for r in (rank - margin, rank + margin)]
    held = F.lit(bytes(sketch))
    return tuple(spark.sql("SELECT 1").select(*[F.kll_sketch_get_quantile_bigint(held, r) for r in ranks]).first())


def _find_cut(hashed: DataFrame, n: int, total: int, sketch: bytes) -> tuple[int, int, int]:
    """The ``_h`` of the n-th row, the rows below it, and the rows that have it.

    One pass counts the values between two bounds around the cut, which the sketch gives; they hold some thousandths
    of the rows. Where those are too many for the driver, a pass makes a sketch of them first, so a pass is
    added for each factor of some hundred. Bounds that the counts show to miss the cut are widened.
    """
    value, margin = F.col("_h"), MARGIN
    below, inside = 0, total
    while True:
        low, high = _around(hashed.sparkSession, sketch, (n - below) / inside, margin)
        part = hashed.where(value <= high)
        within = F.when(value >= low, value)
        if low == high or 2 * margin * inside <= CELL:
            found = part.groupBy(within.alias("v")).agg(F.count("*").alias("n")).collect()
            passed = sum(r["n"] for r in found if r["v"] is None)
            if passed < n:
                for v, rows in sorted((r["v"], r["n"]) for r in found if r["v"] is not None):
                    if passed + rows >= n:
                        return v, passed, rows
                    passed += rows
        else:
            row = part.agg(
                F.count_if(value < low), F.count(within), F.kll_sketch_agg_bigint(within, F.lit(SKETCH))
            ).first()
            if row[0] < n <= row[0] + row[1]:
                below, inside, sketch = row
                continue
        if margin > 1:
            raise RuntimeError("the rows changed while they were counted")
        margin *= 8


def _sample(df: DataFrame, keys, seed: int, order: Column | None, size) -> DataFrame:
    """The ``size(rows)`` first rows by key hash."""
    names = [F.col(k) for k in as_list(keys)]
    hashed = df.withColumn("_h", sample_order(keys, seed) if order is None else order)
    total, sketch = hashed.agg(F.count("_h"), F.kll_sketch_agg_bigint("_h", F.lit(SKETCH))).first()
    n = size(total)
    if n <= 0:
        return df.limit(0)
    if n >= total:
        return df
    value, below, ties = _find_cut(hashed, n, total, sketch)
    if below + ties == n:
        return hashed.where(F.col("_h") <= value).drop("_h")
    # Rows of the cut's key are told apart by their content, digit by digit, so they need not meet in one task.
    taken, left = [hashed.where(F.col("_h") < value).drop("_h")], n - below
    cell = hashed.where(F.col("_h") == value).withColumn("_c", content_hash(df))
    for index in range(64 // _DIGIT_BITS):
        if ties <= CELL:
            break
        digit = _digit(F.col("_c"), index)
        cut, before, ties = _boundary(cell, digit, left)
        taken.append(cell.where(digit < cut).drop("_h", "_c"))
        cell, left = cell.where(digit == cut), left - before
    taken.append(cell.orderBy("_h", *names, "_c").limit(left).drop("_h", "_c"))
    return reduce(DataFrame.unionByName, taken)


def sample_exact(df: DataFrame, keys, n: int, seed: int = 0, order: Column | None = None) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), in order of a key hash.

    A first pass over the keys counts the rows and makes a quantile sketch of the hashes, a second one
    finds the hash of the n-th row between two bounds of the sketch; the sample is then one filter on the
    scan, whatever ``n`` is. Rows that share a key are told apart by their content, digit by digit, so a
    repeated key does not gather in one task. Only rows equal in every column can still share the last
    cell, and any of them will do. ``order`` is a 64-bit number, never NULL, to go by in place of the hash, such as
    ``digest_order``.
    """
    return _sample(df, keys, seed, order, lambda total: n)


def sample_fraction(df: DataFrame, keys, fraction: float, seed: int = 0) -> DataFrame:
    """Exactly ``floor(fraction * rows)`` rows; the pass that sketches the hashes counts them too."""
    return _sample(df, keys, seed, None, lambda total: math.floor(fraction * total))


def sample_approximately(df: DataFrame, keys, fraction: float, seed: int = 0) -> DataFrame:
    """About ``fraction`` of the rows in one pass, by a threshold on the key hash."""
    bound = F.shiftrightunsigned(sample_order(keys, seed), 11)
    return df.where(bound < F.lit(int(fraction * (1 << 53))))


RANGES = 512  # key ranges that are counted to find where the first rows end


def first_n(df: DataFrame, keys, n: int, few: int = CELL) -> DataFrame:
    """The first ``n`` rows by key, NULLs first.

    Up to ``few`` rows are merged in one task. For more, ranges of the first key are counted: ranges before the cut are taken
    whole, where they lie, and only the one that holds the cut goes on, in finer ranges, until few of its rows are wanted. The
    rows are then not in one order. A single value of the first key that holds the cut goes on by the next keys.
    """
    names, taken = as_list(keys), []
    while n > few and names:
        key = F.col(names[0])
        cuts = key_cuts(df, names[0], RANGES)
        while True:
            number = F.when(key.isNull(), -1).otherwise(range_number(key, cuts))
            found = df.groupBy(number.alias("p")).agg(F.count("*").alias("n"), F.min(key).alias("a"), F.max(key).alias("b"))
            ranges = sorted(found.collect())
            if len(ranges) != 1 or ranges[0]["a"] == ranges[0]["b"]:
                break
            cuts = [ranges[0]["a"]]  # no cut told the values apart: the least one is
        before, at = 0, None
        for r in ranges:
            if before + r["n"] > n:
                at = r["p"]
                break
            before += r["n"]
        if at is None:
            return reduce(DataFrame.unionByName, [*taken, df])
        if len(ranges) == 1:  # one value: the rows differ in the next keys
            names = names[1:]
            continue
        taken.append(df.where(number < at))
        df, n = df.where(number == at), n - before
    if n > 0:
        taken.append(df.orderBy(*[F.col(k) for k in as_list(keys)]).limit(n))
    return reduce(DataFrame.unionByName, taken) if taken else df.limit(0)


def with_rank(df: DataFrame, keys, seed: int = 0, column: str = "rank") -> DataFrame:
    """Ranks 0..rows-1 in sampling order, without putting the rows into one task.

    Rows are ranked inside each of 65,536 hash digits; a running count over the digits, a table of
    at most that many rows, gives the rank at which each digit starts.
    """
    hashed = df.withColumn("_h", sample_order(keys, seed))
    digits = hashed.withColumn("_d", _digit(F.col("_h"), 0))
    counts = digits.groupBy("_d").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_d", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_d").orderBy("_h", *[F.col(k) for k in as_list(keys)])
    ranked = digits.withColumn("_r", F.row_number().over(inside))
    return ranked.join(starts, "_d").select(
        *df.columns, (F.col("_start") + F.col("_r") - 1).alias(column)
    )
