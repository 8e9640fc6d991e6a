"""Key ranges: cuts at about equal depth, and the range that a key falls in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 64  # sampled keys for each cut, where keys have no quantiles


def key_cuts(df: DataFrame, key: str, parts: int) -> list:
    """At most ``parts - 1`` rising keys that cut the table into ranges of about equal rows.

    Numbers, dates and times are cut at approximate quantiles; other keys at those of a sample of ``SAMPLE`` keys for
    each cut, taken by hash. NULL keys are left out.
    """
    if parts < 2:
        return []
    keys = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"))
    if isinstance(df.schema[key].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        shares = [i / parts for i in range(1, parts)]
        found = keys.agg(F.percentile_approx("k", shares, 10 * parts).alias("c")).first()["c"] or []
    else:
        sample = [r["k"] for r in keys.distinct().orderBy(F.xxhash64("k"), "k").limit(SAMPLE * parts).collect()]
        sample.sort()
        found = [sample[len(sample) * i // parts] for i in range(1, parts)] if sample else []
    return sorted(set(found))


def range_number(key: Column, cuts: list) -> Column:
    """How many of the rising ``cuts`` are below the key, by binary search; NULL keys are in range 0.

    Range ``i`` holds the keys above cut ``i - 1`` up to and including cut ``i``.
    """
    if not cuts:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    table = F.lit(cuts)
    return F.aggregate(
        F.lit(steps), F.lit(0),
        lambda at, step: F.when(F.try_element_at(table, at + step) < key, at + step).otherwise(at),
    )


def in_range(key: str, cuts: list, first: int, last: int) -> Column:
    """Whether a key lies in ranges ``first`` to ``last``, as bounds that reach the scan; NULL keys are not."""
    inside = F.col(key).isNotNull()
    if first > 0:
        inside = inside & (F.col(key) > F.lit(cuts[first - 1]))
    if last < len(cuts):
        inside = inside & (F.col(key) <= F.lit(cuts[last]))
    return inside
