"""Repeatable draws: each value is a hash of seed, column name and row id.

A draw depends on nothing else, so any number of partitions, any retry and any column subset give
the same values, and generated rows never leave the JVM.
"""

from __future__ import annotations

import decimal
import hashlib
import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_53 = float(1 << 53)


def draw(name: str, key: Column, seed: int = 0) -> Column:
    """A 64-bit hash for one column of one row."""
    salt = hashlib.blake2b(f"{seed}/{name}".encode(), digest_size=8).digest()
    return F.xxhash64(F.lit(int.from_bytes(salt, "big", signed=True)), key)


def unit(hashed: Column) -> Column:
    """Uniform in [0, 1) from a 64-bit hash."""
    return F.shiftrightunsigned(hashed, 11) / F.lit(_TWO_53)


def whole(hashed: Column, low: int, high: int) -> Column:
    """Whole number in [low, high]."""
    return F.pmod(hashed, F.lit(high - low + 1).cast("long")) + F.lit(low).cast("long")


def number(hashed: Column, low: float, high: float, scale: int, precision: int = 18) -> Column:
    """Decimal in [low, high] with ``scale`` digits."""
    steps = round((high - low) * 10**scale)
    units = whole(hashed, 0, steps) + F.lit(round(low * 10**scale)).cast("long")
    unit_value = F.lit(decimal.Decimal(1).scaleb(-scale))
    return (units.cast("decimal(18,0)") * unit_value).cast(f"decimal({precision},{scale})")


def choice(hashed: Column, values) -> Column:
    values = list(values)
    position = (F.pmod(hashed, F.lit(len(values))) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), position)


def digits(hashed: Column, count: int) -> Column:
    """``count`` decimal digits, zeros kept."""
    return F.lpad(F.pmod(hashed, F.lit(10**count)).cast("string"), count, "0")


def pattern(hashed: Column, text: str) -> Column:
    """Text in which each ``#`` becomes a digit, such as ``REF####``; at most 18 of them."""
    drawn, parts, used = digits(hashed, text.count("#")), [], 0
    for run in re.findall(r"#+|[^#]+", text):
        if run[0] == "#":
            parts.append(F.substring(drawn, used + 1, len(run)))
            used += len(run)
        else:
            parts.append(F.lit(run))
    return F.concat(*parts)


def uuid_text(name: str, key: Column, seed: int = 0) -> Column:
    """UUID in version 4 layout from a 128-bit hash."""
    digest = F.md5(F.concat(F.lit(f"{seed}/{name}/"), key.cast("string")).cast("binary"))
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-4"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        choice(draw(name, key, seed), ["8", "9", "a", "b"]),
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def unique_number(key: Column, low: int, size: int, step: int) -> Column:
    """A different number in [low, low + size) for each key in [0, size): no two keys collide.

    Multiplying by a step that shares no factor with ``size`` permutes the range. A key outside it
    fails the query, as its number would repeat another one's.
    """
    if math.gcd(step, size) != 1:
        raise ValueError("step and size share a factor")
    if size * step >= 1 << 63:
        raise ValueError("size * step does not fit a long")
    place = key.cast("long")
    number = F.pmod(place * F.lit(step).cast("long"), F.lit(size).cast("long")) + F.lit(low).cast("long")
    beyond = F.raise_error(F.concat(F.lit(f"no unique number below {size} for key "), place.cast("string")))
    return F.when(place.isNull() | place.between(0, size - 1), number).otherwise(beyond.cast("long"))
