"""Text helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_padded(number: Column, width: int) -> Column:
    """Digits padded with zeros to ``width``; longer numbers are kept whole."""
    return F.format_string(f"%0{width}d", number.cast("long"))


def prefixed(prefix: str, number: Column, width: int) -> Column:
    return F.format_string(f"{prefix.replace('%', '%%')}%0{width}d", number.cast("long"))


def one_line(text: Column, joiner: str = " ") -> Column:
    """Line breaks replaced by ``joiner``."""
    return F.regexp_replace(text, r"\r\n|\r|\n", joiner)


def whole_match(text: Column, pattern: str) -> Column:
    """Regex match anchored at both ends."""
    return text.rlike(rf"^(?:{pattern})\z")


def contains_any_case(text: Column, part: str) -> Column:
    return F.upper(text).contains(part.upper())


def quoted(name: str) -> str:
    """Column or table name in backticks, with dots and backticks kept literal."""
    return "`" + name.replace("`", "``") + "`"


def rename_by_pattern(df, pattern: str, replacement: str):
    """Rename every column whose whole name matches ``pattern``; ``$1`` is group one."""
    python_form = re.sub(r"\$(\d+)", r"\\\1", replacement)
    names = [re.sub(pattern, python_form, c) if re.search(pattern, c) else c for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"renaming gives equal names: {names}")
    return df.toDF(*names)
