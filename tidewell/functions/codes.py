"""Code tables: operation codes, run states, display texts and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operation letters accepted from the two event dialects.
OPERATION_CODES = {
    "I": "I",
    "U": "U",
    "D": "D",
    "R": "R",
    "c": "I",
    "u": "U",
    "d": "D",
    "r": "R",
}

# Numeric codes of task states and of whole-run states. They differ on purpose.
TASK_STATUS_CODES = {
    "success": 1,
    "failed": 2,
    "up_for_retry": 3,
    "running": 4,
    "skipped": 5,
    "unknown": 0,
}
RUN_STATUS_CODES = {"success": 1, "failed": 2, "running": 3, "unknown": 0}

# State shown as text, and the text for a missing state.
STATUS_TEXT = {
    "failed": "Failed",
    "queued": "Queued",
    "running": "Running",
    "success": "Success",
}
NO_STATUS = "No Status"

# Colour bands, lowest first; the first one has no lower bound.
STATUS_BANDS = [(None, "green"), (0, "orange"), (1, "red")]


def lookup(col: Column, table: dict, default=None) -> Column:
    """Value of ``table`` at ``col``, else ``default``; the table is a small constant."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), col)
    return found if default is None else F.coalesce(found, F.lit(default))


def operation_code(col: Column) -> Column:
    """I, U, D or R for either dialect; NULL for anything else, which callers quarantine."""
    return lookup(col, OPERATION_CODES)


def operation_by_modulo(key: Column) -> Column:
    """I, U, D for keys that leave 1, 2, 0 on division by three."""
    rest = F.pmod(key, F.lit(3))
    return F.when(rest == 1, "I").when(rest == 2, "U").otherwise("D")


def task_status_code(col: Column) -> Column:
    return lookup(col, TASK_STATUS_CODES, 0)


def run_status_code(col: Column) -> Column:
    return lookup(col, RUN_STATUS_CODES, 0)


def status_text(col: Column) -> Column:
    """Display text; unknown states show as they are, a missing one as ``No Status``."""
    return F.coalesce(lookup(col, STATUS_TEXT), col, F.lit(NO_STATUS))


def band(col: Column, steps=STATUS_BANDS) -> Column:
    """Name of the highest step whose lower bound ``col`` reaches."""
    base = next(name for bound, name in steps if bound is None)
    bounded = sorted(((b, n) for b, n in steps if b is not None), reverse=True)
    chain = F.when(col.isNull(), F.lit(base))
    for bound, name in bounded:
        chain = chain.when(col >= bound, name)
    return chain.otherwise(base)
