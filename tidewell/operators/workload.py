"""Change workloads: some rows updated and some deleted, as events and as a readable log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import draws
from tidewell.functions.text import quoted
from tidewell.operators.cdc import changed_image, image_struct
from tidewell.operators.sampling import first_n, sample_exact, with_rank
from tidewell.session import staged

# Rows per run and per commit of the large and of the small workload.
LARGE = {"updates": 100, "deletes": 10, "batch": 10}
SMALL = {"updates": 10, "deletes": 2, "batch": 1}


def random_phone(key: Column, seed: int = 0) -> Column:
    return draws.pattern(draws.draw("phone", key, seed), "09########")


def change_events(
    table: DataFrame,
    key: str,
    changes: dict[str, Column],
    updates: int = LARGE["updates"],
    deletes: int = LARGE["deletes"],
    batch: int = LARGE["batch"],
    pick: str = "random",
    seed: int = 0,
) -> DataFrame:
    """``(batch, op_type, key, before, after)`` for updates and then deletes.

    ``changes`` gives the new values. ``pick`` is ``random`` (a repeatable sample, drawn anew for
    the deletes) or ``first`` (the first rows by key, so the deletes are among the updates). A row
    that is updated and then deleted shows its new values in the delete's before image. Updates
    are committed in batches of ``batch`` rows, deletes one by one after them.
    """
    if pick == "random":
        chosen = sample_exact(table, key, updates, seed)
        doomed = sample_exact(table, key, deletes, seed + 1)
    elif pick == "first":
        chosen, doomed = first_n(table, key, updates), first_n(table, key, deletes)
    else:
        raise ValueError(f"unknown pick {pick}")
    # The picks are staged: what follows reads these few rows and not the table again.
    chosen, doomed = staged(chosen, "updates"), staged(doomed, "deletes")
    image = image_struct(table)
    new = changed_image(image, changes)
    update_rows = with_rank(
        chosen.select(F.col(quoted(key)), image.alias("before"), new.alias("after")), key, seed
    )
    updated = update_rows.select(
        F.floor(F.col("rank") / F.lit(batch)).alias("batch"),
        F.lit("U").alias("op_type"),
        F.col(quoted(key)),
        "before",
        "after",
    )
    delete_rows = with_rank(doomed.select(F.col(quoted(key)), image.alias("_old")), key, seed + 1)
    latest = updated.select(F.col(quoted(key)).alias("_k"), F.col("after").alias("_new"))
    batches = -(-updates // batch)
    deleted = delete_rows.join(latest, F.col(quoted(key)) == F.col("_k"), "left").select(
        (F.col("rank") + F.lit(batches)).alias("batch"),
        F.lit("D").alias("op_type"),
        F.col(quoted(key)),
        F.coalesce("_new", "_old").alias("before"),
        F.lit(None).cast(table.schema).alias("after"),
    )
    return updated.unionByName(deleted)


def log_lines(events: DataFrame, key: str, columns) -> DataFrame:
    """The events as log text, one line each, in the order ``batch``, key."""
    values = [
        F.concat(F.lit(f" | {c}="), F.coalesce(F.col(f"after.{quoted(c)}").cast("string"), F.lit("None")))
        for c in columns
    ]
    name = F.concat(F.lit(f"{key}="), F.col(quoted(key)).cast("string"))
    text = F.when(F.col("op_type") == "U", F.concat(F.lit("[UPDATE] "), name, *values)).otherwise(
        F.concat(F.lit("[DELETE] "), name)
    )
    return events.select("batch", F.col(quoted(key)), text.alias("line"))
