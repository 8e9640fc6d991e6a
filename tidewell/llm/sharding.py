"""Shards by histogram sort: count exact bytes below candidate boundaries, refine, exchange once.

Law ``bytes``: shards hold nearly equal bytes. Rows are ordered by ``(hash of the text, id)``, seen
as one 128-bit key. Each round counts, in one pass over a narrow table of keys and sizes, the bytes
in every cell of the cells that still hold a boundary, and halves the doubt ``DIGIT`` times. A
boundary is settled when its cell weighs less than the tolerance or is a single key. Texts that are
equal are neighbours: they share a shard unless their group alone is heavier than the tolerance,
and then the id bits of the key split it. The driver sees only the cells that hold boundaries.

Edge cases: a null text has size 1 like an empty one; rows equal in id and text stand at one key and
so share a shard; null ids sort first; an empty table gives an empty result; further columns are
carried through ``shard_documents`` only when asked for, and never clash because the operator's own
columns are named by the caller's select.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import stage

DIGIT = 12  # bits of the key that one round decides
WORD = 1 << 64
CELL_ROWS = 1 << 18  # rows that one task numbers


@dataclass(frozen=True)
class Splitter:
    """Rows with a key below ``(high, low)`` stand left of the boundary; both unsigned 64 bits."""

    high: int
    low: int


def _signed(value: int) -> int:
    """An unsigned 64-bit number as the signed one that sorts in the same place."""
    return value - (WORD >> 1)


def _size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, size, checksum and the two halves of the sort key, as signed numbers in key order."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        _size(F.col(text_col).cast("string")).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("high"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_signed(0))).alias("low"),
    )


def _cell(bits: int) -> Column:
    """The first ``bits`` bits of the 128-bit key after its first ones are fixed: one digit's cell.

    ``bits`` counts the bits already fixed; the digit is the next ``DIGIT`` of its 64-bit half.
    """
    half, done = ("high", bits) if bits < 64 else ("low", bits - 64)
    width = min(DIGIT, 64 - done)
    # Flipping the sign bit turns the signed order into the unsigned one.
    value = F.col(half).bitwiseXOR(F.lit(-(WORD >> 1)).cast("long"))
    return F.shiftrightunsigned(value, 64 - done - width).bitwiseAND(F.lit((1 << width) - 1))


def splitters(keys: DataFrame, shards: int, tolerance: float = 0.01) -> list[Splitter]:
    """The ``shards - 1`` boundaries by refined histograms; at most 11 passes, usually two or three."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    slack = max(1, int(tolerance * total / shards))
    # Each boundary: bytes wanted left of it, the key prefix it lies in, bytes left of that prefix.
    doubt = {j: (j * total // shards, 0, 0) for j in range(1, shards)}
    bits, settled = 0, {}
    while doubt:
        width = min(DIGIT, (64 if bits < 64 else 128) - bits)
        prefixes = sorted({prefix for _, prefix, _ in doubt.values()})
        counted = (
            keys.withColumn("prefix", _prefix_is(prefixes, bits))
            .where("prefix IS NOT NULL")
            .groupBy("prefix", _cell(bits).alias("cell"))
            .agg(F.sum("size").alias("bytes"), F.min(F.struct("high", "low")).alias("least"),
                 F.max(F.struct("high", "low")).alias("most"))
            .collect()  # at most (shards - 1) * 2**DIGIT cells, whatever the table's size
        )
        cells: dict[int, list] = {}
        for row in sorted(counted, key=lambda r: (r["prefix"], r["cell"])):
            cells.setdefault(prefixes[row["prefix"]], []).append(row)
        still = {}
        for j, (target, prefix, below) in doubt.items():
            seen, row = below, None
            for row in cells.get(prefix, []):
                if seen + row["bytes"] >= target:
                    break
                seen += row["bytes"]
            if row is None:
                settled[j] = 0
                continue
            past = target - seen > seen + row["bytes"] - target  # the nearer side of the cell
            fixed, done = (prefix << width) | row["cell"], bits + width
            if row["least"] == row["most"]:  # one key, which nothing can split
                key = ((row["least"]["high"] + (WORD >> 1)) << 64) + row["least"]["low"] + (WORD >> 1)
                settled[j] = key + past
            elif row["bytes"] <= slack:
                settled[j] = (fixed + past) << (128 - done)
            else:
                still[j] = (target, fixed, seen)
        doubt, bits = still, bits + width
    out, last = [], 0
    for j in range(1, shards):
        last = max(last, min(settled[j], (1 << 128) - 1))
        out.append(Splitter(last >> 64, last & (WORD - 1)))
    return out


def _prefix_is(prefixes: list[int], bits: int) -> Column:
    """Number of the prefix that the key starts with, or null."""
    if not bits:
        return F.lit(0)
    found = F.lit(None).cast("int")
    for number, prefix in enumerate(prefixes):
        high = prefix if bits <= 64 else prefix >> (bits - 64)
        taken = min(bits, 64)
        low, top = high << (64 - taken), ((high + 1) << (64 - taken)) - 1
        match = F.col("high").between(F.lit(_signed(low)).cast("long"), F.lit(_signed(top)).cast("long"))
        if bits > 64:
            rest, used = prefix & ((1 << (bits - 64)) - 1), bits - 64
            low, top = rest << (64 - used), ((rest + 1) << (64 - used)) - 1
            match = match & F.col("low").between(F.lit(_signed(low)).cast("long"), F.lit(_signed(top)).cast("long"))
        found = F.when(match, F.lit(number)).otherwise(found)
    return found


def _shard(cuts: list[Splitter]) -> Column:
    """How many boundaries stand at or left of the key."""
    passed = F.lit(0)
    for cut in cuts:
        high, low = F.lit(_signed(cut.high)).cast("long"), F.lit(_signed(cut.low)).cast("long")
        at = (F.col("high") > high) | ((F.col("high") == high) & (F.col("low") >= low))
        passed = passed + at.cast("int")
    return passed


def shard_rows(df: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
               tolerance: float = 0.01) -> DataFrame:
    """Each row's size, checksum, shard and gapless place in the shard.

    Places are given in two steps, so that no task sees a whole shard: cells of a shard, cut by a
    hash of the key, are counted first, and rows are numbered inside their cell after one exchange.
    """
    keys = stage(_keyed(df, id_col, text_col), "shard-keys")
    cuts = splitters(keys, shards, tolerance)
    rows = keys.count()
    cells = max(1, -(-rows // (shards * CELL_ROWS)), 16 if rows > 16 * shards else 1)
    placed = keys.select(
        "doc_id", "size", "text_crc32", _shard(cuts).alias("shard"),
        F.pmod(F.xxhash64("doc_id", "high", F.lit(1)), F.lit(cells)).cast("int").alias("cell"),
        "high",
    )
    counts = placed.groupBy("shard", "cell").count()
    # One row per cell: a table that the number of rows bounds, CELL_ROWS to one.
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("shard").alias("s"), F.col("cell").alias("c"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"),
    )
    number = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("high", "doc_id"))
    numbered = placed.withColumn("place", number)
    joined = numbered.join(offsets, (F.col("shard") == F.col("s")) & (F.col("cell") == F.col("c")))
    return joined.select(
        F.col("doc_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.col("place") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(df: DataFrame, path: str, shards: int = 16, id_col: str = "doc_id",
                 text_col: str = "text", tolerance: float = 0.01, files_per_shard: int = 8) -> None:
    """Writes the rows, all columns, to one folder per shard (``shard_number=N``), exchanged once.

    Each shard takes ``files_per_shard`` tasks; its rows are spread over them by their key.
    """
    keys = stage(_keyed(df, id_col, text_col).select("size", "high", "low"), "shard-keys")
    cuts = splitters(keys, shards, tolerance)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    columns = [F.col(c) for c in df.columns if c not in ("shard_number",)]
    keyed = df.select(
        F.struct(*columns).alias("row"), F.xxhash64(text).alias("high"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_signed(0))).alias("low"),
    )
    part = F.pmod(F.xxhash64("high", "low"), F.lit(files_per_shard))
    out = keyed.select("row", _shard(cuts).alias("shard_number"), part.alias("part"))
    out = out.repartition(shards * files_per_shard, "shard_number", "part")
    out.select("row.*", "shard_number").write.partitionBy("shard_number").parquet(path)
