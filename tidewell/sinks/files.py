"""Sized file output, manifests and the write-then-compare check."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.draws import unit
from tidewell.functions.numbers import megabytes
from tidewell.operators.keyed import content_hash, differing_rows
from tidewell.session import child_folders, delete_path, move_files, scratch_path
from tidewell.sources.tables import list_files

# Batch defaults of the envelope generator.
FILE_COUNT = 100
TARGET_FILE_MB = 128
RECORDS_PER_FILE = 90000

PROBE_ROWS = 100_000  # rows written to measure a row's size
MOST_PACKING = 10_000  # tasks that pack
NEAR = (0.8, 1.2)  # shares of the target size that are near it
RECUTS = 4  # times that files off the target are cut anew, by the row size just measured on them

SUFFIX = {"parquet": ".parquet", "json": ".json", "csv": ".csv", "orc": ".orc", "avro": ".avro"}


def write_sized(
    df: DataFrame, path: str, file_count: int, records_per_file: int, mode="overwrite", fmt="parquet"
) -> None:
    """At least ``file_count`` files of at most ``records_per_file`` rows, rows dealt out evenly.

    Each file is one task's, in a multiple of ``file_count`` tasks: a task reads no more than a file holds. A row's place is
    its place in its partition after the rows of the partitions before, so that tasks differ by one row at most. (Where the
    frame's partitions are not the same when read again, they differ by some rows, which may be a further file.)
    """
    part, at = F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    counts = {r["part"]: r["n"] for r in df.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    tasks = file_count * max(1, -(-sum(counts.values()) // (file_count * records_per_file)))
    # The first place of each partition: one number for each, whatever the rows.
    firsts, before = [], 0
    for k in range(max(counts, default=-1) + 1):
        firsts.append(before % tasks)
        before += counts.get(k, 0)
    first = F.coalesce(F.get(F.lit(firsts).cast("array<int>"), part), F.lit(0)) if firsts else F.lit(0)
    dealt = df.repartitionById(tasks, F.pmod(first + at, F.lit(tasks)).cast("int"))
    dealt.write.format(fmt).option("maxRecordsPerFile", records_per_file).mode(mode).save(path)


def bytes_per_row(df: DataFrame, rows: int = PROBE_ROWS, fmt: str = "parquet") -> float:
    """Written size of a row, measured on about ``rows`` rows drawn from all partitions by a hash of their content.

    The number of drawn rows does not grow with the table. They are written by as many tasks as read them, and
    removed again. A table too small for a draw is measured whole.
    """
    spark = df.sparkSession
    bound = int(min(1.0, rows / max(1, df.count())) * (1 << 30))
    drawn = df.where(F.pmod(content_hash(df), F.lit(1 << 30)) < bound)
    for part in (drawn, df):
        path = scratch_path(spark, "probe")
        part.write.format(fmt).save(path)
        size = list_files(spark, path, SUFFIX[fmt]).agg(F.sum("size_bytes")).first()[0] or 0
        written = spark.read.format(fmt).schema(df.schema).load(path).count()
        delete_path(spark, path)
        if written:
            return size / written
    return 0.0


def write_to_target_size(
    df: DataFrame, path: str, target_mb: float = TARGET_FILE_MB, mode="overwrite", fmt="parquet"
) -> int:
    """Files of about ``target_mb`` MB; returns the rows allowed per file.

    Files are cut at a row count that a bounded probe gives. What each task has left over is a smaller file; those alone
    are packed together and written once more, before the files are put in their place. A row's size depends on
    the rows that share its file, so files that are still off the target are cut anew, by their measured size, until at
    most one file is, or no later cut helps. Only files that are off are written again.
    """
    spark = df.sparkSession
    target = target_mb * 1024 * 1024
    per_row = bytes_per_row(df, fmt=fmt)
    records = max(1, math.floor(target / per_row)) if per_row else RECORDS_PER_FILE
    if mode != "overwrite" and mode != "append":
        raise ValueError(f"unknown mode {mode}")
    work = scratch_path(spark, "sized")
    df.write.format(fmt).option("maxRecordsPerFile", records).save(work)
    pack_small_files(spark, work, target, df.schema, fmt)
    recut_files(spark, work, target, df.schema, fmt)
    if mode == "overwrite":
        delete_path(spark, path)
    move_files(spark, work, path)
    return records


def bins_of(sizes: dict[str, int], room: float) -> list[list[str]]:
    """Names in bins of at most ``room``, by first fit with the largest first; a larger one has its own bin."""
    bins: list[list[str]] = []
    left: list[float] = []
    # First bin with room by a tree of maxima would matter beyond some 100,000 small files only.
    for name in sorted(sizes, key=lambda n: (-sizes[n], n)):
        at = next((k for k, free in enumerate(left) if free >= sizes[name]), None)
        if at is None:
            bins.append([name])
            left.append(room - sizes[name])
        else:
            bins[at].append(name)
            left[at] -= sizes[name]
    return bins


def pack_small_files(spark: SparkSession, path: str, target: float, schema, fmt: str = "parquet", full: float = 0.8) -> tuple[int, int]:
    """Rewrite files below ``full`` of the target in bins of the target size; the number of files and bytes rewritten.

    Only small files are read, each by the task of its bin. Give a folder that nobody reads yet.
    """
    sizes = {r["file_name"]: r["size_bytes"] for r in list_files(spark, path, SUFFIX[fmt]).collect()}
    small = {n: s for n, s in sizes.items() if s < full * target}
    bins = [b for b in bins_of(small, target) if len(b) > 1]
    if not bins:
        return 0, 0
    names = [(n, k) for k, b in enumerate(bins) for n in b]
    # One row for each small file: at most as many as tasks wrote the folder.
    placed = F.broadcast(spark.createDataFrame(names, "_name string, _bin int"))
    rows = spark.read.format(fmt).schema(schema).load([f"{path}/{n}" for n, _ in names])
    rows = rows.withColumn("_name", F.col("_metadata.file_name")).join(placed, "_name").drop("_name")
    _replaced(spark, path, rows, len(bins), [n for n, _ in names], fmt, "bin")
    return len(names), sum(small[n] for n, _ in names)


def recut_files(spark: SparkSession, path: str, target: float, schema, fmt: str = "parquet") -> int:
    """Cut files that are not near the target size anew, at equal numbers of rows; the number of times that was done.

    What is left over is one smaller file. The row size is that of the files being cut where they are half full, as
    it falls with the rows in a file; else that of all files. Rows stay beside those of their old file.
    """
    for done in range(RECUTS):
        sizes = {r["file_name"]: r["size_bytes"] for r in list_files(spark, path, SUFFIX[fmt]).collect()}
        off = sorted(n for n, s in sizes.items() if not NEAR[0] * target <= s <= NEAR[1] * target)
        if len(off) < 2 and all(sizes[n] < target for n in off):
            return done
        found = spark.read.format(fmt).schema(schema).load([f"{path}/{n}" for n in sizes])
        counts = found.groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count("*").alias("n")).collect()
        rows = {r["name"]: r["n"] for r in counts}
        off = [n for n in off if rows.get(n)]
        full = [n for n in off if sizes[n] >= target / 2] or [n for n in rows if sizes[n] >= target / 2] or off
        if not off:
            return done
        per_file = max(1, math.floor(target * sum(rows[n] for n in full) / sum(sizes[n] for n in full)))
        starts, at = [], 0
        for n in off:
            starts.append((n, at, rows[n]))
            at += rows[n]
        if len(off) == 1 and at <= per_file:
            return done
        # A row's place is its file's and a draw within the file, so that every format is cut alike.
        placed = F.broadcast(spark.createDataFrame(starts, "_name string, _start long, _rows long"))
        cut = spark.read.format(fmt).schema(schema).load([f"{path}/{n}" for n in off])
        cut = cut.withColumn("_name", F.col("_metadata.file_name")).withColumn("_draw", unit(F.xxhash64(F.monotonically_increasing_id())))
        cut = cut.join(placed, "_name").withColumn("_bin", F.floor((F.col("_start") + F.col("_draw") * F.col("_rows")) / per_file).cast("int"))
        _replaced(spark, path, cut.drop("_name", "_start", "_rows", "_draw"), -(-at // per_file), off, fmt, f"cut{done}-")
    return RECUTS


def _replaced(spark: SparkSession, path: str, rows: DataFrame, bins: int, names: list[str], fmt: str, prefix: str) -> None:
    """Write rows as one file for each ``_bin`` and put those in the place of the named files."""
    packed = scratch_path(spark, "packed")
    rows.repartition(min(bins, MOST_PACKING), "_bin").sortWithinPartitions("_bin").write.format(fmt).partitionBy("_bin").save(packed)
    for k in child_folders(spark, packed, "_bin="):
        # One task's files share their name in the folders of different bins.
        move_files(spark, f"{packed}/_bin={k}", path, f"{prefix}{k}-")
    for name in names:
        delete_path(spark, f"{path}/{name}")
    delete_path(spark, packed)


def rows_for_size(df: DataFrame, target_bytes: int, fmt: str = "parquet") -> int:
    """How many rows like those of ``df`` fill ``target_bytes``."""
    per_row = bytes_per_row(df, fmt=fmt)
    return math.ceil(target_bytes / per_row) if per_row else 0


def manifest(
    spark: SparkSession,
    path: str,
    fmt: str,
    run_at: dt.datetime,
    records_per_file: int = RECORDS_PER_FILE,
    target_file_mb: int = TARGET_FILE_MB,
) -> DataFrame:
    """One row per written file."""
    return list_files(spark, path, SUFFIX[fmt]).select(
        F.lit(run_at.strftime("%Y-%m-%dT%H:%M:%SZ")).alias("run_ts"),
        "file_path",
        "file_name",
        "size_bytes",
        megabytes(F.col("size_bytes")).alias("size_mb"),
        F.lit(records_per_file).cast("long").alias("configured_records_per_file"),
        F.lit(target_file_mb).cast("long").alias("target_file_size_mb"),
    )


def write_manifest(files: DataFrame, path: str) -> str:
    """The manifest as JSON files under ``_manifest``, which table scans pass over."""
    target = f"{path.rstrip('/')}/_manifest"
    files.write.mode("overwrite").json(target)
    return target


def manifest_summary(files: DataFrame) -> DataFrame:
    """Counts and sizes over a manifest."""
    return files.agg(
        F.count("*").alias("actual_file_count"),
        F.sum("size_bytes").alias("total_size_bytes"),
        F.round(F.sum("size_mb"), 2).alias("total_size_mb"),
        F.round(F.avg("size_mb"), 2).alias("avg_file_size_mb"),
        F.min("size_mb").alias("min_file_size_mb"),
        F.max("size_mb").alias("max_file_size_mb"),
    )


def write_and_compare(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write, read back, and give the rows that differ; empty means equal content."""
    df.write.format(fmt).mode("overwrite").save(path)
    back = df.sparkSession.read.format(fmt).schema(df.schema).load(path)
    return differing_rows(df, back)
