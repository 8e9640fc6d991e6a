"""Keyed lake tables: format options, save modes, and a plain-file table with merge on read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.cdc import latest_changes, live_rows, merge_with_markers
from tidewell.session import child_folders, delete_path
from tidewell.sources.tables import connector, read_files_or_empty

# Write options of a lake format for each operation.
OPERATIONS = ("bulk_insert", "insert", "upsert", "delete")
TABLE_TYPES = ("COPY_ON_WRITE", "MERGE_ON_READ")
PAYLOAD = "org.apache.hudi.common.model.DefaultHoodieRecordPayload"


def lake_options(
    table: str,
    key: str,
    ordering: str,
    operation: str = "upsert",
    table_type: str = "MERGE_ON_READ",
    partition: str | None = None,
    sync_to_metastore: bool = False,
    overrides: dict[str, str] | None = None,
    schema=None,
) -> dict[str, str]:
    """Write options for a keyed table. ``overrides`` win; partition options only if set.

    With ``schema`` the key, ordering and partition fields are checked to exist.
    """
    if operation not in OPERATIONS:
        raise ValueError(f"unknown operation {operation}")
    if table_type not in TABLE_TYPES:
        raise ValueError(f"unknown table type {table_type}")
    if schema is not None:
        wanted = [*key.split(","), ordering, *([partition] if partition else [])]
        missing = [c for c in wanted if c not in schema.fieldNames()]
        if missing:
            raise ValueError(f"{table} lacks the fields {missing}")
    options = {
        "hoodie.table.name": table,
        "hoodie.datasource.write.recordkey.field": key,
        "hoodie.datasource.write.precombine.field": ordering,
        "hoodie.datasource.write.operation": operation,
        "hoodie.datasource.write.table.type": table_type,
        "hoodie.datasource.write.payload.class": PAYLOAD,
    }
    if partition:
        options["hoodie.datasource.write.partitionpath.field"] = partition
    if sync_to_metastore:
        options["hoodie.datasource.hive_sync.enable"] = "true"
        options["hoodie.datasource.hive_sync.mode"] = "hms"
        options["hoodie.datasource.hive_sync.table"] = table
        if partition:
            options["hoodie.datasource.hive_sync.partition_fields"] = partition
    return {**options, **(overrides or {})}


def write_lake(df: DataFrame, path: str, options: dict[str, str], mode: str, fmt: str = "hudi") -> None:
    """Write with a lake format; its connector must be on the classpath."""
    with connector(fmt):
        df.write.format(fmt).options(**options).mode(mode).save(path)


def write_table(df: DataFrame, path: str, mode: str = "error", fmt: str = "parquet", partition_by=()):
    """Plain files with one of the modes overwrite, append, error, ignore.

    With partition columns rows are first brought together by them, so that there are few files;
    a partition that holds much of the table is split over several tasks (AQE rebalance).
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
        df.write.format(fmt).mode(mode).partitionBy(*partition_by).save(path)
    else:
        df.write.format(fmt).mode(mode).save(path)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Make files known to the metastore under a name, with the partitions their folders hold."""
    spark.catalog.createTable(name, path=path, source=fmt)
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def save_as_table(df: DataFrame, name: str, path: str | None = None, mode="overwrite", fmt="parquet"):
    """Write and register in one step."""
    writer = df.write.format(fmt).mode(mode)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def save_bucketed(
    df: DataFrame, name: str, keys, buckets: int, mode: str = "overwrite", path: str | None = None
) -> None:
    """A metastore table hashed and sorted by key: joins and upserts on it do not shuffle it.

    Rows are first brought to their buckets, which leaves one file per bucket.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    writer = df.repartition(buckets, *keys).write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_indexed(df: DataFrame, path: str, sort_by, lookup=(), mode: str = "error") -> None:
    """Files for point lookups: ranges of ``sort_by`` per file, so that statistics skip files, and
    Bloom filters on the ``lookup`` columns."""
    sort_by = [sort_by] if isinstance(sort_by, str) else list(sort_by)
    writer = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by).write.mode(mode)
    for column in lookup:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


class VersionedTable:
    """Whole-table replacement that never touches the files being read.

    Each write goes to ``data/version=N`` and is then named in ``commits``. Readers take the
    greatest committed version, so a failed write changes nothing and is overwritten by the next
    one. One writer at a time. Old versions are left for the owner to remove.
    """

    def __init__(self, spark: SparkSession, path: str, schema):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _committed(self) -> tuple[int, dict[str, int]]:
        """(version, last epoch of each stream in it); (0, {}) before the first write."""
        log = read_files_or_empty(
            self.spark, f"{self.path}/commits", "version long, epochs map<string,long>", "json"
        )
        last = log.orderBy(F.desc("version")).limit(1).collect()
        return (last[0]["version"], dict(last[0]["epochs"] or {})) if last else (0, {})

    def _data(self, version: int) -> DataFrame:
        if version == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/data/version={version}")

    def _write_version(self, df: DataFrame, version: int, epochs: dict[str, int]) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/data/version={version}")
        commit = self.spark.createDataFrame([(version, epochs)], "version long, epochs map<string,long>")
        commit.coalesce(1).write.mode("append").json(f"{self.path}/commits")

    def version(self) -> int:
        return self._committed()[0]

    def read(self) -> DataFrame:
        return self._data(self.version())

    def write(self, df: DataFrame) -> int:
        """Replace the content, which ``df`` may be derived from."""
        version, epochs = self._committed()
        self._write_version(df, version + 1, epochs)
        return version + 1


class ChangeTable(VersionedTable):
    """A keyed table kept current by appending changes, merged when read.

    A batch costs its own size, not the table's: it is written as ``changes/stream=S/epoch=E``, and
    writing an epoch of a stream again replaces it, so replays change nothing. Epoch numbers count
    within one checkpoint, so each checkpoint is a stream of its own. ``compact`` folds the epochs
    into a new base version. ``schema`` holds the order columns and ``op``: the newest event of each
    key is kept, deletes too, so that a late older event cannot win.
    """

    def __init__(self, spark: SparkSession, path: str, schema, keys, order):
        super().__init__(spark, path, schema)
        self.keys, self.order = keys, order

    def append(self, changes: DataFrame, epoch: int, stream: str = "main") -> None:
        """Store one batch of changes of one stream."""
        last = latest_changes(changes, self.keys, self.order)
        last.write.mode("overwrite").parquet(f"{self.path}/changes/stream={stream}/epoch={epoch}")

    def _open_epochs(self, epochs: dict[str, int]) -> dict[str, list[int]]:
        """Stored epochs beyond the folded ones, by stream; from folder names only."""
        return {
            stream: [e for e in numbers if e > epochs.get(stream, -1)]
            for stream, numbers in self._stored_epochs().items()
        }

    def _stored_epochs(self) -> dict[str, list[int]]:
        found: dict[str, list[int]] = {}
        for stream in child_folders(self.spark, f"{self.path}/changes", "stream="):
            numbers = child_folders(self.spark, f"{self.path}/changes/stream={stream}", "epoch=")
            found[stream] = sorted(int(n) for n in numbers)
        return found

    def _changes(self, open_epochs: dict[str, list[int]]) -> DataFrame | None:
        paths = [
            f"{self.path}/changes/stream={stream}/epoch={epoch}"
            for stream, numbers in open_epochs.items()
            for epoch in numbers
        ]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else None

    def state(self) -> DataFrame:
        """The newest event of each key, delete markers included."""
        version, epochs = self._committed()
        base, changes = self._data(version), self._changes(self._open_epochs(epochs))
        if changes is None:
            return base
        return merge_with_markers(base, changes, self.keys, self.order)

    def read(self) -> DataFrame:
        """The live rows as of the last appended batch."""
        return live_rows(self.state()).drop("op")

    def compact(self, forget: Column | None = None) -> int:
        """Write the merged state as a new base version and return its number.

        Only epochs seen now are folded in; one that arrives meanwhile stays a change.
        ``forget`` selects delete markers that no late event can concern any more.
        """
        version, epochs = self._committed()
        seen = self._open_epochs(epochs)
        changes = self._changes(seen)
        if changes is None:
            return version
        merged = merge_with_markers(self._data(version), changes, self.keys, self.order)
        if forget is not None:
            merged = merged.where((F.col("op") != "D") | ~forget)
        folded = epochs | {stream: numbers[-1] for stream, numbers in seen.items() if numbers}
        self._write_version(merged, version + 1, folded)
        return version + 1

    def remove_folded(self) -> int:
        """Remove the folders of folded epochs, once no reader of an older version is left."""
        _, epochs = self._committed()
        gone = [
            f"{self.path}/changes/stream={stream}/epoch={epoch}"
            for stream, numbers in self._stored_epochs().items()
            for epoch in numbers
            if epoch <= epochs.get(stream, -1)
        ]
        for path in gone:
            delete_path(self.spark, path)
        return len(gone)
