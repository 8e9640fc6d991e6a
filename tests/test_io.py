import datetime as dt
import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell import session
from tidewell.operators import keyed
from tidewell.operators.customer_image import generate_event_files
from tidewell.operators.table_specs import SPECS
from tidewell.sinks import files, lake
from tidewell.sources import avro, jdbc, stream, tables


FAILURES = (PySparkException, Py4JJavaError)


def test_formats_fall_back_only_when_missing(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert tables.read_table(spark, path, ("no_such_format", "parquet")).count() == 3
    with pytest.raises(tables.MissingConnector):
        tables.read_table(spark, path, ("no_such_format",))
    with pytest.raises(AnalysisException):
        tables.read_table(spark, str(tmp_path / "gone"), ("parquet", "json"))


def test_only_a_missing_path_reads_as_empty(spark, tmp_path):
    gone = tables.read_or_empty(spark, str(tmp_path / "gone"), "a int")
    assert gone.count() == 0 and gone.columns == ["a"]
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part.parquet").write_text("not parquet")
    with pytest.raises(FAILURES):
        tables.read_or_empty(spark, str(broken), "a int").count()
    assert not tables.table_exists(spark, str(tmp_path / "gone"))


def test_literal_rows_keep_all_null_columns(spark):
    df = tables.literal_rows(spark, [{"a": 1}, {"a": 2}], "a int, b string, t timestamp", ("t",), "yyyy")
    assert df.schema["b"].dataType == T.StringType() and df.schema["t"].dataType == T.TimestampType()
    assert [r["b"] for r in df.collect()] == [None, None]


@pytest.mark.parametrize("infer", ["true", "false"])
def test_catalog_keeps_partitions_as_text_and_prunes(spark, tmp_path, infer):
    spark.range(4).select("id", F.format_string("2025-07-%02d", "id").alias("date")).write.partitionBy("date").parquet(str(tmp_path / "products"))
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", infer)
    try:
        entry = {"name": "products", "dataPath": "products", "format": "parquet", "partitions": [{"name": "date", "type": "string"}]}
        df = tables.register_catalog(spark, [entry], str(tmp_path))["products"]
        assert df.schema["date"].dataType == T.StringType()
        day = spark.sql("SELECT * FROM products WHERE date = :d", args={"d": "2025-07-02"})
        assert [r["id"] for r in day.collect()] == [2]
        plan = day._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in plan
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    with pytest.raises(ValueError):
        tables.register_catalog(spark, [{**entry, "partitions": [{"name": "day", "type": "string"}]}], str(tmp_path))


def test_csv_needs_its_schema(spark, tmp_path):
    path = tmp_path / "ids.csv"
    path.write_text("UserId,name\n1,a\nx,b\n")
    with pytest.raises(FAILURES):
        tables.read_csv(spark, str(path), "UserId int, name string").collect()
    assert tables.read_csv(spark, str(path), "UserId string, name string").count() == 2


def test_sized_files_and_manifest(spark, tmp_path):
    path = str(tmp_path / "out")
    files.write_sized(spark.range(100), path, 3, 10)
    listed = files.manifest(spark, path, "parquet", dt.datetime(2025, 1, 2, 3, 4, 5), 10, 1)
    sizes = listed.collect()
    assert len(sizes) == 12 and sizes[0]["run_ts"] == "2025-01-02T03:04:05Z"
    assert all(s["file_name"].endswith(".parquet") and s["size_bytes"] > 0 for s in sizes)
    where = files.write_manifest(listed, path)
    assert spark.read.json(where).count() == 12
    assert spark.read.parquet(path).count() == 100
    assert files.manifest_summary(listed).first()["actual_file_count"] == 12


def test_event_files(spark, tmp_path):
    path = str(tmp_path / "events")
    summary = generate_event_files(spark, path, 3, 20, 1).first()
    assert summary["actual_file_count"] == 3
    rows = spark.read.parquet(path)
    assert rows.count() == 60 and rows.select("pos").distinct().count() == 60
    assert {r["count"] for r in rows.groupBy(F.input_file_name()).count().collect()} == {20}


def test_bucketed_table_is_not_shuffled(spark):
    lake.save_bucketed(spark.range(1000).withColumn("v", F.lit(1)), "bucketed_table", "id", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = keyed.absent_by_key(spark.table("bucketed_table"), spark.range(10), "id")
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert left.count() == 990 and plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_table")


def test_indexed_files_are_ranges(spark, tmp_path):
    path = str(tmp_path / "indexed")
    lake.write_indexed(spark.range(1000).withColumn("email", F.sha1(F.col("id").cast("string"))), path, "id", ["email"])
    ranges = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("a").collect()
    assert all(x["b"] < y["a"] for x, y in zip(ranges, ranges[1:]))


def test_target_size_in_one_pass(spark, tmp_path):
    df = spark.range(40000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    path = str(tmp_path / "out")
    limit = files.write_to_target_size(df.coalesce(1), path, target_mb=1)
    sizes = sorted(r["size_bytes"] for r in tables.list_files(spark, path, ".parquet").collect())
    assert len(sizes) > 1 and 0.7 < sizes[-1] / 2**20 < 1.3 and limit < 40000
    assert files.rows_for_size(df, 2**20) == pytest.approx(limit, rel=0.2)


def test_small_files_are_packed(spark, tmp_path):
    """Many tasks with little each: near the target but for one file, every row once, appended files left alone."""
    df = spark.range(60000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    path = str(tmp_path / "out")
    files.write_to_target_size(df.repartition(24), path, target_mb=1)
    sizes = sorted(r["size_bytes"] / 2**20 for r in tables.list_files(spark, path, ".parquet").collect())
    assert sum(0.8 <= s <= 1.2 for s in sizes) >= len(sizes) - 1 and len(sizes) < 8
    assert spark.read.parquet(path).exceptAll(df).isEmpty() and spark.read.parquet(path).count() == 60000
    before = {r["file_name"] for r in tables.list_files(spark, path, ".parquet").collect()}
    files.write_to_target_size(df.limit(100), path, target_mb=1, mode="append")
    after = {r["file_name"] for r in tables.list_files(spark, path, ".parquet").collect()}
    assert before < after and len(after) == len(before) + 1 and spark.read.parquet(path).count() == 60100
    files.write_to_target_size(df.limit(0), path, target_mb=1)
    assert spark.read.schema(df.schema).parquet(path).count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_files_are_near_the_target_where_rows_shrink_together(spark, tmp_path, fmt):
    """Rows that share a file share its dictionary: packed files come out small and are cut anew."""
    df = spark.range(50000).select((F.col("id") % 7).alias("id"), F.sha2((F.col("id") % 4000).cast("string"), 256).alias("h"))
    path = str(tmp_path / "out")
    files.write_to_target_size(df.repartition(24), path, target_mb=0.1, fmt=fmt)
    sizes = sorted(r["size_bytes"] / 2**20 / 0.1 for r in tables.list_files(spark, path, files.SUFFIX[fmt]).collect())
    assert sum(0.8 <= s <= 1.2 for s in sizes) >= len(sizes) - 1 and max(sizes) < 1.3
    assert keyed.differing_rows(spark.read.schema(df.schema).format(fmt).load(path), df).isEmpty()


def test_sized_files_are_one_task_each(spark, tmp_path):
    """As many tasks as files, exactly full ones too; rows of uneven partitions are dealt out evenly."""
    df = spark.range(0, 1000, 1, 3).unionByName(spark.range(1000, 1200, 1, 5))
    path = str(tmp_path / "out")
    files.write_sized(df, path, 4, 100)
    back = spark.read.parquet(path)
    names = back.groupBy(F.col("_metadata.file_name").alias("name")).count().collect()
    assert [r["count"] for r in names] == [100] * 12 and len({r["name"].split("-")[1] for r in names}) == 12
    assert sorted(r["id"] for r in back.collect()) == list(range(1200))
    files.write_sized(df.limit(0), path, 4, 100)
    assert spark.read.schema(df.schema).parquet(path).count() == 0


def test_bins_hold_what_fits():
    rng = __import__("random").Random(1)
    sizes = {f"f{i}": rng.randrange(1, 90) for i in range(200)}
    bins = files.bins_of(sizes, 100)
    assert sorted(n for b in bins for n in b) == sorted(sizes)
    full = [sum(sizes[n] for n in b) for b in bins]
    assert max(full) <= 100 and sum(s < 50 for s in full) <= 1 and len(bins) <= 1.3 * sum(sizes.values()) / 100 + 1


def test_round_trip_counts_copies(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "i int, s string")
    assert files.write_and_compare(df, str(tmp_path / "rt")).isEmpty()


def test_table_survives_overwriting_itself(spark, tmp_path):
    table = lake.VersionedTable(spark, str(tmp_path / "v"), "id long")
    assert table.read().count() == 0
    table.write(spark.range(10))
    table.write(table.read().where("id < 4"))
    assert table.read().count() == 4 and table.version() == 2
    # A write that failed before its commit is not seen, and the next write replaces it.
    spark.range(99).write.parquet(str(tmp_path / "v/data/version=3"))
    assert table.read().count() == 4
    table.write(spark.range(1))
    assert table.read().count() == 1


def test_change_table_replays_and_compacts(spark, tmp_path):
    schema = "id int, v string, pos long, op string"
    table = lake.ChangeTable(spark, str(tmp_path / "c"), schema, "id", "pos")

    def batch(*rows):
        return spark.createDataFrame(list(rows), schema)

    def rows():
        return sorted((r["id"], r["v"]) for r in table.read().collect())

    assert rows() == [] and table.compact() == 0
    table.append(batch((1, "a", 1, "I"), (2, "b", 2, "I")), 0)
    table.append(batch((1, "a2", 3, "U"), (2, None, 4, "D")), 1)
    table.append(batch((1, "a2", 3, "U"), (2, None, 4, "D")), 1)
    assert rows() == [(1, "a2")]
    assert table.compact() == 1 and rows() == [(1, "a2")]
    table.append(batch((2, "late", 3, "U"), (1, "late", 2, "U"), (3, "c", 5, "I")), 2)
    assert rows() == [(1, "a2"), (3, "c")]
    assert table.compact(forget=F.col("pos") < 100) == 2 and rows() == [(1, "a2"), (3, "c")]
    assert table.state().where("op = 'D'").isEmpty()
    assert table.compact() == 2


def test_tables_are_registered(spark, tmp_path):
    path = str(tmp_path / "reg")
    lake.write_table(spark.range(3), path)
    lake.register_table(spark, "registered_files", path)
    assert spark.table("registered_files").count() == 3
    lake.save_as_table(spark.range(5), "saved_table")
    assert spark.table("saved_table").count() == 5
    spark.sql("DROP TABLE registered_files")
    spark.sql("DROP TABLE saved_table")


def test_save_modes(spark, tmp_path):
    path = str(tmp_path / "m")
    lake.write_table(spark.range(2), path)
    with pytest.raises(AnalysisException):
        lake.write_table(spark.range(2), path)
    lake.write_table(spark.range(2), path, "ignore")
    assert spark.read.parquet(path).count() == 2


def test_lake_options():
    plain = lake.lake_options("t", "id", "ts")
    assert plain["hoodie.datasource.write.operation"] == "upsert"
    assert not any("partition" in k or "hive" in k for k in plain)
    full = lake.lake_options("t", "id", "ts", "insert", "COPY_ON_WRITE", "day", True, {"hoodie.table.name": "u"})
    assert full["hoodie.table.name"] == "u" and full["hoodie.datasource.write.partitionpath.field"] == "day"
    assert full["hoodie.datasource.hive_sync.partition_fields"] == "day"
    schema = T._parse_datatype_string("id int, ts timestamp")
    lake.lake_options("t", "id", "ts", schema=schema)
    with pytest.raises(ValueError):
        lake.lake_options("t", "id", "update_ts", schema=schema)
    with pytest.raises(ValueError):
        lake.lake_options("t", "id", "ts", "merge")


def test_missing_connectors_are_reported(spark, tmp_path):
    with pytest.raises(tables.MissingConnector):
        lake.write_lake(spark.range(1), str(tmp_path / "h"), lake.lake_options("t", "id", "id"), "append")
    with pytest.raises(tables.MissingConnector):
        avro.read_avro(spark, str(tmp_path), json.dumps({"type": "record", "name": "r", "fields": []}))
    with pytest.raises(tables.MissingConnector):
        stream.topic_stream(spark, "host:9092", "topic")


def test_jdbc_options():
    assert jdbc.query_options("u", "SELECT 1") == {"url": "u", "query": "SELECT 1"}
    split = jdbc.table_options("u", "t", ("id", 0, 100, 8))
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "8"
    assert jdbc.load_options("u", "t", 50_000, 4) == {"url": "u", "dbtable": "t", "batchsize": "50000", "numPartitions": "4"}


def test_object_store_settings_come_from_the_environment():
    assert session.object_store_conf({}) == {}
    conf = session.object_store_conf({"S3A_ENDPOINT": "http://h:9000", "AWS_ACCESS_KEY_ID": "a", "AWS_SECRET_ACCESS_KEY": "b"})
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "a"


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == configured
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_spec_sizes():
    assert {k: len(v) for k, v in SPECS.items()} == {
        "stock_transactions": 100, "cash_transaction_history": 51, "customer_information": 72,
        "customer_information_small": 20, "customer_transactions": 78}
