import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.operators import keyed, mapping, masking, sampling

SALT = "s"
EMPTY = "cust_id string, uuid string"


def source(spark, n):
    return spark.range(n).select(F.format_string("%05d", "id").alias("cust_id"))


def test_mapping_grows_and_keeps_ids(spark):
    sizes, previous = [], {}
    current = spark.createDataFrame([], EMPTY)
    for n, fraction in ((10, 0.5), (10, 0.5), (25, 0.5), (25, 1.0)):
        rows = source(spark, n).unionByName(spark.createDataFrame([(None,)], "cust_id string"))
        result = mapping.update_uuid_mapping(rows.unionByName(rows), current, "cust_id", SALT, fraction)
        current = result.mapping
        now = {r["cust_id"]: r["uuid"] for r in current.collect()}
        assert previous.items() <= now.items()
        assert len(set(now.values())) == len(now) and None not in now
        assert result.added == len(now) - len(previous)
        previous = now
        sizes.append(len(now))
    assert sizes == [5, 5, 12, 25]


def test_mapping_refuses_duplicates(spark):
    bad = spark.createDataFrame([("1", "u"), ("2", "u"), ("3", "v")], EMPTY)
    with pytest.raises(ValueError):
        mapping.update_uuid_mapping(source(spark, 5), bad, "cust_id", SALT)
    assert sorted(r["cust_id"] for r in mapping.mapping_duplicates(bad).collect()) == ["1", "2"]


def test_clash_with_a_stored_id_is_repaired(spark):
    keys = source(spark, 3)
    taken = keys.limit(1).select(F.lit("stored").alias("cust_id"), mapping.derived_uuid(F.lit("00001"), SALT).alias("uuid"))
    new = mapping.assign_unique_uuids(keys, taken, "cust_id", SALT)
    assert new.count() == 3
    assert new.join(taken, "uuid", "left_semi").isEmpty()


def test_repair_counts(spark):
    rows = spark.range(6).select("id", (F.col("id") % 3).alias("v"))
    stored = spark.createDataFrame([(0,)], "v long")
    fixed, report = mapping.repair_unique(rows, stored, "v", ["id"], lambda n: F.col("id") + 10 * n)
    assert {r["id"]: r["v"] for r in fixed.collect()} == {0: 10, 1: 1, 2: 2, 3: 13, 4: 14, 5: 15}
    assert report == {"regenerated": 4, "skipped": 0}
    left, report = mapping.repair_unique(rows, stored, "v", ["id"], lambda n: F.lit(0).cast("long"), max_attempts=2)
    assert left.count() == 2 and report["skipped"] == 4


ROW = st.tuples(st.integers(0, 4) | st.none(), st.integers(0, 4) | st.none())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=3), st.lists(ROW, min_size=1, max_size=9))
def test_load_decides_as_one_by_one_inserts(spark, stored, rows):
    ids = {a for a, _ in stored if a is not None}
    accounts = {b for _, b in stored if b is not None}
    loaded = []
    for n, (a, b) in enumerate(rows):
        if a in ids or b in accounts:
            continue
        loaded.append(n)
        ids |= {a} - {None}
        accounts |= {b} - {None}
    have = spark.createDataFrame(stored, "a int, b int")
    incoming = spark.createDataFrame([(n, a, b) for n, (a, b) in enumerate(rows)], "n int, a int, b int")
    accept, reject = mapping.load_skipping_duplicates(have, incoming, ["a", "b"], ["n"])
    assert sorted(r["n"] for r in accept.collect()) == loaded
    assert sorted(r["n"] for r in reject.collect()) == [n for n in range(len(rows)) if n not in loaded]


@pytest.mark.parametrize("one_task", [10**6, 2])
def test_load_in_one_task_or_in_rounds(spark, one_task):
    """A few components, decided in order or in rounds, with keys of two types."""
    rows = [(n, n // 2 % 7 if n % 5 else None, f"k{n % 3}" if n % 4 else None) for n in range(40)]
    taken, loaded = [set(), set()], []
    for n, *keys in rows:
        if not any(k in t for k, t in zip(keys, taken)):
            loaded.append(n)
            for k, t in zip(keys, taken):
                t |= {k} - {None}
    incoming = spark.createDataFrame(rows, "n int, a int, b string")
    accept, reject = mapping.load_skipping_duplicates(incoming.limit(0), incoming, ["a", "b"], ["n"], one_task)
    assert sorted(r["n"] for r in accept.collect()) == loaded
    assert reject.count() == len(rows) - len(loaded)


def test_a_long_chain_takes_few_jobs(spark):
    """Each row shares a key with the next one: every second row is loaded."""
    n = 1000
    rows = [(i, i // 2, (i + 1) // 2 + 10**6) for i in range(n)]
    incoming = spark.createDataFrame(rows, "n int, a int, b int").repartition(4)
    spark.sparkContext.setJobGroup("chain", "chain")
    try:
        accept, reject = mapping.load_skipping_duplicates(incoming.limit(0), incoming, ["a", "b"], ["n"])
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("chain"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(r["n"] for r in accept.collect()) == list(range(0, n, 2)) and reject.count() == n // 2
    assert jobs < 250


def test_a_chain_longer_than_a_task_takes_few_jobs(spark):
    """Blocks of a chain are decided one after the other: jobs grow with the blocks, not with the rows."""
    rows = [(i, i // 2, (i + 1) // 2 + 10**6) for i in range(240)]
    incoming = spark.createDataFrame(rows, "n int, a int, b int").repartition(4)
    spark.sparkContext.setJobGroup("blocks", "blocks")
    try:
        accept, reject = mapping.load_skipping_duplicates(incoming.limit(0), incoming, ["a", "b"], ["n"], 70)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("blocks"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(r["n"] for r in accept.collect()) == list(range(0, 240, 2)) and reject.count() == 120
    assert jobs < 250


def test_blocks_are_cut_in_order_within_each_component(spark):
    rows = spark.range(100).select(F.col("id").alias("_row"), (F.col("id") % 3).alias("_component"), (-F.col("id")).alias("n"))
    found = {r["_row"]: r["_block"] for r in mapping._in_blocks(rows.repartition(5), ["n"], 10).collect()}
    assert found == {i: (99 - i) // 3 // 10 if i % 3 == 0 else ((97 if i % 3 == 1 else 98) - i) // 3 // 10 for i in range(100)}


def test_components_of_links(spark):
    from tidewell.operators import graph

    links = [(i, i + 1) for i in range(300, 360)] + [(900, k) for k in range(901, 940)] + [(7, 7), (None, 3), (5, 6), (6, 5)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    wanted = {i: 300 for i in range(300, 361)} | {k: 900 for k in range(900, 940)} | {5: 5, 6: 5}
    assert got == wanted
    assert graph.components(spark.createDataFrame([], "u long, v long")).isEmpty()


def test_second_sync_covers_everything(spark):
    rows = source(spark, 21)
    first = mapping.sync_sampled_copy(rows, None, "cust_id", SALT)
    assert first.count() == 10
    assert mapping.sync_sampled_copy(rows, first, "cust_id", SALT).count() == 11
    assert mapping.sync_sampled_copy(rows, first, "cust_id", SALT, incremental_fraction=0.5).count() == 5


@pytest.mark.parametrize("n", [0, 1, 77, 500, 999, 1000, 1500])
def test_large_samples_are_exact(spark, monkeypatch, n):
    df = spark.range(1000).withColumnRenamed("id", "k")
    small = {r["k"] for r in df.orderBy(sampling.sample_order("k", 4)).limit(n).collect()}
    monkeypatch.setattr(sampling, "CELL", 40)  # the band around the cut is cut again
    monkeypatch.setattr(sampling, "MARGIN", 0.06)
    monkeypatch.setattr(sampling, "SKETCH", 100)
    large = [r["k"] for r in sampling.sample_exact(df.repartition(5), "k", n, seed=4).collect()]
    assert len(large) == min(n, 1000) and set(large) == small


@pytest.mark.parametrize("n", [10, 400, 650])
def test_samples_of_a_repeated_key_are_exact(spark, monkeypatch, n):
    monkeypatch.setattr(sampling, "_DIGIT_BITS", 4)
    monkeypatch.setattr(sampling, "_DIGITS", 16)
    monkeypatch.setattr(sampling, "CELL", 30)
    df = spark.range(700).select(F.when(F.col("id") < 500, 7).otherwise(F.col("id")).alias("k"), (F.col("id") % 350).alias("v"))
    first = sampling.sample_exact(df, "k", n, seed=1)
    assert first.count() == n and first.exceptAll(df).isEmpty()
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, sampling.sample_exact(df.repartition(9), "k", n, seed=1).collect()))


def test_rank_follows_the_sample_order(spark):
    df = spark.range(300).withColumnRenamed("id", "k")
    ranks = {r["rank"]: r["k"] for r in sampling.with_rank(df, "k", seed=2).collect()}
    assert sorted(ranks) == list(range(300))
    first = {r["k"] for r in sampling.sample_exact(df, "k", 25, seed=2).collect()}
    assert first == {ranks[i] for i in range(25)}


def test_approximate_sample(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    assert 0.45 < sampling.sample_approximately(df, "k", 0.5).count() / 20000 < 0.55


def test_null_keys_stay_null_and_never_join(spark, monkeypatch):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([("x", 3), (None, 4)], "k string, b int")
    tables = masking.mask_tables({"a": (a, "k"), "b": (b, "k")}, SALT)
    joined = masking.join_masked(tables["a"], tables["b"], "k").collect()
    assert [(r["a"], r["b"]) for r in joined] == [(1, 3)]
    assert len(joined[0]["k"]) == 64
    monkeypatch.delenv(masking.SALT_VARIABLE, raising=False)
    with pytest.raises(RuntimeError):
        masking.salt_from_environment()


KEYS = st.lists(st.integers(0, 6) | st.none(), max_size=8)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(KEYS, KEYS)
def test_unmatched_keys_partition_the_ids(spark, a, b):
    left = spark.createDataFrame([(x,) for x in a], "k int")
    right = spark.createDataFrame([(x,) for x in b], "k int")
    got = {(r["key"], r["side"]) for r in keyed.unmatched_keys(left, right, "k").collect()}
    sa, sb = set(a) - {None}, set(b) - {None}
    assert got == {(x, "a") for x in sa - sb} | {(x, "b") for x in sb - sa}
    only_a, only_b = keyed.unmatched_rows(left, right, "k")
    assert sorted(r["k"] for r in only_a.collect()) == sorted(x for x in a if x in sa - sb)
    assert sorted(r["k"] for r in only_b.collect()) == sorted(x for x in b if x in sb - sa)


def test_hot_keys_are_split_and_nothing_is_lost(spark):
    many = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("k"), "id")
    many = many.unionByName(spark.createDataFrame([(None, -1), (555, -2)], "k long, id long"))
    one = spark.range(101).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert [r["k"] for r in keyed.hot_keys(many, "k", 0.1).collect()] == [7]
    split = keyed.join_many_to_one(many, one, "k", 0.1, 4)
    assert keyed.differing_rows(split, many.join(one, "k")).isEmpty()


def test_equal_copies_of_a_hot_key_are_spread(spark):
    many = spark.range(0, 4000, 1, 16).select(F.lit(1).cast("long").alias("k"))
    one = spark.createDataFrame([(1, "v")], "k long, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = keyed.join_many_to_one(many, one, "k", 0.1, 16)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4000 and max(sizes) < 2500


def test_append_dedupe_rules(spark):
    stored = spark.createDataFrame([(1,), (None,)], "id int")
    new = spark.createDataFrame([(0, 1, "a"), (1, 2, "b"), (2, 2, "c"), (3, None, "d")], "n int, id int, v string")
    assert sorted(r["v"] for r in keyed.append_dedupe(stored, new, "id", "n").collect()) == ["b", "d"]


def test_latest_is_repeatable_on_ties(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.lit(1).alias("t"), F.col("id").alias("v"))
    once = {tuple(r) for r in keyed.latest_per_key(df, "k", "t").collect()}
    again = {tuple(r) for r in keyed.latest_per_key(df.repartition(7), "k", "t").collect()}
    assert once == again and len(once) == 3


def test_ties_and_comparison_with_maps(spark):
    df = spark.range(60).select((F.col("id") % 3).alias("k"), F.lit(1).alias("t"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    once = {(r["k"], r["m"]["a"]) for r in keyed.latest_per_key(df, "k", "t").collect()}
    again = {(r["k"], r["m"]["a"]) for r in keyed.latest_per_key(df.repartition(7), "k", "t").collect()}
    assert once == again and len(once) == 3
    assert keyed.differing_rows(df, df).isEmpty()
    assert keyed.differing_rows(df, df.where("m['a'] <> 5")).count() == 1


def test_upsert_rules(spark):
    schema = "id int, v string, t int"
    target = spark.createDataFrame([(1, "old", 5), (2, "old", 5), (3, "old", None)], schema)
    changes = spark.createDataFrame([(1, "older", 4), (2, None, 5), (3, "new", 1), (4, "a", 1), (4, "b", 2)], schema)
    rows = sorted(tuple(r) for r in keyed.upsert_by_key(target, changes, "id", "t").collect())
    assert rows == [(1, "old", 5), (2, None, 5), (3, "new", 1), (4, "b", 2)]


def test_update_writes_nulls(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, v string, w int")
    changes = spark.createDataFrame([(1, None, 1), (1, "x", 0), (9, "y", 0)], "id int, v string, n int")
    rows = sorted(tuple(r) for r in keyed.update_by_key(target, changes, "id", "v", order="n").collect())
    assert rows == [(1, None, 1), (2, "b", 2)]


def test_update_of_a_repeated_key_fails_without_an_order(spark):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    changes = spark.createDataFrame([(1, "b"), (1, "c")], "id int, v string")
    with pytest.raises(Exception, match="changed twice"):
        keyed.update_by_key(target, changes, "id", "v").collect()


def test_null_keys_change_nothing(spark):
    target = spark.createDataFrame([(1, "a", 0), (None, "n", 0)], "id int, v string, n int")
    changes = spark.createDataFrame([(None, "x", 1), (2, "b", 1), (1, "c", 1)], "id int, v string, n int")
    once = keyed.upsert_by_key(target, changes, "id", "n")
    twice = keyed.upsert_by_key(once, changes, "id", "n")
    rows = sorted((r["id"] or 0, r["v"]) for r in twice.collect())
    assert rows == sorted((r["id"] or 0, r["v"]) for r in once.collect()) == [(0, "n"), (1, "c"), (2, "b")]
    assert keyed.split_null_keys(changes, "id")[1].count() == 1


def test_rows_that_cannot_be_repaired_are_returned(spark):
    rows = spark.range(50).select("id", F.lit(1).alias("v"))
    done = mapping.repair_unique_columns(rows, rows.limit(0), {"v": lambda n: F.lit(1)}, ["id"], max_attempts=2)
    assert (done.accepted.count(), done.rejected.count(), done.skipped) == (1, 49, 49)


def fullest_share(spark, df):
    """The largest part of a join's probe rows that one task read."""
    # The id stays in the plan, so that rows of one key have a size of their own; an aggregate over the sizes would drop it.
    sizes = df.select(F.spark_partition_id().alias("p"), "id").groupBy("p").agg(F.count("*").alias("n"), F.max("id"))
    counts = [r["n"] for r in sizes.collect()]
    return max(counts) / sum(counts)


@pytest.mark.parametrize("side", ["left", "right", "null"])
def test_existence_joins_split_hot_keys(spark, side):
    hot = F.lit(None).cast("long") if side == "null" else F.lit(7).cast("long")
    skewed = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, hot).otherwise(F.col("id")).alias("k"), "id")
    even = spark.range(300_000).select(F.col("id").alias("k"), "id").where("k % 2 = 1")
    left, right = (even, skewed) if side == "right" else (skewed, even)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        join = keyed.absent_by_key if side == "null" else keyed.present_by_key
        assert fullest_share(spark, join(left, right, "k")) < 0.2
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_staged_copies_are_removed(spark):
    import os

    from tidewell import session

    session.release_staged(spark)
    copy = session.staged(spark.range(5))
    path = copy.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path) and copy.count() == 5
    assert session.release_staged(spark) == 1 and not os.path.exists(path)


@pytest.mark.parametrize("n", [0, 5, 60, 300, 777, 990, 1000, 2000])
def test_first_rows_by_ranges(spark, monkeypatch, n):
    """More rows than one task should merge: NULLs, a value with most rows, ties decided by the second key."""
    monkeypatch.setattr(sampling, "RANGES", 8)
    a = F.when(F.col("id") % 100 == 3, None).when(F.col("id") % 5 > 0, 50).otherwise(F.col("id") % 83)
    df = spark.range(1000).select(a.alias("a"), F.concat(F.lit("t"), F.col("id") * 7 % 1000).alias("b"))
    rows = sorted(map(tuple, df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = sampling.first_n(df, ["a", "b"], n, few=20)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(rows[:n], key=repr)
