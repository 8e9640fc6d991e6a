import pytest
from pyspark.sql import functions as F

from tidewell.operators import quality
from tidewell.operators.quality_states import QualityStates

RULES = [
    {"rule": "row_count", "above": 3}, {"rule": "not_null", "column": "v"}, {"rule": "matches", "column": "v", "pattern": "^a"},
    {"rule": "unique", "column": "k"}, {"rule": "duplicate_count", "column": "k"}, {"rule": "unique", "column": "v"},
    {"rule": "schema", "column": "k", "type": "string"},
]


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def table(spark):
    rows = [(f"2024-01-{d:02d}", k, v) for d in range(1, 9) for k, v in ((d, "a"), (d % 3, None), (100 + d, "b" * d), (None, "a"))]
    return spark.createDataFrame(rows, "day string, k int, v string")


def test_every_range_equals_the_suite(spark, table, tmp_path):
    states = QualityStates(spark, str(tmp_path / "q"), RULES)
    states.add(table.where("day < '2024-01-05'"), F.col("day"))
    states.add(table.where("day >= '2024-01-04'"), F.col("day"))  # one day comes again
    for first, last in (("2024-01-01", "2024-01-08"), ("2024-01-03", "2024-01-05"), ("2024-01-07", "2024-01-07"), (None, None), ("2025", None)):
        chosen = table if first is None else table.where((F.col("day") >= first) & (F.col("day") <= (last or "9")))
        wanted = found(quality.run_suite(chosen, RULES))
        got = found(states.report(first, last))
        # A schema rule has nothing to say where no partition was seen.
        assert got == wanted or first == "2025" and got[:-1] == wanted[:-1]


def test_the_table_and_other_days_are_not_read(spark, table, tmp_path):
    path = str(tmp_path / "q")
    states = QualityStates(spark, path, RULES)
    states.add(table, F.col("day"))
    assert {f.split("part=")[1].split("/")[0] for f in states.states("2024-01-02", "2024-01-03").inputFiles()} >= {"2024-01-02", "2024-01-03"}
    text = states.report("2024-01-02", "2024-01-03")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in text and "slot" in text and text.count("FileScan") == 1
    assert "LocalTableScan" not in text and "ExistingRDD" not in text
    assert QualityStates(spark, path, RULES).report().count() == len(RULES)
    with pytest.raises(ValueError):
        QualityStates(spark, path, RULES[1:])


def test_an_empty_table_has_no_states(spark, table, tmp_path):
    states = QualityStates(spark, str(tmp_path / "q"), RULES)
    states.add(table.limit(0), F.col("day"))
    assert {r["observed"] for r in states.report().collect()} == {0}
