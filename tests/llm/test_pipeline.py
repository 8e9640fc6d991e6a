"""The pipeline against a plain version of its stages on a small table."""

import corpus_pipeline
from tests.llm import brute
from tidewell.llm import quality_rules
from tidewell.llm.pieces import model_path
from tidewell.llm.sentencepiece_nbest import encoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain(rows, items, spark):
    judged = quality_rules.quality_report(spark.createDataFrame(rows, SCHEMA)).collect()
    broken = {r["doc_id"] for r in judged if r["broken_rule"]}
    docs = {r[0]: r[1] for r in rows if not brute.quality(r[1])[-1] and r[0] not in broken}
    docs = {k: docs[k] for k, (_, c) in brute.components(list(docs.items()), 5).items() if k == c}
    for (key, _), (data, gone) in zip(list(docs.items()), brute.unrepeated(list(docs.values()), 200)):
        docs[key] = bytes(b for b, g in zip(data, gone) if not g).decode("utf-8", "ignore")
    docs = {k: t for k, t in docs.items() if brute.words(t)}
    flat = {k: " ".join(t.split()) for k, t in docs.items()}
    return {k: t for k, t in docs.items() if not any(" ".join(i.split()) in flat[k] for i in items)}


def test_pipeline_equals_plain_version(spark, doc_rows, tmp_path):
    items = [" ".join(doc_rows[k][1].split(" ")[2:14]) for k in (7, 9, 12)]
    spark.createDataFrame(doc_rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: r["piece_ids"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    wanted = plain(doc_rows, items, spark)
    engine = encoder(model_path())
    assert {k: engine.decode(ids) for k, ids in got.items()} == wanted
    assert 0 < len(wanted) < len(doc_rows)


def test_stages_return_documents(spark, docs, tmp_path):
    spark.createDataFrame([(1, "no such text stands in any of the documents here")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    for name, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, docs, str(tmp_path)).columns == docs.columns, name
        assert function(spark, docs, str(tmp_path)).dtypes == docs.dtypes, name


def test_empty_tables(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_pass_through(spark, tmp_path, doc_rows):
    """Null ids and repeated rows do not break a stage; a row without an id is not dropped by one."""
    good = [r for r in doc_rows[6:16]]
    rows = [*good, good[0], (None, *doc_rows[20][1:]), (None, *doc_rows[21][1:]), (3_000, None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, None), (1, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = [r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert 3_000 not in got and got.count(None) == 2


def test_one_of_equal_rows_survives(spark, tmp_path, doc_rows):
    """Also under a null id, and a row is not lost for another one of its id."""
    good = quality_rules.keep_good(spark.createDataFrame(doc_rows[6:30], SCHEMA)).orderBy("doc_id").collect()
    one, two, three = [r["text"] for r in good if len(r["text"].encode()) >= 250][:3]
    rows = [(1, one), (1, one), (None, two), (None, two), (None, one), (2, one), (2, three)]
    rows = [(k, t, "en", "web", len(t)) for k, t in rows]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    engine = encoder(model_path())
    got = [(r["doc_id"], engine.decode(r["piece_ids"])) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(1, one), (None, two), (2, three)], key=str)


def test_contaminated_rows_without_an_id_go(spark, tmp_path, doc_rows):
    rows = [(k, t, "en", "web", len(t)) for k, t in ((None, doc_rows[7][1]), (None, doc_rows[9][1]), (3, doc_rows[7][1]), (3, doc_rows[9][1]))]
    spark.createDataFrame([(1, doc_rows[7][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = corpus_pipeline.clean_documents(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path)).collect()
    assert [(r["doc_id"], r["text"]) for r in left] == [(None, doc_rows[9][1]), (3, doc_rows[9][1])]


def test_queries_are_registered():
    import re

    import __spark_entry__ as entry_point

    names = list(entry_point.queries())
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14)) and "pipeline" in names
