"""Licence scan against a plain version of its base part, and its expressions by hand."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidewell.llm import license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    found = [(i, label) for phrase, label in license_scan.BASE.items() for part in [phrase.split()]
             for i in range(len(words)) if words[i : i + len(part)] == part]
    starts = [i for i, _ in found]
    return (len(words), len(found), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in found})))


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels")


def report(frame):
    return {r["doc_id"]: r for r in license_scan.license_report(frame).collect()}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    parts = ("the MIT License mit license. LICENSE gnu General public-license apache\nlicense CC BY cc_by cc-by-nc accc by "
             "by né license é mit SPDX-License-Identifier: GPL-2.0 or (MIT and x) \t under licensed under general").split(" ")
    out = [" ".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(300)]
    return [*out, None, "", " ", "mit", "license mit", "MIT License", "xmit license", "mit licensee", "é mit license"]


def test_base_equals_plain_version(spark, texts, monkeypatch):
    rows = list(enumerate(texts))
    got = report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {k: tuple(r[c] for c in COLUMNS) for k, r in got.items()} == {k: plain(t) for k, t in rows}
    for r in got.values():
        assert 0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
        assert (r["score"] > 0) == bool(r["labels"])


def test_texts_longer_than_a_step(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(license_scan, "STEP", 7)
    data = b"see the MIT License, gnu general public license and the apache license. mit license"
    counts, found = license_scan.scan(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert [(f[3], f[5]) for f in found] == [(2, ["mit"]), (4, ["gpl"]), (10, ["apache"]), (12, ["mit"])]
    assert counts.tolist() == [14] and [data[f[1] : f[2]] for f in found][0] == b"MIT License"


def test_long_text_and_many_finds(spark):
    text = "word mit license " * 200_000
    got = report(spark.createDataFrame([(1, text)], "doc_id long, text string"))[1]
    assert tuple(got[c] for c in COLUMNS) == (600_000, 200_000, 1, 599_998, "mit")


@pytest.mark.parametrize("text,labels,level,said", [
    ("SPDX-License-Identifier: MIT", "mit", "permissive", "mit"),
    ("// SPDX-License-Identifier: MIT OR GPL-2.0-only */ x", "gpl,mit", "permissive", "(mit or gpl-2.0-only)"),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 AND Apache-2.0", "apache,gpl", "weak copyleft",
     "((gpl-2.0-only with classpath-exception-2.0) and apache-2.0)"),
    ("(SPDX-License-Identifier: (MIT or AGPL-3.0+) and LGPL-2.1)", "agpl,lgpl,mit", "weak copyleft",
     "((mit or agpl-3.0+) and lgpl-2.1)"),
    ("SPDX-License-Identifier: a or b and c\nMIT", "other", "unknown", "(a or (b and c))"),
    ("SPDX-License-Identifier: CC-BY-NC-4.0 AND (", "cc-by,cc-by-nc", "restricted", "cc-by-nc-4.0"),
])
def test_tags(spark, text, labels, level, said):
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = report(frame)[1]
    assert (got["labels"], got["tag_level"]) == (labels, level)
    finds = license_scan.find_licenses(frame).select(F.explode("finds").alias("f")).select("f.*").collect()
    assert [r["expression"] for r in finds if r["kind"] == "tag"] == [said]


def test_scores(spark):
    rows = [(1, "the MIT license"), (2, "Released under the MIT License."), (3, "SPDX-License-Identifier: MIT"),
            (4, "SPDX-License-Identifier: my-own"), (5, "nothing here"), (6, "SPDX-License-Identifier:"),
            (7, "released under " + "word " * 20 + "mit license")]
    got = report(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [got[k]["score"] for k in range(1, 8)] == [0.7, 0.9, 1.0, 0.5, 0.0, 0.0, 0.7]


def test_malformed_expressions_are_evaluated():
    rng = random.Random(7)
    for _ in range(5000):
        text = " ".join(rng.choices(["a", "(", ")", "and", "or", "with", "mit"], k=rng.randint(0, 12))).encode()
        notation, end, _ = license_scan.parse(license_scan.tokens(text, 0, len(text)), 0)
        if notation:
            names, _, said = license_scan.evaluate(notation)
            again, _, whole = license_scan.parse(license_scan.tokens(said.encode(), 0, len(said)), 0)
            assert whole and again == notation and names
    long = b"mit or (" * 50_000
    notation, _, whole = license_scan.parse(license_scan.tokens(long, 0, len(long)), 0)
    assert not whole and license_scan.evaluate(notation)[0] == ["mit"]


def test_odd_tables(spark, empty, clashing, doc_rows):
    assert license_scan.license_report(empty).count() == 0
    got = report(clashing)
    assert {k: tuple(r[c] for c in COLUMNS) for k, r in got.items()} == {r[0]: plain(r[1]) for r in doc_rows}
    rows = [(None, "mit license"), (None, "mit license"), (1, None), (1, "x")]
    assert license_scan.license_report(spark.createDataFrame(rows, "doc_id long, text string")).count() == 4
