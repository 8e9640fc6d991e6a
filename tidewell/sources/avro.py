"""Avro scans with a schema that Spark can read. The scan itself needs the Avro connector."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from tidewell.sources.tables import connector

# Spark's widest decimal.
MAX_PRECISION = 38


def safe_reader_schema(document):
    """A reader schema whose decimals beyond 38 digits are plain bytes or fixed.

    Takes the schema as JSON text or parsed, and answers in the same form; once per table.
    """
    if isinstance(document, str):
        return json.dumps(_readable(json.loads(document)))
    return _readable(document)


def _readable(node):
    if isinstance(node, list):
        return [_readable(branch) for branch in node]
    if not isinstance(node, dict):
        return node
    if node.get("logicalType") == "decimal" and node.get("precision", 0) > MAX_PRECISION:
        return {k: v for k, v in node.items() if k not in ("logicalType", "precision", "scale")}
    # Every place where a schema can hold further schemas.
    inner = {k: _readable(node[k]) for k in ("type", "items", "values") if k in node}
    if "fields" in node:
        inner["fields"] = [_readable(field) for field in node["fields"]]
    return {**node, **inner}


def _read_long(raw: bytes, at: int) -> tuple[int, int]:
    """A zigzag variable-length long and the position after it."""
    shift = value = 0
    while True:
        byte = raw[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if not byte & 0x80:
            return (value >> 1) ^ -(value & 1), at
        shift += 7


def header_schema(raw: bytes) -> str:
    """The writer schema in the header of an Avro container file."""
    if raw[:4] != b"Obj\x01":
        raise ValueError("not an Avro container file")
    at, found = 4, {}
    while True:
        count, at = _read_long(raw, at)
        if count == 0:
            break
        if count < 0:
            _, at = _read_long(raw, at)
        for _ in range(abs(count)):
            size, at = _read_long(raw, at)
            name, at = raw[at : at + size], at + size
            size, at = _read_long(raw, at)
            found[name.decode()], at = raw[at : at + size], at + size
    if "avro.schema" not in found:
        raise ValueError("the header carries no schema")
    return found["avro.schema"].decode()


def writer_schema(spark: SparkSession, file: str) -> str:
    """The writer schema of one container file, read in a task."""

    def from_files(batches):
        import pandas as pd

        for batch in batches:
            yield pd.DataFrame({"schema": [header_schema(bytes(c)) for c in batch["content"]]})

    content = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.avro")
        .load(file)
        .select("content")
    )
    found = content.mapInPandas(from_files, "schema string").distinct().collect()
    if not found:
        raise FileNotFoundError(f"no Avro file at {file}")
    if len(found) > 1:
        raise ValueError(f"the files at {file} have {len(found)} writer schemas: give one file or a schema")
    return found[0]["schema"]


def read_avro(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An Avro scan with a reader schema, made safe. The schema is the table's, declared by the caller:
    one file's own would drop the columns that other files added."""
    with connector("avro"):
        return spark.read.format("avro").option("avroSchema", safe_reader_schema(schema)).load(path)
