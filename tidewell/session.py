"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

# AQE decides join strategy, partition counts and skew splits from measured sizes.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM does not compile methods beyond 8,000 bytes: wide projections then run faster
    # as several smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Streaming state lives outside the heap, so its size is not bound by executor memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Partition values keep the text of the directory name; catalogs declare them as strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Environment variable -> Hadoop setting for S3-compatible stores.
S3A_ENVIRONMENT = {
    "S3A_ENDPOINT": "spark.hadoop.fs.s3a.endpoint",
    "AWS_ACCESS_KEY_ID": "spark.hadoop.fs.s3a.access.key",
    "AWS_SECRET_ACCESS_KEY": "spark.hadoop.fs.s3a.secret.key",
    "AWS_SESSION_TOKEN": "spark.hadoop.fs.s3a.session.token",
}


def object_store_conf(environ=None) -> dict[str, str]:
    """Settings for an S3-compatible store, taken from the environment only.

    Path-style addressing is switched on with a custom endpoint, and TLS follows its scheme.
    """
    environ = os.environ if environ is None else environ
    conf = {key: environ[name] for name, key in S3A_ENVIRONMENT.items() if environ.get(name)}
    endpoint = environ.get("S3A_ENDPOINT")
    if endpoint:
        conf["spark.hadoop.fs.s3a.path.style.access"] = "true"
        conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] = str(
            not endpoint.startswith("http://")
        ).lower()
    return conf


def build_session(app_name: str, master: str | None = None, conf: dict | None = None):
    """A session with the defaults above; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **object_store_conf(), **(conf or {})}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: what ``spark.checkpoint.dir`` names.

    Only a local master may go without the setting; there the folder lies in the warehouse. What the
    setting names is trusted to be shared, also a ``file:`` path, which may be a mounted store.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder on whichever file system holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def move_files(spark: SparkSession, source: str, target: str, prefix: str = "") -> None:
    """Move a folder's files into another folder, which is made if need be, and remove the first one. One rename for each
    file, which puts ``prefix`` before its name, or for the whole folder where the target does not exist yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    where, to = path(source), path(target)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(to):
        if to.getParent() is not None:
            store.mkdirs(to.getParent())
        if not store.rename(where, to):
            raise OSError(f"cannot move {source} to {target}")
        return
    for status in store.listStatus(where):
        name = status.getPath().getName()
        if status.isFile() and not name.startswith(("_", ".")) and not store.rename(status.getPath(), path(to, prefix + name)):
            raise OSError(f"cannot move {name} to {target}")
    store.delete(where, True)


def child_folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names of a folder's children; none if there is no such folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(where):
        return []
    names = [status.getPath().getName() for status in store.listStatus(where) if status.isDirectory()]
    return sorted(name.removeprefix(prefix) for name in names if name.startswith(prefix))


_STAGED: list[str] = []


def staged(df, label: str = "staged"):
    """Write ``df`` to the shared folder and read it back.

    Later jobs then see one fixed result, and a lost executor re-reads files
    in place of repeating the plan above them. ``release_staged`` removes the copies.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("error").parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_copies(since: int = 0) -> list[str]:
    """Paths of the copies staged by this process, from the ``since``-th one on."""
    return _STAGED[since:]


def release_staged(spark: SparkSession) -> int:
    """Remove every copy staged so far by this process and return their number.

    For the owner of the results to call, once they are stored or no longer read: a frame that was
    built on a staged copy cannot be read afterwards.
    """
    paths, _STAGED[:] = list(_STAGED), []
    for path in paths:
        delete_path(spark, path)
    return len(paths)
