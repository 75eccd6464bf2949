"""Spark session settings and the shared work folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

#: Settings every job relies on. AQE splits skewed join partitions and merges small
#: shuffle partitions; a side is broadcast only when its measured size is below the
#: threshold, never by a hint.
BASE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


#: On a cluster shuffles start with many partitions, and AQE merges those that turn out small;
#: it cannot split one that is too large outside skewed joins and rebalances.
CLUSTER_CONF = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192"}


def object_store_conf() -> dict[str, str]:
    """S3A settings for an S3-compatible lake; secrets come from the environment only."""
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": "true",
    }
    for key, variable in (
        ("spark.hadoop.fs.s3a.endpoint", "AWS_ENDPOINT_URL"),
        ("spark.hadoop.fs.s3a.access.key", "AWS_ACCESS_KEY_ID"),
        ("spark.hadoop.fs.s3a.secret.key", "AWS_SECRET_ACCESS_KEY"),
    ):
        if os.environ.get(variable):
            conf[key] = os.environ[variable]
    return conf


def build_session(
    app_name: str = "adloom",
    master: str | None = None,
    object_store: bool = False,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with the library's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF) if (master or "").startswith("local") else BASE_CONF | CLUSTER_CONF
    if object_store:
        conf.update(object_store_conf())
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of code above which the JVM leaves a method interpreted; Spark by itself generates methods of up to 65,535.
HUGE_METHOD, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session inside this block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_dropped(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of a write in this block go when it ends, not when the driver next collects its garbage."""
    return _setting(spark, SHUFFLE_CLEANUP, "true")


def methods_compiled(spark: SparkSession) -> AbstractContextManager[None]:
    """Stages of wide rows run operator by operator in this block, where one method for all would be too large to be compiled."""
    return _setting(spark, HUGE_METHOD, COMPILED_BYTES)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate tables, below the folder all executors share (``spark.checkpoint.dir``)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/adloom/{name}-{uuid.uuid4().hex}"
