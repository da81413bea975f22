"""Session options shared by every job."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Adaptive execution joins small shuffle partitions and splits skewed ones of joins, but it never
# makes more of them: a shuffle starts with as many as its size may need.
SHUFFLE_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITION_BYTES = 128 << 20
# What a task reads of a file. Before a shuffle by key a task sorts all of it, which takes about ten times its bytes of Parquet.
SCAN_OPTION, SCAN_BYTES = "spark.sql.files.maxPartitionBytes", 32 << 20
BASE_OPTIONS = {
    SCAN_OPTION: str(SCAN_BYTES),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call sites of single column expressions: costly to collect, of use in a notebook.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Object-store client settings, used when an endpoint is given.
OBJECT_STORE_OPTIONS = {
    "spark.hadoop.fs.s3a.path.style.access": "true",
    "spark.hadoop.fs.s3a.connection.maximum": "100",
    "spark.hadoop.fs.s3a.multipart.size": "67108864",
    "spark.hadoop.fs.s3a.attempts.maximum": "3",
}


def build_session(
    app_name: str,
    master: str | None = None,
    object_store_endpoint: str | None = None,
    shuffle_bytes: int | None = None,
    **options: str,
) -> SparkSession:
    """Create or reuse a session. Credentials come from the environment or the
    cluster's own configuration, never from code.

    ``shuffle_bytes`` is the size of the largest shuffle to be expected; from it follows the
    number of partitions that every shuffle starts with.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = dict(BASE_OPTIONS)
    if object_store_endpoint:
        merged |= OBJECT_STORE_OPTIONS
        merged["spark.hadoop.fs.s3a.endpoint"] = object_store_endpoint
        if "AWS_ACCESS_KEY_ID" in os.environ:
            merged["spark.hadoop.fs.s3a.aws.credentials.provider"] = (
                "com.amazonaws.auth.EnvironmentVariableCredentialsProvider"
            )
    if shuffle_bytes:
        merged[SHUFFLE_PARTITIONS] = str(max(200, -(-shuffle_bytes // PARTITION_BYTES)))
    merged |= {k.replace("__", "."): v for k, v in options.items()}
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Epoch micros and calendar dates are read in UTC everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def bound_scans(spark: SparkSession) -> SparkSession:
    """No task reads more than ``SCAN_BYTES`` of a file, so its memory doesn't grow with the tables. A lower bound stays. Row
    groups are not parted."""
    jvm = spark._jvm.org.apache.spark.network.util.JavaUtils
    if jvm.byteStringAsBytes(spark.conf.get(SCAN_OPTION)) > SCAN_BYTES:
        spark.conf.set(SCAN_OPTION, str(SCAN_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares between executors (``spark.checkpoint.dir``)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("spark.checkpoint.dir is not set: name a folder every executor can reach")
    return configured.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """A new folder below the shared one. Only a session whose tasks all run on this machine may
    go without a shared folder: it then gets one of its own, set in its configuration."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.conf.get("spark.master", "").startswith("local["):
            shared_dir(spark)
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="wardlake-"))
    return f"{shared_dir(spark)}/wardlake-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the tasks, so that they find it wherever the session was started."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="wardlake-"), "wardlake.zip")
    with zipfile.ZipFile(target, "w") as bundle:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    bundle.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)
