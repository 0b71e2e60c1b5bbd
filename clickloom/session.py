"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for a new session. The master, memory and core counts belong to the
# deployment and are left to spark-submit.
RECOMMENDED = {
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "400",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def builder(app_name: str, extra: dict[str, str] | None = None) -> SparkSession.Builder:
    """A session builder with the recommended settings; ``extra`` wins over them."""
    result = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED, **(extra or {})}.items():
        result = result.config(key, value)
    return result


def shuffle_partitions(shuffled_bytes: int, target: int = 128 << 20) -> int:
    """``spark.sql.shuffle.partitions`` for a job that shuffles so much, 400 at least.

    Adaptive execution merges partitions that turn out small, so a generous estimate does no harm.
    """
    return max(int(RECOMMENDED["spark.sql.shuffle.partitions"]), -(-shuffled_bytes // target))


def object_store_conf(
    endpoint: str,
    access_key: str,
    secret_key: str,
    path_style: bool = True,
    ssl: bool = False,
) -> dict[str, str]:
    """Settings for ``s3a://`` paths; pass them to :func:`builder` as ``extra``."""
    prefix = "spark.hadoop.fs.s3a."
    return {
        prefix + "endpoint": endpoint,
        prefix + "access.key": access_key,
        prefix + "secret.key": secret_key,
        prefix + "path.style.access": str(path_style).lower(),
        prefix + "connection.ssl.enabled": str(ssl).lower(),
        prefix + "impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        prefix + "aws.credentials.provider": "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
    }


def pin_utc(spark: SparkSession) -> SparkSession:
    """Time parsing and time labels are defined in UTC, so the session zone must be UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    It lies below ``spark.checkpoint.dir``. Only a local-mode session without that
    setting gets a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
        root = os.path.join(tempfile.gettempdir(), "clickloom")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
