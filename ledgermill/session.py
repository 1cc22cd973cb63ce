"""Session factory.

The master, memory and object-store credentials come from ``spark-submit`` or
the caller; nothing is hard-coded. ``input_bytes`` sizes the shuffle: about
200 MB of input per reduce task, which adaptive execution then merges or splits.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

BYTES_PER_SHUFFLE_TASK = 200 * 1024 * 1024


def shuffle_partitions(input_bytes: int, floor: int = 200) -> int:
    """Reduce tasks for a given input size, at least ``floor``."""
    return max(floor, -(-input_bytes // BYTES_PER_SHUFFLE_TASK))


def object_store_conf(endpoint: str, path_style: bool = True) -> dict[str, str]:
    """Hadoop settings for an S3-compatible endpoint; keys come from the provider chain."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
    }


def build_session(
    app_name: str,
    *,
    input_bytes: int | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Create or get a session with the settings the operators rely on."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.session.timeZone": "UTC",
        # Integer money sums must raise on overflow, never wrap.
        "spark.sql.ansi.enabled": "true",
    }
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
