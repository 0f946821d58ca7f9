"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings the library relies on. Partition counts are left to the cluster:
# adaptive execution coalesces small shuffle partitions and splits skewed join partitions. Join
# sides are broadcast, or hashed instead of sorted, only by their measured size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}

_local_scratch: str | None = None


def build_session(app_name: str = "rosterflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is only ever used by a local session that names none.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="rosterflow-")
        base = _local_scratch
    return f"{base.rstrip('/')}/rosterflow/{label}-{uuid.uuid4().hex}"


def use_java_charsets(spark: SparkSession, encoding: str) -> None:
    """Spark 4 reads and writes only the UTF charsets, Latin-1 and ASCII unless told otherwise."""
    if encoding.lower() not in ("utf-8", "us-ascii", "iso-8859-1", "utf-16", "utf-16be", "utf-16le", "utf-32"):
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
