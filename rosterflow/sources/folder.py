"""Pick the newest drop in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_drops(spark: SparkSession, folder: str) -> DataFrame:
    """Direct children of a folder with their newest modification time.

    A child is a file, or a folder of part files as Spark writes them. Only names and times are
    read, never file contents.
    """
    root = folder.rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "modificationTime")
    )
    # The listing gives full addresses, the caller maybe a bare or relative path: Spark's own reading of it is the root.
    address = spark._jvm.org.apache.hadoop.fs.Path(root)
    address = address.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(address).toString().rstrip("/")
    plain = address.split(":", 1)[-1].lstrip("/")
    below = F.regexp_replace("path", r"^[a-zA-Z][-+.a-zA-Z0-9]*:/+|^/+", "")
    child = F.element_at(F.split(F.substring(below, len(plain) + 2, 1 << 20), "/"), 1)
    return files.groupBy(child.alias("name")).agg(F.max("modificationTime").alias("modified"))


def latest_drop(spark: SparkSession, folder: str) -> str:
    """Path of the most recently modified file or folder of part files; the larger name among equals."""
    newest = list_drops(spark, folder).orderBy(F.desc("modified"), F.desc("name")).first()
    if newest is None:
        raise FileNotFoundError(f"no file in {folder}")
    return f"{folder.rstrip('/')}/{newest['name']}"
