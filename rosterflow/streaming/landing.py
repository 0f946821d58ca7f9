"""Land files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rosterflow.operators.columns import clean_columns
from rosterflow.session import use_java_charsets
from rosterflow.sources.delimited import CSV_AS_IS, refuse_bad_bytes


def land_new_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
    sep: str = ",",
    header: bool = True,
    encoding: str = "UTF-8",
    files_per_batch: int = 1000,
) -> DataFrame:
    """Append all files that are new in a folder to a Parquet folder, then stop; returns the landed table.

    The checkpoint remembers which files were loaded: a second run loads what came since, and a
    run that fails half-way goes on without loading a file twice. Run it again, or on a
    schedule, to follow the folder. A file whose header is not that of the schema, in its order,
    and bytes that the charset does not have fail the run.
    """
    use_java_charsets(spark, encoding)
    arriving = (
        spark.readStream.schema(schema)
        .options(sep=sep, header=header, encoding=encoding, maxFilesPerTrigger=files_per_batch, enforceSchema=False, mode="FAILFAST", **CSV_AS_IS)
        .csv(folder)
    )
    landing = (
        clean_columns(refuse_bad_bytes(arriving))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    landing.awaitTermination()
    return spark.read.parquet(target)
