"""Counts per window of event time, with late rows kept apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.functions.names import column


class WindowedStream:
    """Sums over windows of event time of files that arrive in a folder, out of order.

    A run first splits what is new, batch by batch: a row whose window had ended ``delay`` before the newest row of earlier
    batches is late and goes to a table of its own; the others go on. Then Spark's own windowed aggregate with the same
    watermark takes them up: its state holds open windows only, and ended ones are evicted. As a row that went on is never
    behind that watermark, no row is lost: windows and late rows together are all rows. A row without a moment goes on, but
    stands in no window.

    Below ``folder`` are ``on_time``, ``late``, ``ledger`` (the newest moment of each batch), ``windows`` (each
    window's figures by the batch that changed them) and the checkpoints. Every batch overwrites what an earlier try of it wrote,
    so one that is repeated changes nothing.
    """

    def __init__(
        self,
        spark: SparkSession,
        source: str,
        schema: T.StructType | str,
        folder: str,
        moment: str,
        keys: Sequence[str],
        figures: dict[str, Column],
        width: str = "1 hour",
        delay: str = "10 minutes",
        files_per_batch: int = 1000,
    ):
        self.spark, self.source, self.schema, self.folder = spark, source, schema, folder.rstrip("/")
        self.moment, self.keys, self.figures = moment, list(keys), figures
        self.width, self.delay, self.files_per_batch = width, delay, files_per_batch

    def run(self) -> None:
        """Take up all files that are new, then stop. Run it again, or on a schedule, to follow the folder."""
        arriving = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", self.files_per_batch).parquet(self.source)
        self._finish(arriving.writeStream.foreachBatch(self.split).option("checkpointLocation", f"{self.folder}/split-checkpoint"))
        on_time = self.spark.readStream.schema(arriving.schema).option("recursiveFileLookup", "true").parquet(f"{self.folder}/on_time")
        stamped = on_time.withColumn("_at", column(self.moment).cast("timestamp")).withWatermark("_at", self.delay)
        grouped = stamped.groupBy(F.window("_at", self.width).alias("_window"), *[column(c) for c in self.keys])
        summed = grouped.agg(*[figure.alias(name) for name, figure in self.figures.items()])
        out = summed.select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *[column(c) for c in [*self.keys, *self.figures]])
        self._finish(out.writeStream.outputMode("update").foreachBatch(self.keep).option("checkpointLocation", f"{self.folder}/window-checkpoint"))

    @staticmethod
    def _finish(writer) -> None:
        running = writer.trigger(availableNow=True).start()
        running.awaitTermination()

    def split(self, batch: DataFrame, batch_id: int) -> None:
        """Write a batch's late rows and the others, and note its newest moment."""
        spark = batch.sparkSession
        newest = self._newest_before(spark, batch_id)
        at = column(self.moment).cast("timestamp")
        # Windows start at multiples of their width, counted from the epoch.
        width = F.lit(self._seconds(self.width) * 1_000_000)
        ends = (F.floor(F.unix_micros(at) / width) + 1) * width
        bound = None if newest is None else newest - self._seconds(self.delay) * 1_000_000
        late = F.lit(False) if bound is None else F.coalesce(ends <= bound, F.lit(False))
        batch.filter(~late).write.mode("overwrite").parquet(f"{self.folder}/on_time/batch-{batch_id}")
        batch.filter(late).write.mode("overwrite").parquet(f"{self.folder}/late/batch-{batch_id}")
        moments = batch.agg(F.unix_micros(F.max(at)).alias("newest")).withColumn("batch_id", F.lit(batch_id).cast("long"))
        moments.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/ledger/batch-{batch_id}")

    def _seconds(self, interval: str) -> int:
        seconds = F.expr(f"unix_seconds(TIMESTAMP '1970-01-01 00:00:00Z' + INTERVAL {interval})")
        return self.spark.range(1).select(seconds).first()[0]

    def _newest_before(self, spark: SparkSession, batch_id: int) -> int | None:
        if batch_id == 0:
            return None
        ledger = spark.read.schema("newest long, batch_id long").option("recursiveFileLookup", "true").parquet(f"{self.folder}/ledger")
        return ledger.filter(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]

    def keep(self, batch: DataFrame, batch_id: int) -> None:
        """Write the windows that a batch changed."""
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{self.folder}/windows/batch-{batch_id}")

    def windows(self) -> DataFrame:
        """Each window as its last change left it."""
        changes = self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.folder}/windows")
        keys = ["window_start", "window_end", *self.keys]
        newest = changes.groupBy(*[column(c) for c in keys]).agg(F.max_by(F.struct(*[column(c) for c in self.figures]), "batch_id").alias("_newest"))
        return newest.select(*[column(c) for c in keys], *[F.col("_newest").getField(c).alias(c) for c in self.figures])

    def late_rows(self) -> DataFrame:
        """All late rows."""
        return self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.folder}/late")
