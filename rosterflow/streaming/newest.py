"""The newest row per key of a stream, kept up to date by batches that may come twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.operators.latest import latest_record


class NewestRows:
    """One newest row per key of everything that arrived, by ``moment`` and, at one moment, the larger ``tie_break``.

    A batch is cut to the newest row per key before it is written, so what is stored grows with the keys that change. Batches are
    changes beside a base; ``compact`` makes a new base of both. The ledger says up to which batch the base holds
    and which changes count: a batch that comes again is written over itself, or left out if the base already has it.
    """

    def __init__(self, spark: SparkSession, folder: str, by: Sequence[str], moment: str, tie_break: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.by, self.moment, self.tie_break = list(by), moment, tie_break

    def follow(self, source: str, schema: T.StructType | str, files_per_batch: int = 1000) -> None:
        """Take up all Parquet files that are new in a folder, then stop."""
        arriving = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
        running = (
            arriving.writeStream.foreachBatch(self.upsert).option("checkpointLocation", f"{self.folder}/checkpoint").trigger(availableNow=True).start()
        )
        running.awaitTermination()

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Add a batch; one whose id was added before changes nothing."""
        held, _ = self.state()
        if batch_id <= held or self._entries().filter((F.col("kind") == "batch") & (F.col("batch_id") == batch_id)).take(1):
            return
        latest_record(batch, self.by, self.moment, self.tie_break).write.mode("overwrite").parquet(f"{self.folder}/changes/batch-{batch_id}")
        self._note("batch", batch_id)

    def compact(self) -> None:
        """Make a new base of the base and all changes; a failed try leaves the old one."""
        held, added = self.state()
        if not added:
            return
        upto = max(added)
        self.rows().write.mode("overwrite").parquet(f"{self.folder}/base/{upto}")
        self._note("base", upto)

    def rows(self) -> DataFrame:
        """The newest row of each key so far; needs at least one batch."""
        held, added = self.state()
        paths = [f"{self.folder}/changes/batch-{b}" for b in added] + ([f"{self.folder}/base/{held}"] if held >= 0 else [])
        if not paths:
            raise ValueError(f"{self.folder} holds no batch yet")
        return latest_record(self.spark.read.parquet(*paths), self.by, self.moment, self.tie_break)

    def state(self) -> tuple[int, list[int]]:
        """The batch up to which the base holds (-1 without one), and the batches added since, from the ledger."""
        entries = [(r["kind"], r["batch_id"]) for r in self._entries().collect()]
        held = max((b for kind, b in entries if kind == "base"), default=-1)
        return held, sorted({b for kind, b in entries if kind == "batch" and b > held})

    def _entries(self) -> DataFrame:
        ledger = f"{self.folder}/ledger"
        path = self.spark._jvm.org.apache.hadoop.fs.Path(ledger)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], "kind string, batch_id long")
        return self.spark.read.schema("kind string, batch_id long").option("recursiveFileLookup", "true").parquet(ledger)

    def _note(self, kind: str, batch_id: int) -> None:
        line = self.spark.createDataFrame([(kind, batch_id)], "kind string, batch_id long")
        line.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/ledger/{kind}-{batch_id}")
