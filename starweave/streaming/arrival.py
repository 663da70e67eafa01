"""Run the warehouse load when new source files land.

The reference has no streams: its one recurring job is a daily full reload
(dimensions, fact, summaries).  Here a file stream over the landing folder
of the transaction lines drives that same load through ``foreachBatch``:
with ``availableNow`` it handles everything that has arrived and stops, so
any scheduler can start it; the stream checkpoint (in the cluster-shared
folder) records which files were already loaded, so a finished arrival is not
loaded again and an empty run does nothing.  ``foreachBatch`` is at least once:
Spark runs a batch again, with the same id, when a run ends before the batch is
in the checkpoint.  A marker by batch id is written after every load and looked
up before it, so a load that ended is not repeated; one that failed half-way
is, and should write to a folder named by the batch id.
"""

from __future__ import annotations

from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir
from ..sources.schemas import SOURCE_SCHEMAS


def is_loaded(spark: SparkSession, markers: str, batch_id: int) -> bool:
    try:
        return not spark.read.schema("batch_id long").parquet(f"{markers}/{batch_id}").isEmpty()
    except AnalysisException:  # no marker there; anything else raises
        return False


def mark_loaded(spark: SparkSession, markers: str, batch_id: int) -> None:
    """One row in a folder of its own; Spark commits the file as a whole."""
    rows = spark.createDataFrame([(batch_id,)], "batch_id long").coalesce(1)
    rows.write.mode("overwrite").parquet(f"{markers}/{batch_id}")


def reload_on_arrival(spark: SparkSession, landing_dir: str, load: Callable[[DataFrame, int], None],
                      checkpoint: str | None = None, fmt: str = "parquet",
                      table: str = "sales_transaction_details") -> int:
    """Process newly arrived files of ``table`` once; returns the number of
    micro-batches that triggered ``load(new_rows, batch_id)``.  The markers lie
    beside the checkpoint, whose batch ids they carry."""
    ckpt = checkpoint or f"{shared_dir(spark)}/starweave/arrival-{table}"
    markers = f"{ckpt.rstrip('/')}-loaded"
    batches = []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty() or is_loaded(spark, markers, batch_id):
            return
        load(batch, batch_id)
        mark_loaded(spark, markers, batch_id)
        batches.append(batch_id)

    stream = (spark.readStream.schema(SOURCE_SCHEMAS[table]).format(fmt)
              .option("recursiveFileLookup", "true").load(landing_dir))
    q = (stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", ckpt)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)
