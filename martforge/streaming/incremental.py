"""Incremental loads as a Structured Streaming job.

Each load batch is published as staged tables in its own folder plus one
row in a manifest folder. A file-source stream over the manifest hands the
new rows to ``foreachBatch``, which applies the batch to the star tables
(dimension upserts, date inserts, fact delete + insert of the touched
months). The stream's checkpoint records which manifest files are done, so a
restarted job resumes with the first batch that was not completed. Applying it
again changes nothing that is right already; nothing else guards replays.

Only the manifest rows -- one per batch, a handful per trigger -- reach the
driver; every batch table is read and processed by the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import STAGE_COLUMNS
from ..session import run_concurrently
from ..sources.star_tables import StarTables
from ..sources.staging import write_table

MANIFEST = T.StructType([
    T.StructField("batch_id", T.IntegerType(), False),
    T.StructField("path", T.StringType(), False),
])


def publish_batch(spark: SparkSession, landing: str, batch_id: int,
                  staged: dict[str, DataFrame]) -> str:
    """Write one staged batch and announce it in the manifest."""
    path = f"{landing.rstrip('/')}/batches/b{batch_id:06d}"
    run_concurrently({name: (lambda name=name, df=df: write_table(df.select(*STAGE_COLUMNS[name]), f"{path}/{name}"))
                      for name, df in staged.items()})
    (spark.createDataFrame([(batch_id, path)], MANIFEST).coalesce(1)
     .write.mode("append").parquet(f"{landing.rstrip('/')}/manifest"))
    return path


def _apply(tables: StarTables):
    def apply_batches(manifest: DataFrame, epoch_id: int) -> None:
        spark = manifest.sparkSession
        for row in manifest.orderBy("batch_id").collect():
            tables.apply({name: spark.read.parquet(f"{row.path}/{name}") for name in STAGE_COLUMNS})
    return apply_batches


def run_maintenance(spark: SparkSession, landing: str, star_root: str,
                    checkpoint: str, available_now: bool = True) -> StarTables:
    """Start the maintenance stream; with ``available_now`` it processes the
    batches present and stops (a scheduled incremental job)."""
    tables = StarTables(spark, star_root)
    source = (spark.readStream.schema(MANIFEST).option("maxFilesPerTrigger", 1)
              .parquet(f"{landing.rstrip('/')}/manifest"))
    writer = source.writeStream.foreachBatch(_apply(tables)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return tables
