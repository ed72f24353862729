"""A stream feeding the incremental strategies through ``foreachBatch``.

Each micro-batch is applied with the same pure strategy as a batch load, to the files
that hold rows it can change.  The stream's checkpoint makes reruns resume after the
last committed batch.  The number of a batch is noted in the table by the commit that
applies it, so a batch that Spark hands over again (the stream stopped between the
table's commit and its own) is skipped, under every strategy: no row twice, none lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewater.operators.writers import apply_incremental


def stream_upsert(spark: SparkSession, source_dir: str, schema: T.StructType, target_path: str,
                  checkpoint_location: str, unique_key: str | Sequence[str], strategy: str = "delete+insert",
                  partition_by: Sequence[str] = (), derive: dict | None = None,
                  path_glob: str | None = None, max_files_per_trigger: int = 1, stream: str | None = None,
                  **opts) -> None:
    """Run the stream to the end of the data available now, upserting each batch.

    ``stream`` names the stream in the table's record of applied batches; by default it is
    the id that the stream's checkpoint holds, so a new checkpoint is a new stream.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    rows = reader.parquet(source_dir)
    if derive:
        rows = rows.withColumns(derive)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        name = stream or session.sparkContext.getLocalProperty("sql.streaming.queryId")
        apply_incremental(session, target_path, batch, strategy, unique_key, partition_by, batch=(name, epoch_id), **opts)

    q = (rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    q.awaitTermination()

