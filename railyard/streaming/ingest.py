"""Incremental ingest of landed files.

The stream's checkpoint remembers which files were read, in place of a test whether a
partition folder exists.  Late rows need no watermark: each row is filed under its own
date and merged into what that partition already holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from railyard.session import remove_dir
from railyard.sinks.store import publish_merge, stage_merge


def incremental_ingest(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    normalise: Callable[[DataFrame], DataFrame],
    root: str,
    name: str,
    checkpoint: str,
    fmt: str = "parquet",
    max_files: int = 1000,
) -> int:
    """Load every file not seen before and stop; returns the rows written.

    Every batch is merged into the partitions it touches: a day whose files arrive in
    several batches ends up whole.  The complete partitions of a batch are staged beside the
    checkpoint under the batch's number.  A batch that Spark replays, because an attempt
    ended between staging and the stream's own commit, is published from there: the same
    rows again, not a merge of the batch with itself.
    """
    written: list[int] = []
    ledger = f"{checkpoint.rstrip('/')}-batches"

    def load(batch: DataFrame, number: int) -> None:
        here = batch.sparkSession
        stage = f"{ledger}/{number}"
        written.append(stage_merge(here, normalise(batch), root, name, stage))
        publish_merge(here, root, name, stage)
        # Only the last batch can come again.
        remove_dir(here, f"{ledger}/{number - 1}")

    query = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(written)
