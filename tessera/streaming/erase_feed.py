"""Apply batches of erase requests as they arrive (files in a folder).

``readStream`` over the request folder -> ``foreachBatch`` -> ``erase_records``
on the target table.  The stream's checkpoint records which files were applied;
it is kept at a place that depends only on the table and the request path
(under the configured ``spark.checkpoint.dir``), so a restarted application
goes on where the last one ended.  ``foreachBatch`` may replay a batch after a
failure, and the erase protocol is idempotent (a second application finds
nothing left to erase, and an interrupted call is ended by the next), so each
request takes effect exactly once.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tessera.operators.erase import erase_records
from tessera.session import stable_root


def feed_checkpoint(spark: SparkSession, table: str, request_path: str) -> str:
    """The feed's own checkpoint folder: the same in every application."""
    digest = hashlib.sha1(f"{table}\n{request_path}".encode()).hexdigest()[:16]
    return f"{stable_root(spark)}/tessera_erase_feed/{digest}"


def start_erase_feed(spark: SparkSession, table: str, request_path: str,
                     request_schema: StructType | str, key: str, *,
                     fmt: str = "json", req_key: str | None = None,
                     req_part: str | None = None, checkpoint: str | None = None,
                     available_now: bool = True, reports: list | None = None,
                     max_files_per_trigger: int | None = None,
                     **erase_options) -> StreamingQuery:
    """Start the feed; with ``available_now`` it drains what is there and stops.
    ``erase_options`` go to ``erase_records`` (``swap=``, ``files_per_partition=`` ...)."""
    reader = spark.readStream.schema(request_schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    requests = reader.load(request_path)

    def apply(batch: DataFrame, batch_id: int) -> None:
        rep = erase_records(batch.sparkSession, table, batch, key,
                            req_key=req_key, req_part=req_part, **erase_options)
        spark.catalog.refreshTable(table)   # the stream runs in a cloned session
        if reports is not None:
            reports.append((batch_id, rep))

    writer = (requests.writeStream.foreachBatch(apply)
              .option("checkpointLocation", checkpoint or feed_checkpoint(spark, table, request_path)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
