"""Arriving raw activity files, merged into the publication queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from perkmill.plans import marts, queue as Q, staging
from perkmill.plans.audits import enforce, run_audits
from perkmill.plans.queue_store import QueueStore
from perkmill.schemas import QUEUE, RAW
from perkmill.session import checkpoint
from perkmill.sources.lineage import FIRST_ROW, has_block, number_rows, with_block, with_position

_ARRIVED = RAW["sport_activities_txt"]
_FOUND_FILE = "__file"
_FOUND_ROW = "__row"


def read_activity_stream(
    spark: SparkSession, folder: str, format: str = "parquet", files_per_batch: int | None = None,
) -> DataFrame:
    """Raw activity files as they arrive, with the fixed schema.

    Where a row was read travels with it, so that files without lineage columns get their
    lineage when a batch is merged. CSV files hold the other columns only.
    """
    columns = _ARRIVED if format != "csv" else _ARRIVED[2:]
    reader = spark.readStream.schema(columns).format(format)
    if format == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(folder)
    if format == "csv":
        return with_block(rows)
    return rows.select("*", F.col("_metadata.file_name").alias(_FOUND_FILE), (
        F.col("_metadata.row_index") + FIRST_ROW).cast("string").alias(_FOUND_ROW))


def with_lineage(batch: DataFrame) -> DataFrame:
    """The batch as raw rows: lineage of its own is kept, missing lineage is filled in.

    A row number counts the rows of its file from 2 on, as in a full load.
    """
    if has_block(batch):
        batch = number_rows(with_position(batch))
    elif _FOUND_FILE in batch.columns:
        found = {"source_file": _FOUND_FILE, "source_row_number": _FOUND_ROW}
        batch = batch.withColumns({name: F.coalesce(F.col(name), F.col(place)) for name, place in found.items()})
    return batch.select(*_ARRIVED.names)


def append_batch(batch: DataFrame, queue_path: str, now: Column | None = None, invalid_path: str | None = None,
                 batch_id: int | None = None) -> None:
    """Append the batch's activities that are not queued yet; store those that are not valid.

    The batch is typed once and its new rows are worked out once. Only the key column of the
    stored queue is read, and only new rows are written. They pass the queue's audits first. A
    batch that is replayed after a failure finds its rows stored and adds nothing, so no
    watermark or state is kept, however late an activity arrives. Invalid rows are written to
    ``invalid_path`` (by default beside the queue) as staged rows, under the number of the
    batch: a replayed batch replaces its own.
    """
    spark = batch.sparkSession
    stored = spark.read.schema(QUEUE).parquet(queue_path)
    raw = with_lineage(batch)
    staged = checkpoint(staging.sport_activities(raw))
    fresh = checkpoint(Q.new_rows(stored, marts.activity_fact(staged), now))
    enforce(run_audits({Q.RELATION: fresh}, Q.queue_audits()))
    fresh.write.mode("append").parquet(queue_path)
    invalid = staged.filter(~F.coalesce(F.col("record_is_valid"), F.lit(False)))
    number = "unnumbered" if batch_id is None else batch_id
    invalid.write.mode("overwrite").parquet(f"{invalid_path or invalid_rows_path(queue_path)}/batch={number}")


def merge_into_store(
    raw_stream: DataFrame, store: QueueStore, checkpoint_folder: str, source: str, now: Column | None = None,
) -> StreamingQuery:
    """Merge everything that has arrived into a queue store, then stop.

    ``source`` names the stream in the ledger; give another name with a new checkpoint folder,
    whose batches are counted from 0 again.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        store.append_batch(with_lineage(batch), source, batch_id, now)

    return (
        raw_stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_folder)
        .trigger(availableNow=True).start()
    )


def invalid_rows_path(queue_path: str) -> str:
    """Where the invalid rows of a queue's batches are kept."""
    return f"{queue_path.rstrip('/')}_invalid"


def merge_stream(
    raw_stream: DataFrame, queue_path: str, checkpoint_folder: str, now: Column | None = None,
    invalid_path: str | None = None,
) -> StreamingQuery:
    """Merge everything that has arrived, then stop. Run it again for what comes later.

    ``queue_path`` must exist; an empty queue will do. No other writer may be active.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, queue_path, now, invalid_path, batch_id)

    return (
        raw_stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_folder)
        .trigger(availableNow=True).start()
    )


def create_queue(spark: SparkSession, queue_path: str) -> None:
    """An empty queue to start from."""
    spark.createDataFrame([], QUEUE).write.mode("errorifexists").parquet(queue_path)
