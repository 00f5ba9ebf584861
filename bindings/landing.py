"""Writing feed rows as the files a loader expects to find on a stage."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import ExitStack

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.workspace import PACKED, Store, shuffles_dropped

# Fixed value: how a delivery is named; parts of one share a folder.
_DELIVERY = "{feed}_20260108_0930{batch:02d}_batch{batch:03d}"

def _array_files(folder: str, files: int = 1, packed: bool = False):
    """A task that writes its partition's JSON objects as array files, dealt to them by batches; ``packed`` ones with zstd.

    Spark's JSON writer only makes one object per line. A task holds one batch of rows, whatever the
    size of its files. They are written under names of their own and renamed, so a copy of the task can't spoil them; the final
    names depend on the partition alone, so a task run again replaces its own files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        store, base = fs.FileSystem.from_uri(re.sub("^file:/+", "/", folder))
        store.create_dir(base)
        own, n, packing = f"{base}/_{uuid.uuid4().hex}", [0] * files, "zstd" if packed else None
        with ExitStack() as open_files:
            out = [open_files.enter_context(store.open_output_stream(f"{own}-{k}", compression=packing)) for k in range(files)]
            for file in out:
                file.write(b"[\n")
            for number, batch in enumerate(b for b in batches if b.num_rows):
                k = number % files
                out[k].write(((",\n" if n[k] else "") + ",\n".join(batch.column(0).to_pylist())).encode())
                n[k] += batch.num_rows
            for file in out:
                file.write(b"\n]\n")
        for k in range(files):
            store.move(f"{own}-{k}", f"{base}/part-{part:05d}-{k:05d}{'.zst' if packed else ''}.json")
        yield pa.RecordBatch.from_arrays([pa.array([sum(n)], pa.int64())], ["n"])

    return write


def whole_files(table: DataFrame) -> DataFrame:
    """A written table, read by one task a file."""
    own = table.sparkSession.newSession()
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(name, "1t")
    return own.read.schema(table.schema).parquet(*table.inputFiles())


def deliver(rows: DataFrame, feed: str, stage: str, batch: int, files: int | None = None, files_a_task: int = 1,
            gathered: bool | None = None, packed: bool = False) -> str:
    """Write ``rows`` as delivery number ``batch`` of ``feed`` below ``stage``, in ``files`` files if there are as many rows.

    Where as many tasks read the rows, these are put together, which shuffles nothing. Of events, a task may write several files.
    ``gathered`` says so beforehand, as asking for the tasks of rows that are joined or summed up would run their shuffles.
    Files of events may be ``packed``.
    """
    if gathered is None:
        gathered = files is not None and rows.rdd.getNumPartitions() >= files
    folder = _write(rows if files is None else rows.coalesce(files) if gathered else rows.repartition(files), feed, stage, batch, files_a_task, packed)
    if gathered and sum(not n.startswith(("_", ".")) for n in Store(rows.sparkSession, folder).sizes()) < files * files_a_task:
        _write(rows.repartition(files), feed, stage, batch, files_a_task, packed)  # fewer tasks than files, or one had no row of this delivery
    return folder


def _write(rows: DataFrame, feed: str, stage: str, batch: int, files_a_task: int = 1, packed: bool = False) -> str:
    folder = f"{stage}/{_DELIVERY.format(feed=feed, batch=batch)}"
    with shuffles_dropped(rows.sparkSession):
        _write_files(rows, feed, folder, files_a_task, packed)
    return folder


def _write_files(rows: DataFrame, feed: str, folder: str, files_a_task: int, packed: bool) -> None:
    if feed == "trades":
        # A timestamp becomes text by cast, which no session zone can shift.
        text = rows.select([F.col(c).cast("string").alias(c.upper()) for c in rows.columns])
        text.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(folder)
    elif feed == "market_events":
        objects = rows.select(
            F.to_json(
                F.struct(
                    F.col("event_ts").cast("string").alias("event_ts"),
                    F.col("symbol").alias("Symbol"),
                    F.col("event_type").alias("EVENT_TYPE"),
                    F.col("event_attr").alias("EVENT_ATTR"),
                )
            ).alias("value")
        )
        objects.mapInArrow(_array_files(folder, files_a_task, packed), "n bigint").agg(F.sum("n")).collect()
    else:
        numbers = {"quantity": "bigint", "updated_at": "string"}
        kinds = {c: numbers.get(c, "double") for c in rows.columns}
        kinds.update(symbol="string", account_id="string")
        rows.select([F.col(c).cast(kinds[c]).alias(c) for c in rows.columns]).write.mode("overwrite").options(**PACKED).parquet(folder)
