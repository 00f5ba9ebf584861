"""Loading new files into RAW tables, each file once.

A Structured Streaming query over the stage's *file list* decides what is new;
its checkpoint is the load history that both the batch load and the continuous
pipe of a table share. Each micro-batch then reads its files with the ordinary
batch scan and writes them as one ``_batch`` folder, which a replay of the same
micro-batch replaces. Only after that is the batch entered in the load log, and
readers look no further than the log.

Where a store tells of new files, a pipe can follow these notices instead of
listing the stage. Notices are small files that are deleted once their batch is
done, and which files were told of is state of the query, kept on the executors.
So neither the driver's memory nor a trigger's time grows with the files loaded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tradeflow.schemas import LINEAGE, RAW_TABLES
from tradeflow.sources.formats import FEEDS, FORMATS, Feed, literal, matches, scan
from tradeflow.sources.json_arrays import byte_size
from tradeflow.streaming.progress import follow_progress
from tradeflow.workspace import read_or_empty, settled

_BATCH = StructField("_batch", LongType())
LOAD_LOG = StructType(
    [
        StructField("file_name", StringType()),
        StructField("file_size", LongType()),
        StructField("row_count", LongType()),
        StructField("last_load_time", TimestampType()),
        StructField("status", StringType()),  # LOADED or FAILED
        StructField("error", StringType()),
        _BATCH,  # the folder's name
    ]
)
# Fixed value: what Spark's binaryFile source offers of each file.
_LISTING = "path string, modificationTime timestamp, length bigint, content binary"
# Inside a micro-batch, failures of the JVM arrive as they are.
_FAILURES = (PySparkException, Py4JJavaError)
# Keeps the paths one micro-batch sends through the driver bounded.
FILES_PER_BATCH = 1000
# Files older than this are neither remembered nor loaded. The default of a
# week would skip a late backfill without a word.
REMEMBERED = "36500d"


NOTICE = "file_name string, file_size bigint"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STORES = "spark.sql.streaming.stateStore.providerClass"
_OPEN_COST = "spark.sql.files.openCostInBytes"
_OPEN_COST_DEFAULT = 4 * 1024 * 1024  # fixed value: Spark's
# Files up to this size are not cut into ranges, which would be read three times.
WHOLE_TEXT = 64 * 1024 * 1024


def announce(files: DataFrame, notices: str, files_per_notice: int = FILES_PER_BATCH) -> None:
    """Tell pipes that follow ``notices`` of ``file_name`` (as in file metadata) and ``file_size``.

    A file may be told of more than once.
    """
    files.select("file_name", "file_size").write.mode("append").option("maxRecordsPerFile", files_per_notice).json(notices)


def list_stage(spark: SparkSession, feed: Feed, stage: str) -> DataFrame:
    """``file_name, file_size`` of the feed's files below ``stage``; no file is opened."""
    listing = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=feed.name_glob)
    rows = listing.load(literal(stage)).select(F.col("_metadata.file_path").alias("file_name"), F.col("length").alias("file_size"))
    return rows.where(matches(stage, feed.pattern, F.col("file_name")))


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, unless the session names another store."""
    named = spark.conf.get(_STORES, None)
    if named is not None and "RocksDB" not in named and not named.endswith("HDFSBackedStateStoreProvider"):
        yield
        return
    spark.conf.set(_STORES, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_STORES) if named is None else spark.conf.set(_STORES, named)


@contextmanager
def whole_texts(spark: SparkSession, feed: Feed) -> Iterator[None]:
    """Pipes of JSON started inside read files of up to WHOLE_TEXT at once, unless the session names another size."""
    if FORMATS[feed.file_format].kind != "json" or byte_size(spark, _OPEN_COST) != _OPEN_COST_DEFAULT:
        yield
        return
    named = spark.conf.get(_OPEN_COST)
    spark.conf.set(_OPEN_COST, WHOLE_TEXT)
    try:
        yield
    finally:
        spark.conf.set(_OPEN_COST, named)


def _told(spark: SparkSession, notices: str) -> DataFrame:
    """Files told of, each once, however often and in however many runs."""
    # One notice a trigger, as it names as many files as a batch may hold.
    rows = spark.readStream.schema(NOTICE).options(maxFilesPerTrigger=1, cleanSource="delete", maxFileAge=REMEMBERED).json(literal(notices))
    return rows.dropDuplicates(["file_name"])


def raw_path(root: str, table: str) -> str:
    return f"{root}/raw/{table}"


def load_log_path(root: str, table: str) -> str:
    return f"{root}/logs/load/{table}"


def load_log(spark: SparkSession, root: str, table: str) -> DataFrame:
    return read_or_empty(spark, load_log_path(root, table), LOAD_LOG)


def latest_batch(spark: SparkSession, root: str, table: str) -> int:
    """The last batch that is completely loaded; -1 before the first."""
    newest = load_log(spark, root, table).agg(F.max("_batch")).first()[0]
    return -1 if newest is None else newest


def _store(spark: SparkSession, feed: Feed, stage: str, files: list[str], target: str) -> None:
    rows = scan(spark, feed, stage, files=files)
    settled(rows.withColumn("_load_ts", F.current_timestamp()), target)


def _unreadable(spark: SparkSession, feed: Feed, stage: str, files: list[str]) -> dict[str, str]:
    """Files that can't be read to their end, with the reason; halves the list to find them."""
    for _ in range(2):  # a file counts as bad only if it fails again by itself
        try:
            scan(spark, feed, stage, files=files).write.format("noop").mode("overwrite").save()
            return {}
        except _FAILURES as failure:
            reason = str(failure)
            if len(files) > 1:
                break
    if len(files) == 1:
        return {files[0]: reason[:1000]}
    half = len(files) // 2
    return _unreadable(spark, feed, stage, files[:half]) | _unreadable(spark, feed, stage, files[half:])


def _load_batch(spark: SparkSession, feed: Feed, stage: str, root: str, found: DataFrame, batch: int,
                skip_bad_files: bool) -> bool:
    """Load the batch's files; False if it has none of the feed."""
    wanted = found.where(matches(stage, feed.pattern, F.col("file_name")))
    files = wanted.select("file_name", "file_size").collect()
    if not files:
        return False
    target = f"{raw_path(root, feed.table)}/_batch={batch}"
    names, bad = [f["file_name"] for f in files], {}
    try:
        _store(spark, feed, stage, names, target)
    except _FAILURES:
        bad = _unreadable(spark, feed, stage, names) if skip_bad_files else {}
        if not bad:
            raise
        _store(spark, feed, stage, [n for n in names if n not in bad], target)

    # Counted from what was stored, reading one column of it. A file without
    # rows is in the listing only, and is logged with none.
    stored = spark.read.schema(LINEAGE).parquet(target)
    counts = {r["_src_file"]: r["count"] for r in stored.groupBy("_src_file").count().collect()}
    now = datetime.now(timezone.utc)
    entries = [
        (name, size, counts.get(name, 0), now, "FAILED" if name in bad else "LOADED", bad.get(name))
        for name, size in files
    ]
    log = spark.createDataFrame(entries, StructType(LOAD_LOG.fields[:-1])).coalesce(1)
    log.write.mode("overwrite").parquet(f"{load_log_path(root, feed.table)}/_batch={batch}")
    return True


def _listed(spark: SparkSession, feed: Feed, stage: str, files_per_batch: int) -> DataFrame:
    # Listing files needs no bytes of them: content is never selected.
    return (
        spark.readStream.format("binaryFile")
        .schema(_LISTING)
        .options(
            recursiveFileLookup=True,
            pathGlobFilter=feed.name_glob,
            maxFilesPerTrigger=files_per_batch,
            maxFileAge=REMEMBERED,
        )
        .load(literal(stage))
        .select(
            F.col("_metadata.file_path").alias("file_name"),
            F.col("length").alias("file_size"),
        )
    )


def start_pipe(
    spark: SparkSession,
    feed_name: str,
    stage: str,
    root: str,
    *,
    every: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    then: Callable[[SparkSession, str, int], None] | None = None,
    skip_bad_files: bool | None = None,
    notices: str | None = None,
) -> StreamingQuery:
    """Start loading a feed: once over what is there, or again ``every`` interval.

    A file that can't be read stops a single load. A repeated one enters it in
    the load log as FAILED, and loads the others whole; no row of a file is
    ever left out by itself. ``skip_bad_files`` says otherwise.

    ``notices`` is a folder of notices (see ``announce``) to follow; the stage is
    not listed then. A pipe keeps to one way of finding files for its life.

    ``then(spark, root, batch)`` runs after each batch that brought files, so a
    step that depends on new data needs no polling.
    """
    feed = FEEDS[feed_name]
    found = _listed(spark, feed, stage, files_per_batch) if notices is None else _told(spark, notices)

    def on_batch(new_files: DataFrame, batch: int) -> None:
        session = new_files.sparkSession
        skip = every is not None if skip_bad_files is None else skip_bad_files
        if _load_batch(session, feed, stage, root, new_files, batch, skip) and then is not None:
            then(session, root, batch)

    writer = (
        found.writeStream.queryName(f"{feed_name}_pipe")
        .option("checkpointLocation", f"{root}/checkpoints/{feed.table}")
        .foreachBatch(on_batch)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    follow_progress(spark, root, f"{feed_name}_pipe")
    with state_on_disk(spark), whole_texts(spark, feed):
        return writer.trigger(**trigger).start()


def load_new_files(
    spark: SparkSession, feed_name: str, stage: str, root: str, **options
) -> StreamingQuery:
    """Load every file not loaded before, and return the finished query."""
    query = start_pipe(spark, feed_name, stage, root, **options)
    query.awaitTermination()
    return query


def raw_rows(
    spark: SparkSession, root: str, table: str, *, after: int = -1, upto: int | None = None
) -> DataFrame:
    """Loaded rows of the batches in (after, upto]; whole batches only.

    Reading on from a batch opens the folders of the later ones by name, so its
    cost does not grow with the history that is listed but not wanted.
    """
    schema = StructType(RAW_TABLES[table].fields + LINEAGE.fields + [_BATCH])
    path, log = raw_path(root, table), load_log(spark, root, table)
    if upto is not None:
        log = log.where(F.col("_batch") <= upto)
    if after >= 0:
        newer = log.where(F.col("_batch") > after).select("_batch").distinct().collect()
        if not newer:
            return spark.createDataFrame([], schema)
        folders = [f"{path}/_batch={r['_batch']}" for r in newer]
        return spark.read.schema(schema).option("basePath", path).parquet(*folders)
    last = log.agg(F.max("_batch")).first()[0]
    rows = read_or_empty(spark, path, schema)
    return rows.where(F.col("_batch") <= (-1 if last is None else last))
