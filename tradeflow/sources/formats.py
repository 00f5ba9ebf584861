"""Named file formats and the scans that use them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tradeflow.schemas import MARKET_EVENTS, POSITIONS, TRADES, conform
from tradeflow.sources.json_arrays import array_elements


@dataclass(frozen=True)
class FileFormat:
    """Reader options kept under a name. A bad value stops the load."""

    kind: str
    options: dict[str, object] = field(default_factory=dict)


FORMATS = {
    # One header line, columns by position, quotes optional and doubled inside.
    "csv_trades": FileFormat(
        "csv",
        {"header": True, "enforceSchema": True, "quote": '"', "escape": '"', "mode": "FAILFAST"},
    ),
    # Arrays, read by as many tasks as a file has ranges. Each element is parsed as a
    # variant, because Spark matches JSON keys by exact case and the feed may
    # spell them in any.
    "json_events": FileFormat("json"),
    # Files may lack columns that others have, or have them in another type, so
    # files of one footer are read together and then cast to the table.
    "parquet_positions": FileFormat("parquet"),
}


@dataclass(frozen=True)
class Feed:
    """What is loaded into one RAW table, and from which files."""

    table: str
    file_format: str
    pattern: str
    name_glob: str
    schema: StructType


# How Spark names types of two files that have no common one.
_UNMERGED = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")

# The path pattern of each feed below a shared stage.
FEEDS = {
    "trades": Feed("trades_raw", "csv_trades", ".*trades.*[.]csv", "*.csv", TRADES),
    "market_events": Feed(
        "market_events_raw", "json_events", ".*events.*[.]json", "*.json", MARKET_EVENTS
    ),
    "positions": Feed(
        "positions_raw", "parquet_positions", ".*positions.*[.]parquet", "*.parquet", POSITIONS
    ),
}


def encoded(path: str) -> str:
    """A path as file metadata spells it: what a URI may not hold is percent-coded."""
    return re.sub(r"""[\x00-\x20"#%<>?\[\]\\^`{|}\x7F]""", lambda m: f"%{ord(m[0]):02X}", path)


def literal(path: str) -> str:
    """A path that a reader takes as it is, with no character standing for others."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def below(stage: str, path: Column) -> Column:
    """The part of a file's path under ``stage``.

    A folder above the stage must not decide whether a file matches.
    """
    bare = encoded(re.sub(r"^[a-z0-9]+:/*", "", stage.strip()).strip("/"))
    at = F.instr(path, f"{bare}/")
    return F.when(at > 0, F.substr(path, at + F.lit(len(bare)))).otherwise(F.raise_error(F.concat(F.lit("not below the stage: "), path)))


def matches(stage: str, pattern: str, path: Column) -> Column:
    return below(stage, path).rlike(f"^(?:{pattern})$")


def _events(elements: DataFrame, schema: StructType) -> DataFrame:
    """One row per array element, keys matched ignoring case."""
    rows = elements.select(F.parse_json("element").cast("map<string,variant>").alias("_row"), "_src_file")

    def field_of(name: str) -> Column:
        # The usual spellings are a plain lookup; any other falls through to a
        # search over the row's few keys.
        other = F.filter(F.map_entries("_row"), lambda e: F.lower(e["key"]) == name.lower())
        return F.coalesce(
            F.col("_row")[name.upper()], F.col("_row")[name.lower()], F.get(other, 0)["value"]
        )

    columns = []
    for want in schema.fields:
        value = field_of(want.name)
        if want.dataType.typeName() != "variant":
            value = value.cast("string").cast(want.dataType)
        columns.append(value.alias(want.name))
    return rows.select(*columns, "_src_file")


def _reading(spark: SparkSession, feed: Feed, stage: str, files: list[str] | None,
             pattern: str | None) -> tuple[Callable[[str, dict], DataFrame], Column]:
    """How to read the files wanted in any of Spark's formats, and a condition on their metadata."""
    if files is not None:
        paths = [literal(_plain(f)) for f in files]
        return lambda kind, options: spark.read.format(kind).options(**options).load(paths), F.lit(True)
    found = {"recursiveFileLookup": True, "pathGlobFilter": feed.name_glob}
    wanted = matches(stage, pattern or feed.pattern, F.col("_metadata.file_path"))
    return lambda kind, options: spark.read.format(kind).options(**found, **options).load(literal(stage)), wanted


def _plain(path: str) -> str:
    """A file's path from its metadata spelling, without percent codes."""
    return unquote(path)


# Hadoop's names of stores next to those of the library that reads footers.
_SAME_STORE = {"s3a": "s3", "s3n": "s3"}


def _footers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column("_src_file").to_pylist()
        kinds = []
        for path in paths:
            scheme, _, rest = _plain(path).partition(":")
            store, local = fs.FileSystem.from_uri(f"{_SAME_STORE.get(scheme, scheme)}://{rest.lstrip('/') if scheme != 'file' else '/' + rest.lstrip('/')}")
            with store.open_input_file(local) as file:
                found = pq.read_schema(file).remove_metadata()
            kinds.append("\n".join(sorted(f"{f.name} {f.type}" for f in found)))
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(kinds, pa.string())], names=["_src_file", "kind"])


def _parquet_rows(spark: SparkSession, feed: Feed, read: Callable[[str, dict], DataFrame], wanted: Column) -> DataFrame:
    """Rows of Parquet files that may differ in their columns, and in the types of them.

    Spark merges the files' schemas. Only where types can't be merged are footers
    looked at one by one (in tasks), and files of one kind read together.
    """
    path = F.col("_metadata.file_path").alias("_src_file")
    declared = StructType([*feed.schema.fields, StructField("_src_file", StringType())])
    try:
        return conform(read("parquet", {"mergeSchema": True}).where(wanted).select("*", path), declared)
    except (PySparkException, Py4JJavaError) as failure:  # inside a micro-batch the JVM's failures arrive as they are
        if "UNABLE_TO_INFER_SCHEMA" in str(failure):  # there are no files
            return spark.createDataFrame([], declared)
        if not any(name in str(failure) for name in _UNMERGED):
            raise
    files = read("binaryFile", {}).where(wanted).select(path)
    kinds = files.mapInArrow(_footers, "_src_file string, kind string").groupBy("kind").agg(F.collect_list("_src_file"))
    groups = [
        spark.read.parquet(*[literal(_plain(path)) for path in paths]).select("*", F.col("_metadata.file_path").alias("_src_file"))
        for _, paths in sorted(kinds.collect())
    ]
    rows = [conform(group, declared) for group in groups]
    return reduce(DataFrame.unionByName, rows) if rows else spark.createDataFrame([], declared)


def scan(
    spark: SparkSession,
    feed: Feed,
    stage: str,
    *,
    files: list[str] | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """The feed's files below ``stage`` as rows of its table, plus ``_src_file``.

    The glob keeps other file types out of the listing. The pattern is a
    condition on the file's path alone, so files it rejects are never opened.
    ``files`` reads just those, by their path in file metadata, whatever else
    the stage holds.
    """
    fmt = FORMATS[feed.file_format]
    if fmt.kind == "csv":
        reader = spark.read.format("csv").options(**fmt.options).schema(feed.schema)
        if files is None:
            reader = reader.options(recursiveFileLookup=True, pathGlobFilter=feed.name_glob)
        rows = reader.load([literal(_plain(f)) for f in files] if files is not None else literal(stage))
        rows = rows.select("*", F.col("_metadata.file_path").alias("_src_file"))
        if files is None:
            rows = rows.where(matches(stage, pattern or feed.pattern, F.col("_src_file")))
        return conform(rows, StructType(feed.schema.fields + [rows.schema["_src_file"]]))
    if fmt.kind == "json":
        return _events(array_elements(spark, *_reading(spark, feed, stage, files, pattern)), feed.schema)
    return _parquet_rows(spark, feed, *_reading(spark, feed, stage, files, pattern))
