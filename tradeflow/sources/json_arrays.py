"""Elements of JSON arrays, read by many tasks whatever the size of a file.

Spark's text reader cuts a file into ranges and a range into pieces that end at a
closing brace. Whether a range begins inside a string, and how deep, depends on
all text before it. So files that may have several ranges are read in three steps,
a parallel prefix scan:

1. each range says whether it flips between string and not, and how much it
   nests, for both ways it may begin;
2. these are added up per file, in order, which gives each range its true start;
3. each range is cut at the commas of depth one. What is open at a border comes as
   fragments, which are put together by file and order.

Files that Spark never splits are read once, each as one text; so are packed ones (``.gz.json``, ``.zst.json``), whatever
their size, which are unpacked bit by bit. For other files a task reads one range after the
other, and holds one batch of pieces and one unfinished element. Elements leave as text; what they hold is parsed by Spark.

A file holds one array or several one after the other; an empty array has no
elements. Anything else stops the read, but for files of no bytes, which Spark
doesn't list.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeflow.workspace import new_folder, settled

_END = b"}"
_SPACE = b" \t\r\n"
_MARK = b"\xef\xbb\xbf"
_QUOTE, _SLASH, _COMMA, _OPEN, _CLOSE = b'"\\,[]'
_NEST = np.zeros(256, dtype=np.int8)
_NEST[[ord("["), ord("{")]], _NEST[[ord("]"), ord("}")]] = 1, -1
# All bytes but quotes, brackets and braces; a table of those and commas; what a backslash takes its meaning from.
_PLAIN = bytes(b for b in range(256) if b not in b'"[]{}')
_MARKED = bytes(b in b'",[]{}' for b in range(256))
_ESCAPES = re.compile(rb'\\[\\"]')
# A task reads so much at least where its ranges are smaller, and there are ranges enough for all cores.
TASK_BYTES = 16 * 1024 * 1024
# So many ranges' starts are broadcast at once: a path and five numbers each.
RANGES_AT_ONCE = 200_000
# A text that comes whole is cut in parts of about so many bytes.
PART_BYTES = 1024 * 1024
# How packed files are named, and how what unpacks them is told by their first bytes.
PACKED_NAMES = (".gz.json", ".zst.json")
_PACKINGS = {b"\x1f\x8b": "gzip", b"\x28\xb5\x2f\xfd": "zstd"}
# Pieces of an open element: it begins in the range, runs through it, or ends in it.
BEGINS, RUNS, ENDS = 2, 1, 0


def _unescaped_quotes(data: np.ndarray) -> np.ndarray:
    quotes = data == _QUOTE
    slashes = np.flatnonzero(data == _SLASH)
    if len(slashes):
        # An odd number of backslashes before a quote makes it part of the string.
        first = np.append(True, np.diff(slashes) > 1)
        run = np.diff(np.append(np.flatnonzero(first), len(slashes)))
        after = slashes[first] + run
        odd = after[(run % 2 == 1) & (after < len(data))]
        quotes[odd] = False
    return quotes


def _signs(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the text has commas, brackets, braces and quotes that are not escaped, and which."""
    data = np.frombuffer(text, dtype=np.uint8)
    places = np.flatnonzero(np.frombuffer(text.translate(_MARKED), dtype=np.bool_))
    signs = data[places]
    if b"\\" in text:
        kept = (signs != _QUOTE) | _unescaped_quotes(data)[places]
        places, signs = places[kept], signs[kept]
    return places, signs


@dataclass
class Shape:
    """What a text does to the state it is met in: outside a string (0) or inside (1)."""

    flips: int = 0
    nests: list[int] = field(default_factory=lambda: [0, 0])
    size: int = 0

    def add(self, text: bytes) -> None:
        if b"\\" in text:
            text, size = _ESCAPES.sub(b"", text), len(text)
        else:
            size = len(text)
        data = np.frombuffer(text.translate(None, _PLAIN), dtype=np.uint8)
        quotes = np.cumsum(data == _QUOTE, dtype=np.uint8)
        apart, nest = quotes & 1 == 0, _NEST[data]
        sums = int(nest[apart].sum(dtype=np.int64)), int(nest[~apart].sum(dtype=np.int64))
        self.nests = [self.nests[s] + sums[s ^ self.flips] for s in (0, 1)]
        self.flips ^= int(quotes[-1]) & 1 if len(quotes) else 0
        self.size += size


@dataclass
class Cutter:
    """Cuts the text of one range, part by part, into elements and fragments.

    Parts must not end within an escape; those that end after a brace don't.
    """

    name: str
    inside: bool = False
    depth: int = 0
    held: list[bytes] = field(default_factory=list)
    begun: bool = False  # the open element began in this range
    opened: bool = False  # it is the first of its array
    arrays: int = 0
    fragments: list[tuple[int, bytes, bool, bool]] = field(default_factory=list)  # kind, text, first, last

    def malformed(self, what: str) -> ValueError:
        return ValueError(f"malformed JSON, {what}: {self.name}")

    def elements(self, text: bytes) -> list[bytes]:
        places, signs = _signs(text)
        quotes = signs == _QUOTE
        outside = ((np.cumsum(quotes, dtype=np.uint8) & 1) ^ self.inside == 0) & ~quotes
        nest = np.where(outside, _NEST[signs], 0)
        depth = self.depth + np.cumsum(nest, dtype=np.int64)
        if len(depth) and depth.min() < 0:
            raise self.malformed("a bracket closes nothing")
        marks = np.flatnonzero(outside & ((signs == _COMMA) & (depth == 1) | (depth == 0) & (nest < 0) | (depth == 1) & (nest > 0)))
        found, at = [], 0
        for mark, sign, level in zip(places[marks].tolist(), signs[marks].tolist(), depth[marks].tolist(), strict=True):
            part = text[at:mark]
            if level == 1 and sign != _COMMA:
                if sign != _OPEN:
                    raise self.malformed("not an array")
                self.gap(part)
                self.begun = self.opened = True
                self.arrays += 1
            else:
                if level == 0 and sign != _CLOSE:
                    raise self.malformed("an array ends with a brace")
                self.held.append(part)
                self.close(found, last=sign == _CLOSE)
                self.begun, self.opened = sign == _COMMA, False
            at = mark + 1
        self.inside ^= bool(quotes.sum() & 1)
        self.depth = int(depth[-1]) if len(depth) else self.depth
        if self.depth:
            self.held.append(text[at:])
        else:
            self.gap(text[at:])
        return found

    def gap(self, text: bytes) -> None:
        if text.removeprefix(_MARK).strip(_SPACE):
            raise self.malformed("text outside an array")

    def close(self, found: list[bytes], last: bool) -> None:
        element = b"".join(self.held)
        self.held = []
        if not self.begun:
            self.fragments.append((ENDS, element, False, last))
        elif element := element.strip(_SPACE):
            found.append(element)
        elif not (self.opened and last):
            raise self.malformed("an element is missing")

    def end(self, last: bool) -> None:
        """The range is over; ``last`` if the file is."""
        if last and (self.depth or self.inside):
            raise self.malformed("the array is cut off")
        if self.depth:
            kind = BEGINS if self.begun else RUNS
            self.fragments.append((kind, b"".join(self.held), self.opened and self.begun, False))


def _borders(batch: pa.RecordBatch) -> list[int]:
    """Where runs of one range begin in a batch, and its end. Path and start tell ranges apart."""
    n = batch.num_rows
    if not n:
        return [0]
    path = batch.column("path").dictionary_encode().indices.to_numpy()
    start = batch.column("start").to_numpy()
    new = np.flatnonzero((path[1:] != path[:-1]) | (start[1:] != start[:-1])) + 1
    return [0, *new.tolist(), n]


def _ranges(batches: Iterable[pa.RecordBatch], part: Callable[[tuple, bytes], Iterable], end: Callable[[tuple], Iterable]) -> Iterator:
    """Calls ``part`` with the text of each range, bit by bit, then ``end``. Ranges of a task come one after the other.

    A piece lost its brace; the last one of a file may have had none.
    """
    now, pieces = None, 0
    for batch in batches:
        cuts = _borders(batch)
        runs = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), batch.column(0)), _END)
        for a, b, run in zip(cuts[:-1], cuts[1:], runs, strict=True):
            key = tuple(batch.column(i)[a].as_py() for i in range(1, batch.num_columns))
            if key != now:
                if now is not None:
                    yield from end(now)
                now, pieces = key, 0
            text = run.as_py()
            yield from part(now, _END + text if pieces else text)
            pieces += b - a
    if now is not None:
        yield from end(now)


def _shapes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shapes: dict[tuple, Shape] = {}

    def part(key, text):
        shapes.setdefault(key, Shape()).add(text)
        return ()

    def end(key):
        shape = shapes.pop(key)
        size = shape.size + 1
        shape.add(_END)  # as if there were one; the file's size tells whether there is
        row = (*key, size, shape.flips, *shape.nests)
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["path", "start", "size", "bytes", "flips", "nests0", "nests1"])

    yield from _ranges(batches, part, end)


def _cut(batches: Iterable[pa.RecordBatch], fragments: bool) -> Iterator[pa.RecordBatch]:
    """Elements, or fragments, of ranges whose start is known."""
    held: dict[tuple, Cutter] = {}

    def cutter(key) -> Cutter:
        path, start, inside, depth = key[:4]
        if depth is None:
            raise ValueError(f"changed while it was read: {path}")
        if key not in held:
            held[key] = Cutter(path, bool(inside), depth)
        return held[key]

    def part(key, text):
        found = cutter(key).elements(text)
        if not fragments:
            yield from _rows(found, key[0])

    def end(key):
        path, start, _, _, last, closed = key
        cut = held.pop(key)
        found = cut.elements(_END) if closed else []
        cut.end(last)
        if last and not cut.arrays and not cut.fragments and start == 0:
            raise cut.malformed("not an array")
        if not fragments:
            yield from _rows(found, path)
        elif cut.fragments:
            kinds, texts, firsts, lasts = zip(*cut.fragments, strict=True)
            n = len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * n), pa.array([start] * n, pa.int64()), pa.array(kinds, pa.int32()),
                 pa.array(texts, pa.binary()).cast(pa.string()), pa.array(firsts), pa.array(lasts)],
                names=["path", "start", "kind", "text", "first", "last"])

    yield from _ranges(batches, part, end)


def _rows(found: list[bytes], path: str) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(found), 10_000):
        some = found[at : at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary()).cast(pa.string()), pa.repeat(pa.scalar(path), len(some))],
                                         names=["element", "_src_file"])


def _pieces(read: Callable[[str, dict], DataFrame], wanted: Column) -> DataFrame:
    text = read("text", {"lineSep": _END.decode()}).where(wanted)
    about = [F.col(f"_metadata.{n}").alias(m) for n, m in (("file_path", "path"), ("file_block_start", "start"), ("file_size", "size"))]
    return text.select(F.col("value").cast("binary"), *about)


def _starts(spark: SparkSession, pieces: DataFrame) -> DataFrame:
    """How each range begins, and whether it is the last one and ends with a brace."""
    shapes = pieces.mapInArrow(_shapes, "path string, start bigint, size bigint, bytes bigint, flips bigint, nests0 bigint, nests1 bigint")
    shapes = settled(shapes, new_folder(spark, "json-ranges"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    file = Window.partitionBy("path")
    inside = F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2
    change = F.when(F.col("inside") == 1, F.col("nests1")).otherwise(F.col("nests0"))
    last = F.col("start") == F.max("start").over(file)
    # ``bytes`` is as if each piece had ended with a brace; a mark of three bytes may have been taken off.
    closed = ~last | (F.col("size") - F.sum("bytes").over(file)).isin(0, len(_MARK))
    known = shapes.withColumn("inside", inside).withColumn("depth", F.coalesce(F.sum(change).over(before), F.lit(0)))
    known = known.select("path", "start", "inside", "depth", last.alias("last"), closed.alias("closed"))
    return settled(known, new_folder(spark, "json-starts"))


def _put_together(fragments: DataFrame) -> DataFrame:
    """Elements that lie in several ranges. A range has two fragments at most."""
    order = Window.partitionBy("path").orderBy("start", "kind")
    number = F.sum((F.col("kind") == BEGINS).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = fragments.withColumn("number", number).groupBy("path", "number").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "text"))).alias("parts"), F.max("first").alias("first"), F.max("last").alias("last"))
    text = F.trim(F.array_join(F.transform("parts", lambda p: p["text"]), ""), F.lit(_SPACE.decode()))
    missing = F.raise_error(F.concat(F.lit("malformed JSON, an element is missing: "), "path")).cast("string")
    whole = parts.select("path", "first", "last", text.alias("element"))
    kept = whole.where((F.col("element") != "") | ~(F.col("first") & F.col("last")))
    return kept.select(F.when(F.col("element") == "", missing).otherwise(F.col("element")).alias("element"), F.col("path").alias("_src_file"))


def byte_size(spark: SparkSession, name: str) -> int:
    """A size the session is set to."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get(name).lower()).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


def never_split(spark: SparkSession) -> int:
    """The size up to which Spark reads a file in one range."""
    return min(byte_size(spark, "spark.sql.files.openCostInBytes"), byte_size(spark, "spark.sql.files.maxPartitionBytes"))


def array_elements(spark: SparkSession, read: Callable[[str, dict], DataFrame], wanted: Column) -> DataFrame:
    """``element, _src_file`` of all arrays in the files that ``read(format, options)`` finds and ``wanted`` lets in.

    ``wanted`` may use the files' metadata only.
    """
    size, schema = F.col("_metadata.file_size"), "element string, _src_file string"
    most, name, path = never_split(spark), F.lower(F.col("_metadata.file_name")), F.col("_metadata.file_path").alias("path")
    packed = reduce(Column.__or__, [name.endswith(ending) for ending in PACKED_NAMES])
    files = read("binaryFile", {}).where(wanted)
    kinds = {r["kind"] for r in files.select(F.when(packed, "packed").when(F.col("length") > most, "large").otherwise("small").alias("kind")).distinct().collect()}
    wanted &= ~packed
    small = read("text", {"wholetext": True}).where(wanted & (size <= most))
    whole = [small.select(F.col("value").cast("binary"), path)] if "packed" not in kinds or "small" in kinds else []
    if "packed" in kinds:
        whole.append(files.where(packed).select(F.col("content").alias("value"), path))
    found = reduce(DataFrame.unionByName, whole).mapInArrow(_cut_whole, schema)
    if "large" not in kinds:
        return found
    starts = _starts(spark, _gathered(_pieces(read, wanted & (size > most))))
    # The starts of as many ranges as may be broadcast at once; ranges of a file stay together.
    groups = max(1, math.ceil(starts.count() / RANGES_AT_ONCE))
    for group in range(groups):
        def own(path: Column) -> Column:
            return F.lit(True) if groups == 1 else F.pmod(F.xxhash64(path), F.lit(groups)) == group

        pieces = _gathered(_pieces(read, wanted & (size > most) & own(F.col("_metadata.file_path"))))
        # One row per range. The join keeps the pieces of a range together and in order.
        known = F.broadcast(starts.where(own(F.col("path"))))
        placed = pieces.join(known, ["path", "start"], "left").select("value", "path", "start", "inside", "depth", "last", "closed")
        parts = placed.mapInArrow(lambda batches: _cut(batches, True), "path string, start bigint, kind int, text string, first boolean, last boolean")
        found = found.unionByName(placed.mapInArrow(lambda batches: _cut(batches, False), schema)).unionByName(_put_together(parts))
    return found


def _gathered(pieces: DataFrame) -> DataFrame:
    """Small ranges are read by tasks of several; one range stays one task where it is large, or where they are few."""
    spark = pieces.sparkSession
    ranges = pieces.rdd.getNumPartitions()
    most = max(1, TASK_BYTES // byte_size(spark, "spark.sql.files.maxPartitionBytes"))
    tasks = max(math.ceil(ranges / most), min(ranges, 16 * spark.sparkContext.defaultParallelism))
    return pieces.coalesce(tasks) if tasks < ranges else pieces


def _parts(text: bytes) -> Iterator[bytes]:
    """The text in parts that end after a brace."""
    at = 0
    while at < len(text):
        end = text.find(_END, at + PART_BYTES) + 1 or len(text)
        yield text[at:end]
        at = end


def _unpacked(content: pa.Buffer, packing: str) -> Iterator[bytes]:
    """The packed text in parts that end after a brace, but for the last; nothing is held past the brace."""
    held = []
    with pa.input_stream(content, compression=packing) as text:
        while more := text.read(PART_BYTES):
            end = more.rfind(_END) + 1
            if end:
                yield b"".join([*held, more[:end]])
                held = []
            held.append(more[end:])
    if any(held):
        yield b"".join(held)


def _cut_whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements of files that come as one text each."""
    for batch in batches:
        for text, path in zip(batch.column("value"), batch.column("path").to_pylist(), strict=True):
            cut = Cutter(path)
            data = text.as_buffer()
            packing = next((p for first, p in _PACKINGS.items() if bytes(memoryview(data)[: len(first)]) == first), None)
            for part in _unpacked(data, packing) if packing else _parts(text.as_py()):
                yield from _rows(cut.elements(part), path)
            cut.end(True)
            if not cut.arrays:
                raise cut.malformed("not an array")
