"""Vectors as short codes: each part of a vector becomes the number of its nearest codebook entry.

Components become integers, ``floor(scale * x)``, so sums and distances are exact
and no result depends on the order in which tasks finish. The codebook of each
part starts as that part of the first vectors by id, and is moved to the floored
means of what was assigned to it, a fixed number of rounds.

The nearest entry is found by equal-average search. Entries are sorted by the sum
of their components. By Cauchy's inequality the squared difference of two sums,
divided by the number of components, is at most the squared distance. So the
search starts at the part's own sum and goes outward, nearer sums first, until the
squared gap over the dimension is strictly greater than the best distance found.
Ties go to the lower index.

Rows whose vector is null or holds null or non-finite components are left out.
Null ids come last in the order of ids; rows that share an id come in order of
their components and are vectors of their own. With fewer vectors than entries
the codebooks have that many entries; an empty table gives no rows. All vectors
must have as many components as the first one, a multiple of the number of parts,
and components within ``LIMIT``, or a ``ValueError`` tells which rule was broken.

Scale: the driver holds the codebooks (entries times dimension numbers, whatever
the input) and sends them to the tasks. A task answers with sums and counts per
entry, never with rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.operators.joins import lookup_join
from tradeflow.workspace import new_folder, settled

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LIMIT = 1 << 22  # of a scaled component; squares then fit 64 bits, parts of 256 components included
_ROWS = 8192


def _whole_numbers(batches: Iterable[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """Rows with a usable vector, its components as integers."""
    for batch in batches:
        vectors = batch.column("vector")
        batch = batch.filter(pc.is_valid(vectors))
        vectors = batch.column("vector")
        values = vectors.flatten()
        numbers = np.floor(pc.fill_null(values.cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False) * scale)
        sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        bad = np.append(0, np.cumsum(~np.isfinite(numbers)))
        fine = bad[ends] == bad[ends - sizes]
        numbers = numbers[np.repeat(fine, sizes)]
        if len(numbers) and np.abs(numbers).max() >= LIMIT:
            raise ValueError(f"a component times {scale} is {LIMIT} or more")
        offsets = pa.array(np.append(0, np.cumsum(sizes[fine])), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(numbers.astype(np.int32)))
        batch = batch.filter(pa.array(fine))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), lists], names=["vec_id", "label", "vector"])


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                  scale: int = SCALE) -> DataFrame:
    """``vec_id, label, vector``: usable vectors with whole components. Labels are strings."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.mapInArrow(lambda batches: _whole_numbers(batches, scale), "vec_id bigint, label string, vector array<int>")


class NearestEntry:
    """Equal-average search in the codebook of one part."""

    def __init__(self, entries: np.ndarray):
        sums = entries.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.entries, self.sums = entries[self.number], sums[self.number]

    def of(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each part's nearest entry, and its squared distance."""
        best = np.full(len(parts), np.iinfo(np.int64).max)
        chosen = np.full(len(parts), len(self.sums))
        own = parts.sum(axis=1)
        above = np.searchsorted(self.sums, own)
        below = above - 1
        rows, dimension = np.arange(len(parts)), parts.shape[1]
        far, started = np.iinfo(np.int64).max, False
        while len(rows):
            has_low, has_high = below >= 0, above < len(self.sums)
            low_gap = np.where(has_low, own - self.sums[np.maximum(below, 0)], far)
            high_gap = np.where(has_high, self.sums[np.minimum(above, len(self.sums) - 1)] - own, far)
            down = low_gap < high_gap
            gap = np.minimum(low_gap, high_gap)
            go = has_low | has_high
            if not started:
                started = True
            else:  # the squared gap over the dimension, strictly above the best distance, ends a search
                limit = best[rows] * dimension
                go &= gap <= np.sqrt(limit.astype(np.float64)) + 1
                near = np.where(go, gap, 0)
                go &= near * near <= limit
            rows, own, below, above, down = rows[go], own[go], below[go], above[go], down[go]
            at = np.where(down, below, above)
            away = parts[rows] - self.entries[at]
            distance = np.einsum("ij,ij->i", away, away)
            number = self.number[at]
            closer = (distance < best[rows]) | ((distance == best[rows]) & (number < chosen[rows]))
            best[rows[closer]], chosen[rows[closer]] = distance[closer], number[closer]
            below -= down
            above += ~down
        return chosen, best


def _parts(batch: pa.RecordBatch, books: np.ndarray) -> np.ndarray:
    """Components as (rows, parts, dimension of a part)."""
    count, _, width = books.shape
    vectors = batch.column("vector")
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes != count * width).any():
        raise ValueError("vectors differ in their number of components")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, count, width)


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _gathered(batches: Iterable[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What a task's vectors add to each entry: how many, and the sum of each component."""
    count, size, width = books.shape
    search = [NearestEntry(book) for book in books]
    times, sums = np.zeros((count, size), np.int64), np.zeros((count, size, width), np.int64)
    for batch in _slices(batches):
        parts = _parts(batch, books)
        for p in range(count):
            chosen, _ = search[p].of(parts[:, p])
            np.add.at(times[p], chosen, 1)
            np.add.at(sums[p], chosen, parts[:, p])
    part, entry = np.nonzero(times)
    part, entry = np.repeat(part, width + 1), np.repeat(entry, width + 1)
    place = np.tile(np.arange(-1, width), len(part) // (width + 1))
    value = np.where(place < 0, times[part, entry], sums[part, entry, np.maximum(place, 0)] if width else 0)
    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (part, entry, place, value)],
                                     names=["part", "entry", "place", "value"])


def codebooks(whole: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """(parts, entries, dimension of a part) integers. ``whole`` reads the same way each time, as a written table does."""
    first = whole.select("vec_id", "vector").orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    width = len(first[0]["vector"]) if first else 0
    if width % parts or any(len(r["vector"]) != width for r in first):
        raise ValueError(f"vectors must share a number of components that is a multiple of {parts}")
    books = np.array([r["vector"] for r in first], np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2)
    for _ in range(rounds if first else 0):
        now = books
        added = whole.select("vector").mapInArrow(
            lambda batches, now=now: _gathered(batches, now), "part bigint, entry bigint, place bigint, value bigint")
        books = now.copy()
        found = added.groupBy("part", "entry").agg(
            F.sum(F.when(F.col("place") < 0, F.col("value"))).alias("n"),
            *[F.sum(F.when(F.col("place") == i, F.col("value"))).alias(f"s{i}") for i in range(width // parts)])
        for part, entry, n, *sums in found.collect():  # a row per entry, whatever the input
            books[part, entry] = [s // n for s in sums]
    return books


def digest_of(books: np.ndarray) -> str:
    """SHA-256 of all components in order of part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _coded(batches: Iterable[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    search = [NearestEntry(book) for book in books]
    for batch in _slices(batches):
        parts = _parts(batch, books)
        found = [search[p].of(parts[:, p]) for p in range(len(books))]
        codes = np.stack([chosen for chosen, _ in found], axis=1)
        error = np.sum([distance for _, distance in found], axis=0, dtype=np.int64)
        digits = 2 if books.shape[1] <= 256 else 4
        texts = ["".join(f"{c:0{digits}x}" for c in row) for row in codes.tolist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(texts, pa.string()), pa.array(error)],
            names=["vec_id", "label", "code", "error"])


def coded(whole: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error``: two hex digits a part, and the summed squared distances."""
    if not books.shape[1]:
        return whole.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
    return whole.mapInArrow(lambda batches: _coded(batches, books), "vec_id bigint, label string, code string, error bigint")


def compressed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *,
               parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every usable vector."""
    spark = vectors.sparkSession
    whole = settled(whole_vectors(vectors, id_col, vector_col, label_col, scale), new_folder(spark, "whole-vectors"))
    books = codebooks(whole, parts=parts, entries=entries, rounds=rounds)
    # A label may hold a third of all vectors: it is summed in the tasks first, then looked up.
    key = F.coalesce(F.concat(F.lit("="), "label"), F.lit(""))
    rows = settled(coded(whole, books).withColumn("_label", key).drop("label"), new_folder(spark, "vector-codes"))
    errors = rows.groupBy("_label").agg(F.sum("error").alias("label_error"))
    found = lookup_join(rows, settled(errors, new_folder(spark, "label-errors")), "_label", spread_by="vec_id")
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest_of(books)).alias("codebooks_sha256"))
