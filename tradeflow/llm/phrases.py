"""A positional inverted index of training texts, and phrase search on it.

The index is a Parquet table of shards. A shard holds a few megabytes of texts:
its terms in order, and for each the positions it stands at. A phrase is looked
up shard by shard: its terms' lists are taken from the rarest one on, adjusted
by the term's place in the phrase, and intersected. With a slop, a term may
stand up to so many words beside its place, counted from where the first term
stands; of several such places the nearest is taken, the earlier of two.

Terms are runs of letters, digits and all characters beyond ASCII; A-Z are
lower-cased. They are compared by 64-bit hashes; a phrase matches only where all
its terms do.

Scale: a shard is built and searched where its texts are read, and nothing is
shuffled, so a frequent term or passage is spread over all shards that hold it.
Phrases are made in tasks. They are collected and sent to the search in blocks
of at most ``BLOCK`` (a stated query set), each block a pass over the index.

Null or empty texts are in the index with no terms. Items without terms match
nothing. Repeated rows are indexed once each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.llm.text import ALNUM, chunks, slices, split_words, free_names
from tradeflow.workspace import new_folder

WINDOW = 10
BLOCK = 50_000  # phrases sent to the tasks at once: 4 MB of terms
PIECE = 1000  # an item of no more phrases is not split, however small the blocks

_SHARD = "shard bigint, ids array<bigint>, sizes binary, terms binary, times binary, steps binary"
_MATCH = pa.struct([("item", pa.string()), ("start", pa.int64()), ("length", pa.int64())])
_FOUND = "shard bigint, ordinal int, doc_id bigint, n_words bigint, " \
         "matches array<struct<item:string,start:bigint,length:bigint>>"


@dataclass
class Phrases:
    """Phrases of up to ``terms.shape[1]`` terms; ``item[i]`` is a place in ``items``."""

    terms: np.ndarray
    sizes: np.ndarray
    item: np.ndarray
    items: list[str | None]


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    for number, batch in enumerate(chunks(batches, "text")):
        words = split_words(batch.column("text"), ALNUM, lower=True)
        hashes = words.hashes()
        # One free position after each text, so that no phrase runs across texts.
        place = np.arange(len(hashes)) + words.text_of_word()
        order = np.argsort(hashes, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(hashes[order]) != 0)) if len(order) else np.empty(0, np.int64)
        steps = np.diff(place[order], prepend=0)
        steps[first] = place[order][first]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part << 32 | number], pa.int64()),
                pa.array([batch.column("id").to_pylist()], pa.list_(pa.int64())),
                pa.array([words.counts.astype(np.uint32).tobytes()], pa.binary()),
                pa.array([hashes[order][first].tobytes()], pa.binary()),
                pa.array([np.diff(np.append(first, len(order))).astype(np.uint32).tobytes()], pa.binary()),
                pa.array([steps.astype(np.uint32).tobytes()], pa.binary()),
            ],
            names=["shard", "ids", "sizes", "terms", "times", "steps"],
        )


def write_index(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Store the postings of all terms of ``docs`` as a table of shards."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    rows.mapInArrow(_shards, _SHARD).write.mode("overwrite").option("compression", "zstd").parquet(folder)


def phrase_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW,
                  block: int = BLOCK) -> Iterator[Phrases]:
    """Every ``size`` consecutive terms of each item, at most ``block`` (or ``PIECE``) at once; an item of fewer is one phrase."""
    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    made = rows.mapInArrow(lambda batches: _phrases(batches, size, block), "item string, n int, terms binary")
    held: list[tuple[str | None, np.ndarray]] = []
    waiting = 0
    for item, n, data in made.toLocalIterator():
        own = np.frombuffer(bytes(data), np.uint64).reshape(-1, n)
        if waiting and waiting + len(own) > block:
            yield _block(held, size)
            held, waiting = [], 0
        held.append((item, own))
        waiting += len(own)
    if waiting:
        yield _block(held, size)


def _phrases(batches: Iterable[pa.RecordBatch], size: int, block: int) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        words = split_words(batch.column("text"), ALNUM, lower=True)
        hashes = words.hashes()
        for i, count in enumerate(words.counts.tolist()):
            if not count:
                continue
            n, at = min(count, size), int(words.bounds[i])
            own = np.lib.stride_tricks.sliding_window_view(hashes[at : at + count], n)
            step = max(block, PIECE)
            for first in range(0, len(own), step):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item").slice(i, 1), pa.array([n], pa.int32()), pa.array([own[first : first + step].tobytes()], pa.binary())],
                    names=["item", "n", "terms"])


def _block(held: list[tuple[str | None, np.ndarray]], size: int) -> Phrases:
    counts = [len(own) for _, own in held]
    return Phrases(
        np.concatenate([np.pad(own, ((0, 0), (0, size - own.shape[1]))) for _, own in held]),
        np.repeat([own.shape[1] for _, own in held], counts), np.repeat(np.arange(len(held)), counts), [item for item, _ in held])


def _ranges(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each range of keys (both ends included) its number, and the place of each key in it."""
    first = np.searchsorted(keys, low)
    counts = np.maximum(np.searchsorted(keys, high, "right") - first, 0)
    return np.repeat(np.arange(len(low)), counts), np.repeat(first, counts) + slices(counts)


def _lookup(terms: np.ndarray, times: np.ndarray, steps: np.ndarray, starts: np.ndarray, phrases: Phrases,
            slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrase number, first and last position of each match in one shard."""
    none = np.empty(0, np.int64)
    if not len(terms) or not len(phrases.sizes):
        return none, none, none
    first = np.cumsum(times) - times
    place = np.cumsum(steps)
    place -= np.repeat(place[first] - steps[first], times)
    keys = (np.repeat(np.arange(len(terms)), times) << 32) | place
    width = phrases.terms.shape[1]
    used = np.arange(width) < phrases.sizes[:, None]
    at = np.minimum(np.searchsorted(terms, phrases.terms), len(terms) - 1)
    alive = np.flatnonzero(((terms[at] == phrases.terms) | ~used).all(axis=1))
    at, used = at[alive], used[alive]
    rarest = np.argsort(np.where(used, times[at], np.iinfo(np.int64).max), axis=1, kind="stable")
    lead = rarest[:, 0]
    lead_term = at[np.arange(len(alive)), lead]
    many = times[lead_term]
    row = np.repeat(np.arange(len(alive)), many)
    begin = place[np.repeat(first[lead_term], many) + slices(many)] - np.repeat(lead, many)
    text = np.searchsorted(starts, begin + lead[row], "right") - 1
    ends = np.append(starts[1:], place.max() + 2) - 2  # last position of each text
    if slop:  # from the lead's places to all places of the first term that it allows
        of = at[row, 0] << 32
        which, hit = _ranges(keys, of | np.maximum(begin - slop, starts[text]),
                             of | np.maximum(np.minimum(begin + slop, ends[text]), 0))
        row, begin = np.unique(np.stack([row[which], keys[hit] & 0xFFFFFFFF]), axis=1)
        text = np.searchsorted(starts, begin, "right") - 1
        low, high = begin, begin
    else:
        low, high = begin + lead[row], begin + lead[row]
    for step in range(0 if slop else 1, width):
        which = rarest[row, step]
        live = used[row, which] & ((which > 0) | (slop == 0))
        least, most = np.maximum(begin + which - slop, starts[text]), np.minimum(begin + which + slop, ends[text])
        wished = np.clip(begin + which, starts[text], ends[text])
        of = at[row, which] << 32
        hit = np.searchsorted(keys, of | wished)
        after, prior = keys[np.minimum(hit, len(keys) - 1)], keys[np.maximum(hit - 1, 0)]
        good = (hit < len(keys)) & (after >= of | least) & (after <= of | most) & (least <= most)
        back = (hit > 0) & (prior >= of | least) & (prior <= of | most) & (least <= most) if slop else np.zeros(len(hit), bool)
        nearer = back & (~good | (wished - (prior & 0xFFFFFFFF) <= (after & 0xFFFFFFFF) - wished))
        found = np.where(nearer, prior, after) & 0xFFFFFFFF
        good |= back
        low, high = np.where(live & good, np.minimum(low, found), low), np.where(live & good, np.maximum(high, found), high)
        keep = good | ~live
        row, begin, text, low, high = (x[keep] for x in (row, begin, text, low, high))
    return alive[row], low, high


def _found(batches: Iterable[pa.RecordBatch], phrases: Phrases, slop: int, all_texts: bool) -> Iterator[pa.RecordBatch]:
    names = pa.array(phrases.items, pa.string())
    for batch in batches:
        for i in range(batch.num_rows):
            column = lambda name, kind: np.frombuffer(batch.column(name)[i].as_py(), kind).astype(np.int64)  # noqa: B023, E731
            terms = np.frombuffer(batch.column("terms")[i].as_py(), np.uint64)
            sizes = column("sizes", np.uint32)
            starts = np.cumsum(sizes + 1) - sizes - 1
            which, low, high = _lookup(terms, column("times", np.uint32), column("steps", np.uint32), starts, phrases, slop)
            text = np.searchsorted(starts, low, "right") - 1
            order = np.lexsort((phrases.item[which], high, low, text))
            which, low, high, text = which[order], low[order], high[order], text[order]
            per_text = np.bincount(text, minlength=len(sizes))
            rows = np.arange(len(sizes)) if all_texts else np.flatnonzero(per_text)
            offsets = np.append(0, np.cumsum(per_text[rows])).astype(np.int32)
            matches = pa.StructArray.from_arrays(
                [names.take(pa.array(phrases.item[which])), pa.array(low - starts[text]), pa.array(high - low + 1)],
                fields=list(_MATCH))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(rows), batch.column("shard")[i].as_py())), pa.array(rows.astype(np.int32)),
                    batch.column("ids")[i].values.take(pa.array(rows)), pa.array(sizes[rows]),
                    pa.ListArray.from_arrays(pa.array(offsets), matches),
                ],
                names=["shard", "ordinal", "doc_id", "n_words", "matches"],
            )


def search(spark: SparkSession, folder: str, items: DataFrame, id_col: str = "item_id", text_col: str = "text", *,
           size: int = WINDOW, slop: int = 0, block: int = BLOCK) -> DataFrame:
    """All texts of the index with the phrases of ``items`` they hold.

    ``doc_id, n_words, matches``: item id as string, first word and number of
    words of each match, in order. Exact phrases with ``slop`` 0.
    """
    index = spark.read.schema(_SHARD).parquet(folder)
    parts = []
    for phrases in phrase_blocks(items, id_col, text_col, size, block):
        parts.append(index.mapInArrow(_finder(phrases, slop, not parts), _FOUND))
    if not parts:
        nothing = Phrases(np.empty((0, size), np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), [])
        parts.append(index.mapInArrow(_finder(nothing, slop, True), _FOUND))
    if len(parts) == 1:
        return parts[0].drop("shard", "ordinal")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("shard", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("matches")), _by_place).alias("matches"),
    ).drop("shard", "ordinal")


def _finder(phrases: Phrases, slop: int, all_texts: bool):
    return lambda batches: _found(batches, phrases, slop, all_texts)


def _by_place(a: Column, b: Column) -> Column:
    return F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(
        F.signum(a["length"] - b["length"])).cast("int")


def covered_words(matches: Column) -> Column:
    """How many words lie in at least one match."""
    state = lambda n, end: F.struct(n.alias("n"), end.alias("end"))
    zero = F.lit(0).cast("bigint")
    return F.aggregate(
        matches, state(zero, zero),
        lambda s, m: state(
            s["n"] + F.greatest(zero, m["start"] + m["length"] - F.greatest(s["end"], m["start"])),
            F.greatest(s["end"], m["start"] + m["length"])),
        lambda s: s["n"],
    )


def contamination(found: DataFrame) -> DataFrame:
    """Per text: words hit, items found, a digest of their ids, and a verdict."""
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: F.coalesce(m["item"], F.lit("")))))
    return found.select("doc_id", "n_words", covered_words(F.col("matches")).alias("n_hit"), items.alias("_items")).select(
        "doc_id", "n_words", "n_hit", F.size("_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                         item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no phrase of ``items``, with their columns.

    Texts are told apart by a 64-bit hash, so ids may be null or repeat.
    """
    folder = new_folder(docs.sparkSession, "phrase-index")
    write_index(docs.select(F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("text")), folder, "_hash")
    hit = search(docs.sparkSession, folder, items, item_col, item_text_col).where(F.size("matches") > 0)
    (name,) = free_names(docs.columns, "_hit")
    return docs.join(hit.select(F.col("doc_id").alias(name)), F.xxhash64(text_col) == F.col(name), "left_anti")
