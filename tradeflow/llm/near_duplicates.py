"""Texts whose sets of five-word shingles are alike, by MinHash banding.

Each text has a signature per tree, of fixed length: a band. The length is the
longest at which a pair at the threshold meets in some band with the target
recall; it is computed once from the threshold, not shortened by what is found.
Texts with equal bands are candidates, "trie nodes" below. They are then
verified by the words of their shingles, so no reported link is wrong.

A word is a run of characters other than ASCII white space. A text of fewer
words than a shingle is one shingle; a text without words (null included) is
alone. Equal texts are one node, told apart by 64-bit content hashes, so copies
cost nothing beyond a count. Rows that share an id each have the class of their
own text. Null ids take no part in naming a class.

Scale: a trie node links its members to its least one (no pairs), after the
texts of one chunk have met. Candidates of one component are verified together;
a component of more than ``BLOCK_TEXTS`` or ``BLOCK_BYTES`` is cut to blocks and
each two blocks meet in a task of their own, so that no task holds more than two.
Only counts and class roots leave a task. Hand over a table that reads the same
way each time, as a written one does.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.components import components
from tradeflow.llm.text import Words, chunks, dealt, free_names, gathered, gram_hashes, mix, split_words
from tradeflow.workspace import new_folder, settled

SHINGLE = 5
THRESHOLD = 0.8
TREES = 32
DEPTH = 8
RECALL = 0.9999
BLOCK_TEXTS = 512
BLOCK_BYTES = 8 << 20
_COLUMNS = 2048

_NODE = {"key": np.uint64, "text": np.int64}
_EDGE = {"a": np.int64, "b": np.int64}
_DEALT = "target int, key binary, text binary, a binary, b binary"
HAS_WORD = r"[^\x20\x09-\x0D]"


def prefix_length(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix by which a pair at the threshold meets in some tree often enough."""
    length = depth
    while length > 1 and 1 - (1 - threshold**length) ** trees < recall:
        length -= 1
    return length


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every shingle, in order of texts; repeated ones included."""
    hashes, counts = words.hashes(), words.counts
    at = np.flatnonzero(words.left() >= size)
    of, values = np.searchsorted(words.bounds, at, "right") - 1, mix(gram_hashes(hashes, size))[at]
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            of = np.append(of, short)
            values = np.append(values, mix(gram_hashes(hashes, n)[words.bounds[short]] + np.uint64(n)))
    order = np.argsort(of, kind="stable")
    return of[order], values[order]


def _numbered(parts: np.ndarray, size: int) -> np.ndarray:
    """Equal numbers for equal runs of ``size`` parts, by doubling."""
    def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.unique(left * np.int64(right.max(initial=0) + 1) + right, return_inverse=True)[1]

    result, covered, block, width, left = None, 0, parts, 1, size
    while left:
        if left & 1:
            part = block[covered : covered + len(parts) - size + 1]
            result = part if result is None else joined(result, part)
            covered += width
        left >>= 1
        if left:
            block = joined(block[:-width], block[width:])
            width *= 2
    return result


def exact_shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and shingle of every shingle; shingles are equal if their words are, byte by byte."""
    number, counts, left = words.distinct()[1], words.counts, words.left()
    texts, values = [], []
    for n in range(1, size + 1):
        at = np.flatnonzero(left >= size) if n == size else words.bounds[np.flatnonzero(counts == n)]
        if len(at):
            texts.append(np.searchsorted(words.bounds, at, "right") - 1)
            values.append(_numbered(number, n)[at] * size + n - 1)
    if not texts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(texts), np.concatenate(values)


def _signatures(of: np.ndarray, values: np.ndarray, numbers: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts that have shingles, and ``numbers`` minimum hashes of each."""
    seeds = mix(np.arange(1, 2 * numbers + 1, dtype=np.uint64))
    begin = np.flatnonzero(np.append(True, np.diff(of) != 0)) if len(of) else np.empty(0, np.int64)
    out = np.empty((len(begin), numbers), dtype=np.uint64)
    ends = np.append(begin[1:], len(of))
    first = 0
    while first < len(begin):  # a few texts at a time, so that the work stays in the cache
        last = max(first + 1, int(np.searchsorted(ends, begin[first] + 32_768, "right")))
        part, cuts = values[begin[first] : ends[last - 1]], begin[first:last] - begin[first]
        hold = np.empty_like(part)
        for i in range(numbers):
            np.bitwise_xor(part, seeds[2 * i], out=hold)
            np.multiply(hold, seeds[2 * i + 1] | np.uint64(1), out=hold)
            np.minimum.reduceat(hold, cuts, out=out[first:last, i])
        first = last
    return of[begin], out


def _linked(key: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorts keys; each text after the first of a key is linked to it. Also the firsts' places."""
    order = np.lexsort((text, key))
    new = np.append(True, np.diff(key[order]) != 0) if len(key) else np.empty(0, bool)
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
    away = text[order] != text[first]
    return text[order][away], text[first][away], order[new]


def _planted(batches: Iterable[pa.RecordBatch], targets: int, size: int, trees: int, length: int) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in _DEALT.split(", ")]
    types = pa.schema([(n, pa.int32() if n == "target" else pa.binary()) for n in names])
    for batch in chunks(batches, "text"):
        text = batch.column("_hash").to_numpy()
        _, once = np.unique(text, return_index=True)
        batch, text = batch.take(pa.array(once)), text[once]
        of, least = _signatures(*shingles(split_words(batch.column("text")), size), trees * length)
        keys, texts, edges = [], [], []
        for tree in range(trees):
            key = np.full(len(of), tree, dtype=np.uint64)
            for i in range(tree * length, (tree + 1) * length):
                key = mix(key ^ least[:, i])
            a, b, firsts = _linked(key, text[of])
            keys.append(key[firsts])
            texts.append(text[of][firsts])
            edges.append(np.stack([a, b]))
        key, own = np.concatenate(keys), np.concatenate(texts)
        pairs = np.unique(np.concatenate(edges, axis=1), axis=1)
        out = list(dealt((key % np.uint64(targets)).astype(np.int64), {"key": key, "text": own})) if len(key) else []
        if pairs.size:
            out += dealt((mix(pairs[0].view(np.uint64)) % np.uint64(targets)).astype(np.int64), {"a": pairs[0], "b": pairs[1]})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=types)


def _trie_nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = gathered(batches, _NODE | _EDGE)
    a, b, _ = _linked(got["key"], got["text"])
    pairs = np.unique(np.stack([np.append(a, got["a"]), np.append(b, got["b"])]), axis=1)
    yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def candidates(texts: DataFrame, *, size: int = SHINGLE, threshold: float = THRESHOLD, trees: int = TREES,
               depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """Edges ``a, b`` between content hashes; texts of one trie node are connected by them.

    ``texts`` has ``_hash`` and ``text``.
    """
    targets = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    length = prefix_length(threshold, trees, depth, recall)
    parts = texts.mapInArrow(lambda batches: _planted(batches, targets, size, trees, length), _DEALT)
    return parts.repartitionById(targets, "target").mapInArrow(_trie_nodes, "a bigint, b bigint")


def _alike(words: Words, side: np.ndarray | None, size: int, threshold: float) -> np.ndarray:
    """Whether each two texts reach the threshold; given sides, only texts of different sides are compared."""
    of, values = exact_shingles(words, size)
    m = len(words.counts)
    order = np.lexsort((of, values))
    of, values = of[order], values[order]
    once = np.append(True, (np.diff(values) != 0) | (np.diff(of) != 0))
    of, values = of[once], values[once]
    sizes = np.bincount(of, minlength=m)
    number = np.cumsum(np.append(True, np.diff(values) != 0)) - 1
    shared = np.bincount(number)[number] > 1
    of, number = of[shared], np.unique(number[shared], return_inverse=True)[1]
    common = np.zeros((m, m), dtype=np.float32)
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, _COLUMNS):
        a, b = np.searchsorted(number, [at, at + _COLUMNS])
        block = np.zeros((m, _COLUMNS), dtype=np.float32)
        block[of[a:b], number[a:b] - at] = 1
        common += block @ block.T
    both = sizes[:, None] + sizes[None, :] - common
    alike = common >= threshold * both - 1e-6
    np.fill_diagonal(alike, False)
    return alike if side is None else alike & (side[:, None] != side[None, :])


def _roots(alike: np.ndarray) -> np.ndarray:
    """The least member of each text's component."""
    label = np.arange(len(alike))
    while True:
        near = np.where(alike, label[None, :], len(alike)).min(axis=1, initial=len(alike))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _verified(batches: Iterable[pa.RecordBatch], size: int, threshold: float) -> Iterator[pa.RecordBatch]:
    def result(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        _, once = np.unique(rows.column("_hash").to_numpy(), return_index=True)
        rows = rows.take(pa.array(once))
        text, copies = rows.column("_hash").to_numpy(), rows.column("copies").to_numpy()
        one_block = rows.column("low")[0] == rows.column("high")[0]
        side = None if one_block else rows.column("second").to_numpy(zero_copy_only=False)
        alike = _alike(split_words(rows.column("text")), side, size, threshold)
        linked = alike.any(axis=1)
        links = alike @ copies
        return pa.RecordBatch.from_arrays(
            [pa.array(x[linked]) for x in (text, text[_roots(alike)], links)], names=["_hash", "root", "links"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        group = np.stack([batch.column(n).to_numpy() for n in ("comp", "low", "high")])
        cuts = np.append(np.flatnonzero(np.append(True, (np.diff(group) != 0).any(axis=0))), batch.num_rows)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(a, b - a)
            if held and any(part.column(n)[0] != held[-1].column(n)[0] for n in ("comp", "low", "high")):
                yield result(held)
                held = []
            held.append(part)
    if held:
        yield result(held)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, size: int = SHINGLE,
                    threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id, n_links, n_copies, is_kept``.

    A class is what links connect; its id is its least document id. ``n_links``
    counts the other documents that reach the threshold with this one, its copies
    included. One row of each class is kept: of the least id, or any one row of
    an all-null class; repeated rows of that id are kept together.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("_hash", F.xxhash64("text"))
    keys = settled(rows.select(
        "doc_id", "_hash", F.coalesce("doc_id", "_hash").alias("_key"), F.octet_length("text").alias("bytes"),
        F.coalesce(F.col("text").rlike(HAS_WORD), F.lit(False)).alias("worded"),
    ), new_folder(spark, "text-keys"))
    nodes = keys.where("worded").groupBy("_hash").agg(
        F.min("_key").alias("_key"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"),
        F.max("bytes").alias("bytes"))

    edges = candidates(rows.where(F.col("text").rlike(HAS_WORD)).select("_hash", "text"),
                       size=size, threshold=threshold, trees=trees, depth=depth, recall=recall)
    comps = components(edges).select(F.col("node").alias("_hash"), F.col("component").alias("comp"))
    members = settled(comps.join(nodes, "_hash"), new_folder(spark, "candidates"))
    cut = members.groupBy("comp").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    placed = members.select("_hash", "_key", "comp", "copies").join(cut, "comp").withColumn(
        "own", F.pmod(F.xxhash64(F.lit(7), "_hash"), F.col("blocks")).cast("int"))
    # Always a shuffle join: candidates grow with the input, so they are never broadcast.
    met = rows.select(F.coalesce("doc_id", "_hash").alias("_key"), "_hash", "text").join(
        placed.hint("merge"), ["_key", "_hash"])
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "comp", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).alias("second"), "_hash", "copies", "text")
    group = ["comp", "low", "high"]
    verified = settled(
        met.repartition(*group).sortWithinPartitions(*group).mapInArrow(
            lambda batches: _verified(batches, size, threshold), "_hash bigint, root bigint, links bigint"),
        new_folder(spark, "verified"))
    found = verified.groupBy("_hash").agg(F.sum("links").alias("links"), F.min("root").alias("root"))
    if cut.where("blocks > 1").limit(1).count():  # a text of several groups may have several roots
        joined = components(verified.select(F.col("_hash").alias("a"), F.col("root").alias("b")))
        found = found.drop("root").join(joined.select(F.col("node").alias("_hash"), F.col("component").alias("root")), "_hash")

    rooted = nodes.join(found, "_hash", "left").withColumn("root", F.coalesce("root", "_hash"))
    named = rooted.groupBy("root").agg(F.min("least_id").alias("class_id"), F.min("_hash").alias("first_hash"))
    texts = rooted.join(named, "root").select(
        "_hash", "class_id", "first_hash", "least_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "copies")
    return keys.join(texts, "_hash", "left").select(
        "doc_id", F.when(F.col("worded"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(F.col("worded"), F.col("n_links")).otherwise(0).alias("n_links"),
        F.when(F.col("worded"), F.col("copies")).otherwise(1).alias("n_copies"),
        (~F.col("worded") | F.when(F.col("class_id").isNotNull(), F.col("doc_id").eqNullSafe(F.col("class_id")))
         .otherwise(F.col("_hash") == F.col("first_hash"))).alias("is_kept"), F.col("_hash").alias("text_hash"))


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that stand for their class, with their columns."""
    kept_id, kept_hash = free_names(docs.columns, "_kept_id", "_kept_hash")
    kept = near_duplicates(docs, id_col, text_col, **settings).where("is_kept").select(
        F.col("doc_id").alias(kept_id), F.col("text_hash").alias(kept_hash))
    same = F.col(id_col).eqNullSafe(F.col(kept_id)) & (F.xxhash64(text_col) == F.col(kept_hash))
    return docs.join(kept, same, "left_semi")
