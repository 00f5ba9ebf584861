"""Packing tokenized documents into sequences of a fixed size, by best-two-fit.

A sequence is filled greedily with the largest document that still fits. When
none fits any more, its smallest document is replaced by the two unpacked ones
that use the widened gap best, if they use it better.

The method needs only how many documents have each length: at most ``capacity``
counters, whatever the input. Equal fillings are made all at once, as often as
the counters allow. Each document then finds its place by its rank among those
of its length. Ranks are counted in hashed buckets, so a length that a third of
all documents have is spread over many tasks.

Documents longer than a sequence are cut to pieces; only the last may be
shorter. A null text is an empty one; its only id is the closing one. Repeated
rows are packed once each. Places are written before they are read back, so the
result does not depend on tasks that are run again.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.text import Words, chunks, letter_runs, slices, split_words
from tradeflow.workspace import new_folder, settled

CAPACITY = 4096
END = 1  # closes each document
CACHED_WORDS = 1_000_000
CACHED_BYTES = 64 << 20
ENCODED_WORDS = 4096  # words given to the tokenizer at once
CHUNK_BYTES = 4 << 20

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


# Tokenizers of these rules ignore case and cut words into runs of letters, single digits and runs of others.
_IGNORES_CASE = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_CUTS_RUNS = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
              "behavior": "Removed", "invert": True}
_MAPS_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_BORDER = "."


def _whole(model: str) -> bytes | None:
    """Which signs make a word one that only the tokenizer can cut; None if it goes by other rules than these."""
    rules = json.loads(model)
    cuts = {"type": "Sequence", "pretokenizers": [_CUTS_RUNS, _MAPS_BYTES]}
    known = {"normalizer": _IGNORES_CASE, "pre_tokenizer": cuts, "truncation": None, "padding": None}
    if any(rules.get(name) != rule for name, rule in known.items()) or rules["model"].get("type") != "BPE":
        return None
    added = [t["content"] for t in rules.get("added_tokens", [])]
    signs = [{c for c in content if c.isascii() and c.isprintable() and not c.isalnum() and c != " "} for content in added]
    return "".join(sorted({"'"}.union(*signs))).encode() if all(signs) else None


class WordIds:
    """Token ids of words, remembered by the word; starts anew when full.

    By rules of runs, what is remembered are the runs, of which there are far fewer.
    """

    def __init__(self, model: str):
        import tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_str(model)
        self.whole = _whole(model)
        border = self.tokenizer.encode(_BORDER, add_special_tokens=False).ids
        self.border = border[0] if self.whole is not None and len(border) == 1 else None
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.begin, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)
        self.held = 0

    def _encode(self, texts: list[str], joined: bool) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has, and all of them; an encoding is large, so few are held.

        ``joined`` texts are runs of letters, encoded as one text with a border in between, which takes less time.
        """
        if joined:
            ids = np.array(self.tokenizer.encode_batch_fast([_BORDER.join(texts)], add_special_tokens=False)[0].ids, np.uint32)
            own = ids != self.border
            borders = np.flatnonzero(~own)
            if len(borders) == len(texts) - 1:
                return np.diff(borders, prepend=-1, append=len(ids)) - 1, ids[own]
        coded = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        count = np.fromiter(map(len, coded), np.int64, len(coded))
        return count, np.fromiter((i for x in coded for i in x), np.uint32, int(count.sum()))

    def _learn(self, new: list[bytes]) -> None:
        letters, others, coded = [], [], []
        for w in new:
            (letters if self.border is not None and _LETTERS.fullmatch(w) else others).append(w)
        for part, joined in ((letters, True), (others, False)):
            texts = [w.decode() for w in part]
            coded += [self._encode(texts[i : i + ENCODED_WORDS], joined) for i in range(0, len(texts), ENCODED_WORDS)]
        new = letters + others
        count = np.concatenate([c for c, _ in coded])
        begin = len(self.ids) + np.cumsum(count) - count
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.begin, self.count = np.append(self.begin, begin), np.append(self.count, count)
        self.ids = np.concatenate([self.ids, *[ids for _, ids in coded]])
        self.held += sum(map(len, new))

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each word has."""
        if len(self.known) > CACHED_WORDS or self.held > CACHED_BYTES:
            self.clear()
        places, which = words.distinct()
        told = words.words(places)
        if new := [w for w in told if w not in self.known]:
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, told), np.int64, len(told))[which]
        count = self.count[at]
        return self.ids[np.repeat(self.begin[at], count) + slices(count)], count


def _word_ids(model: str) -> WordIds:
    """One per worker process: tasks that follow each other share what they know."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    import tokenizers

    held = vars(tokenizers).setdefault("_word_ids_by_model", {})
    if model not in held:
        held.clear()
        held[model] = WordIds(model)
    return held[model]


def _pieces(batches: Iterable[pa.RecordBatch], model: str, capacity: int, end: int) -> Iterator[pa.RecordBatch]:
    coder = _word_ids(model)
    for batch in chunks(batches, "text", CHUNK_BYTES):
        words = split_words(batch.column("text"))
        if coder.whole is not None:
            words = letter_runs(words, coder.whole)
        own, per_word = coder.of(words)
        sums = np.append(0, np.cumsum(per_word))
        sizes = np.diff(sums[words.bounds]) + 1
        ends = np.cumsum(sizes)
        ids = np.full(ends[-1] if len(ends) else 0, end, dtype="<u4")
        inner = np.ones(len(ids), dtype=bool)
        inner[ends - 1] = False
        ids[inner] = own
        pieces = -(-sizes // capacity)
        number = slices(pieces)
        doc = np.repeat(np.arange(len(sizes)), pieces)
        start = number * capacity
        length = np.minimum(sizes[doc] - start, capacity)
        base = (ends - sizes)[doc] + start
        crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(base, length, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(doc)), pa.array(number.astype(np.int32)), pa.array(start),
             pa.array(length), pa.array(crc, pa.int64())],
            names=["doc_id", "piece", "start", "length", "ids_crc32"])


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``doc_id, piece, start, length, ids_crc32``.

    The tokenizer must treat words between ASCII white space independently. Its
    file is read here once and sent to the tasks.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda batches: _pieces(batches, model.value, capacity, end), _PIECES)


def _tighter_pair(sizes: np.ndarray, left: np.ndarray, gap: int, least: int) -> tuple[int, int] | None:
    """Two unpacked sizes that fill ``gap`` best, if they fill more than ``least`` of it."""
    fits = sizes[: np.searchsorted(sizes, gap)]
    if not len(fits):
        return None
    other = np.minimum(np.searchsorted(sizes, gap - fits, "right") - 1, np.arange(len(fits)))
    other -= (other == np.arange(len(fits))) & (left[fits] < 2)
    total = np.where(other >= 0, fits + sizes[other], 0)
    best = int(total.argmax())
    return (int(fits[best]), int(sizes[other[best]])) if total[best] > least else None


def fillings(counts: Mapping[int, int], capacity: int = CAPACITY) -> Iterator[tuple[Counter, int]]:
    """Kinds of sequence as counted lengths, and how many of each kind."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for size, count in counts.items():
        left[size] = count
    while True:
        sizes = np.flatnonzero(left)
        if not len(sizes):
            return
        some, one, room = sizes.tolist(), Counter(), capacity
        while (i := bisect_right(some, room)) and room:
            size = some[i - 1]
            if take := min(int(left[size]) - one[size], room // size):
                one[size] += take
                room -= take * size
            if one[size] == left[size]:
                del some[i - 1]
        if room and one.total() > 1:
            least, rest = min(one), left.copy()
            for size, used in one.items():
                rest[size] -= used
            if pair := _tighter_pair(np.flatnonzero(rest), rest, room + least, least):
                one[least] -= 1
                one.update(pair)
                one += Counter()
        times = min(int(left[size]) // used for size, used in one.items())
        for size, used in one.items():
            left[size] -= times * used
        yield one, times


def _places(counts: Mapping[int, int], capacity: int) -> pa.Table:
    """For each length, which ranks go to which sequences and where in them."""
    rows, ranks, sequence = [], Counter(), 0
    for one, times in fillings(counts, capacity):
        offset = 0
        for size in sorted(one, reverse=True):
            used = one[size]
            rows.append((size, ranks[size], ranks[size] + times * used, sequence, used, offset))
            ranks[size] += times * used
            offset += size * used
        sequence += times
    names = ["length", "_from", "_to", "_sequence", "_used", "_offset"]
    return pa.table({n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(names)})


def packed(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length`` is at most ``capacity``.

    ``pieces`` must give the same rows each time it is read: hand over a written
    table. ``order`` are columns that tell the pieces of one length apart.
    """
    spark = pieces.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = settled(dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("n")), new_folder(spark, "lengths"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # At most a few times ``capacity`` kinds of sequence, whatever the input.
    places = F.broadcast(spark.createDataFrame(_places(counts, capacity)))
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy(*order)
    ranked = dealt.withColumn("_rank", F.row_number().over(inside) - 1).join(before, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before"))
    found = ranked.join(places, "length").where("_rank >= _from and _rank < _to")
    return found.select(
        *pieces.columns,
        (F.col("_sequence") + F.expr("(_rank - _from) div _used")).alias("sequence_id"),
        (F.col("_offset") + F.pmod(F.col("_rank") - F.col("_from"), F.col("_used")) * F.col("length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """All documents in sequences: a row per piece, with its place."""
    pieces = settled(token_pieces(docs, tokenizer_path, id_col, text_col, capacity, end),
                     new_folder(docs.sparkSession, "pieces"))
    return packed(pieces, ["doc_id", "piece", "ids_crc32"], capacity)
