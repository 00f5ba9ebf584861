"""Passages that texts repeat, by seed and extend.

Seeds are winnowed anchors: of the 13 eight-word grams inside a window of 20
words, the one with the least hash (leftmost of equals). Equal windows choose
the same anchor at the same place, so joining on anchors meets every repeated
window. A match is then extended both ways from the anchor: over each window
around it that chose it. Windows that also start earlier merge to maximal spans.

Rows are ordered by id, then start. Null texts and texts of fewer words than a
window have no spans. Repeated identical rows are one document and don't make
each other a copy; rows of one id with other texts come in order of a text
hash. Rows with a null id come last.

Windows are equal if their 64-bit hashes and the upper half of their anchors' are.

Scale: equal windows of one chunk of texts meet before anything is shuffled, so
an anchor held by a third of all texts reaches its partition once per chunk.
Anchors spread by hash; no pairs are made, each window is compared with the
earliest one only. An anchor that holds more than an even partition's share of a
1 % sample has its windows spread by their own hashes; the sample only picks
these anchors. Memory is a partition's anchors, so partitions
(``spark.sql.shuffle.partitions``) must grow with the input, as for any shuffle.
Hand over a table that reads the same way each time, as a written one does: a
task that is run again must meet the same texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.text import Words, chunks, dealt, gathered, gram_hashes, mix, slices, split_words

WINDOW = 20
ANCHOR = 8
CHUNK_BYTES = 4 << 20
SAMPLE = 0.01

_RUN = {"anchor": np.uint32, "doc": np.int64, "row": np.int32, "start": np.int32, "size": np.uint8}
_SPAN = {"known_doc": np.int64, "known_row": np.int32, "known_start": np.int32, "known_size": np.int32}
_DEALT = "target int, anchor binary, doc binary, row binary, start binary, size binary, windows binary, " \
         "known_doc binary, known_row binary, known_start binary, known_size binary"
_SPANS = "_id bigint, _row int, start int, length int"


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    span, have = values, 1
    while have * 2 <= width:
        span = np.minimum(span[:-have], span[have:])
        have *= 2
    rest = width - have
    return np.minimum(span[: len(span) - rest], span[rest:]) if rest else span


def _windows(words: Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start words of all windows, the anchor word each chose, and all window hashes."""
    hashes = words.hashes()
    if len(hashes) < window:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = mix(gram_hashes(hashes, anchor))
    low = np.uint64((1 << 24) - 1)
    place = np.arange(len(grams), dtype=np.uint64)
    if len(grams) > int(low):  # one very long text: order by hash first, then place
        rank = np.empty(len(grams), dtype=np.uint64)
        rank[np.argsort(grams, kind="stable")] = place
        chosen = np.argsort(grams, kind="stable")[_least(rank, window - anchor + 1)]
    else:
        chosen = (_least((grams & ~low) | place, window - anchor + 1) & low).astype(np.int64)
    starts = np.flatnonzero(words.left() >= window)
    return starts, chosen[starts], mix(gram_hashes(hashes, window))[starts]


def _later_copies(key: np.ndarray, doc: np.ndarray, row: np.ndarray, start: np.ndarray,
                  group: np.ndarray | None = None) -> np.ndarray:
    """Whether each window also starts earlier (in its group); the arrays come in order of doc, row, start."""
    order = np.argsort(key, kind="stable") if group is None else np.lexsort((key, group))
    new = np.append(True, np.diff(key[order]) != 0) if len(key) else np.empty(0, bool)
    if group is not None and len(key):
        new[1:] |= np.diff(group[order]) != 0
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
    late = np.zeros(len(key), dtype=bool)
    late[order] = (doc[order] != doc[first]) | (row[order] != row[first]) | (start[order] != start[first])
    return late


def _spans(doc: np.ndarray, row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of consecutive starts."""
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int32)
    new = np.append(True, (np.diff(doc) != 0) | (np.diff(row) != 0) | (np.diff(start) != 1))
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(start))).astype(np.int32)


def _anchor_counts(batches: Iterable[pa.RecordBatch], window: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """How many windows chose each anchor, and (null) how many there are."""
    for batch in chunks(batches, "text"):
        words = split_words(batch.column("text"))
        _, chosen, _ = _windows(words, window, anchor)
        if len(chosen):
            found, times = np.unique(mix(gram_hashes(words.hashes(), anchor))[chosen], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *found.view(np.int64).tolist()], pa.int64()), pa.array(np.append(len(chosen), times))],
                names=["anchor", "n"])


def _hot_anchors(keyed: DataFrame, targets: int, window: int, anchor: int) -> np.ndarray:
    """Anchors above an even partition's share of a sample's windows: at most ``targets``, sorted."""
    counts = keyed.select("text").sample(SAMPLE, seed=7).mapInArrow(
        lambda batches: _anchor_counts(batches, window, anchor), "anchor bigint, n bigint")
    top = counts.groupBy("anchor").agg(F.sum("n").alias("n")).orderBy(
        F.col("anchor").isNotNull(), F.col("n").desc()).limit(targets + 1).collect()
    hot = [r["anchor"] for r in top[1:] if r["n"] * targets > top[0]["n"]]
    return np.sort(np.array(hot, dtype=np.int64).view(np.uint64))


def _anchored(batches: Iterable[pa.RecordBatch], targets: int, window: int, anchor: int,
              hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in _DEALT.split(", ")]
    types = pa.schema([(n, pa.int32() if n == "target" else pa.binary()) for n in names])
    for batch in chunks(batches, "text", CHUNK_BYTES):
        keys = batch.column("_row").to_numpy(), batch.column("_id").to_numpy()
        batch = batch.take(pa.array(np.lexsort((*keys, keys[0] < 0))))
        words = split_words(batch.column("text"))
        at, chosen, whole = _windows(words, window, anchor)
        of = np.searchsorted(words.bounds, at, "right") - 1
        doc = batch.column("_id").to_numpy()[of]
        row = batch.column("_row").to_numpy()[of]
        start = (at - words.bounds[of]).astype(np.int32)
        late = _later_copies(whole, doc, row, start)
        out = []
        first, size = _spans(doc[late], row[late], start[late])
        if len(first):
            known = dict(zip(_SPAN, (doc[late][first], row[late][first], start[late][first], size), strict=True))
            out += dealt((mix(doc[late][first].astype(np.uint64)) % np.uint64(targets)).astype(np.int64), known)
        at, chosen, doc, row, start, whole = (x[~late] for x in (at, chosen, doc, row, start, whole))
        if len(at):
            grams = mix(gram_hashes(words.hashes(), anchor))[chosen]
            apart = np.isin(grams, hot)
            new = np.append(True, (np.diff(chosen) != 0) | (np.diff(at) != 1) | apart[1:])
            first = np.flatnonzero(new)
            sizes = np.diff(np.append(first, len(at)))
            grams = grams[first]
            place = np.where(apart[first], mix(grams ^ whole[first]), grams)
            upper = (grams >> np.uint64(32)).astype(np.uint32)
            runs = dict(zip(_RUN, (upper, doc[first], row[first], start[first], sizes.astype(np.uint8)), strict=True))
            out += dealt((place % np.uint64(targets)).astype(np.int64), runs, sizes, {"windows": whole})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=types)


def _extended(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = gathered(batches, _RUN | {"windows": np.uint64} | _SPAN)
    _, which, times = np.unique(got["anchor"], return_inverse=True, return_counts=True)
    seed = times[which] > 1
    size = got["size"].astype(np.int64)
    before = np.cumsum(size) - size
    kept = np.flatnonzero(seed)
    kept = kept[np.lexsort((got["start"][kept], got["row"][kept], got["doc"][kept], got["row"][kept] < 0))]
    runs, inner = np.repeat(kept, size[kept]), slices(size[kept])
    key = got["windows"][before[runs] + inner]
    doc, row, start = got["doc"][runs], got["row"][runs], (got["start"][runs] + inner).astype(np.int32)
    late = _later_copies(key, doc, row, start, which[runs])
    first, length = _spans(doc[late], row[late], start[late])
    columns = [
        np.concatenate([doc[late][first], got["known_doc"]]), np.concatenate([row[late][first], got["known_row"]]),
        np.concatenate([start[late][first], got["known_start"]]), np.concatenate([length, got["known_size"]]),
    ]
    for at in range(0, len(columns[0]), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 100_000]) for c in columns],
                                         names=["_id", "_row", "start", "length"])


def _keyed(docs: DataFrame, id_col: str, text_col: str, carried: dict[str, str]) -> DataFrame:
    """Rows told apart by ``_id`` and ``_row``, 31 bits of a text hash; without an id, by 95 bits of it and a sign."""
    texts = F.shiftrightunsigned(F.xxhash64(F.lit(1), text_col), 33).cast("int")
    return docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.xxhash64(text_col)).alias("_id"),
        F.when(F.col(id_col).cast("bigint").isNull(), -1 - texts).otherwise(texts).alias("_row"),
        F.col(text_col).alias("text"), *[F.col(c).alias(name) for c, name in carried.items()],
    )


def _late_windows(keyed: DataFrame, window: int, anchor: int) -> DataFrame:
    """Runs of windows that also start earlier: _id, _row, start, length (in windows)."""
    if not 1 <= anchor <= window:
        raise ValueError("an anchor must fit into a window")
    targets = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = _hot_anchors(keyed, targets, window, anchor)
    parts = keyed.select("_id", "_row", "text").mapInArrow(
        lambda batches: _anchored(batches, targets, window, anchor, hot), _DEALT
    )
    return parts.repartitionById(targets, "target").mapInArrow(_extended, _SPANS)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Maximal runs of words covered by windows that also start earlier.

    One row per span: ``doc_id, text_hash, start, length`` in words from 0.
    Spans of one text may touch or overlap; together they are the words to remove.
    """
    return _late_windows(_keyed(docs, id_col, text_col, {}), window, anchor).select(
        F.when(F.col("_row") >= 0, F.col("_id")).alias("doc_id"), F.col("_row").alias("text_hash"),
        F.col("start").cast("bigint").alias("start"), (F.col("length") + window - 1).cast("bigint").alias("length"),
    )


def _removed_words(words: Words, firsts: list, lengths: list, window: int) -> np.ndarray:
    """True for each word covered by a window of the given runs."""
    change = np.zeros(len(words.starts) + 1, dtype=np.int64)
    counts = np.array([len(x) if x is not None else 0 for x in firsts], dtype=np.int64)
    if counts.sum():
        base = np.repeat(words.bounds[:-1], counts)
        first = base + np.concatenate([x for x in firsts if x is not None])
        last = first + np.concatenate([x for x in lengths if x is not None]) + window - 1
        np.add.at(change, first, 1)
        np.add.at(change, last, -1)
    return np.cumsum(change[:-1]) > 0


def _kept_texts(words: Words, removed: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Kept words, one space after each, and where each text's part begins."""
    data = words.data.copy()
    data[words.ends] = 0x20
    change = np.zeros(len(data) + 2, dtype=np.int8)
    change[words.starts[~removed]] += 1
    change[words.ends[~removed] + 1] -= 1
    keep = np.cumsum(change[: len(data)], dtype=np.int8) > 0
    return data[keep].tobytes(), np.append(0, np.cumsum(keep))[words.offsets]


def _cut(batches: Iterable[pa.RecordBatch], window: int, carried: list[str], added: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text", CHUNK_BYTES):
        words = split_words(batch.column("text"))
        removed = _removed_words(words, batch.column("_starts").to_pylist(), batch.column("_lengths").to_pylist(), window)
        gone = np.diff(np.append(0, np.cumsum(removed))[words.bounds])
        columns = {"n_words": pa.array(words.counts), "n_removed": pa.array(gone)}
        if "kept_sha256" in added:
            kept, at = _kept_texts(words, removed)
            parts = [kept[a : max(a, b - 1)] for a, b in zip(at[:-1], at[1:], strict=True)]
            columns["kept_sha256"] = pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())
        if "kept_text" in added:
            texts = batch.column("text")
            columns["kept_text"] = pa.array(
                [texts[i].as_py() if not g else _without(words, removed, i) for i, g in enumerate(gone)], pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in carried] + [columns[n] for n in added], names=carried + added)


def _without(words: Words, removed: np.ndarray, i: int) -> str:
    """The text without removed words; kept words keep the white space before them."""
    a, b = words.bounds[i], words.bounds[i + 1]
    gone, out, begin = removed[a:b], [], words.offsets[i]
    for k in np.flatnonzero(~gone):
        word = a + k
        space = words.data[(words.ends[word - 1] if k else begin) : words.starts[word]]
        if not out:
            space = space[:0]
        out.append(space.tobytes() + words.data[words.starts[word] : words.ends[word]].tobytes())
    return b"".join(out).decode("utf-8")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = WINDOW,
                    anchor: int = ANCHOR, rewrite: bool = False) -> DataFrame:
    """``docs`` with words of repeated windows counted and removed.

    Adds ``n_words``, ``n_removed`` and ``kept_sha256`` (kept words joined by one
    space). With ``rewrite`` it adds ``kept_text`` instead of the digest: kept
    words with the white space before each, or the text itself where nothing was
    removed. Columns of ``docs`` that have these names are replaced.
    """
    added = {"n_words": "long", "n_removed": "long"}
    added["kept_text" if rewrite else "kept_sha256"] = "string"
    others = {c: f"_in{i}" for i, c in enumerate(docs.columns) if c != text_col and c not in added}
    keyed = _keyed(docs, id_col, text_col, others)
    runs = _late_windows(keyed, window, anchor).groupBy("_id", "_row").agg(
        F.collect_list("start").alias("_starts"), F.collect_list("length").alias("_lengths"))
    joined = keyed.join(runs, ["_id", "_row"], "left").drop("_id", "_row")
    carried = [n for n in joined.columns if n not in ("_starts", "_lengths")]
    schema = joined.select(carried).schema
    for name, kind in added.items():
        schema = schema.add(name, kind)
    cut = joined.mapInArrow(lambda batches: _cut(batches, window, carried, list(added)), schema)
    back = {"text": text_col} | {name: c for c, name in others.items()} | {n: n for n in added}
    order = [c for c in docs.columns if c not in added] + list(added)
    return cut.select(*[F.col(n).alias(back[n]) for n in carried + list(added)]).select(*order)
