"""Rows of equal text and the one of them that stays, found by radix tries.

Texts are equal if they are the same bytes once A-Z are lower-cased. A null text
is an empty one. Of equal texts the row with the largest id stays (or, on demand,
the smallest). A row without an id stays only where no row of its group has one.
Exactly one row of a group stays, also where ids repeat: of equal ids the first
one met.

1. Each task inserts its texts into a compressed trie. What leaves it, an
   *entry*, is one row per different text: its length and content hash, the text,
   and the ids that had it. Entries are written.
2. Entries meet by length and content hash and are inserted, whole, into tries
   again; a terminal node holds the owner's id and the entries that ended there.
   So texts are compared byte by byte, and hashes only bring them together.
3. Every entry learns its owner, and so do the rows in it.

Scale: no text travels more than once per task that has it. Rows arrive sorted by
length and hash, so when a trie holds ``HELD_BYTES`` all of its subtrees but the
current one are complete; they are handed on and dropped. A key that has more
entries than an even partition's share, by a 1 % sample, is merged in salted parts first. A group's
rows are never together: they stay with their entries, which are bounded.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.text import chunks
from tradeflow.operators.joins import frequent_keys
from tradeflow.workspace import new_folder, settled

HELD_BYTES = 32 << 20
_OUT_BYTES = 4 << 20
_NODE_BYTES = 300  # a node's own objects, roughly

_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))

_ENTRY = pa.schema([
    ("entry", pa.int64()), ("length", pa.int64()), ("hash", pa.int64()), ("text", pa.large_binary()), ("owner", pa.int64()),
    ("owner_entry", pa.int64()), ("owner_at", pa.int32()), ("n", pa.int64()), ("members", pa.list_(pa.int64()))])
_ENTRY_SQL = "entry bigint, length bigint, hash bigint, text binary, owner bigint, owner_entry bigint, owner_at int, " \
             "n bigint, members array<bigint>"
_OWNER = pa.schema([
    ("entry", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("text_sha256", pa.string()),
    ("owner_entry", pa.int64()), ("owner_at", pa.int32())])
_OWNER_SQL = "entry bigint, keep_id bigint, group_size bigint, text_sha256 string, owner_entry bigint, owner_at int"


class RadixTrie:
    """Byte strings in a compressed trie. A node is ``[edge, children by first byte, value]``."""

    def __init__(self):
        self.root: list = [b"", {}, None]
        self.held = 0

    def terminal(self, key: bytes) -> list:
        """The node at which ``key`` ends; made if there was none, then without a value."""
        node, at = self.root, 0
        while at < len(key):
            child = node[1].get(key[at])
            if child is None:
                child = [key[at:], {}, None]
                node[1][key[at]] = child
                self.held += len(child[0]) + _NODE_BYTES
            elif not key.startswith(child[0], at):
                child = node[1][key[at]] = self._split(child, key, at)
            node, at = child, at + len(child[0])
        return node

    def _split(self, child: list, key: bytes, at: int) -> list:
        """A new node above ``child`` that holds what its edge and the key share."""
        edge = child[0]
        low, high = 1, min(len(edge) - 1, len(key) - at)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if key.startswith(edge[:middle], at) else (low, middle - 1)
        child[0] = edge[low:]
        self.held += _NODE_BYTES
        return [edge[:low], {edge[low]: child}, None]

    def items(self) -> Iterator[tuple[bytes, object]]:
        """Keys that have a value, with it."""
        open_nodes = [(b"", self.root)]
        while open_nodes:
            before, (edge, children, value) = open_nodes.pop()
            key = before + edge
            if value is not None:
                yield key, value
            open_nodes += [(key, child) for child in children.values()]


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += size(row)
        if weight > _OUT_BYTES:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _entry_size(row: tuple) -> int:
    return len(row[3]) + 8 * len(row[8]) + 100


def _numbers() -> Iterator[int]:
    """Entry numbers no other task of the stage gives."""
    first = TaskContext.get().partitionId() << 32
    return iter(range(first, first + (1 << 32)))


def _before(a: int | None, b: int | None, largest: bool) -> bool:
    """Whether id ``a`` owns a group rather than ``b``."""
    if a is None or b is None:
        return a is not None and b is None
    return a > b if largest else a < b


def _met_in_task(batches: Iterable[pa.RecordBatch], largest: bool, limit: int) -> Iterator[pa.RecordBatch]:
    number = _numbers()

    def entries(trie: RadixTrie) -> Iterator[tuple]:
        for text, ids in trie.items():
            at = 0
            for i, doc in enumerate(ids):
                if _before(doc, ids[at], largest):
                    at = i
            entry = next(number)
            yield entry, len(text), xxhash.xxh64_intdigest(text) - (1 << 63), text, ids[at], entry, at, len(ids), ids

    trie = RadixTrie()
    for batch in chunks(batches, "text"):
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        for doc, text in zip(batch.column("id").to_pylist(), texts, strict=True):
            node = trie.terminal((text or b"").translate(_LOWER))
            if node[2] is None:
                node[2] = []
            node[2].append(doc)
            trie.held += 40
            if trie.held > limit:
                yield from _batches(entries(trie), _ENTRY, _entry_size)
                trie = RadixTrie()
    yield from _batches(entries(trie), _ENTRY, _entry_size)


def _merged(batches: Iterable[pa.RecordBatch], largest: bool, limit: int) -> Iterator[tuple[bytes, int, int, list]]:
    """(text, length, hash, [owner, its entry, its place, rows, entries]) of entries sorted by length and hash."""
    trie, last = RadixTrie(), None
    names = ("entry", "length", "hash", "text", "owner", "owner_entry", "owner_at", "n")
    for batch in chunks(batches, "text"):
        for entry, length, key, text, owner, owner_entry, at, n in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
            if trie.held > limit and last != (length, key):  # all of it is complete
                yield from _terminals(trie)
                trie = RadixTrie()
            last = length, key
            node = trie.terminal(struct.pack(">qq", length, key) + text)
            if node[2] is None:
                node[2] = [owner, owner_entry, at, 0, []]
            held = node[2]
            if _before(owner, held[0], largest) or owner == held[0] and (owner_entry, at) < (held[1], held[2]):
                held[:3] = owner, owner_entry, at
            held[3] += n
            held[4].append(entry)
            trie.held += 40
    yield from _terminals(trie)


def _terminals(trie: RadixTrie) -> Iterator[tuple[bytes, int, int, list]]:
    for key, held in trie.items():
        yield key[16:], *struct.unpack(">qq", key[:16]), held


def _merged_entries(batches: Iterable[pa.RecordBatch], largest: bool, limit: int) -> Iterator[pa.RecordBatch]:
    number = _numbers()
    rows = ((-1 - next(number), length, key, text, *held) for text, length, key, held in _merged(batches, largest, limit))
    return _batches(rows, _ENTRY, _entry_size)


def _owners(batches: Iterable[pa.RecordBatch], largest: bool, limit: int) -> Iterator[pa.RecordBatch]:
    def rows():
        for text, _, _, (owner, owner_entry, at, n, entries) in _merged(batches, largest, limit):
            digest = hashlib.sha256(text).hexdigest()
            for entry in entries:
                yield entry, owner, n, digest, owner_entry, at

    return _batches(rows(), _OWNER, lambda _: 150)


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, keep: str = "largest",
                 held_bytes: int = HELD_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    The digest is that of the lower-cased text. ``keep`` is ``largest`` or
    ``smallest``. An empty table gives no rows; other columns are not looked at.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is largest or smallest, not {keep}")
    spark, largest = docs.sparkSession, keep == "largest"
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    entries = settled(rows.mapInArrow(lambda b: _met_in_task(b, largest, held_bytes), _ENTRY_SQL), new_folder(spark, "text-entries"))

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = spark.createDataFrame(frequent_keys(entries, "hash", partitions), "hash bigint, salts int")
    salted = entries.join(F.broadcast(hot), "hash").withColumn("salt", F.pmod(F.xxhash64("entry"), "salts"))
    merged = settled(
        _in_order(salted.repartition("length", "hash", "salt")).mapInArrow(lambda b: _merged_entries(b, largest, held_bytes), _ENTRY_SQL),
        new_folder(spark, "merged-entries"))
    others = entries.join(F.broadcast(hot), "hash", "left_anti").select(*_ENTRY.names)
    owners = settled(
        _in_order(others.unionByName(merged).repartition("length", "hash")).mapInArrow(lambda b: _owners(b, largest, held_bytes), _OWNER_SQL),
        new_folder(spark, "text-owners"))
    inside = merged.select("entry", "members").join(owners, "entry").withColumn("entry", F.explode("members")).drop("members")
    known = owners.where("entry >= 0").unionByName(inside)
    found = entries.select("entry", "members").join(known, "entry")
    found = found.select("*", F.posexplode("members").alias("at", "doc_id"))
    kept = (F.col("entry") == F.col("owner_entry")) & (F.col("at") == F.col("owner_at"))
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def _in_order(entries: DataFrame) -> DataFrame:
    return entries.select(*_ENTRY.names).sortWithinPartitions("length", "hash")
