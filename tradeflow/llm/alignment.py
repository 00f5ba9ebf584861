"""Which tokens of two tokenizers cover the same bytes, text by text.

Tokenizer A is a byte-level BPE given a space and the text; tokenizer B is a
sentencepiece BPE given the text, to which it adds the space itself. Special
tokens are not added, and their strings inside a text are plain text. Where a
token of A and one of B end at the same byte, a group ends. Every two tokens
whose bytes overlap are a link; a pair of ids counts as often as links hold it in
all rows.

1. Rows meet by their full text, so each different text is tokenized and aligned
   once, and counts as often as it has rows.
2. Pair counts are summed up, the highest of each B id is found, and both come back
   to the texts.
3. The measures of a text go to its rows by the SHA-256 of the text.

A text is read as *units*: runs that begin at a space after a character that is no
white space. No token of either tokenizer reaches from one unit into the next, so
a unit is aligned once per worker process and its result reused. Vocabularies for
which that doesn't hold (see ``Aligner``) make the whole text one unit.

Null and empty texts have no tokens, nor have texts whose tokens of A or B don't
give back the space and the text; their measures are 0 and the digest is ''.
Repeated rows count once each. Null ids are rows like others.

Scale: the text is shuffled once, combined in the tasks first, so a text of a third
of all rows arrives as one row per task. Texts are aligned in chunks of
``CHUNK_BYTES``; a chunk has one row per different pair in it, and only these meet
by pair. Pairs are many for few chunks, so a frequent pair is salted.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.text import chunks, slices
from tradeflow.operators.joins import lookup_join
from tradeflow.workspace import new_folder, settled

CHUNK_BYTES = 4 << 20
HELD_UNITS = 400_000
HELD_BYTES = 40 << 20
ENCODED = 8192  # units aligned at once
TOGETHER = 256  # units in one text given to a tokenizer
_WHITE = [chr(c) for c in range(0x3001) if chr(c).isspace()]
SPACE = "▁"  # how sentencepiece writes a space

_MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_CHUNK = pa.schema([
    ("chunk", pa.int64()), ("digests", pa.list_(pa.string())), *[(m, pa.list_(pa.int64())) for m in _MEASURES],
    ("groups", pa.list_(pa.string())), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
    ("unit_pairs", pa.binary()), ("pair_links", pa.binary()), ("units", pa.binary()), ("text_units", pa.binary())])
_CHUNK_SQL = "chunk bigint, digests array<string>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, " \
             "n_links array<bigint>, groups array<string>, pairs array<bigint>, times array<bigint>, unit_pairs binary, " \
             "pair_links binary, units binary, text_units binary"
_TEXT = pa.schema([("digest", pa.string()), *[(m, pa.int64()) for m in _MEASURES], ("n_best", pa.int64()),
                   ("count_sum", pa.int64()), ("groups_sha256", pa.string())])
_TEXT_SQL = "digest string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def byte_of_letter() -> dict[str, int]:
    """Byte-level BPE writes visible Latin-1 characters as themselves, and other bytes as letters from 256 on."""
    shown = {b for b in range(0x21, 0x100) if b <= 0x7E or b >= 0xA1 and b != 0xAD}
    hidden = [b for b in range(0x100) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Aligned units of one worker process, remembered by their text."""

    def __init__(self, a_model: str, b_model: bytes):
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(a_model)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = byte_of_letter()
        a_bytes = [b""] * self.a.get_vocab_size()
        for token, number in self.a.get_vocab().items():
            a_bytes[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else b""
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.sides = (_Side(a_bytes, "|"), _Side(b_bytes, ";"))
        self.splits = self._splits(json.loads(a_model), pieces)
        self.clear()

    def _splits(self, a: dict, pieces: list[str]) -> bool:
        """Whether no token reaches over a space into the next word, and neither tokenizer changes its text."""
        before = a.get("pre_tokenizer") or {}
        words_apart = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        probe = self.b.encode("a  b \n c")
        told = b"".join(self.sides[1].bytes[probe])
        return bool(words_apart and a.get("normalizer") is None and not any(SPACE in p.lstrip(SPACE) for p in pieces)
                    and told == b" a  b \n c")

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.valid = np.empty(0, bool)
        self.counts = np.empty((len(_MEASURES), 0), np.int64)
        self.begin = np.empty(0, np.int64)
        self.pairs = np.empty(0, np.int64)  # a << 32 | b of each link, unit by unit
        self.held = 0

    def units(self, text: str) -> list[str]:
        """The units of a space and the text, each without its first space."""
        if not self.splits:
            return [text]
        words = text.split(" ")
        if "" not in words and not any(c + " " in text for c in _WHITE):
            return words
        out, now = [], words[0]
        for before, word in zip(words, words[1:], strict=False):
            if before and not before[-1].isspace():
                out.append(now)
                now = word
            else:
                now += " " + word
        if not now and out:  # sentencepiece adds no space to an empty text
            now = out.pop() + " "
        return [*out, now]

    def learn(self, units: Iterable[str]) -> None:
        """Align the units not known yet."""
        new = sorted((u for u in units if u not in self.known), key=_stands_alone)
        found = [self._aligned(new[at : at + ENCODED]) for at in range(0, len(new), ENCODED)]
        if not found:
            return
        valid, counts, pairs, groups = zip(*found, strict=True)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        links = np.concatenate([c[-1] for c in counts])
        self.begin = np.append(self.begin, len(self.pairs) + np.cumsum(links) - links)
        self.valid = np.concatenate([self.valid, *valid])
        self.counts = np.concatenate([self.counts, *counts], axis=1)
        self.pairs = np.concatenate([self.pairs, *pairs])
        for some in groups:
            self.groups += some
        self.held += sum(map(len, new)) + sum(len(g) for some in groups for g in some)

    def _aligned(self, units: list[str], together: int = TOGETHER) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Whether the tokens give each unit back, its measures, the id pairs of all links, and its groups as text.

        Units are tokenized in runs, as in a text. If one isn't given back, they are again, one by one.
        """
        if not self.splits:
            together = 1
        alone = next((i for i, u in enumerate(units) if _stands_alone(u)), len(units))
        runs = [units[i : min(i + together, alone)] for i in range(0, alone, together)] + [[u] for u in units[alone:]]
        texts = ["".join([" " + u for u in run]) for run in runs]
        told = [text.encode() for text in texts]
        coded = ([x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)],
                 self.b.encode([text[1:] for text in texts], num_threads=1))
        valid = np.ones(len(runs), bool)
        for side, ids in zip(self.sides, coded, strict=True):
            valid &= side.gives_back(ids, told)
        if len(runs) == len(units):
            sizes = np.where(valid, np.fromiter(map(len, told), np.int64, len(told)), 0)
        elif not valid.all():
            return self._aligned(units, together=1)
        else:
            valid, sizes = np.ones(len(units), bool), 1 + np.fromiter((len(u.encode()) for u in units), np.int64, len(units))
        kept = valid.tolist() if len(runs) == len(units) else [True] * len(runs)
        spans = [_Spans.of(side, ids, kept) for side, ids in zip(self.sides, coded, strict=True)]
        unit_ends = np.cumsum(sizes)
        both = np.sort(np.concatenate([span.ends for span in spans]), kind="stable")
        twice = np.append(both[1:] == both[:-1], False) if len(both) else np.empty(0, bool)
        shared, cuts = both[twice], both[~twice]
        # Between two neighbouring ends of either side lies one token of each: a link.
        a, b = (span.ids[np.searchsorted(span.ends, cuts)] for span in spans)
        of = lambda ends: np.bincount(np.searchsorted(unit_ends, ends), minlength=len(units))
        counts = np.stack([*[of(span.ends) for span in spans], of(shared), of(cuts)])
        return valid, counts, a << 32 | b, self._group_texts(spans, shared, unit_ends)

    def _group_texts(self, spans: list[_Spans], shared: np.ndarray, unit_ends: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2`` of each unit."""
        parts, groups, sides = [], [], []
        for number, (side, span) in enumerate(zip(self.sides, spans, strict=True)):
            groups.append(np.searchsorted(shared, span.ends))
            last = shared[groups[-1]] == span.ends if len(shared) else np.empty(0, bool)
            parts.append(np.where(last, side.ending[span.ids], side.going_on[span.ids]))
            sides.append(np.full(len(span.ids), number))
        group = np.concatenate(groups)
        order = np.lexsort((np.concatenate(sides), group))  # stable, so tokens of a side stay in order
        texts = np.concatenate(parts)[order].tolist()
        ends = np.append(0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts))))
        done = np.searchsorted(group[order], np.searchsorted(shared, unit_ends, "right"))  # tokens up to each unit's end
        whole, places = "".join(texts), ends[done].tolist()
        return [whole[x : max(x, y - 1)] for x, y in zip([0, *places[:-1]], places, strict=True)]

    def full(self) -> bool:
        return len(self.known) > HELD_UNITS or self.held + self.pairs.nbytes > HELD_BYTES


def _stands_alone(unit: str) -> bool:
    """Whether a unit must not be followed by another: they would not be units of their own."""
    return not unit or unit[-1].isspace()


class _Side:
    """One tokenizer's tokens, as bytes and as numbers with what follows them in a group."""

    def __init__(self, data: list[bytes], end: str):
        self.bytes = np.array(data, object)
        self.sizes = np.array(list(map(len, data)), np.int64)
        self.going_on = np.array([f"{i}," for i in range(len(data))], object)
        self.ending = np.array([f"{i}{end}" for i in range(len(data))], object)

    def gives_back(self, coded: list[list[int]], told: list[bytes]) -> np.ndarray:
        """For each unit whether its tokens' bytes are those of the text."""
        counts = np.fromiter(map(len, coded), np.int64, len(coded))
        ids = np.fromiter(chain.from_iterable(coded), np.int64, int(counts.sum()))
        ends = np.append(0, np.cumsum(self.sizes[ids]))[np.append(0, np.cumsum(counts))]
        if np.diff(ends).tolist() == list(map(len, told)) and b"".join(self.bytes[ids].tolist()) == b"".join(told):
            return np.ones(len(told), bool)
        texts = [b"".join(self.bytes[own].tolist()) for own in coded]
        return np.fromiter(map(bytes.__eq__, texts, told), bool, len(told))


@dataclass
class _Spans:
    """Tokens of the valid units one after the other, and where each ends."""

    ids: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, side: _Side, coded: list[list[int]], kept: list[bool]) -> _Spans:
        ids = np.fromiter(chain.from_iterable(compress(coded, kept)), np.int64)
        return cls(ids, np.cumsum(side.sizes[ids]))


def _aligner(a_model: str, b_model: bytes) -> Aligner:
    """One per worker process, shared by the tasks that follow each other in it."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    import tokenizers

    held = vars(tokenizers).setdefault("_aligners_by_model", {})
    key = hashlib.sha256(a_model.encode() + b_model).digest()
    if key not in held:
        held.clear()
        held[key] = Aligner(a_model, b_model)
    return held[key]


def _aligned_chunks(batches: Iterable[pa.RecordBatch], a_model: str, b_model: bytes) -> Iterator[pa.RecordBatch]:
    aligner, number = _aligner(a_model, b_model), TaskContext.get().partitionId() << 32
    for batch in chunks(batches, "text", CHUNK_BYTES):
        if aligner.full():
            aligner.clear()
        texts = batch.column("text").to_pylist()
        units = [aligner.units(text) for text in texts]
        aligner.learn(set(chain.from_iterable(units)))
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        held = np.fromiter(map(aligner.known.__getitem__, chain.from_iterable(units)), np.int64, int(sizes.sum()))
        begin = np.cumsum(sizes) - sizes
        valid = np.logical_and.reduceat(aligner.valid[held], begin) if len(held) else sizes > 0
        texts = [t for t, v in zip(texts, valid, strict=True) if v]
        if not texts:
            continue
        held, sizes, times = held[np.repeat(valid, sizes)], sizes[valid], batch.column("times").to_numpy()[valid]
        yield pa.RecordBatch.from_pylist([_chunk_row(aligner, number, texts, times, held, sizes)], schema=_CHUNK)
        number += 1


def _chunk_row(aligner: Aligner, number: int, texts: list[str], times: np.ndarray, held: np.ndarray, sizes: np.ndarray) -> dict:
    """Measures of the texts, and which pairs their units hold, numbered inside the chunk."""
    own, unit = np.unique(held, return_inverse=True)
    ends = np.append(0, np.cumsum(sizes))
    row = {"chunk": number, "digests": [hashlib.sha256(t.encode()).hexdigest() for t in texts]}
    for name, counts in zip(_MEASURES, aligner.counts, strict=True):
        row[name] = np.add.reduceat(counts[held], ends[:-1])
    groups, places = aligner.groups, held.tolist()
    row["groups"] = [hashlib.sha256(";".join([groups[i] for i in places[a:b]]).encode()).hexdigest()
                     for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    link_counts = aligner.counts[-1][own]
    links = aligner.pairs[np.repeat(aligner.begin[own], link_counts) + slices(link_counts)]
    pairs, which = np.unique(links, return_inverse=True)
    of_unit = np.zeros(len(own), np.int64)
    np.add.at(of_unit, unit, np.repeat(times, sizes))
    total = np.zeros(len(pairs), np.int64)
    np.add.at(total, which, np.repeat(of_unit, link_counts))
    return row | {"pairs": pairs, "times": total, "unit_pairs": which.astype(np.uint32).tobytes(),
                  "pair_links": link_counts.astype(np.uint32).tobytes(), "units": unit.astype(np.uint32).tobytes(),
                  "text_units": sizes.astype(np.uint32).tobytes()}


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: the counts of its links' pairs, added up, and how many are the highest of their B id."""
    for batch in batches:
        for i in range(batch.num_rows):
            whole = {n: batch.column(n)[i] for n in batch.schema.names}
            place = {n: np.frombuffer(whole[n].as_buffer(), np.uint32).astype(np.int64)
                     for n in ("unit_pairs", "pair_links", "units", "text_units")}
            found = whole["found"].values
            order = np.argsort(found.field("place").to_numpy())
            parts = [batch.column(n)[i].values for n in ("digests", *_MEASURES)]
            sums = []
            for name in ("best", "count"):
                value = found.field(name).to_numpy()[order][place["unit_pairs"]]
                ends = np.cumsum(place["pair_links"])
                before = np.append(0, np.cumsum(value))
                of_unit = (before[ends] - before[ends - place["pair_links"]])[place["units"]]
                ends, before = np.cumsum(place["text_units"]), np.append(0, np.cumsum(of_unit))
                sums.append(pa.array(before[ends] - before[ends - place["text_units"]]))
            yield pa.RecordBatch.from_arrays([*parts, *sums, whole["groups"].values], schema=_TEXT)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, count, best``: a << 32 | b, links that hold it, and 1 where no A id has more links with that B id."""
    counted = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(
        F.sum("p.times").alias("count"))
    counted = settled(counted, new_folder(aligned.sparkSession, "pair-counts"))
    of_b = counted.withColumn("b", F.expr("pair & 4294967295"))
    most = of_b.groupBy("b").agg(F.max("count").alias("most"))  # a row per B id: the size of a vocabulary at most
    return of_b.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).cast("bigint").alias("best"))


def aligned_texts(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """Measures of each different text that has tokens, by the ``digest`` of the text."""
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as a_file, open(b_path, "rb") as b_file:
        models = spark.sparkContext.broadcast((a_file.read(), b_file.read()))
    texts = docs.where(F.octet_length(text_col) > 0).groupBy(F.col(text_col).alias("text")).agg(F.count(F.lit(1)).alias("times"))
    chunked = settled(texts.mapInArrow(lambda batches: _aligned_chunks(batches, *models.value), _CHUNK_SQL), new_folder(spark, "aligned"))
    counts = settled(pair_counts(chunked), new_folder(spark, "pairs"))
    asked = chunked.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    told = lookup_join(asked, counts, "pair", "inner", spread_by="chunk")
    found = told.groupBy("chunk").agg(F.collect_list(F.struct("place", "count", "best")).alias("found"))
    return chunked.drop("pairs", "times").join(found, "chunk").mapInArrow(_summed, _TEXT_SQL)


def aligned_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs``.

    ``docs`` is read twice and must be the same both times, as a written table is.
    """
    texts = settled(aligned_texts(docs, a_path, b_path, text_col), new_folder(docs.sparkSession, "aligned-texts"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.sha2(F.col(text_col), 256).alias("digest"))
    found = lookup_join(rows, texts, "digest", spread_by="doc_id")
    numbers = [F.coalesce(F.col(n), F.lit(0).cast("bigint")).alias(n) for n in (*_MEASURES, "n_best", "count_sum")]
    return found.select("doc_id", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
