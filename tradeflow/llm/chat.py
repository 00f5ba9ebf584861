"""Chat logs folded into messages, and messages rendered for training.

A log is events of conversations in order of ``seq``: ``message`` starts a
message over, ``delta`` adds text to it, ``edit`` replaces its text, and
``regenerate`` empties it and drops what later messages were told up to then. A
later message told anew after that stays, with what it was told since.

Rendering marks each turn and escapes control strings in roles and texts by a
backslash after their first character; one that is there already gets one more,
so the text can be restored exactly.

Scale: events meet per message, never per conversation. What needs a whole
conversation in order (which messages were dropped, digests) reads sorted rows
one after the other, so a conversation of any length takes little memory.

An event told twice counts once. Null texts and roles are empty. A null
conversation id is a conversation. Unknown kinds are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END = "<|turn|>", "<|end|>\n"
# What models and common templates take as control strings; a backslash may follow the first character.
CONTROL = r"(/?s>|/?INST\]|</?SYS>>|\|[a-zA-Z0-9_]+\|>)"
_ESCAPE = rf"([<\[])(\\*){CONTROL}"
_UNESCAPE = re.compile(rf"([<\[])\\(\\*){CONTROL}")
_TURN = re.compile(r"<\|turn\|>([^\n]*)\n(.*)<\|end\|>\n", re.DOTALL)


def folded(events: DataFrame, message: list[str], conv_col: str = "conv_id", seq_col: str = "seq") -> DataFrame:
    """Final messages: ``conv_id``, the ``message`` columns, ``role`` and ``text``.

    ``message`` columns tell messages of a conversation apart and put them in
    order. The role is the last one told.
    """
    known = events.where("kind in ('message', 'delta', 'edit', 'regenerate')").groupBy(conv_col, *message).agg(
        F.array_distinct(F.sort_array(F.collect_list(F.struct(
            F.col(seq_col).alias("seq"), "kind", "role", F.coalesce("text", F.lit("")).alias("text"))))).alias("_log"))
    last = lambda kinds: F.array_max(F.transform(F.filter(
        "_log", lambda e: e["kind"].isin(*kinds)), lambda e: e["seq"]))
    before = Window.partitionBy(conv_col).orderBy(*message).rowsBetween(Window.unboundedPreceding, -1)
    known = known.withColumn("_cut", F.max(last(["regenerate"])).over(before)).withColumn(
        "_log", F.filter("_log", lambda e: F.col("_cut").isNull() | (e["seq"] > F.col("_cut")))).where(F.size("_log") > 0)
    known = known.withColumn("_from", last(["message", "edit", "regenerate"]))
    live = F.filter("_log", lambda e: F.col("_from").isNull() | (e["seq"] >= F.col("_from")))
    # Of events of one seq the one that starts the text over comes first.
    text = F.aggregate(live, F.lit(""), lambda s, e: F.when(
        e["kind"] == "delta", F.concat(s, e["text"])).when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"]))
    roles = F.filter(F.transform("_log", lambda e: e["role"]), lambda r: r.isNotNull())
    return known.select(conv_col, *message, F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"), text.alias("text"))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def _escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def restored(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def _restored_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], restored(role))


def rendered(messages: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``messages`` with ``formatted``, one turn each, and the code points of it that are trained on.

    A conversation's text is its turns' ``formatted`` in order.
    """
    head = F.concat(F.lit(BEGIN), _escaped_role(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    counts = F.when(F.col("role").isin(*trained), F.length(body)).otherwise(F.lit(0))
    return messages.select("*", F.concat(head, body, F.lit(END)).alias("formatted"),
                           F.length(head).alias("loss_start"), counts.alias("loss_length"))


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of one rendered turn."""
    found = _TURN.fullmatch(formatted)
    if not found:
        raise ValueError("not a rendered turn")
    return _restored_role(found[1]), restored(found[2])


_DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _DIGESTS.split(", ")]
    kinds = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in names])
    now, out = None, []

    def row(state):
        conv, turns, digest, loss, loss_digest, chars = state
        return dict(zip(names, (conv, turns, digest.hexdigest(), loss, loss_digest.hexdigest(), chars), strict=True))

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_start", "loss_length")]
        for conv, formatted, start, length in zip(*columns, strict=True):
            if now is None or now[0] != conv:
                if now is not None:
                    out.append(row(now))
                now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = read_turn(formatted)
            learned = restored(formatted[start : start + length])
            now[1] += 1
            now[2].update(f"{role}\n{text}\n".encode())
            now[3] += len(learned)
            now[4].update(learned.encode())
            now[5] += len(formatted)
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema=kinds)
            out = []
    if now is not None:
        out.append(row(now))
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=kinds)


def digests(turns: DataFrame, message: list[str], conv_col: str = "conv_id") -> DataFrame:
    """Per conversation: what its rendered turns hold, read back from them."""
    rows = turns.select(F.col(conv_col).cast("bigint").alias("conv_id"), *message, "formatted", "loss_start", "loss_length")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", *message)
    return ordered.select("conv_id", "formatted", "loss_start", "loss_length").mapInArrow(_digested, _DIGESTS)


def log_of_turns(conversations: DataFrame, deltas: int = 2) -> DataFrame:
    """A table of finished turns as the log that led to them: a message, then ``deltas`` of what is left of its text.

    Rows of one turn are messages told apart by text, then by ``copy``. A null turn comes first.
    """
    rows = conversations.select("conv_id", "turn", "role", "text").groupBy("conv_id", "turn", "role", "text").agg(
        F.count(F.lit(1)).alias("_times"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times")))).drop("_times")
    size = F.ceil(F.length(F.coalesce("text", F.lit(""))) / (deltas + 1)).cast("int")
    rows = rows.withColumn("version", F.xxhash64("role", "text")).withColumn("_size", size)
    step = F.explode(F.sequence(F.lit(0), F.lit(deltas))).alias("_step")
    rows = rows.select("*", step)
    part = F.substring(F.col("text"), F.col("_step") * F.col("_size") + 1, F.col("_size"))
    before = F.coalesce(F.col("turn").cast("decimal(19,0)"), F.lit(-(1 << 63)).cast("decimal(19,0)")) * (deltas + 1)
    return rows.select(
        "conv_id", (before + F.col("_step")).alias("seq"), F.when(F.col("_step") == 0, "message").otherwise("delta").alias("kind"),
        "turn", "version", "copy", F.when(F.col("_step") == 0, F.col("role")).alias("role"), part.alias("text"))
