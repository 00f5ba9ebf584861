"""Licence scans by digests of canonical texts.

A text is made canonical by lower-casing A-Z, dropping copyright lines and
lines that reserve all rights, spelling some words one way and turning everything that is neither letter nor
digit into single spaces. Its SHA-256 is joined with those of known licences.
Whole documents are looked up as texts, and each line as a notice.

Everything is expressions. A digest is taken only where a known text has that
canonical length, which loses nothing. Only ids and digests are shuffled. The
known texts are a small list or a table; how they are joined is left to Spark.
The built-in list has short licences and notices only, no full text of a long
licence: callers add those they hold to ``known_table``.

Null and empty texts match nothing. Rows that repeat are told apart by id and
text; identical rows get the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.llm.licence_texts import known_texts

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_LINE = r"^[ \t\r*#/;-]*(portions )?(copyright|\(c\)|©).*([0-9]{4}|\(c\)|©|year|yyyy)"
# More lines that published texts have and the SQL's pattern lets stand: copyright lines without a year, and reserved rights.
# A line of prose may begin with "copyright", so what follows must be a name.
RIGHTS_LINE = (
    r"^[ \t\r*#/;-]*(((portions )?copyright:?[ \t]+(by[ \t]+)?(?!(notices?|holders?|owners?|laws?|licen[cs]\w*|and|or|in|to|of|is|are|as|on|"
    r"for|with|by|interests?|statements?|protection|permission|acts?|treat\w*|infringement|disclaimer|status|terms|information|"
    r"the copyright)\b)|©)[^.;:]{1,80}([.][ \t\r]*)?([ \t]*all rights reserved[. \t\r*#/;-]*)?|all rights reserved[. \t\r*#/;-]*)$")
NOT_WORD = r"[^a-z0-9\x{80}-\x{10FFFF}]+"
# Spellings that count as the same.
SPELLINGS = (
    (r"\blicenc(e|es|ed|ing|ee|ees|or|ors)\b", "licens"), (r"\bsub licens(e|es|ed|ing)\b", "sublicens"),
    (r"\backnowledgement(s|)\b", "acknowledgment"), (r"\bnon (commercial|infringement|derivatives)\b", "non"),
    (r"\borganisation(s|)\b", "organization"), (r"\bfavour(s|)\b", "favor"), (r"\bhttps(|)\b", "http"),
)


def canonical(text: Column) -> Column:
    lower = F.translate(text, _UPPER, _LOWER)
    lines = F.filter(F.split(lower, "\n"), lambda line: ~line.rlike(COPYRIGHT_LINE) & ~line.rlike(RIGHTS_LINE))
    words = F.regexp_replace(F.array_join(lines, " "), NOT_WORD, " ")
    for spelling, same in SPELLINGS:
        words = F.regexp_replace(words, spelling, same + "$1")
    return F.trim(words)


def known_table(spark: SparkSession, texts: DataFrame | list[tuple[str, str, str]] | None = None) -> DataFrame:
    """``licence, kind, wording``: the given known texts, or else the built-in ones, to which callers may add by a union."""
    if isinstance(texts, DataFrame):
        return texts.select("licence", "kind", "wording")
    return spark.createDataFrame(texts or known_texts(), "licence string, kind string, wording string")


def known_digests(spark: SparkSession, texts: DataFrame | list[tuple[str, str, str]] | None = None) -> DataFrame:
    """``kind, digest, licence``; wordings that are canonically equal are one, of the least id."""
    rows = known_table(spark, texts)
    return rows.groupBy("kind", F.sha2(canonical(F.col("wording")), 256).alias("digest")).agg(F.min("licence").alias("licence"))


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            texts: DataFrame | list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Per row: ``doc_id``, the ``licence`` its whole text is, and its ``notices`` (ids, sorted, comma-joined)."""
    spark = docs.sparkSession
    wordings = known_table(spark, texts)
    sizes = {k: [r["n"] for r in wordings.where(F.col("kind") == k).select(
        F.length(canonical(F.col("wording"))).alias("n")).distinct().collect()] for k in ("text", "notice")}
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    whole = F.array(F.struct(F.lit("text").alias("kind"), canonical(F.col("text")).alias("unit")))
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(F.lit("notice").alias("kind"), canonical(x).alias("unit")))
    fits = lambda u: ((u["kind"] == "text") & F.length(u["unit"]).isin(sizes["text"])) | (
        (u["kind"] == "notice") & F.length(u["unit"]).isin(sizes["notice"]))
    units = keyed.select("doc_id", "text_hash", F.inline(F.filter(F.concat(whole, lines), fits)))
    found = units.select("doc_id", "text_hash", "kind", F.sha2("unit", 256).alias("digest")).join(
        known_digests(spark, texts), ["kind", "digest"])
    per_row = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.min(F.when(F.col("kind") == "text", F.col("licence"))).alias("licence"),
        F.array_sort(F.collect_set(F.when(F.col("kind") == "notice", F.col("licence")))).alias("_notices"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return keyed.drop("text").join(per_row, same, "left").select(
        "doc_id", "licence", F.coalesce(F.array_join("_notices", ","), F.lit("")).alias("notices"))
