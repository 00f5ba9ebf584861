"""One registered query per operator, each over whole tables, and its check SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.llm import alignment, chat, exact_copies, html_text, licence_texts, licences, near_duplicates, oracles, packing, phrases, quality, substrings, url_rules, vector_codes, warc
from tradeflow.workspace import new_folder

TOKENIZER = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(oracles.ORACLES)


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_substring_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.without_repeats(docs).drop("text")


@query
def op5_benchmark_decontamination(spark, sf_dir):
    index = new_folder(spark, "phrase-index")
    phrases.write_index(_table(spark, sf_dir, "documents"), index)
    return phrases.contamination(phrases.search(spark, index, _table(spark, sf_dir, "benchmark")))


@query
def op4_ngram_jaccard_join(spark, sf_dir):
    found = near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_copies")


@query
def op2_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op7_quality_rules(spark, sf_dir):
    found = quality.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op6_chat_formatting(spark, sf_dir):
    message = ["turn", "version", "copy"]
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id bigint, turn bigint, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.rendered(chat.folded(chat.log_of_turns(rows), message)), message)


@query
def op8_html_extraction(spark, sf_dir):
    return html_text.extracted(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


# The rules of the contract, which outrank the method's own.
URL_RULES = [url_rules.prefix_rule(spec, verdict, 1000 + len(spec)) for spec, verdict in [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
]]


@query
def op9_url_filters(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    found = url_rules.judged(pages, URL_RULES + list(url_rules.COMMON_BLOCKS))
    return found.select("page_id", "host", "path", F.when(F.col("rank") >= 1000, F.col("rule")).alias("rule"), "verdict")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLES["op9_url_filters"] = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), ruled AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parsed
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host || path, '^([^/]*[.-])?(ads|adult|bets|casino|pills|spam)([.-]|/|$)') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""


@query
def op10_warc(spark, sf_dir):
    folder = new_folder(spark, "warc")
    warc.write_archive(warc.captures_to_write(_table(spark, sf_dir, "pages")), folder)
    captures = warc.assembled(warc.read_records(spark, folder), payloads=False)
    page = warc.metadata_field(F.col("metadata.fields"), "page-id").cast("bigint")
    return captures.select(
        page.alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.type").alias("record_type"),
        F.col("response.refers_to").cast("bigint").alias("refers_to"))


@query
def op1_license_scan(spark, sf_dir):
    return licences.scanned(_table(spark, sf_dir, "documents"))


def _canonical_sql(text: str) -> str:
    lines = f"list_filter(string_split(translate({text}, '{_UPPER}', '{_LOWER}'), chr(10)), " \
            f"lambda x: NOT regexp_matches(x, '{licences.COPYRIGHT_LINE}'))"
    words = f"regexp_replace(array_to_string({lines}, ' '), '{licences.NOT_WORD}', ' ', 'g')"
    for spelling, same in licences.SPELLINGS:
        words = f"regexp_replace({words}, '{spelling}', '{same}\\1', 'g')"
    return f"trim({words})"


def _known_sql() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    return ", ".join(f"({', '.join(map(quote, row))})" for row in licence_texts.known_texts())


ORACLES["op1_license_scan"] = f"""
WITH wordings(licence, kind, wording) AS (VALUES {_known_sql()}),
known AS (
  SELECT kind, sha256({_canonical_sql('wording')}) AS digest, min(licence) AS licence FROM wordings GROUP BY ALL
), units AS (
  SELECT doc_id, 'text' AS kind, sha256({_canonical_sql("coalesce(text, '')")}) AS digest FROM documents
  UNION ALL
  SELECT doc_id, 'notice', sha256({_canonical_sql('line')})
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
), found AS (
  SELECT doc_id, min(licence) FILTER (kind = 'text') AS licence,
         coalesce(string_agg(DISTINCT licence, ',' ORDER BY licence) FILTER (kind = 'notice'), '') AS notices
  FROM units JOIN known USING (kind, digest) GROUP BY doc_id
)
SELECT doc_id, licence, coalesce(notices, '') AS notices FROM documents LEFT JOIN found USING (doc_id)
"""


@query
def op11_cross_tokenizer_alignment(spark, sf_dir):
    return alignment.aligned_documents(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_vector_code_compression(spark, sf_dir):
    return vector_codes.compressed(_table(spark, sf_dir, "embeddings"))


@query
def op13_exact_dedup(spark, sf_dir):
    return exact_copies.exact_copies(_table(spark, sf_dir, "documents"))
