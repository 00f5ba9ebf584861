"""The pipeline's stages against the plain form of each, on the smallest table."""

from collections import Counter

import brute
import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer



def pairs(rows):
    return [(r["doc_id"], r["text"]) for r in rows.select("doc_id", "text").collect()]


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, stages = docs.columns, [stage for _, stage in corpus_pipeline.STAGES]
    rows = pairs(docs)

    docs = stages[0](spark, docs, sf_dir).cache()
    kept = pairs(docs)
    assert docs.columns == columns
    assert {i for i, _ in kept} <= {i for i, t in rows if not brute.measures(t)[-1]}
    assert len(kept) >= 0.95 * sum(not brute.measures(t)[-1] for _, t in rows)  # too few labels to reject more

    docs = stages[1](spark, docs, sf_dir).cache()
    assert docs.columns == columns
    assert {i for i, _ in pairs(docs)} == {c for _, c, _ in brute.near_duplicates(kept)}

    before = pairs(docs)
    docs = stages[2](spark, docs, sf_dir).cache()
    assert docs.columns == columns
    want = {i: (digest, n - gone) for i, n, gone, digest in brute.substring_dedup(before)}
    got = {i: (brute.digest(" ".join(brute.WORD.findall(t or ""))), len(brute.WORD.findall(t or ""))) for i, t in pairs(docs)}
    assert got == {i: w for i, w in want.items() if w[1]}
    assert docs.where("n_chars <> length(text)").count() == 0

    before = pairs(docs)
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    docs = stages[3](spark, docs, sf_dir).cache()
    assert docs.columns == columns
    assert Counter(i for i, _ in pairs(docs)) == Counter(r[0] for r in brute.contamination(before, items) if not r[5])

    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = stages[4](spark, docs, sf_dir)
    tokens = {i: len(coder.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in pairs(docs)}
    found = packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in found} == tokens


def test_run_returns_the_last_stage(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).columns[:4] == ["doc_id", "piece", "start", "length"]


def test_stages_take_empty_and_odd_tables(spark, sf_dir):
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    body = " ".join(f"w{i}" for i in range(60))
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "a", 0), (2, body, "en", "a", 1), (2, body, "en", "a", 1)], columns)
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, sf_dir).count()


def test_columns_with_names_the_stages_use(spark, sf_dir):
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint, N_Words string, n_removed int, _kept_id int, _KEPT_HASH int, _hit int"
    body = " ".join(f"w{i}" for i in range(60))
    rows = [(1, body, "en", "a", 1, "x", 2, 3, 4, 5), (2, body + " more", "en", "a", 1, "y", 2, 3, 4, 5)]
    docs = spark.createDataFrame(rows, columns)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, sf_dir)
        assert found.columns == docs.columns
        assert all(tuple(r)[5:] in {t[5:] for t in rows} for r in found.collect())
