import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, n_words string, _id int"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def small_docs(spark):
    """The smallest documents table, as (doc_id, text) rows."""
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    r = random.Random(5)
    long = " ".join(r.choice("abcdefghij") + str(r.randrange(3000)) for _ in range(60_000))
    body = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, None, "en", "x", 1), (2, "", None, "x", 1), (3, " \n\t ", "en", None, 1), (4, body, "en", "x", 1),
        (5, body, "de", "x", 1), (5, body, "de", "x", 1), (6, f"head\n{body}\ttail é漢", "en", "x", None),
        (7, long, "en", "x", 1), (8, long[: len(long) // 2] + " new " + long[len(long) // 2 :], "en", "x", 1),
        (None, body + " more", "en", "x", 1), (9, "one two", "en", "x", 1), (10, "one two", "en", "x", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
