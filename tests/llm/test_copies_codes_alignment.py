"""Exact copies, vector codes and token alignment against plain forms of their contracts."""

import random

import brute
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tradeflow.llm import alignment, exact_copies, vector_codes

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def told(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=str)


# ---- exact copies

COPY = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("held", [exact_copies.HELD_BYTES, 1000])
def test_copies_equal_brute_force(spark, small_docs, keep, held):
    rows = small_docs + [(10**6 + i, f"Group {i % 3}É".upper() if i % 2 else f"group {i % 3}É") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = exact_copies.exact_copies(docs, keep=keep, held_bytes=held)
    assert told(found, *COPY) == sorted(brute.exact_copies(rows, keep == "largest"), key=str)


def test_copies_of_odd_rows(spark, odd_docs, no_docs):
    found = exact_copies.exact_copies(odd_docs).collect()
    assert len(found) == odd_docs.count()
    groups = {}
    for r in found:
        groups.setdefault(r["text_sha256"], []).append(r)
    assert all(sum(r["kept"] for r in rows) == 1 and {r["group_size"] for r in rows} == {len(rows)} for rows in groups.values())
    empty = groups[brute.digest("")]
    assert {(r["doc_id"], r["kept"]) for r in empty} == {(1, False), (2, True)}
    assert sorted(r["doc_id"] for r in found if r["keep_id"] == 5) == [4, 5, 5]  # a repeated row: one of them stays
    assert exact_copies.exact_copies(no_docs).collect() == []


def test_rows_without_ids_stay_only_among_themselves(spark):
    rows = [(None, "a"), (None, "A"), (None, "b"), (3, "B"), (-4, "b")]
    found = told(exact_copies.exact_copies(spark.createDataFrame(rows, "doc_id bigint, text string")), *COPY[:4])
    assert found == sorted([(None, None, 2, True), (None, None, 2, False), (None, 3, 3, False), (3, 3, 3, True), (-4, 3, 3, False)], key=str)


def test_hot_texts_are_merged_in_parts(spark, monkeypatch):
    monkeypatch.setattr(exact_copies, "frequent_keys", lambda rows, key, partitions: [
        (r["hash"], 3) for r in rows.groupBy("hash").count().where("count > 1").collect()])
    rows = [(i, ["Hot text", "hot TEXT", "other", f"own {i}"][i % 4]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    assert told(exact_copies.exact_copies(docs, held_bytes=500), *COPY) == sorted(brute.exact_copies(rows), key=str)


def test_equal_hashes_do_not_make_texts_equal(spark, monkeypatch):
    from tradeflow.llm import exact_copies as module

    def same_hash(batches, largest, limit, inner=module._met_in_task):
        import pyarrow as pa
        for batch in inner(batches, largest, limit):
            yield batch.set_column(2, "hash", pa.array([7] * batch.num_rows, pa.int64()))

    monkeypatch.setattr(module, "_met_in_task", same_hash)
    rows = [(i, f"text {i % 9}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert told(module.exact_copies(docs, held_bytes=200), *COPY) == sorted(brute.exact_copies(rows), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=6)))
def test_trie_holds_what_was_put_in(keys):
    trie = exact_copies.RadixTrie()
    for i, key in enumerate(keys):
        node = trie.terminal(key)
        node[2] = (node[2] or []) + [i]
    want = {}
    for i, key in enumerate(keys):
        want.setdefault(key, []).append(i)
    assert dict(trie.items()) == want


def test_wrong_choice_is_refused(no_docs):
    with pytest.raises(ValueError):
        exact_copies.exact_copies(no_docs, keep="longest")


# ---- vector codes

CODE = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
VECTORS = "vec_id bigint, embedding array<float>, label int, error string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], VECTORS)


def some_vectors(count, width=32, seed=1):
    r = random.Random(seed)
    return [(i, [r.choice([-1.5, 0.25, r.gauss(0, 1)]) * 0.5**k for k in range(width // 16)] * 16, r.choice([None, 1, 2])) for i in range(count)]


def as_floats(rows):
    import numpy as np
    return [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


@pytest.mark.parametrize("count", [1, 40, 300])
def test_codes_equal_brute_force(spark, count):
    rows = some_vectors(count)
    found = vector_codes.compressed(vectors(spark, rows).repartition(4))
    assert told(found, *CODE) == sorted(brute.vector_codes(as_floats(rows)), key=str)


def test_codes_of_odd_rows(spark):
    good = some_vectors(70)
    odd = [(100, None, 1), (101, [1.0, None] * 16, 1), (102, [float("nan")] * 32, 1), (103, [float("inf")] + [0.0] * 31, None),
           (None, [0.5] * 32, 2), (5, [0.5] * 32, 2), (5, good[5][1], None), (104, [16000.0, -16000.0] * 16, 9)]
    found = vector_codes.compressed(vectors(spark, good + odd))
    assert told(found, *CODE) == sorted(brute.vector_codes(as_floats(good + odd)), key=str)


def test_no_vectors_and_empty_vectors(spark):
    assert vector_codes.compressed(vectors(spark, [])).collect() == []
    assert vector_codes.compressed(vectors(spark, [(1, None, 1)])).collect() == []
    found = vector_codes.compressed(vectors(spark, [(1, [], 1), (2, [], None)])).collect()
    assert {(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in found} == {(1, "00" * 16, 0, 0), (2, "00" * 16, 0, 0)}


@pytest.mark.parametrize("vector", [[1.0] * 17, [1e9] * 32])
def test_unfit_vectors_are_refused(spark, vector):
    with pytest.raises(Exception, match="multiple of 16|or more|differ in their number"):
        vector_codes.compressed(vectors(spark, [(1, vector, 1)])).collect()


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 9), st.integers(1, 5))
def test_search_equals_trying_all(seed, size, width):
    import numpy as np
    r = np.random.default_rng(seed)
    book, parts = r.integers(-4, 5, (size, width)), r.integers(-9, 10, (30, width))
    chosen, far = vector_codes.NearestEntry(book).of(parts)
    assert list(zip(chosen.tolist(), far.tolist(), strict=True)) == [brute.nearest(p.tolist(), book.tolist()) for p in parts]


# ---- alignment

ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def coders():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    letters = alignment.byte_of_letter()
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)

    def ours(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids
        return [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in ids]

    def theirs(text):
        return [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                for i in b.encode(text)]

    return ours, theirs


ODD_TEXTS = ["", None, " ", "  ", "a", "a  b", " lead", "trail ", "x \n y", "\n\n  z", "tab\t\there", "no break 　 wide  x",
             "<|endoftext|> </s> <s>", "under▁score", "é漢字 \U0001f600\U0001f600", "it's we'll  don't", "0x41 <0x41>", "\x00 \x1c a",
             "a" * 500, "12345 6789.00 --- ... !!", "mixed   runs    of  spaces", "Hello hello HELLO"]


def test_alignment_of_odd_texts(spark, coders):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS * 2)] + [(None, "a  b"), (3, " lead")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, digest string, n_a int").repartition(3)
    found = alignment.aligned_documents(docs, A_PATH, B_PATH)
    assert told(found, *ALIGNED) == sorted(brute.alignment(rows, *coders), key=str)


def test_alignment_of_real_texts(spark, small_docs, coders):
    rows = [(i, t[:2000] if t else t) for i, t in small_docs[:60]]
    rows += [(10**6 + i, rows[i][1]) for i in range(0, 60, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert told(alignment.aligned_documents(docs, A_PATH, B_PATH), *ALIGNED) == sorted(brute.alignment(rows, *coders), key=str)


def test_alignment_without_units(spark, coders, monkeypatch):
    monkeypatch.setattr(alignment.Aligner, "_splits", lambda *_: False)
    aligner = alignment.Aligner(open(A_PATH, encoding="utf-8").read(), open(B_PATH, "rb").read())
    assert aligner.units("a b  c") == ["a b  c"]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" ab\n\t'sé　 .9▁", max_size=30))
def test_units_change_nothing(coders, text):
    aligner = _aligner()
    units = aligner.units(text)
    assert " " + text == "".join(" " + u for u in units)
    aligner.learn(units)
    places = [aligner.known[u] for u in units]
    ours, theirs = coders
    a, b = (ours(text), theirs(text)) if text else ([], [])
    whole = (" " + text).encode()
    valid = bool(text) and b"".join(x for _, x in a) == whole == b"".join(x for _, x in b)
    if text:
        assert all(aligner.valid[i] for i in places) == valid
    if valid:
        assert aligner.counts[:2, places].sum(axis=1).tolist() == [len(a), len(b)]


def _aligner(held=[]):
    if not held:
        held.append(alignment.Aligner(open(A_PATH, encoding="utf-8").read(), open(B_PATH, "rb").read()))
    return held[0]


def test_empty_table(no_docs):
    assert alignment.aligned_documents(no_docs, A_PATH, B_PATH).collect() == []
