"""Operators on documents against the plain form of their contracts."""

from collections import Counter, defaultdict
import json
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from check_oracles import connect, difference
from tradeflow.llm import licence_texts, licences, near_duplicates, packing, phrases, quality, queries, substrings
from tradeflow.llm.components import components
from tradeflow.llm.text import gram_hashes, letter_runs, split_words, word_hashes
from tradeflow.workspace import new_folder

MODEL = public_tokenizers.path("word_bpe_49k.json")


def pairs(rows):
    return [(r["doc_id"], r["text"]) for r in rows.select("doc_id", "text").collect()]


def test_words_and_hashes_do_not_depend_on_their_place():
    words = split_words(pa.array(["a bb\x0bccc", None, "", "bb x a"]))
    assert words.counts.tolist() == [3, 0, 0, 2]
    hashes = words.hashes()
    assert hashes[0] == hashes[4] and len(set(hashes.tolist())) == 4
    many = split_words(pa.array(["ab " * 600_000])).hashes()  # several segments
    assert len(set(many.tolist())) == 1
    for size in (1, 2, 3, 5, 8, 10, 20):
        grams = gram_hashes(np.arange(40, dtype=np.uint64) % np.uint64(13), size)
        assert len(grams) == 41 - size
        assert all((grams[i] == grams[j]) == ((i - j) % 13 == 0) for i in range(5) for j in range(20 if size < 20 else 15))


def test_numbers_are_those_of_the_bytes():
    texts = ["a bb\x0bccc a", None, "", "bb x" + "y" * 100 + " x" + "y" * 100 + " x" + "y" * 99 + "z", "aaaaaaaab aaaaaaaaa aaaaaaaa"]
    for same_hash in (False, True):
        words = split_words(pa.array(texts))
        if same_hash:
            words.hashes = lambda n=len(words.starts): np.zeros(n, np.uint64)
        told = [words.data[a:b].tobytes() for a, b in zip(words.starts, words.ends, strict=True)]
        places, numbers = (x.tolist() for x in words.distinct())
        assert told == [words.word(places[n]) for n in numbers]
        assert len(set(zip(told, numbers, strict=True))) == len(set(told)) == len(set(numbers))


def opposites(length):
    """Two words that any sum of powers modulo 2**64 gives one hash, from 1,024 letters on."""
    letters = [bin(i).count("1") % 2 for i in range(length)]
    return "".join("ab"[x] for x in letters), "".join("ba"[x] for x in letters)


def opposite_rows(length):
    one, other = opposites(length)
    shared = " ".join(f"w{i}" for i in range(19))
    return [(1, f"{one} {shared}"), (2, f"{other} {shared}"), (3, " ".join([one] * 12)), (4, " ".join([other] * 12)), (5, one), (6, other)]


@pytest.mark.parametrize("length", [1024, 4096])
def test_words_with_opposite_letters_are_told_apart(spark, length):
    rows = opposite_rows(length)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    found = substrings.without_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, found)) == Counter(brute.substring_dedup(rows))
    found = near_duplicates.near_duplicates(docs).select("doc_id", "class_id", "n_links").collect()
    assert Counter(map(tuple, found)) == Counter(brute.near_duplicates(rows))
    items = [(1, rows[0][1]), (2, opposites(length)[0])]
    folder = new_folder(spark, "test-index")
    phrases.write_index(docs, folder)
    found = phrases.contamination(phrases.search(spark, folder, spark.createDataFrame(items, "item_id bigint, text string"))).collect()
    assert Counter(map(tuple, found)) == Counter(brute.contamination(rows, items))
    coder = Tokenizer.from_file(MODEL)
    crc = lambda text: zlib.crc32(np.array([*coder.encode(text, add_special_tokens=False).ids, 1], dtype="<u4").tobytes())
    short = [r for r in rows if r[0] in (1, 2, 5, 6)]
    packed = packing.pack_documents(docs.where("doc_id in (1, 2, 5, 6)"), MODEL).collect()
    assert {r["doc_id"]: r["ids_crc32"] for r in packed if r["piece"] == 0 and r["length"] < 4096} == {i: crc(t) for i, t in short}


def test_rows_without_ids_keep_apart(spark):
    rows = [(None, " ".join(f"u{i}x{k}" for k in range(25))) for i in range(3000)]
    found = substrings.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert found.agg(F.sum("n_removed")).first()[0] == 0
    keyed = substrings._keyed(spark.createDataFrame([*rows, (7, "x"), (2**63 - 1, "y")], "doc_id bigint, text string"), "doc_id", "text", {})
    assert keyed.select("_id", "_row").distinct().count() == 3002 and keyed.where("_row < 0").count() == 3000


def test_rows_without_ids_come_last(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (2**63 - 1, text), (None, text + " more")]
    found = substrings.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in found.collect() if r["doc_id"]} == {2**63 - 1: 0}
    assert sorted(r["n_removed"] for r in found.collect()) == [0, 30, 30]


def test_substrings_equal_brute_force(spark, small_docs, odd_docs):
    for rows in (small_docs, [r for r in dict(pairs(odd_docs)).items()]):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
        found = substrings.without_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
        assert Counter(map(tuple, found)) == Counter(brute.substring_dedup(rows))


@pytest.mark.parametrize("seed", range(3))
def test_substrings_of_few_words(spark, seed):
    r = random.Random(seed)
    rows = [(i, " ".join(r.choice("ab") for _ in range(r.randrange(60)))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for window, anchor in ((20, 8), (5, 2), (3, 3)):
        found = substrings.without_repeats(docs, window=window, anchor=anchor)
        found = found.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
        assert Counter(map(tuple, found)) == Counter(brute.substring_dedup(rows, window))


def test_substrings_keep_columns_and_rewrite(odd_docs, no_docs):
    found = substrings.without_repeats(odd_docs, rewrite=True)
    assert found.columns == ["doc_id", "text", "lang", "_id", "n_words", "n_removed", "kept_text"]
    rows = {r["doc_id"]: r for r in found.collect()}
    assert rows[6]["kept_text"] == "head\ttail é漢" and rows[1]["kept_text"] is None
    assert rows[5]["n_removed"] == 60 and rows[4]["n_removed"] == 0
    assert substrings.without_repeats(no_docs).count() == 0
    spans = substrings.repeated_spans(odd_docs).where("doc_id = 5").agg(F.min("start"), F.max(F.expr("start + length"))).first()
    assert tuple(spans) == (0, 60)


def test_windows_that_share_anchor_and_half_a_hash_are_told_apart(spark):
    common = " ".join(f"c{i}" for i in range(19))
    rows = [(n, f"u{n} {common}") for n in (69557, 94293, 194097, 220379, 185173, 250123)]
    found = substrings.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert [r["doc_id"] for r in found.where("n_removed > 0").collect()] == []


def test_windows_of_hot_anchors_are_spread(spark, monkeypatch):
    common = " ".join(f"c{i}" for i in range(19))
    rows = [(n, f"u{n % 400} {common} v{n % 3} w{n % 5}") for n in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    monkeypatch.setattr(substrings, "SAMPLE", 1.0)
    keyed = substrings._keyed(docs, "doc_id", "text", {})
    hot = substrings._hot_anchors(keyed, 8, 20, 8)
    assert len(hot) >= 1
    parts = list(substrings._anchored(keyed.select("_id", "_row", "text").toArrow().to_batches(), 8, 20, 8, hot))
    sizes = Counter()
    for part in parts:
        for r in part.to_pylist():
            sizes[r["target"]] += len(r["windows"] or b"")
    assert len(sizes) == 8 and max(sizes.values()) < sum(sizes.values()) / 4
    found = substrings.without_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, found)) == Counter(brute.substring_dedup(rows))


def test_near_duplicates_equal_brute_force(spark, small_docs, monkeypatch):
    r = random.Random(3)
    base = [f"w{i}" for i in range(160)]
    copies = []
    for i in range(60):  # one large group of near copies
        words = list(base)
        for _ in range(r.randrange(5)):
            words[r.randrange(160)] = f"x{r.random()}"
        copies.append((10_000 + i, " ".join(words)))
    rows = small_docs + copies
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = Counter(brute.near_duplicates(rows))
    for most in (512, 16):
        monkeypatch.setattr(near_duplicates, "BLOCK_TEXTS", most)
        found = near_duplicates.near_duplicates(docs).select("doc_id", "class_id", "n_links").collect()
        assert Counter(map(tuple, found)) == want
    kept = near_duplicates.one_of_each_class(docs)
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted({c for _, c, _ in want})


def test_links_are_counted_once_where_a_block_is_empty(spark, monkeypatch):
    rows = []
    for pair in range(8):
        words = [f"p{pair}w{i}" for i in range(400)]
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(words[:-1] + ["end"]))]
    monkeypatch.setattr(near_duplicates, "BLOCK_BYTES", 4000)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = near_duplicates.near_duplicates(docs).select("doc_id", "class_id", "n_links").collect()
    assert Counter(map(tuple, found)) == Counter((i, i - i % 2, 1) for i in range(16))


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    rows = near_duplicates.near_duplicates(odd_docs).collect()
    assert len(rows) == 12
    of = {r["doc_id"]: r for r in rows}
    assert of[5]["class_id"] == 4 and of[10]["class_id"] == 9 and of[8]["class_id"] == 7
    assert all(of[i]["class_id"] == i and of[i]["n_links"] == 0 and of[i]["is_kept"] for i in (1, 2, 3))
    assert not of[10]["is_kept"]
    assert near_duplicates.near_duplicates(no_docs).count() == 0
    assert near_duplicates.prefix_length(0.8) == 6 and near_duplicates.prefix_length(0.95) == 8


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (7, 7)], "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert found == {i: 0 for i in range(31)} | {100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


def test_decontamination_equals_brute_force(spark, sf_dir, small_docs, odd_docs):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").unionByName(
        spark.createDataFrame([(-1, "W1-w2, W3"), (-2, None), (-3, "--"), (-4, "tail É漢"), (-5, "tail é漢")], "item_id bigint, text string"))
    known = [tuple(r) for r in items.select("item_id", "text").collect()]
    docs = spark.createDataFrame(small_docs, "doc_id bigint, text string").unionByName(odd_docs.select("doc_id", "text"))
    folder = new_folder(spark, "test-index")
    phrases.write_index(docs, folder)
    want = Counter(brute.contamination(pairs(docs), known))
    for block in (1, phrases.BLOCK):
        found = phrases.contamination(phrases.search(spark, folder, items, block=block)).collect()
        assert Counter(map(tuple, found)) == want
    none = phrases.contamination(phrases.search(spark, folder, items.limit(0)))
    assert none.where("contaminated or n_items > 0").count() == 0 and none.count() == docs.count()
    kept = phrases.without_contaminated(docs, items)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(w[0] for w in want.elements() if not w[5])


def test_proximity(spark):
    folder = new_folder(spark, "near-index")
    phrases.write_index(spark.createDataFrame([(1, "a x b c"), (2, "a x y b c"), (3, "c b a")], "doc_id bigint, text string"), folder)
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    hits = lambda slop: {r["doc_id"] for r in phrases.search(spark, folder, items, slop=slop).where("size(matches) > 0").collect()}
    assert hits(0) == set() and hits(1) == {1} and hits(2) == {1, 2} and hits(4) == {1, 2, 3}


def near_plainly(text, phrase, slop):
    """Whether the phrase's terms stand near their places, counted from some place of the first."""
    spots = lambda term: [i for i, w in enumerate(text) if w == term]
    return any(all(any(abs(p - start - i) <= slop for p in spots(term)) for i, term in enumerate(phrase)) for start in spots(phrase[0]))


def test_proximity_tries_all_places_in_every_text(spark):
    r = random.Random(4)
    texts = ["z b", "a b"] + [" ".join(r.choice("abcdez") for _ in range(r.randrange(9))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    items = ["a b", "a b c", "c a e d", "d", "e z"]
    for parts, slop in ((1, 3), (1, 1), (4, 2)):
        folder = new_folder(spark, "near-index")
        phrases.write_index(docs.coalesce(1) if parts == 1 else docs.repartition(parts), folder)
        found = phrases.search(spark, folder, spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string"), slop=slop).collect()
        want = {(d, str(i)) for d, t in enumerate(texts) for i, p in enumerate(items) if near_plainly(t.split(), p.split(), slop)}
        assert {(x["doc_id"], m["item"]) for x in found for m in x["matches"]} == want


def test_long_items_are_split_to_blocks(spark):
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(3000))), (2, "a b")], "item_id bigint, text string")
    blocks = list(phrases.phrase_blocks(items, block=20))
    assert sum(len(b.sizes) for b in blocks) == 2992 and max(len(b.sizes) for b in blocks) == phrases.PIECE


def test_empty_index(spark, no_docs):
    folder = new_folder(spark, "empty-index")
    phrases.write_index(no_docs, folder)
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert phrases.search(spark, folder, items).count() == 0


def test_pieces_equal_the_tokenizer(spark, small_docs, odd_docs):
    rows = small_docs + pairs(odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"])) + [
        (90_001, "Don't İSTANBUL ΑΣ ﬁ é ́x a\u0085b c d 12'5 <|endoftext|> x<|startoftext|>y ☃️ 한국어")]
    rows = list({i: (i, t) for i, t in rows}.values())
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    coder, want = Tokenizer.from_file(MODEL), {}
    for doc_id, text in rows:
        ids = np.array([*coder.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[doc_id, piece] = (at, len(part), zlib.crc32(part.tobytes()))
    found = packing.pack_documents(docs, MODEL).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in found} == want
    assert len(found) == len(want)
    check_places(found, 4096)


def check_places(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


@pytest.mark.parametrize("seed", range(4))
def test_fillings_use_each_length_once_and_few_sequences(seed):
    r = random.Random(seed)
    lengths = [r.choice([r.randint(1, 100), r.randint(1, 30), 37]) for _ in range(5000)]
    counts, used, made = Counter(lengths), Counter(), 0
    for one, times in packing.fillings(counts, 100):
        assert sum(k * n for k, n in one.items()) <= 100
        made += times
        for k, n in one.items():
            used[k] += n * times
    assert used == counts
    assert made <= -(-sum(lengths) // 100) * 1.02 + 1


def test_a_pair_replaces_the_smallest():
    # Greedy takes 60 + 30 of 100; 60 + 21 + 19 fills it.
    fillings = list(packing.fillings({60: 1, 30: 1, 21: 1, 19: 1}, 100))
    assert fillings[0] == (Counter({60: 1, 21: 1, 19: 1}), 1)


def _coded(coder, texts):
    """Ids of each text, put together from what the coder remembers."""
    words = split_words(pa.array(texts))
    words = letter_runs(words, coder.whole) if coder.whole is not None else words
    ids, per_word = coder.of(words)
    ends = np.append(0, np.cumsum(per_word))[words.bounds]
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]


@pytest.mark.parametrize("by_runs", [True, False])
def test_runs_have_the_ids_of_whole_texts(by_runs):
    with open(MODEL, encoding="utf-8") as file:
        model = file.read()
    if not by_runs:  # a tokenizer that minds case goes by other rules
        rules = json.loads(model)
        del rules["normalizer"]["normalizers"][-1]
        model = json.dumps(rules)
    coder, whole, rng = packing.WordIds(model), Tokenizer.from_str(model), random.Random(7)
    assert (coder.whole is not None) == by_runs
    signs = [*map(chr, range(0x1, 0x250)), "\u0301", "\u0307", "\u00a0", "\u200b", "\u2019", "\u212a", "\u0130", "\u03a3", "\u4e2d", "\U0001f600",
             "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "'s", "'LL", "it's", "Gr\u00f6\u00dfe,", "\u00c9T\u00c9.", "3.14", "2\u00d73", "...", " "]
    texts = ["".join(rng.choice([*signs, "Ab", "c"]) for _ in range(rng.randint(1, 12))) for _ in range(4000)]
    texts += [f"x{a}Y{b}" for a in signs for b in ("1", ".", a)] + ["", " \t", None]
    assert _coded(coder, texts) == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert _coded(coder, texts[::-1]) == [whole.encode(t or "", add_special_tokens=False).ids for t in texts[::-1]]


def test_forms_of_a_word_are_remembered_once():
    with open(MODEL, encoding="utf-8") as file:
        coder = packing.WordIds(file.read())
    names = [f"{a}{b}ning" for a in "bcdfg" for b in "aeiou"]
    _coded(coder, [" ".join(f"{n} {n.upper()} {n.title()}, ({n}) {n}." for n in names)])
    assert len(coder.known) <= len(names) + 4  # and , ( ) .


def test_packing_odd_rows(spark, odd_docs, no_docs):
    assert packing.pack_documents(no_docs, MODEL).count() == 0
    rows = packing.pack_documents(odd_docs, MODEL).collect()
    check_places(rows, 4096)
    assert sorted(r["length"] for r in rows if r["doc_id"] in (1, 2, 3)) == [1, 1, 1]


def test_measures_equal_brute_force(spark, small_docs, odd_docs):
    rows = small_docs + pairs(odd_docs) + [(99, "a b c a b c a b"), (98, "x\nx\n \n \ny\nx"), (97, "a a a a"), (96, "a b c d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("lang", F.lit(None).cast("string"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = quality.measures(docs).withColumn("failed", quality.base_failed()).select(*columns, "failed").collect()
    assert Counter(map(tuple, found)) == Counter((i, *brute.measures(t)) for i, t in rows)


def test_binomial_tail(spark):
    from math import comb
    rows = [(k, n) for n in (1, 10, 400) for k in (0, 1, 2, 4) if k <= n]
    found = spark.createDataFrame(rows, "k bigint, n bigint").select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), 0.01).alias("p"))
    for k, n, p in found.collect():
        want = sum(comb(n, i) * 0.01**i * 0.99 ** (n - i) for i in range(k + 1)) if k <= n * 0.01 else 1.0
        assert p == pytest.approx(want, rel=1e-9)


def test_cutoffs_are_safe_and_take_effect(spark):
    good = [(i, "plain words without marks " * 3 + " ".join(f"w{i}x{k}" for k in range(60)), "en") for i in range(3000)]
    bad = [(5000 + i, " ".join(f"v{i}x{k}***" for k in range(70)), lang) for i, lang in enumerate(["en", "en", "fr", None])]
    docs = spark.createDataFrame(good + bad, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(3000)] + [(5000, 0), (1, None)], "doc_id bigint, quality int")
    found = {r["doc_id"]: r for r in quality.judged(docs, labels).collect()}
    assert not found[5000]["kept"] and not found[5001]["kept"] and found[5000]["failed"] == ["symbols"]
    assert found[5002]["kept"] and found[5003]["kept"]  # strata without labels
    assert sum(not found[i]["kept"] for i in range(3000)) == 0
    few = quality.judged(docs, labels.where("doc_id < 300 or doc_id = 5000"))
    assert few.where("doc_id = 5000").first()["kept"]  # too few labels to show that it is safe
    assert quality.kept_documents(docs, labels).count() == 3002
    assert quality.judged(docs, labels.limit(0)).where("kept").count() == 3004
    assert quality.judged(docs.limit(0), labels).count() == 0


def test_quality_of_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(4, 1), (None, 1), (7, None)], "doc_id bigint, quality int")
    rows = quality.judged(odd_docs, labels).collect()
    assert len(rows) == 12 and {r["doc_id"] for r in rows if r["kept"]} == {4, 5, 6, 7, 8, None}


def test_licences(spark, odd_docs, no_docs):
    texts = licence_texts.TEXTS
    rows = [
        (1, "The MIT License\n\nCopyright (c) 2021 Some One\n\n" + texts["MIT"].upper().replace("\n", "  ")),
        (2, texts["BSD-3-Clause"].replace(",", " ;")), (3, texts["BSD-2-Clause"]), (4, texts["MIT"] + " and more"),
        (5, "a\n// Licenced under the Apache Licence, version 2.0\nb\nSPDX-License-Identifier: GPL-3.0"), (6, None),
    ]
    found = {r["doc_id"]: tuple(r)[1:] for r in licences.scanned(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == {1: ("MIT", ""), 2: ("BSD-3-Clause", ""), 3: ("BSD-2-Clause", ""), 4: (None, ""),
                     5: (None, "Apache-2.0,GPL-3.0"), 6: (None, "")}
    assert licences.scanned(odd_docs).where("licence is null and notices = ''").count() == 12
    assert licences.scanned(no_docs).count() == 0


def test_licences_as_published_and_added_ones(spark):
    bsd, long = licence_texts.TEXTS["BSD-3-Clause"], "Long Licence\n1. You may copy it.\nCopyright holders may not.\n2. And so on."
    rows = [
        (1, "BSD 3-Clause License\n\nCopyright (c) 2020, Jane Doe\nAll rights reserved.\n\n" + bsd),
        (2, "MIT License\n\nCopyright Jane Doe\n\n" + licence_texts.TEXTS["MIT"]),
        (3, "Copyright Jane Doe and others. All rights reserved.\n" + bsd.replace("the above copyright notice,", "the above\n    copyright notice,")),
        (4, "Copyright Jane Doe\n" + long), (5, long.replace("Copyright holders may not.\n", "")),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = licences.known_table(spark).union(spark.createDataFrame([("Long-1.0", "text", long)], "licence string, kind string, wording string"))
    found = {r["doc_id"]: r["licence"] for r in licences.scanned(docs, texts=known).collect()}
    assert found == {1: "BSD-3-Clause", 2: "MIT", 3: "BSD-3-Clause", 4: "Long-1.0", 5: None}
    assert licences.scanned(docs).where("doc_id = 4 and licence is null").count() == 1


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(spark, connect(sf_dir), name, sf_dir) is None


def test_every_operator_has_a_query():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
