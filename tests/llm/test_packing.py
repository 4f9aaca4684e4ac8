from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from odd_rows import odd_rows, prose
from strata.llm import packing


def whole_text_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def check_places(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(bins)


def test_word_encoder_equals_whole_text_encoding():
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    coder = packing.WordEncoder(packing.vocabulary_path())
    odd = ["it's we'll DON'T 's 12ab３", "<|endoftext|> a<|startoftext|>b", "ﬁ ß ẞ ſ Å Å z̀ İ ǅ ŉ", "́ ́a", "a b c\x1cd­e"]
    for text in [r[1] for r in odd_rows()[:1] + odd_rows()[2:5] + odd_rows()[6:]] + odd + ["a,b.c!!d--e_f (g) ...", ""]:
        got = np.frombuffer(coder.encode((text or "").encode()), "<u4").tolist()
        assert got == whole_text_ids(tokenizer, text)


def test_pieces_and_places(spark, odd_docs):
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    rows = packing.pack_pieces(packing.tokenize_pieces(odd_docs)).collect()
    check_places(rows, packing.CAPACITY)
    expected = []
    for r in odd_rows():
        ids = whole_text_ids(tokenizer, r[1])
        for p, lo in enumerate(range(0, len(ids), packing.CAPACITY)):
            cut = ids[lo : lo + packing.CAPACITY]
            expected.append((r[0], p, lo, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    key = lambda x: tuple((v is None, v) for v in x)
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(k, prose(k, 40 + 7 * k)) for k in range(30)], "doc_id long, text string")
    packed = packing.pack_pieces(packing.tokenize_pieces(docs, capacity=256, keep_ids=True), capacity=256)
    pieces = packed.collect()
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    assert len(whole) == check_places(pieces, 256)
    for p in pieces:
        assert whole[p["sequence_id"]][p["offset"] : p["offset"] + p["length"]] == p["ids"]


def test_tree_of_nodes_loses_nothing_and_packs_tightly(spark):
    rng = np.random.default_rng(3)
    sizes = np.minimum(1000, rng.geometric(0.01, 4_000)).tolist()
    pieces = spark.createDataFrame([(k, 0, 0, s, 0) for k, s in enumerate(sizes)],
                                   "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack_pieces(pieces, capacity=1000, node_pieces=150, fan_in=3).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(4_000))
    n = check_places(rows, 1000)
    assert n <= 1.01 * sum(sizes) / 1000 + 1


def test_bins_that_never_fill_are_split_over_nodes(spark):
    # No two of the large pieces fit together, so that every node has underfull bins only.
    sizes = [600 + k % 7 for k in range(1_500)] + [95] * 1_500
    pieces = spark.createDataFrame([(k, 0, 0, s, 0) for k, s in enumerate(sizes)],
                                   "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack_pieces(pieces, capacity=1000, node_pieces=200, fan_in=4).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(3_000))
    assert check_places(rows, 1000) == 1_500
    alone = pieces.filter("length > 500")
    rows = packing.pack_pieces(alone, capacity=1000, node_pieces=100, fan_in=2).collect()
    assert len(rows) == 1_500 == check_places(rows, 1000)


def test_best_fit_takes_the_tightest_bin():
    bins, offsets = packing.best_fit(np.array([7, 5, 3, 2, 1]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 7, 5, 7]
    bins, _ = packing.best_fit(np.array([10, 10]), 10)
    assert sorted(bins.tolist()) == [0, 1]


def test_a_worker_keeps_the_words_it_met_last():
    coder, fresh = (packing.WordEncoder(packing.vocabulary_path()) for _ in range(2))
    for k in range(20):
        text = b"often " + b" ".join(b"x%d" % i for i in range(8_000 * k, 8_000 * (k + 1)))
        ids = coder.encode(text)
        coder.trim()
        assert len(coder) + len(coder.older) <= 130_000
        assert b"often" in coder or b"often" in coder.older
    assert ids == fresh.encode(text) == coder.encode(text)


def test_empty_table(no_docs):
    assert packing.pack_pieces(packing.tokenize_pieces(no_docs)).count() == 0
