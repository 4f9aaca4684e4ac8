from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np

from odd_rows import doc_rows, make_docs, odd_rows, prose
from strata.llm import lm_scoring as lm


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def check_base(rows, got):
    train = Counter(t for k, text in rows if not is_held_out(k) for t in tokens(text))
    n, v = sum(train.values()), len(train)
    expected = []
    for k, text in rows:
        ts = tokens(text)
        base = sum(math.log10((train[t] + 1) / (n + v + 1)) for t in ts)
        expected.append((k, is_held_out(k), len(ts), sum(train[t] > 0 for t in ts), n, round(base, 6)))
    found = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
             for r in got]
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(found, key=key) == sorted(expected, key=key)


def test_base_matches_brute_force(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_BYTES", 40_000)  # several buckets
    got = lm.score_texts(odd_docs).collect()
    check_base([(r[0], r[1]) for r in odd_rows()], got)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def learned(spark, texts, **options):
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = Counter(t for x in texts for t in tokens(x))
    ends = counts.pop(None)
    words = [(lm.word_hash(w.encode()), 0, c, lm.ending(w.encode()), c, True) for w, c in counts.items()]
    table = spark.createDataFrame(words, "word long, bucket long, here long, ending int, all long, first boolean")
    total = ends + sum(counts.values())
    alphabet = lm.choose_symbols(table, total, ends, options.get("min_share"))
    return lm.learn_tree(docs, alphabet, **options), alphabet, counts, ends


PATTERN = ["the cat sat on the mat the cat ran", "a dog sat on a mat a dog ran", "the cat sat on the mat"] * 40


def test_states_are_distributions(spark):
    tree, alphabet, counts, ends = learned(spark, PATTERN + [prose(1, 300)], min_share=0.001, entry_share=0.0005)
    size = tree.symbols
    states = sorted(set(tree.state[1:].tolist()))
    assert len(states) > 5  # contexts of one symbol and more
    for s in states:
        total = tree.probability(np.full(size, s), np.arange(size)).sum()
        assert math.isclose(total, 1.0, rel_tol=1e-9)
    # In a shared symbol, its known words and the unseen event make one.
    by_symbol = Counter()
    for w, c in counts.items():
        k = alphabet[w.encode()]
        by_symbol[k] += 10 ** alphabet.log_share(np.array([k]), np.array([float(c)]))[0]
    for k, share in by_symbol.items():
        unseen = 10 ** alphabet.log_share(np.array([k]), np.array([0.0]))[0] if k < lm.OTHER + 1 + len(alphabet.shared) else 0
        assert math.isclose(share + unseen, 1.0, rel_tol=1e-9)


def test_counts_are_the_same_without_a_table(spark, monkeypatch):
    one, alphabet, _, _ = learned(spark, PATTERN, min_share=0.001, entry_share=0.0001)
    monkeypatch.setattr(lm, "TABLE_CELLS", 0)
    docs = spark.createDataFrame([(t,) for t in PATTERN], "text string")
    texts = lm.symbol_texts(docs, alphabet)
    found = {r["code"]: r["n"] for r in lm.count_level(texts, 2, one).collect()}
    monkeypatch.undo()
    assert found == {r["code"]: r["n"] for r in lm.count_level(texts, 2, one).collect()} and found


def test_level_counts_match_a_plain_count(spark):
    one, alphabet, _, _ = learned(spark, PATTERN, min_share=0.001, entry_share=0.0001, max_depth=2)
    docs = spark.createDataFrame([(t,) for t in [*PATTERN, None, ""]], "text string")
    found = {r["code"]: r["n"] for r in lm.count_level(lm.symbol_texts(docs, alphabet), 2, one).collect()}
    symbols = [s for t in [*PATTERN, None, ""] for s in (*(alphabet[w.encode()] for w in tokens(t)[:-1]), lm.END)]
    plain = Counter(zip([lm.END, lm.END, *symbols], [lm.END, *symbols], symbols))
    node = dict(zip(one.child_keys.tolist(), one.child_nodes.tolist(), strict=True))
    expected = Counter()
    for (left, last, x), n in plain.items():
        deep = node.get(node.get(one.symbols + last, 0) * one.symbols + left)
        if deep:
            expected[(deep - one.first[2]) * one.symbols + x] += n
    assert found == expected and found


def test_the_tree_grows_with_the_corpus(spark):
    sizes = []
    for n in (40, 640):
        texts = [prose(k, 200, vocabulary=4_000 * n // 640 + 500) for k in range(n)]
        tree, alphabet, _, _ = learned(spark, texts)
        sizes.append((alphabet.symbols, tree.first[-1], len(tree.entries)))
    small, large = sizes
    assert all(b > 1.5 * a for a, b in zip(small[:2], large[:2], strict=True))
    assert math.isclose(lm.least_count(1e6, 100.0), 100.0) and math.isclose(lm.least_count(8e6, 100.0), 400.0)
    assert lm.least_count(10, 100.0) == 2.0


def test_longest_suffix_state_is_used(spark):
    texts = PATTERN
    tree, alphabet, _, _ = learned(spark, texts, min_share=0.001, entry_share=0.0001)
    numbers = {(): 1}
    for key, node in zip(tree.child_keys.tolist(), tree.child_nodes.tolist(), strict=True):
        numbers[key] = node
    for text in ["the cat sat on a mat", "", "mat mat", "unseen cat sat"]:
        symbols = [alphabet[w.encode()] for w in tokens(text)[:-1]] + [lm.END]
        history, logs = [lm.END], []
        for x in symbols:
            node = 1
            for left in reversed(history):
                longer = numbers.get(node * tree.symbols + left)
                if longer is None:
                    break
                node = longer
            logs.append(math.log10(tree.probability(np.array([tree.state[node]]), np.array([x]))[0]))
            history.append(x)
        found = tree.log_probs(np.array([lm.END, *symbols]))[1:]  # a text before it doesn't matter
        assert np.allclose(found, logs)
    after = lambda s, x: tree.log_probs(np.array([*[alphabet[w.encode()] for w in s.split()], alphabet[x]]))[-1]
    assert after("the cat sat on", b"the") > after("the cat sat on", b"a")
    assert after("sat on the", b"mat") > after("on the", b"cat") - 0.5


def test_held_out_texts_beat_the_base(spark):
    docs = make_docs(spark, doc_rows({k: prose(k, 150) + " the end of it all" * (k % 3) for k in range(120)}))
    got = lm.score_texts(docs).collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 5 and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_nothing_to_learn_from(spark, no_docs):
    assert lm.score_texts(no_docs).count() == 0
    held = [k for k in range(60) if is_held_out(k)][:3]
    docs = make_docs(spark, doc_rows({k: "some words" for k in held}))
    got = lm.score_texts(docs).collect()
    check_base([(k, "some words") for k in held], got)
    assert all(math.isfinite(r["score"]) for r in got)
