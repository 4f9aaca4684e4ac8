from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from odd_rows import make_docs, odd_rows, prose
from strata.llm import lexical_search as search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return TERM.findall(lowered)


def brute_force(docs, items, top=10):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_docs, total = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(terms(text))
    out = []
    for item, query in wanted.items():
        rows = []
        for d, c, n in counts:
            m = 100 - 90 + (90 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in query if c[t]
            )
            if score > 0:
                rows.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(rows, key=lambda r: r[:3])[:top])]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(n=500):
    rng = random.Random(4)
    docs = [(k, prose(k, rng.choice([5, 40, 90, 400]), vocabulary=900)) for k in range(n)]
    docs += [(2_000 + k, prose(17, 60, vocabulary=900)) for k in range(30)]  # ties
    items = [(k, prose(3_000 + k, 12, vocabulary=900)) for k in range(12)]
    items += [(50, prose(17, 60, vocabulary=900)[:200]), (51, "zzz qqq"), (52, ""), (53, None), (54, "ba " * 30)]
    return docs, items


@pytest.fixture(scope="module")
def tables(spark):
    docs, items = corpus()
    return (docs, items, spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
            spark.createDataFrame(items, "item_id long, text string"))


def test_equals_brute_force(spark, tables):
    docs, items, d, i = tables
    assert got(search.rank_documents(d, i)) == brute_force(docs, items)


def test_small_segments_blocks_and_query_parts(spark, tables, monkeypatch):
    docs, items, d, i = tables
    for name, value in (("PAIRS_AT_ONCE", 60), ("VOCABULARY_LIMIT", 3), ("PIECE", 50)):
        monkeypatch.setattr(search, name, value)
    assert got(search.rank_documents(d, i, top=3)) == brute_force(docs, items, top=3)


def segments(docs, size, wanted=None):
    for at in range(0, len(docs), size):
        counted = [(d, *search.term_counts(t, wanted)) for d, t in docs[at : at + size]]
        rows = [x for x in counted if x[1]]
        row = search.build_segment([x[0] for x in rows], [x[1] for x in rows], [x[2] for x in rows])
        yield {k: np.asarray(v) if k not in ("docs", "terms", "data") else v for k, v in row.items()}


def test_blocks_are_rejected_before_they_are_unpacked(monkeypatch):
    """Words that most documents hold and words that few do, as in prose."""
    monkeypatch.setattr(search, "BLOCK", 16)
    rng = random.Random(8)
    common, rare = [f"c{k}" for k in range(20)], [f"r{k}" for k in range(3_000)]
    docs = [(k, " ".join(rng.choices(common, k=rng.randint(5, 40)) + rng.choices(rare, k=6))) for k in range(3_000)]
    items = [(k, " ".join(rng.sample(common, 6) + docs[7 * k][1].split()[-4:])) for k in range(12)]
    whole = search.Corpus(len(docs), sum(len(terms(t)) for _, t in docs))
    df = Counter(t for _, text in docs for t in set(terms(text)))
    known = {t: k for k, t in enumerate(sorted(df))}
    queries = [[(known[t], search.weight(whole.docs, df[t])) for t in set(terms(x)) if t in known] for _, x in items]
    seen, made = [], search.Segment

    class Counting(made):
        def __init__(self, *a):
            super().__init__(*a)
            seen.append(self)

        def search(self, query, floor):
            out = super().search(query, floor)
            self.whole.clear()  # nothing is shared between queries: every block counts
            return out

    monkeypatch.setattr(search, "Segment", Counting)
    heaps = search.search_segments(segments(docs, 500), queries, known, whole, 10)
    rows = [(i, k + 1, d, -s) for (i, _), best in zip(items, heaps.best, strict=True) for k, (s, _, d) in enumerate(best)]
    assert sorted(rows, key=repr) == brute_force(docs, items)
    all_blocks = [sum(s.lists[t][1] - s.lists[t][0] for q in queries for t, _ in q if t in s.lists) for s in seen]
    assert seen[0].unpacked == all_blocks[0]  # nothing to hold against yet
    assert sum(s.unpacked for s in seen[1:]) < 0.5 * sum(all_blocks[1:])


def test_block_bounds_hold_every_posting():
    docs, _ = corpus(400)
    whole = search.Corpus(len(docs), sum(len(terms(t)) for _, t in docs))
    known = {t: k for k, t in enumerate(sorted({t for _, x in docs for t in terms(x)}))}
    for row in segments(docs, 200):
        segment = search.Segment(row, whole, known)
        for t, (first, end, size) in segment.lists.items():
            doc, impact = segment.read_whole(t)
            assert len(doc) == size and (np.diff(doc) > 0).all()
            for b in range(end - first):
                part = slice(b * search.BLOCK, (b + 1) * search.BLOCK)
                assert impact[part].max() <= segment.block_bound[first + b] and doc[part][-1] == segment.last[first + b]


def test_packing_round_trip():
    values = np.array([0, 1, 127, 128, 16_383, 16_384, 2_097_151, 2_097_152, (1 << 31) - 1, 5])
    data, where = search.pack(values)
    assert search.unpack(data).tolist() == values.tolist() and where[-1] == len(data)
    assert search.unpack(search.pack(np.array([3, 4]))[0]).tolist() == [3, 4]


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    items = [(1, prose(1, 20)), (1, "été 日本語 naïve"), (None, "eins ZWEI"), (3, None)]
    i = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r[0], r[1]) for r in odd_rows()]
    assert got(search.rank_documents(odd_docs, i)) == brute_force(docs, items)
    none = spark.createDataFrame([], "item_id long, text string")
    assert search.rank_documents(no_docs, i).count() == 0
    assert search.rank_documents(odd_docs, none).count() == 0
    assert search.rank_documents(no_docs, none).columns == ["item_id", "rank", "doc_id", "score"]
