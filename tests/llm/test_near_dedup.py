from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_rows import doc_rows, make_docs, odd_rows, prose
from strata.llm import near_dedup as near


def brute_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_similarity(s, t):
    a, b = near.words_in((s or "").encode()), near.words_in((t or "").encode())
    return 1.0 if a == b else 1.0 - brute_distance(a, b) / max(len(a), len(b))


def test_edit_distance_within_its_band():
    rng = random.Random(1)
    for _ in range(3_000):
        a = [rng.randint(0, rng.choice([2, 5, 50])) for _ in range(rng.randint(0, 25))]
        b = list(a)
        for _ in range(rng.randint(0, 10)):
            kind, at = rng.random(), rng.randint(0, max(0, len(b) - 1))
            if kind < 0.4 and b:
                b[at] = rng.randint(0, 50)
            elif kind < 0.7 and b:
                b.pop(at)
            else:
                b.insert(at, rng.randint(0, 9))
        most, real = rng.randint(0, 12), brute_distance(a, b)
        found = near.edit_distance(np.array(a, np.uint64), np.array(b, np.uint64), most)
        assert found == (real if real <= most else most + 1)


def test_shingles_are_labelled_by_occurrence():
    words = np.array([1, 2, 3, 4, 5, 1, 2, 3, 4, 5, 1], np.uint64)
    shingles = near.labelled_shingles(words)
    assert len(shingles) == 7 and len(set(shingles.tolist())) == 7
    again = near.labelled_shingles(np.concatenate((words[:5], words[:5], words[:1])))
    assert (shingles == again).all()
    assert len(near.labelled_shingles(words[:3])) == 1
    swapped = np.concatenate((words[5:], words[:5]))
    assert not (near.sketch(words) == near.sketch(swapped)).all()


def edited(text, n, seed):
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def test_sketches_meet_at_the_threshold():
    rng = np.random.default_rng(7)
    for size in (5, 7, 10, 14, 20, 25, 40, 200, 1_000):
        met = 0
        for _ in range(200):
            words = rng.integers(1, 1 << 62, size).astype(np.uint64)
            other = words.copy()
            other[rng.choice(size, int(0.2 * size + 1e-9), replace=False)] = rng.integers(1, 1 << 62, int(0.2 * size + 1e-9))
            one, two = near.sketch(words), near.sketch(other)
            met += int((one == two).any())
        assert met >= 170, (size, met)  # 0.9 or more, less three deviations


def family_texts():
    texts = {}
    for k in range(25):
        texts[k] = prose(k, 100 + 5 * k)
        texts[100 + k] = edited(texts[k], 2, k)
        texts[200 + k] = texts[k].upper() if k % 2 else texts[k] + " and more words"
    base = prose(500, 150)
    for k in range(300):  # one large group of near copies
        texts[1_000 + k] = edited(base, 3, k)
    for k in range(80):  # one large group of copies
        texts[2_000 + k] = prose(501, 90)
    passage = prose(502, 30)
    for k in range(60):  # a passage that else unlike texts share
        texts[3_000 + k] = prose(3_000 + k, 60) + "\n" + passage + "\n" + prose(4_000 + k, 60)
    texts |= {5_000: "one two", 5_001: "one two", 5_002: "one three", 5_003: "one", 5_004: "", 5_005: None}
    return texts


def test_classes_match_brute_force(spark):
    texts = family_texts()
    got = near.near_classes(make_docs(spark, doc_rows(texts))).collect()
    assert len(got) == len(texts)
    class_of = {r["doc_id"]: r["class_id"] for r in got}
    members = defaultdict(list)
    for d, c in class_of.items():
        members[c].append(d)
    for c, ds in members.items():
        assert c == min(ds)
    for d in range(25):
        assert class_of[d] == class_of[100 + d] == class_of[200 + d] == d
    assert {class_of[1_000 + k] for k in range(300)} == {1_000}
    assert {class_of[2_000 + k] for k in range(80)} == {2_000}
    assert all(class_of[3_000 + k] == 3_000 + k for k in range(60))
    assert [class_of[5_000 + k] for k in range(6)] == [5_000, 5_000, 5_002, 5_003, 5_004, 5_004]
    # Every class is held together by pairs of at least the threshold.
    for c, ds in members.items():
        if c < 1_000 and len(ds) > 1:
            joined = {c}
            for _ in ds:
                joined |= {d for d in ds if any(brute_similarity(texts[d], texts[j]) >= near.SIMILARITY for j in joined)}
            assert joined == set(ds)


@pytest.mark.parametrize("many", [8, 0])
def test_pairs_without_a_hub_of_their_bucket(spark, monkeypatch, many):
    monkeypatch.setattr(near, "MANY_PAIRS", many, raising=False)  # 0: new hubs as long as they join any
    describe = near.describe
    one_bucket = F.when(F.size("values") > 0, F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).alias("values")
    monkeypatch.setattr(
        near, "describe", lambda docs: describe(docs).select(*[one_bucket if c == "values" else c for c in describe(docs).columns])
    )
    texts = {}
    for k in range(12):
        texts |= {k: prose(600 + k, 30 + 3 * k), 100 + k: edited(prose(600 + k, 30 + 3 * k), 2, k)}
    got = {r["doc_id"]: r["class_id"] for r in near.near_classes(make_docs(spark, doc_rows(texts))).collect()}
    links = {(a, b) for a in texts for b in texts if brute_similarity(texts[a], texts[b]) >= near.SIMILARITY}
    assert len(links) == 48 and not [(a, b) for a, b in links if got[a] != got[b]]
    assert got == {k: k % 100 for k in texts}


def test_all_pairs_of_a_bucket_that_can_be_links_are_tried(spark):
    texts = {}
    for k in range(30):  # a passage of three quarters of the text, and one edit more or less
        texts |= {2 * k: prose(700, 90) + " " + prose(710 + k, 30 + k % 7), 2 * k + 1: prose(760 + k, 40 + 4 * k)}
    texts |= {60: "same " * 6_000, 63: "same " * 5_000 + "other " * 200, 66: edited(texts[0], 9, 0), 69: texts[59] + " end"}
    rows = spark.createDataFrame(
        [(k, len(t.split()), 0, 7, k // 3) for k, t in texts.items()], "node long, n_words int, k int, value long, root long"
    )
    signed = near.signatures(spark.createDataFrame(list(texts.items()), "node long, text string"))
    bags = {k: Counter(t.split()) for k, t in texts.items()}
    allowed, needed = set(), set()
    for a in texts:
        for b in [b for b in texts if b < a]:
            n, m = bags[a].total(), bags[b].total()
            if a // 3 != b // 3 and abs(n - m) <= near.most_edits(n, m, 0.8):
                allowed.add((a, b))
                if max(n, m) - (bags[a] & bags[b]).total() <= near.most_edits(n, m, 0.8):
                    needed.add((a, b))
    got = {(r["right"], r["left"]) for r in near.remaining_pairs(rows, signed, 0.8).collect()}
    assert needed and needed <= got <= allowed and len(got) < len(allowed) / 3
    assert near.open_pair_count(rows) == 64 * 63 // 2 - 20 * 3


def test_a_group_of_copies_takes_rows_in_proportion(spark, monkeypatch):
    base, tries = prose(800, 120), []
    real = near.verified_links
    monkeypatch.setattr(near, "verified_links", lambda pairs, *rest: tries.append(pairs.count()) or real(pairs, *rest))
    texts = {k: edited(base, 8, k) for k in range(400)}
    got = near.near_classes(make_docs(spark, doc_rows(texts))).collect()
    assert {r["class_id"] for r in got} == {0}
    assert sum(tries) <= 3 * len(texts)


def test_a_node_of_a_large_group_has_few_candidate_pairs(spark):
    rng = random.Random(3)  # a group of which every second one, never the same ones, shares a sketch
    rows = [(k, 100, [2 * s + rng.randint(0, 1) for s in range(near.SKETCHES)]) for k in range(600)]
    sketched = spark.createDataFrame(rows, "node long, n_words int, values array<long>")
    pairs = near.candidate_pairs(sketched).collect()
    ends = [n for r in pairs for n in (r["left"], r["right"])]
    assert set(ends) == set(range(600))
    assert len(pairs) <= 24 * 600


def test_words_kept_by_a_worker_are_bounded():
    known = near.WordHashes()
    for k in range(250_000):
        known[b"%d" % k]
        assert len(known) <= 200_001


def test_no_rows_lost_on_odd_rows(spark, odd_docs, no_docs):
    got = near.near_classes(odd_docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in odd_rows())
    class_of = {r["doc_id"]: r["class_id"] for r in got}
    assert class_of[6] == 1 and class_of[2] == class_of[3] == class_of[4] == 2 and class_of[5] == 5
    assert class_of[None] is None and class_of[8] == 8
    kept = near.drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 2, 5, None, 8, 9])
    assert near.near_classes(no_docs).count() == 0 and near.drop_copies(no_docs).count() == 0


def test_an_id_with_two_texts(spark):
    rows = doc_rows({1: prose(1, 80), 2: prose(2, 80)}) + doc_rows({2: prose(1, 80), 3: edited(prose(2, 80), 1, 0)})
    docs = make_docs(spark, rows)
    got = Counter((r["doc_id"], r["class_id"]) for r in near.near_classes(docs).collect())
    assert got == Counter([(1, 1), (2, 2), (2, 1), (3, 2)])
    assert sorted(r["doc_id"] for r in near.drop_copies(docs).collect()) == [1, 2]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)]
    links += [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(70)]
    links = [(a, b) for a, b in links if a != b]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r["node"]: r["root"] for r in near.components(spark.createDataFrame(links, "left long, right long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}


def test_few_links_take_one_table_and_many_the_rounds(spark, monkeypatch):
    staged, real = [], near.stage_table
    monkeypatch.setattr(near, "stage_table", lambda df, name, *rest: staged.append(name) or real(df, name, *rest))
    links = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 60)] + [(300, 301), (301, 301)]
    roots = {k: 0 for k in range(1, 61)} | {100 + k: 100 for k in range(1, 60)} | {301: 300}
    frame = spark.createDataFrame(links, "left long, right long").repartition(5)
    assert {r["node"]: r["root"] for r in near.components(frame).collect()} == roots
    assert len(staged) == 1
    monkeypatch.setattr(near, "LINKS_A_TASK", 20)
    got = near.components(frame).collect()
    assert {r["node"]: r["root"] for r in got} == roots and len(got) == len(roots)
    assert len(staged) > 3


def test_texts_are_read_once_for_all_rounds_of_best_pairs(spark, monkeypatch):
    reads, real = [], near.texts_of
    monkeypatch.setattr(near, "texts_of", lambda docs, needed, nodes: reads.append(needed.count()) or real(docs, needed, nodes))
    texts = {k: edited(prose(810 + k % 3, 100), 6, k) for k in range(90)}
    got = near.near_classes(make_docs(spark, doc_rows(texts))).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {k: k % 3 for k in texts}
    assert len(reads) == 2  # for the pairs of hubs, and for the buckets left open
