from __future__ import annotations

import random
import re

import pytest

from odd_rows import doc_rows, make_docs, odd_rows, prose
from strata.llm import decontaminate as leaks

ITEM_SCHEMA = "item_id long, text string, words string, n string, key string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def shingles(ws):
    k = leaks.SHINGLE
    return {tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))} if ws else set()


def brute(docs, items):
    """Best weighted similarity of any item-sized window, for every pair that reaches the threshold."""
    weigh = lambda x: sum(len(w) for s in x for w in s)
    found = {}
    for d, text in docs.items():
        ws = words(text)
        for i, item in items.items():
            iw = words(item)
            for start in range(max(1, len(ws) - len(iw) + 1)) if iw and ws else []:
                a, b = shingles(ws[start : start + len(iw)]), shingles(iw)
                similarity = weigh(a & b) / weigh(a | b)
                if similarity >= leaks.SIMILARITY and similarity > found.get((d, i), (0, 0))[0]:
                    found[d, i] = (similarity, start)
    return found


def planted():
    items = {k: prose(9_000 + k, 20 + 3 * k).replace("\n", " ") for k in range(12)}
    items |= {50: "just four words here", 51: "", 52: None, 53: items[3], 54: "Quokka wombat", 55: "numbat"}
    rng = random.Random(3)
    docs = {k: prose(k, 120) for k in range(20)}
    for k in range(12):
        head, tail = prose(200 + k, rng.randrange(60)), prose(300 + k, rng.randrange(60))
        docs[100 + k] = f"{head}\n{items[k]}\n{tail}"
        docs[120 + k] = f"{head} {items[k].upper().replace(' ', '!  ')}. {tail}"
        part = items[k].split(" ")
        docs[140 + k] = f"{head} {' '.join(part[: len(part) // 2])} {tail}"  # half of it is no leak
        part[len(part) // 2] = "changed"
        docs[160 + k] = f"{head} {' '.join(part)} {tail}"
        docs[180 + k] = f"{head} {' '.join(part[1:])} {tail}"
    docs[200] = items[11]
    docs[201] = " ".join(items[11].split(" ")[1:])  # shorter than the item
    docs[202] = "Just four words, HERE"
    docs[204] = f"{prose(801, 70)} just four, words here {prose(802, 70)} quokka wombat"
    docs[205] = "numbat " + prose(803, 40) + " just four words"
    docs[206] = "wombat quokka\n" + prose(804, 30) + "\nnumbat"
    docs[207] = "Quokka"
    docs[203] = items[5] + "\n" + items[6] + "\n" + items[5]
    docs |= {300 + k: prose(700, 25) + "\n" + items[8] for k in range(40)}  # many of one passage
    return docs, items


def test_pairs_match_brute_force(spark):
    docs, items = planted()
    benchmark = spark.createDataFrame([(k, t, "x", "y", "z") for k, t in items.items()], ITEM_SCHEMA)
    got = leaks.find_leaks(make_docs(spark, doc_rows(docs)), benchmark).collect()
    found = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"]) for r in got}
    assert len(found) == len(got)
    expected = brute(docs, items)
    assert set(found) == set(expected)
    for pair, (similarity, start) in expected.items():
        assert found[pair][0] == pytest.approx(similarity) and found[pair][1] == start
    assert {(100 + k, k) for k in range(12)} <= set(found) and not {d for d, _ in found if d < 20 or 140 <= d < 160}
    assert (103, 53) in found and (202, 50) in found and (203, 6) in found
    assert {(204, 50), (204, 54), (205, 55), (206, 55)} <= set(found) and not {d for d, _ in found} & {207}
    kept = leaks.drop_leaks(make_docs(spark, doc_rows(docs)), benchmark)
    assert {r["doc_id"] for r in kept.collect()} == set(docs) - {d for d, _ in expected}


def test_block_index_finds_all_within_the_radius(spark):
    rng = random.Random(4)
    to_signed = lambda x: x - (1 << 64) if x >> 63 else x
    prints, near = [], []
    for k in range(6):
        f = rng.getrandbits(64)
        prints.append((k, 7, to_signed(f)))
        for j in range(25):
            bits = rng.sample(range(64), leaks.RADIUS if j else 0)
            near.append((k, 7, to_signed(f ^ sum(1 << b for b in bits))))
    items = spark.createDataFrame(prints, "item_no int, n int, fingerprint long")
    from pyspark.sql import functions as F

    probes = spark.createDataFrame(near, "of int, n int, fingerprint long").withColumn("no", F.monotonically_increasing_id())
    probes = probes.select("*", F.explode(leaks.block_values(F.col("fingerprint"))).alias("b")).select("no", "of", "n", "b.*")
    met = probes.join(leaks.item_index(items), ["n", "block", "value"]).filter("of = item_no").select("no").distinct()
    assert met.count() == len(near)


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    benchmark = spark.createDataFrame([(1, prose(1, 120), "x", "y", "z"), (None, prose(7, 60), "x", "y", "z")], ITEM_SCHEMA)
    got = {(r["doc_id"], r["item_id"]) for r in leaks.find_leaks(odd_docs, benchmark).collect()}
    assert got == {(1, 1), (6, 1), (None, None)}
    kept = leaks.drop_leaks(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 5, 8, 9]
    none = spark.createDataFrame([], ITEM_SCHEMA)
    assert leaks.find_leaks(odd_docs, none).count() == 0 and leaks.drop_leaks(odd_docs, none).count() == len(odd_rows())
    assert leaks.find_leaks(no_docs, benchmark).count() == 0
