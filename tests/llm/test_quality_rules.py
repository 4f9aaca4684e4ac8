from __future__ import annotations

import duckdb
import pandas as pd

from odd_rows import doc_rows, make_docs, odd_rows, prose
from strata.llm import quality_rules as quality
from strata.llm.oracle import ORACLES

FIGURES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def by_sql(rows):
    frame = pd.DataFrame([r[:5] for r in rows], columns=["doc_id", "text", "lang", "source", "n_chars"])
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("documents", frame.astype({"text": object}))
    return con.sql(ORACLES["op6_quality_rules"]).fetchall()


def same(spark, rows):
    got = [tuple(r) for r in quality.judge(make_docs(spark, rows)).select(*FIGURES).collect()]
    con = by_sql(rows)
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(got, key=key) == sorted(con, key=key)
    return {r[0]: r for r in got}


def test_odd_rows(spark):
    got = same(spark, odd_rows())
    assert got[2][1] == 0 and got[2][6] and not got[2][7]
    assert got[8][4] == 1  # lines are compared as they are, blanks included


def test_repeated_words(spark):
    texts = {
        1: "a b c a b c", 2: "a a a a", 3: "a b c d", 4: "a b", 5: "x y z " * 40, 6: "a b c d b c d e b c d",
        7: prose(1, 300, vocabulary=12), 8: "a b c\na b c\td a b\x0bc", 9: "A b c a B c a b C",
    }
    got = same(spark, doc_rows(texts))
    assert got[1][5] == 6 and got[2][5] == 4 and got[3][5] == 0 and got[5][6]


def boilerplate_rows():
    rows = []
    for k in range(60):
        text = "Buy  our\tcookies NOW\n" + prose(k, 70)
        source = "shop" if k < 40 else "blog"
        rows.append((k, text, "en", source, len(text), *doc_rows({0: "x"})[0][5:]))
    for k in range(60, 70):  # little but boilerplate
        text = "buy our cookies now\n" * 20 + "\n".join(prose(k, 10).split("\n"))
        rows.append((k, text, "en", "shop", len(text), *doc_rows({0: "x"})[0][5:]))
    for k in range(70, 80):
        text = "buy our cookies now\n" + prose(k, 70)
        rows.append((k, text, "en", None if k < 75 else "rare", len(text), *doc_rows({0: "x"})[0][5:]))
    return rows


def test_lines_that_a_host_repeats(spark):
    rows = boilerplate_rows()
    got = same(spark, rows)
    assert all(got[k][7] for k in range(60)) and not any(got[k][7] for k in range(60, 70))
    docs = make_docs(spark, rows)
    cleaned = quality.clean_documents(docs)
    assert cleaned.columns == docs.columns
    out = {r["doc_id"]: r for r in cleaned.collect()}
    assert set(out) == {k for k, r in got.items() if r[7]}
    assert out[3]["text"] == prose(3, 70) and out[3]["n_chars"] == len(prose(3, 70))
    assert out[72]["text"] == rows[72][1]  # too few documents of its host have the line
    assert out[50]["text"] == prose(50, 70) and out[3]["host"] == "h"


def test_copies_make_no_boilerplate(spark):
    # Thirty near copies, each with a line of its own; three of them also hold the line of other documents.
    base = "\n".join(f"line {k} says {prose(k, 9)}".replace("\n", " ") for k in range(12))
    texts = {k: f"{base}\nonly copy number {k} says so" for k in range(30)}
    texts |= {k: f"All rights   reserved\n{prose(k, 80)}" for k in range(30, 50)}
    texts |= {k: f"{texts[k]}\nall rights reserved" for k in range(3)}
    rows = doc_rows(texts)
    got = same(spark, rows)
    assert all(r[7] for r in got.values())
    out = {r["doc_id"]: r["text"] for r in quality.clean_documents(make_docs(spark, rows)).collect()}
    assert out[5] == texts[5] and out[40] == prose(40, 80)
    assert out[1] == texts[1].removesuffix("\nall rights reserved")


def test_limits(spark):
    texts = {k: f"seen by many here\n{prose(k, 80)}" for k in range(12)}
    docs = make_docs(spark, doc_rows(texts))
    dropped = lambda **o: sum(r["dropped"] is not None for r in quality.judge(docs, **o).collect())
    assert dropped() == 12 and dropped(line_docs=12) == 12 and dropped(line_docs=13) == 0
    assert dropped(line_share=0.99) == 12 and dropped(line_share=1.0) == 0 and dropped(own_share=0.01) == 0


def test_repeated_rows_count_once(spark):
    line = "the very same line of words"
    rows = [r for r in doc_rows({1: line + "\n" + prose(1, 80)}) for _ in range(30)]
    got = quality.judge(make_docs(spark, rows)).collect()
    assert len(got) == 30 and all(r["kept"] and r["dropped"] is None for r in got)


def test_empty_table(no_docs):
    assert quality.judge(no_docs).count() == 0 and quality.clean_documents(no_docs).count() == 0
