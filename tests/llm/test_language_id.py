from __future__ import annotations

import math
import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest

from odd_rows import make_docs
from strata.llm import language_id as language

SCHEMA = "page_id long, url string, html string, host string, declared string, logs string"
STEMS = {
    "en": "the and ing ion ther with ness ough ight ship".split(),
    "de": "der und ung schaft lich keit ßen über zwi pf".split(),
    "fr": "les des eau tion que été ille eux oir ment".split(),
}


def words(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def training(spark):
    rows = [(k, words(lang, 150, k), lang, "s", 1, *["x", 1, "k", 2.0, 3, 4, "y", 5, "h"])
            for k, lang in enumerate(["en", "de", "fr"] * 8)]
    rows += [(90, "no language", None, "s", 1, *rows[0][5:]), (91, None, "en", "s", 1, *rows[0][5:])]
    return make_docs(spark, rows)


def page(k, lang, declared, host, n=60):
    attr = f" lang='{declared}'" if declared else ""
    return (k, f"http://{host}/{k}", f"<HTML{attr}><script>the and the and</script><p>{words(lang, n, k) if n else ''}</p>", "x", "y", "z")


def page_rows():
    rows = [page(k, lang, lang, f"{lang}{k % 2}.example.{'de' if lang == 'de' else 'org'}")
            for k, lang in enumerate(["en", "de", "fr"] * 30)]
    rows += [page(200 + k, "fr", "en" if k % 2 else None, "fr1.example.org") for k in range(4)]
    rows += [page(300, "fr", None, "fr0.example.org", 0), page(301, "de", None, "new.example.de", 0)]
    rows += [page(302, "en", "xx", "unknown.host"), (303, None, None, "x", "y", "z"), (303, None, None, "x", "y", "z"),
             (None, "http://de0.example.de/", "", "x", "y", "z")]
    return rows


def brute_posterior(rows, langs, likelihood):
    """The same fusion, page by page in plain numbers."""
    import re

    n = len(langs)
    seen, post, info = np.zeros(n), [], []
    declared, suffix, domain, host = (defaultdict(lambda: np.zeros(n)) for _ in range(4))
    for _, url, html, *_ in rows:
        found = language.trigrams(language.page_text(html))
        weight = min(1.0, language.TEMPER / len(found)) if len(found) else 0.0
        logs = likelihood[:, found].sum(axis=1, dtype=float) * weight
        p = np.exp(logs - logs.max())
        p /= p.sum()
        m = re.match(r"(?s)^.*?://([^/?#:]*)", url or "")
        h = m.group(1).lower() if m else ""
        s, d, c = h.split(".")[-1], ".".join(h.split(".")[-2:]), language.declared_language(html)
        seen += p
        for table, key in ((declared, c), (suffix, s), (domain, d), (host, h)):
            table[key] += p
        post.append(p)
        info.append((logs, c, s, d, h))
    overall = (seen + 1) / (seen.sum() + n)
    out = []
    for p, (logs, c, s, d, h) in zip(post, info, strict=True):
        believed = lambda x: np.log((x + x.sum() / max(1.0, seen.sum()) + 1e-9) / (seen + 1.0))
        left = np.maximum(domain[d] - p, 0)
        prior = (left + language.DOMAIN_WEIGHT * overall) / (left.sum() + language.DOMAIN_WEIGHT)
        left = np.maximum(host[h] - p, 0)
        prior = (left + language.HOST_WEIGHT * prior) / (left.sum() + language.HOST_WEIGHT)
        total = logs + (believed(declared[c]) if c else 0) + believed(suffix[s]) + np.log(prior)
        q = np.exp(total - total.max())
        out.append((langs[int(np.argmax(q))], float(q.max() / q.sum())))
    return out


def test_fusion_matches_brute_force(spark):
    rows = page_rows()
    pages = spark.createDataFrame(rows, SCHEMA)
    got = language.identify_pages(pages, training(spark)).collect()
    langs, likelihood = language.learn_text_model(training(spark))
    assert langs == ["de", "en", "fr"]
    expected = brute_posterior(rows, langs, likelihood)
    key = lambda x: tuple((v is None, v) for v in x)
    found = sorted([(r["page_id"], r["lang"], round(r["probability"], 6)) for r in got], key=key)
    assert found == sorted([(r[0], lang, round(p, 6)) for r, (lang, p) in zip(rows, expected, strict=True)], key=key)
    by_id = {r["page_id"]: r for r in got}
    assert all(by_id[k]["lang"] == lang for k, lang in enumerate(["en", "de", "fr"] * 30))
    assert all(by_id[200 + k]["lang"] == "fr" for k in range(4))  # the text outweighs a wrong declaration
    assert by_id[300]["lang"] == "fr" and by_id[301]["lang"] == "de"  # no text: host, domain and suffix decide
    assert by_id[302]["lang"] == "en" and by_id[302]["declared"] == "xx" and by_id[None]["lang"] == "de"


def test_text_of_a_page():
    assert language.page_text("<p>a&amp;b<br>c</p><style>x</style><!-- y -->").split() == ["a&b", "c"]
    assert language.page_text(None) == ""
    assert language.declared_language('<!DOCTYPE html><html class="a" lang="EN-us">') == "en"
    assert language.declared_language("<html>") == "" and language.declared_language(None) == ""
    assert len(language.trigrams("")) == 0 and language.trigrams("Été").max() < language.BUCKETS


def test_nothing_to_learn_from_or_to_judge(spark, no_docs):
    pages = spark.createDataFrame(page_rows(), SCHEMA)
    got = language.identify_pages(pages, no_docs).collect()
    assert len(got) == len(page_rows()) and all(r["lang"] is None for r in got)
    assert language.identify_pages(spark.createDataFrame([], SCHEMA), training(spark)).count() == 0
    assert math.isfinite(language.SMOOTHING)


def test_declaration_behind_a_long_comment():
    comment = "<!-- " + "licence text, not <html lang='de'> " * 300 + "-->"
    assert len(comment) > 10_000
    for before in (comment, " " * 10_000, "<!DOCTYPE html [" + "<!ENTITY x 'y'>" * 700 + "]>", comment * 3):
        assert language.declared_language(before + "<html class='x' lang='fr'><p>text") == "fr"
    assert language.declared_language(comment + "<p>text") == language.NONE
    assert language.declared_language("<script>'<html lang=de>'</script><HTML LANG=En>") == "en"


def test_one_pass_equals_the_patterns_it_stands_for():
    scripts = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->", re.S | re.I)
    declared = re.compile(scripts.pattern + r"|<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]{2,3})\b", re.S | re.I)
    bits = ["<script", "</script >", "<style>", "</STYLE>", "<!--", "-->", "<html ", "lang = 'de'", "lang=fr", ">", "<p>", "x y",
            "<", "</html>", "&amp;", " lang", "=", "en-us", "<htmlx lang=it>", "\n", "<!-->", "<scripts>"]
    rng = random.Random(6)
    for _ in range(20_000):
        page = "".join(rng.choices(bits, k=rng.randint(1, 14)))
        plain = re.sub(r"<[^>]*>", " ", scripts.sub(" ", page)).replace("&amp;", "&")
        assert language.page_text(page) == plain, page
        found = next((x for x in declared.finditer(page) if x.group(2)), None)
        assert language.declared_language(page) == (found.group(2).lower() if found else language.NONE), page


@pytest.mark.parametrize("unit", ["<!--", "<html ", "<script ", "<style>", "<", "</script", "<html lang", "<html lang= ", " ", "&", "<!-- -->"])
def test_long_pages_of_one_kind_take_linear_time(unit):
    page = "<html lang=" + " " * 1_000 + unit * (1_000_000 // len(unit))
    began = time.process_time()
    language.page_text(page)
    language.declared_language(page)
    assert time.process_time() - began < 5
