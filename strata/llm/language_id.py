"""Language identification by Bayesian fusion of four kinds of evidence.

* Text: hashed byte trigrams, naive Bayes, learned from all documents that
  state a language. A page's likelihood is tempered to that of ``TEMPER``
  trigrams, since neighbouring trigrams aren't independent.
* Markup: the language that the page declares.
* Address: the last label of its host.
* Host: how its other pages read, smoothed towards its domain's pages, and
  these towards all pages.

How far a declaration or an address suffix is to be believed, and the host
priors, come from one grouped aggregation each over the pages' text
posteriors. Per host and per domain there is one row of sums, so a host with
a third of all pages is one row a task before anything is shuffled.

Cases: a null or empty html has no text evidence and declares nothing; a
null url has host '' and suffix ''; without documents that state a language
there is none to choose and the result is null; repeated rows are judged one
by one and each counts; an empty table gives no rows.
"""

from __future__ import annotations

import html as html_text
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.text import lower_ascii
from strata.session import stage_table

BUCKETS = 1 << 16
TEMPER = 12.0
SMOOTHING = 0.5
#: Pages that a domain's prior weighs in a host's, and the prior of all pages in a domain's.
HOST_WEIGHT, DOMAIN_WEIGHT = 8.0, 8.0
#: Pages that a declaration's or suffix's share of all pages weighs in each language's count.
EVIDENCE_SMOOTHING = 1.0
NONE = ""

TAGS = re.compile(r"<[^>]*>")
OPENER = re.compile(r"<(?:!--|(script|style|html)\b)", re.I | re.A)
CLOSER = {kind: re.compile(rf"</{kind}\s*>", re.I | re.A) for kind in ("script", "style")}
LANG = re.compile(r"\blang\s*+=\s*+[\"']?+\s*+([a-z]{2,3})\b", re.I | re.A)
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def page_parts(page: str) -> tuple[list[tuple[int, int]], str]:
    """Places of scripts, styles and comments, and the language that the page's html tag declares.

    One pass forward, linear in the page: what has no end once has none later
    on, and a tag that declares nothing is not searched again. What scripts,
    styles and comments hold declares nothing.
    """
    spans, endless, lang, searched, at = [], set(), NONE, 0, 0
    while opener := OPENER.search(page, at):
        kind = (opener.group(1) or "").lower()
        at = opener.end()
        if kind == "html":
            if not lang and opener.start() >= searched:
                end = page.find(">", at)
                searched = len(page) if end < 0 else end
                found = LANG.search(page, at, searched)
                lang = found.group(1).lower() if found else NONE
        elif kind not in endless:
            if kind:
                closer = CLOSER[kind].search(page, at)
                end = closer.end() if closer else -1
            else:
                end = page.find("-->", at)
                end = end + 3 if end >= 0 else -1
            if end < 0:
                endless.add(kind)
            else:
                spans.append((opener.start(), end))
                at = end
    return spans, lang


def page_text(page: str | None) -> str:
    """Text of a page without scripts, styles, comments and tags."""
    page = page or ""
    kept, at = [], 0
    for start, end in page_parts(page)[0]:
        kept.append(page[at:start])
        at = end
    text = " ".join([*kept, page[at:]])
    last = text.rfind(">") + 1  # behind it no tag ends
    text = TAGS.sub(" ", text[:last]) + text[last:]
    return html_text.unescape(text) if "&" in text else text


def declared_language(page: str | None) -> str:
    return page_parts(page or "")[1]


def trigrams(text: str | None) -> np.ndarray:
    """Bucket of every byte trigram of a text's letters; words are one blank apart."""
    data = b" " + b" ".join((text or "").lower().encode("utf-8").translate(LETTERS).split()) + b" "
    if len(data) < 3:
        return np.zeros(0, np.int64)
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all documents that state a language; a task sends each bucket once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                by_lang: dict[str, list[np.ndarray]] = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    by_lang.setdefault(lang, []).append(trigrams(text))
                for lang, found in by_lang.items():
                    table = tables.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    table += np.bincount(np.concatenate(found), minlength=BUCKETS)
        for lang, table in tables.items():
            at = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(table[at], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    named = docs.select(F.lower("lang").alias("lang"), "text").filter("lang is not null and lang <> ''")
    rows = named.mapInArrow(count, "lang string, bucket int, n long")
    return rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def learn_text_model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and the log likelihood of every bucket in each: one bounded row per language."""
    pdf = trigram_counts(docs).toPandas()
    langs = sorted(pdf["lang"].unique().tolist())
    table = np.zeros((len(langs), BUCKETS))
    if langs:
        row = np.searchsorted(np.array(langs, dtype=object), pdf["lang"].to_numpy(dtype=object))
        table[row, pdf["bucket"].to_numpy()] = pdf["n"].to_numpy()
    table += SMOOTHING
    return langs, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def read_pages(pages: DataFrame, langs: list[str], likelihood: np.ndarray) -> DataFrame:
    """(page_id, host, declared, text_logs): the tempered log likelihood of each language."""
    id_type = pages.schema["page_id"].dataType.simpleString()
    shared = pages.sparkSession.sparkContext.broadcast(likelihood)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                logs, declared = [], []
                for page in part.column(2).to_pylist():
                    found = trigrams(page_text(page))
                    weight = min(1.0, TEMPER / len(found)) if len(found) else 0.0
                    logs.append((model[:, found].sum(axis=1, dtype=np.float64) * weight).tolist())
                    declared.append(declared_language(page))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(declared, pa.string()),
                     pa.array(logs, pa.list_(pa.float64()))],
                    names=["page_id", "host", "declared", "text_logs"],
                )

    return pages.select("page_id", host_of(F.col("url")).alias("host"), "html").mapInArrow(
        run, f"page_id {id_type}, host string, declared string, text_logs array<double>"
    )


def softmax(logs: Column) -> Column:
    parts = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(parts, lambda x: x / F.aggregate(parts, F.lit(0.0), lambda a, y: a + y))


def sums_by(rows: DataFrame, keys: list[str], n_langs: int, name: str) -> DataFrame:
    """Text posteriors of all pages of a group, summed per language."""
    sums = [F.sum(F.col("text_post")[k]).alias(f"_{k}") for k in range(n_langs)]
    grouped = rows.groupBy(*keys).agg(*sums)
    return grouped.select(*keys, F.array(*[F.col(f"_{k}") for k in range(n_langs)]).alias(name))


def identify_pages(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """Language, its probability, and what each kind of evidence says, for every page."""
    langs, likelihood = learn_text_model(docs)
    if not langs:
        none = F.lit(None)
        return pages.select(
            "page_id", host_of(F.col("url")).alias("host"), none.cast("string").alias("declared"),
            none.cast("string").alias("text_lang"), none.cast("string").alias("lang"),
            none.cast("double").alias("probability"),
        )
    n = len(langs)
    rows = read_pages(pages, langs, likelihood)
    rows = rows.withColumns({
        "suffix": F.regexp_extract("host", r"([^.]*)$", 1),
        "domain": F.regexp_extract("host", r"([^.]*\.?[^.]*)$", 1),
        "text_post": softmax(F.col("text_logs")),
    })
    rows, _ = stage_table(rows, "language_pages")

    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, y: a + y)
    all_pages = rows.agg(*[F.sum(F.col("text_post")[k]).alias(str(k)) for k in range(n)]).first()
    seen = np.array([all_pages[k] or 0.0 for k in range(n)])
    overall = F.array(*[F.lit(float(x)) for x in (seen + 1.0) / (seen.sum() + n)])
    by_lang = F.array(*[F.lit(float(x)) for x in seen])
    # P(declared | language) and P(suffix | language), smoothed by the value's share of all pages.
    share = lambda sums: EVIDENCE_SMOOTHING * total(sums) / F.lit(max(1.0, float(seen.sum())))
    believed = lambda sums: F.zip_with(
        sums, by_lang, lambda s, t: F.log((s + share(sums) + 1e-9) / (t + EVIDENCE_SMOOTHING))
    )
    markup = sums_by(rows, ["declared"], n, "sums").select(
        "declared",
        F.when(F.col("declared") == NONE, F.array_repeat(F.lit(0.0), n)).otherwise(believed(F.col("sums"))).alias("markup_logs"),
    )
    address = sums_by(rows, ["suffix"], n, "sums").select("suffix", believed(F.col("sums")).alias("address_logs"))
    domains = sums_by(rows, ["domain"], n, "domain_sums")
    hosts = sums_by(rows, ["host", "domain"], n, "host_sums")

    # A page's own posterior is taken out of its host's and its domain's sums.
    less = lambda a, b: F.zip_with(a, b, lambda x, y: F.greatest(x - y, F.lit(0.0)))
    priors = (
        rows.join(hosts, ["host", "domain"])
        .join(domains, "domain")
        .join(markup, "declared")
        .join(address, "suffix")
        .withColumn("d", less(F.col("domain_sums"), F.col("text_post")))
        .withColumn("h", less(F.col("host_sums"), F.col("text_post")))
    )
    domain_prior = F.zip_with(
        "d", overall, lambda s, p: (s + DOMAIN_WEIGHT * p) / (total(F.col("d")) + DOMAIN_WEIGHT)
    )
    fused = priors.withColumn("domain_prior", domain_prior)
    host_prior = F.zip_with(
        "h", "domain_prior", lambda s, p: (s + HOST_WEIGHT * p) / (total(F.col("h")) + HOST_WEIGHT)
    )
    fused = fused.withColumn("host_prior", host_prior)
    kinds = F.arrays_zip("text_logs", "markup_logs", "address_logs", "host_prior")
    logs = F.transform(
        kinds, lambda x: x["text_logs"] + x["markup_logs"] + x["address_logs"] + F.log(x["host_prior"])
    )
    fused = fused.withColumn("logs", logs).withColumn("posterior", softmax(F.col("logs")))
    names = F.array(*[F.lit(x) for x in langs])
    best = lambda x: F.element_at(names, F.array_position(x, F.array_max(x)).cast("int"))
    return fused.select(
        "page_id", "host", F.nullif("declared", F.lit(NONE)).alias("declared"),
        best(F.col("text_post")).alias("text_lang"), best(F.col("posterior")).alias("lang"),
        F.array_max("posterior").alias("probability"),
    )
