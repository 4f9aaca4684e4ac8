"""Ranked lexical search: Block-Max MaxScore over segments of an inverted index.

Index: documents are gathered into segments of bounded size, one row of a
table each. Inside a segment documents are numbered by rising length, so a
block of a posting list holds documents of like length. A list's postings are
cut into blocks of ``BLOCK`` and compressed (gaps and counts as variable
bytes); beside each block stand its last document, its largest count and its
shortest document. These two bound every score in the block whatever the
corpus' size and mean length, so segments can be added without a rewrite.

Search: the weights of a block of queries are sent to the tasks, which go
through their segments one after the other and keep a heap for each query. A
list's bound is the largest of its blocks. Lists are sorted by bound; the
longest run of the smallest whose sum stays under the heap's threshold is
non-essential: no document that is only there can enter. Essential lists are
read whole; of the others, block maxima reject candidates before a block is
decompressed. Heaps are merged by one window per query.

All figures are whole numbers, so equal scores are equal; ties are broken by
the smaller doc_id (null last). A query holds each of its terms once.

Cases: null and empty texts have no term, are no part of N and can't be
found; a text of any length is split in pieces at separators; repeated rows
are documents of their own; the rows of one item_id are one query, a null id
being an id; a query without terms has no rows; empty tables give none. Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.text import ALNUM_LOWER, raw
from strata.session import stage_table

TOP = 10
BLOCK = 128
SEGMENT_DOCS = 4_096
SEGMENT_TERMS = 8_000_000
PIECE = 1 << 20
#: Distinct terms of all queries up to which an index made for them holds no other lists.
VOCABULARY_LIMIT = 1_000_000
#: (query, term) pairs that are searched for at once.
PAIRS_AT_ONCE = 500_000

SEGMENT = (
    "docs array<bigint>, lengths array<int>, terms array<string>, postings array<int>, blocks array<int>, "
    "last array<int>, top array<int>, low array<int>, at array<int>, data binary"
)


def pieces(text: bytes) -> Iterator[bytes]:
    """The text in parts of about ``PIECE`` bytes, cut at blanks."""
    at = 0
    while len(text) - at > PIECE:
        cut = text.find(b" ", at + PIECE)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def term_counts(text: str | None, wanted: frozenset | None = None) -> tuple[int, Counter]:
    """How many terms a text has, and how often each (wanted) one occurs."""
    n, counts = 0, Counter()
    for piece in pieces(raw(text).translate(ALNUM_LOWER)):
        words = piece.split()
        n += len(words)
        counts.update(words if wanted is None else filter(wanted.__contains__, words))
    return n, counts


# ---------------------------------------------------------------------------
# Compressed lists
# ---------------------------------------------------------------------------


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variable bytes (7 bits each, the top bit marks a last one) and where each value begins."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for k in range(1, 5):
        size += values >= np.uint64(1 << (7 * k))
    begin = np.concatenate(([0], np.cumsum(size)))
    out = np.zeros(int(begin[-1]), np.uint8)
    for k in range(5):
        has = size > k
        part = (values[has] >> np.uint64(7 * k)).astype(np.uint8) & 0x7F
        part[size[has] == k + 1] |= 0x80
        out[begin[:-1][has] + k] = part
    return out, begin


def unpack(data: np.ndarray) -> np.ndarray:
    """The values of whole variable bytes."""
    ends = np.flatnonzero(data & 0x80)
    if len(ends) == len(data):
        return (data & 0x7F).astype(np.int64)
    first = np.concatenate(([0], ends[:-1] + 1))
    place = np.arange(len(data)) - np.repeat(first, ends - first + 1)
    return np.add.reduceat((data & 0x7F).astype(np.int64) << (7 * place), first)


def build_segment(docs: list, lengths: list[int], counts: list[Counter]) -> dict:
    """The row of one segment; documents without a term are left out by the caller."""
    order = sorted(range(len(docs)), key=lambda k: lengths[k])
    terms: dict[bytes, int] = {}
    sizes = np.fromiter((len(counts[k]) for k in order), np.int64, len(order))
    total = int(sizes.sum())
    term = np.fromiter((terms.setdefault(w, len(terms)) for k in order for w in counts[k]), np.int64, total)
    tf = np.fromiter((c for k in order for c in counts[k].values()), np.int64, total)
    doc = np.repeat(np.arange(len(order)), sizes)
    long = np.array([lengths[k] for k in order], np.int64)
    by_term = np.argsort(term, kind="stable")  # documents stay in order
    term, tf, doc = term[by_term], tf[by_term], doc[by_term]
    postings = np.bincount(term, minlength=len(terms))
    begin = np.cumsum(postings) - postings
    inside = np.arange(total) - np.repeat(begin, postings)
    starts = np.flatnonzero(inside % BLOCK == 0)
    ends = np.append(starts[1:], total)
    gap = np.diff(doc, prepend=0)
    gap[starts] = doc[starts]
    # Of every block first the gaps, then the counts.
    block = np.repeat(np.arange(len(starts)), ends - starts)
    place = np.arange(total) + starts[block]
    values = np.empty(2 * total, np.int64)
    values[place] = gap
    values[place + (ends - starts)[block]] = tf
    data, where = pack(values)
    return {
        "docs": [docs[k] for k in order], "lengths": long.astype(np.int32), "terms": [w.decode() for w in terms],
        "postings": postings.astype(np.int32), "blocks": (-(-postings // BLOCK)).astype(np.int32),
        "last": doc[ends - 1].astype(np.int32) if total else [],
        "top": np.maximum.reduceat(tf, starts).astype(np.int32) if total else [],
        "low": np.minimum.reduceat(long[doc], starts).astype(np.int32) if total else [],
        "at": where[2 * starts].astype(np.int32), "data": data.tobytes(),
    }


def build_index(docs: DataFrame, wanted: frozenset[bytes] | None = None) -> DataFrame:
    """One row for each segment of the index; map-only. ``wanted``: the terms that get a list (default: all)."""
    spark = docs.sparkSession
    schema = spark.createDataFrame([], SEGMENT).schema
    arrow = pa.schema([
        ("docs", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("terms", pa.list_(pa.string())),
        *[(c, pa.list_(pa.int32())) for c in ("postings", "blocks", "last", "top", "low", "at")], ("data", pa.binary()),
    ])
    known = spark.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, counts, terms = [], [], [], 0

        def closed() -> pa.RecordBatch:
            row = build_segment(ids, lengths, counts)
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in arrow], schema=arrow)

        for batch in batches:
            for k in range(batch.num_rows):
                n, found = term_counts(batch.column(1)[k].as_py(), known.value)
                if not n:
                    continue
                ids.append(batch.column(0)[k].as_py())
                lengths.append(n)
                counts.append(found)
                terms += n
                if len(ids) >= SEGMENT_DOCS or terms >= SEGMENT_TERMS:
                    yield closed()
                    ids, lengths, counts, terms = [], [], [], 0
        if ids:
            yield closed()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


# ---------------------------------------------------------------------------
# Search
# ---------------------------------------------------------------------------


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Corpus:
    """N and L: documents with a term, and all their terms."""

    docs: int
    terms: int

    def impact(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        """A posting's part of a score, before its term's weight; grows with tf, falls with the length."""
        m = 10 + (90 * length * self.docs) // self.terms
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Segment:
    """The lists of one segment, for as long as it is searched."""

    def __init__(self, row: dict, corpus: Corpus, known: dict[str, int]):
        self.corpus = corpus
        self.docs = row["docs"]
        self.lengths = row["lengths"].astype(np.int64)
        self.data = np.frombuffer(row["data"], np.uint8)
        ends = np.cumsum(row["blocks"].astype(np.int64))
        self.at = np.append(row["at"].astype(np.int64), len(self.data))
        self.last = row["last"].astype(np.int64)
        self.block_bound = corpus.impact(row["top"].astype(np.int64), row["low"].astype(np.int64)) if len(self.last) else self.last
        self.lists: dict[int, tuple[int, int, int]] = {}  # term -> first block, one past the last, postings
        for term, size, n, end in zip(row["terms"], row["postings"].tolist(), row["blocks"].tolist(), ends.tolist(), strict=True):
            if term in known:
                self.lists[known[term]] = (end - n, end, size)
        self.bounds = {t: int(self.block_bound[a:b].max()) for t, (a, b, _) in self.lists.items()}
        self.whole: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.unpacked = 0

    def read(self, term: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of some blocks of a list, in order."""
        first, end, size = self.lists[term]
        counts = np.full(end - first, BLOCK)
        counts[-1] = size - BLOCK * (end - first - 1)
        counts = counts[chosen]
        self.unpacked += len(chosen)
        values = unpack(np.concatenate([self.data[self.at[first + b] : self.at[first + b + 1]] for b in chosen.tolist()]))
        begin = np.cumsum(2 * counts) - 2 * counts
        place = np.arange(int(counts.sum())) + np.repeat(begin - (np.cumsum(counts) - counts), counts)
        gaps = values[place]
        total = np.cumsum(gaps)
        starts = np.cumsum(counts) - counts
        base = np.concatenate(([0], total))[starts]
        doc = total - np.repeat(base, counts)
        return doc, self.corpus.impact(values[place + np.repeat(counts, counts)], self.lengths[doc])

    def read_whole(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        if term not in self.whole:
            first, end, _ = self.lists[term]
            self.whole[term] = self.read(term, np.arange(end - first))
        return self.whole[term]

    def search(self, query: list[tuple[int, int]], floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents whose score is at least ``floor`` (and over 0), and those scores."""
        parts = sorted((w * self.bounds[t], t, w) for t, w in query if w and t in self.lists)
        below, essential = 0, 0
        while essential < len(parts) and below + parts[essential][0] < floor:
            below += parts[essential][0]
            essential += 1
        if essential == len(parts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        score = np.zeros(len(self.docs), np.int64)
        for _, term, w in parts[essential:]:
            doc, impact = self.read_whole(term)
            score[doc] += w * impact
        found = np.flatnonzero((score > 0) & (score + below >= floor))
        score = score[found]
        for bound, term, w in reversed(parts[:essential]):
            below -= bound  # what the lists after this one can still add
            first, end, _ = self.lists[term]
            block = np.searchsorted(self.last[first:end], found)
            inside = block < end - first
            most = np.where(inside, w * self.block_bound[first + np.minimum(block, end - first - 1)], 0)
            stays = score + most + below >= floor
            found, score, block, inside = found[stays], score[stays], block[stays], inside[stays]
            if not inside.any():
                continue
            if term in self.whole:
                doc, impact = self.whole[term]
            else:
                doc, impact = self.read(term, np.unique(block[inside]))
            place = np.minimum(np.searchsorted(doc, found), len(doc) - 1)
            score = score + np.where(inside & (doc[place] == found), w * impact[place], 0)
        good = (score >= floor) & (score > 0)
        return found[good], score[good]


class Heaps:
    """The best documents of every query so far."""

    def __init__(self, queries: int, top: int):
        self.top = top
        self.best: list[list[tuple]] = [[] for _ in range(queries)]

    def floor(self, query: int) -> int:
        """The least score that can still enter."""
        best = self.best[query]
        return -best[-1][0] if len(best) == self.top else 1

    def add(self, query: int, docs: list, scores: list[int]) -> None:
        rows = self.best[query] + [(-s, d is None, d) for d, s in zip(docs, scores, strict=True)]
        rows.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        self.best[query] = rows[: self.top]


def search_segments(rows: Iterator[dict], queries: list[list[tuple[int, int]]], known: dict[str, int], corpus: Corpus,
                    top: int) -> Heaps:
    """Heaps of all queries over some segments, one segment in memory at a time."""
    heaps = Heaps(len(queries), top)
    for row in rows:
        segment = Segment(row, corpus, known)
        for k, query in enumerate(queries):
            found, score = segment.search(query, heaps.floor(k))
            if len(found) > 4 * top:  # only the best can enter; ties at the edge stay
                edge = np.partition(score, len(score) - top)[len(score) - top]
                found, score = found[score >= edge], score[score >= edge]
            if len(found):
                heaps.add(k, [segment.docs[i] for i in found.tolist()], score.tolist())
    return heaps


def segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {}
            for name, column in zip(batch.schema.names, batch.columns, strict=True):
                cell = column[k]
                if name in ("docs", "terms", "data"):
                    row[name] = cell.as_py()
                else:
                    row[name] = cell.values.to_numpy(zero_copy_only=False)
            yield row


def search_index(index: DataFrame, weights: DataFrame, corpus: Corpus, n_blocks: int, top: int = TOP) -> DataFrame:
    """The best documents of every query: item_id, rank, doc_id, score.

    ``weights`` is a table (item_id, part, term, weight); the queries of a
    part, at most about ``PAIRS_AT_ONCE`` pairs, are broadcast together.
    """
    spark = index.sparkSession
    results = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for part in range(n_blocks):
        items: dict = {}
        known: dict[str, int] = {}
        for r in weights.where(F.col("part") == part).select("item_id", "term", "weight").collect():
            items.setdefault(r["item_id"], []).append((known.setdefault(r["term"], len(known)), r["weight"]))
        sent = spark.sparkContext.broadcast((list(items), [sorted(q) for q in items.values()], known))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, queries, terms = sent.value
            heaps = search_segments(segment_rows(batches), queries, terms, corpus, top)
            rows = [(i, d, -s) for i, best in zip(ids, heaps.best, strict=True) for s, _, d in best]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])

        results = results.unionByName(index.mapInArrow(run, "item_id long, doc_id long, score long"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = results.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def query_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                terms = sorted(term_counts(batch.column(1)[k].as_py())[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[k].as_py()] * len(terms), pa.int64()), pa.array([t.decode() for t in terms], pa.string())],
                    names=["item_id", "term"],
                )

    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "item_id long, term string").distinct()


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Every item's best documents over an index that is made for the items' terms."""
    pairs, counted = stage_table(query_terms(items), "search_queries", {"pairs": F.count(F.lit(1))})
    vocabulary, known = stage_table(pairs.select("term").distinct(), "search_terms", {"terms": F.count(F.lit(1))})
    wanted = None
    if known["terms"] <= VOCABULARY_LIMIT:
        wanted = frozenset(r["term"].encode() for r in vocabulary.collect())
    sizes = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    index, totals = stage_table(
        build_index(docs, wanted), "search_index",
        {"docs": F.sum(F.size("docs")), "terms": F.sum(sizes)},
    )
    corpus = Corpus(int(totals["docs"] or 0), int(totals["terms"] or 0))
    lists = index.select(F.explode(F.arrays_zip("terms", "postings")).alias("list"))
    df = lists.groupBy(F.col("list.terms").alias("term")).agg(F.sum("list.postings").alias("df"))
    n_docs = corpus.docs
    exact = F.floor(1000 * F.log((F.lit(2.0) * n_docs + 2) / (F.lit(2.0) * F.col("df") + 1)))
    n_blocks = -(-counted["pairs"] // PAIRS_AT_ONCE)
    weights = pairs.join(df, "term").select(
        "item_id", "term", exact.alias("weight"), F.pmod(F.xxhash64("item_id"), F.lit(max(1, n_blocks))).alias("part")
    )
    return search_index(index, stage_table(weights, "search_weights")[0], corpus, n_blocks, top)
