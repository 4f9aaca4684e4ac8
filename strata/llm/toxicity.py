"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the average of the embeddings of its hashed byte n-grams, a window
the average of its words, and a linear softmax turns a window into a
probability; a document scores as its worst window does, so that one insult
counts as much in a long text as in a short one. Embeddings and softmax are
learned together from document labels. A misspelling or an unseen inflection
shares most n-grams with words that were seen.

Learning takes a sample of labelled documents whose size is a parameter
(``SAMPLE_PER_CLASS``; the smallest hashes of the ids of each class, the
clean class times ``CLEAN_TIMES``; of these, in the same order, as many as
have ``SAMPLE_BYTES`` together, none longer than ``LONGEST_BYTES``), in one
task, one text an id. Scoring runs over all texts, map-only, with one number
per n-gram bucket.

Cases: a null or empty text has an empty window and scores the bias alone;
several labels of one document count as toxic if one does; of several rows of
one id the text with the smallest hash is learned from; without a toxic
label nothing can be learned and every score is under 1e-300; repeated rows and null
ids are scored one by one; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.text import ALNUM_LOWER, forget, fresh, id_bucket, remembered
from strata.session import stage_table

#: Labelled documents to learn from: toxic ones, and times as many clean ones.
SAMPLE_PER_CLASS = 4_096
CLEAN_TIMES = 2
#: Bytes of text to learn from, toxic and clean together, and of one document at most.
SAMPLE_BYTES = 24 << 20
LONGEST_BYTES = 1 << 20
FOLDS, HELD_OUT_FOLD = 5, 0

BUCKETS = 1 << 18
GRAMS = (3, 4, 5, 6)
DIMENSIONS = 8
WINDOW = 12
STEPS = 80
RATE = 4.0
DECAY = 1e-4
#: Documents at which an n-gram's own evidence counts half, and what that evidence weighs at the start.
RELIABLE_FROM = 20.0
START = 3.0
#: Size of the random vectors that embeddings start from.
INIT = 1.0
#: Words whose figure a worker process keeps.
MEMO_WORDS = 600_000
NO_TOXIC_BIAS = -800.0


def words_in(text: str | None) -> list[bytes]:
    """Lower-cased letters-and-digits words."""
    return (text or "").lower().encode("utf-8").translate(ALNUM_LOWER).split()


def word_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the n-grams of every ``<word>``, and where each word's begin.

    All words are hashed at once, as one run of bytes; an n-gram that would
    cross the end of its word is left out.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    data = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(starts + sizes, sizes) - np.arange(len(data))  # bytes up to the word's end
    hashed = np.zeros(len(data), np.uint64)
    buckets, owners = [], []
    mix, gold = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
    for n in range(1, max(GRAMS) + 1):
        shifted = data[n - 1 :]
        hashed = hashed[: len(shifted)] * mix + shifted + np.uint64(1)
        if n in GRAMS:
            valid = left[: len(shifted)] >= n
            mixed = (hashed[valid] * gold) >> np.uint64(64 - BUCKETS.bit_length() + 1)
            buckets.append(mixed.astype(np.int32))
            owners.append(owner[: len(shifted)][valid])
    bucket, who = np.concatenate(buckets), np.concatenate(owners)
    order = np.argsort(who, kind="stable")
    return bucket[order], np.searchsorted(who[order], np.arange(len(words) + 1))


def word_scores(words: list[bytes], weight: np.ndarray) -> np.ndarray:
    """Average weight of the n-grams of each word (each has at least ``<x>``)."""
    if not words:
        return np.zeros(0)
    buckets, bounds = word_grams(words)
    return np.add.reduceat(weight[buckets].astype(np.float64), bounds[:-1]) / np.diff(bounds)


@dataclass
class Model:
    embedding: np.ndarray  # buckets x dimensions
    softmax: np.ndarray  # classes (clean, toxic) x dimensions
    bias: float

    @property
    def weight(self) -> np.ndarray:
        """What a bucket adds to the log odds of the toxic class."""
        return (self.embedding @ (self.softmax[1] - self.softmax[0])).astype(np.float32)


def window_bounds(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows of texts with so many words, and the windows' texts."""
    n = np.maximum(1, -(-counts // WINDOW))
    text = np.repeat(np.arange(len(counts)), n)
    k = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    first = np.repeat(np.cumsum(counts) - counts, n) + k * WINDOW
    return first, text


def window_means(z: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean word score of every window (0 for an empty text's), and the windows' texts."""
    first, text = window_bounds(counts)
    total = np.concatenate(([0.0], np.cumsum(z)))
    end = np.minimum(first + WINDOW, np.cumsum(counts)[text])
    return (total[end] - total[first]) / np.maximum(1, end - first), text


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> Model:
    """Full-batch training of embeddings and softmax together.

    Embeddings start as random vectors, to which is added, along the softmax'
    own direction, how much oftener an n-gram stands in toxic texts. In the
    first steps a text's log odds are a mean over its windows, later more and
    more those of its worst one. With two classes the gradient of an
    embedding is a number times the difference of the softmax' rows, which
    turn as the embeddings pull them; so a step is a few sums over words and
    n-grams. What few texts hold is held back, here and in every step, else
    single texts would be learned by heart.
    """
    rng = np.random.default_rng(seed)
    softmax = rng.normal(size=(2, DIMENSIONS))
    softmax /= np.linalg.norm(softmax[1] - softmax[0])
    labels = np.asarray(labels, dtype=np.float64)
    if not len(labels) or labels.max() == 0:
        return Model(np.zeros((BUCKETS, DIMENSIONS)), softmax, NO_TOXIC_BIAS)
    index: dict[bytes, int] = {}
    parts = []
    for text in texts:
        words = words_in(text)
        parts.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.int32, len(words)))
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    token = np.concatenate(parts)
    if not index:
        return Model(np.zeros((BUCKETS, DIMENSIONS)), softmax, 0.0)
    buckets, bounds = word_grams(list(index))
    grams = np.diff(bounds)
    gram_word = np.repeat(np.arange(len(index), dtype=np.int32), grams)
    first, text_of = window_bounds(counts)
    ends = np.minimum(first + WINDOW, np.cumsum(counts)[text_of])
    sizes = np.maximum(1, ends - first)
    window_of = np.repeat(np.arange(len(first), dtype=np.int32), ends - first)
    begins = np.concatenate(([0], np.flatnonzero(np.diff(text_of)) + 1))
    balance = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum())) * len(labels)
    held = np.unique(np.repeat(np.arange(len(texts)), counts) * len(index) + token)
    by_label = [np.bincount(held % len(index), (labels == y)[held // len(index)], len(index)) for y in (0, 1)]
    clean, toxic = (np.bincount(buckets, n[gram_word], BUCKETS) for n in by_label)
    del held, parts
    reliable = (clean + toxic) / (clean + toxic + RELIABLE_FROM)
    odds = np.log((toxic + 0.5) / (labels.sum() + 1)) - np.log((clean + 0.5) / ((1 - labels).sum() + 1))
    embedding = rng.normal(scale=INIT / math.sqrt(DIMENSIONS), size=(BUCKETS, DIMENSIONS)) * np.sqrt(reliable)[:, None]
    embedding += np.outer(START * reliable * np.clip(odds, -3, 6), softmax[1] - softmax[0])
    bias, seen, seen_bias, seen_softmax = 0.0, np.full(BUCKETS, 1e-8), 1e-8, np.full(DIMENSIONS, 1e-8)
    for step in range(STEPS):
        direction = softmax[1] - softmax[0]
        weight = embedding @ direction
        z = np.add.reduceat(weight[buckets], bounds[:-1]) / grams
        odds = np.bincount(window_of, z[token], len(first)) / sizes
        sharp = 0.5 * step
        top = np.maximum.reduceat(odds, begins)[text_of]
        share = np.exp(np.maximum(-60.0, sharp * (odds - top)))
        share /= np.add.reduceat(share, begins)[text_of]
        if step >= STEPS // 2:  # the worst window alone, as in scoring
            share = (odds == top).astype(float)
            share /= np.add.reduceat(share, begins)[text_of]
        logit = np.add.reduceat(share * odds, begins) + bias
        wrong = (1.0 / (1.0 + np.exp(-np.clip(logit, -60, 60))) - labels) * balance / len(labels)
        by_window = wrong[text_of] * share / sizes
        by_word = np.bincount(token, by_window[window_of], len(index)) / grams
        slope = np.bincount(buckets, by_word[gram_word], BUCKETS)
        softmax_slope = embedding.T @ slope  # of the toxic row; the clean row's is its opposite
        slope_bias = wrong.sum()
        seen += slope**2
        seen_bias += slope_bias**2
        seen_softmax += softmax_slope**2
        embedding *= 1.0 - DECAY
        embedding -= np.outer(RATE * reliable * slope / np.sqrt(seen.max()), direction)
        turn = 0.05 * RATE * softmax_slope / np.sqrt(seen_softmax)
        softmax = softmax + np.outer([1.0, -1.0], turn)
        bias -= 0.2 * RATE * slope_bias / np.sqrt(seen_bias)
    return Model(embedding, softmax, float(bias))


class Scorer(dict):
    """Word -> its part in the log odds, for the words that this process has met."""

    def __init__(self, weight: np.ndarray, bias: float):
        super().__init__()
        self.weight, self.bias = weight, bias

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability that a text is toxic."""
        words = [words_in(t) for t in texts]
        if not texts:
            return np.zeros(0)
        new = list({w for ws in words for w in ws if w not in self})
        self.update(zip(new, word_scores(new, self.weight).tolist(), strict=True))
        counts = np.fromiter(map(len, words), np.int64, len(words))
        z = np.fromiter((self[w] for ws in words for w in ws), np.float64, int(counts.sum()))
        odds, text = window_means(z, counts)
        begins = np.concatenate(([0], np.flatnonzero(np.diff(text)) + 1))
        logit = np.maximum.reduceat(odds, begins) + self.bias
        if len(self) > MEMO_WORDS:
            self.clear()
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -700, 700)))


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(doc_id, text, toxic) of at most ``per_class`` toxic and ``CLEAN_TIMES`` as many clean documents.

    The ids are chosen first, from the labels; their number is bounded, so
    they are broadcast and no text is shuffled but those chosen.
    """
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .filter(id_bucket(F.col("doc_id"), FOLDS) != HELD_OUT_FOLD)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    toxic = known.filter("toxic = 1").orderBy(*order).limit(per_class)
    clean = known.filter("toxic = 0").orderBy(*order).limit(CLEAN_TIMES * per_class)
    chosen = toxic.unionByName(clean).withColumnsRenamed({"doc_id": "_id", "toxic": "_toxic"})
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    body = F.coalesce("text", F.lit(""))
    one = texts.groupBy("doc_id", "_toxic").agg(F.min(F.struct(F.xxhash64(body), body.alias("text"))).alias("_row"))
    found = stage_table(one.select("doc_id", "_row.text", F.col("_toxic").alias("toxic")), "toxicity_sample")[0]
    # Lengths alone are added up; there are at most as many rows as ids were chosen.
    sized = found.select("doc_id", "toxic", F.octet_length("text").alias("_size")).filter(F.col("_size") <= LONGEST_BYTES)
    upto = F.sum("_size").over(Window.partitionBy("toxic").orderBy(*order))
    share = F.when(F.col("toxic") == 1, SAMPLE_BYTES // (1 + CLEAN_TIMES)).otherwise(
        SAMPLE_BYTES * CLEAN_TIMES // (1 + CLEAN_TIMES)
    )
    kept = sized.withColumn("_upto", upto).filter(F.col("_upto") <= share).select("doc_id")
    return found.join(F.broadcast(kept), "doc_id", "left_semi")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple[np.ndarray, float]:
    """Bucket weights and bias, learned in one task from the bounded sample."""

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()  # what this worker keeps of other operators
        parts = list(batches)
        rows = pd.concat(parts) if parts else pd.DataFrame({"doc_id": [], "text": [], "toxic": []})
        rows = rows.sort_values(["doc_id", "text"], kind="stable")
        model = train(rows["text"].tolist(), rows["toxic"].to_numpy())
        yield pd.DataFrame({"weight": [model.weight.tobytes()], "bias": [model.bias]})

    sample = labelled_sample(docs, labels, per_class).repartition(1)
    found = sample.mapInPandas(learn, "weight binary, bias double").collect()
    if not found:  # an empty sample has no task to learn in
        return np.zeros(BUCKETS, np.float32), NO_TOXIC_BIAS
    return np.frombuffer(found[0]["weight"], np.float32), float(found[0]["bias"])


def scorer(weight: np.ndarray, bias: float) -> Scorer:
    """This process's scorer for a model; another model takes its place."""
    key = hashlib.sha1(weight.tobytes() + repr(bias).encode()).digest()
    return remembered(("toxicity", key), lambda: Scorer(weight, bias))


def with_scores(docs: DataFrame, weight: np.ndarray, bias: float, text: str = "text", name: str = "score") -> DataFrame:
    """Adds the score of ``text`` as a column to all others; map-only."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast((weight, bias))
    place = docs.columns.index(text)
    schema = docs.select("*", F.lit(0.0).cast("double").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = scorer(*model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                scores = pa.array(known.score(part.column(place).to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, scores], names=[*part.schema.names, name])

    return docs.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted class of every document."""
    weight, bias = fit(docs, labels, per_class)
    scored = with_scores(docs.select("doc_id", "text"), weight, bias)
    return scored.select(
        "doc_id", (id_bucket(F.col("doc_id"), FOLDS) == HELD_OUT_FOLD).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """The documents whose score is under 0.5, with all their columns."""
    weight, bias = fit(docs, labels, per_class)
    (name,) = fresh(docs.columns, "_toxic_score")
    return with_scores(docs, weight, bias, name=name).filter(F.col(name) < 0.5).drop(name)
