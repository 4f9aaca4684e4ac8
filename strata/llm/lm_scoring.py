"""LM scoring with a probabilistic suffix tree over tokens.

Symbols: every frequent training token is a symbol; the others share one by
the last bytes of their spelling (again if frequent enough, else one for the
rest). Frequent is what occurs at least N^(2/3) / ``CONTEXTS`` times among N
training tokens, so that the symbols, and the contexts below, grow with the
corpus: there can be up to ``CONTEXTS`` * N^(1/3) of them. A token's probability is
that of its symbol after what came before, times its share in its symbol. In
a shared symbol the tokens not seen in training are one event, as in the
base score; its probability is that of tokens seen once (Good-Turing).

Tree: contexts of up to ``MAX_DEPTH`` symbols, counted level by level by
Spark over all training texts, which are written as symbols once. Candidates
are the frequent ones; an entry (context, next symbol) occurs at least
N^(2/3) / ``ENTRIES`` times. Places of one length don't overlap, so a level
has at most ``CONTEXTS`` * N^(1/3) contexts and ``ENTRIES`` * N^(1/3) entries
of 16 bytes: 2.6 million and 103 million at most for 100 TB of text (1.7e13
tokens), which is why the tree may be broadcast. A candidate becomes a state
if its next-symbol distribution diverges from that of its longest suffix
state by more than its entries cost. Distributions are smoothed by absolute
discounting towards that suffix state's; a token is scored by the longest
suffix of its history that is a state.

Counts: the count of every word of every text is needed, which no broadcast
holds. Texts are dealt into buckets of bounded size; each sends its distinct
words with its own counts, and gets back those that count elsewhere too. All
of the vocabulary takes part and none of it passes the driver, but for the
symbols. Words are compared by 64-bit hashes.

Cases: a null or empty text is its end token alone; a null id counts as ''
for the fold; repeated rows are scored, and counted, one by one; without
training texts counts are 0 and the tree is its root alone; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.text import LOWER_ASCII, id_bucket, remembered
from strata.session import stage_table

FOLDS, HELD_OUT_FOLD = 7, 2
MAX_DEPTH = 3
#: Most symbols, contexts of a level and entries of a level, as multiples of the cube root of the training tokens.
CONTEXTS = 100.0
ENTRIES = 4_000.0
#: Least divergence (nats a token) of a state from its suffix state.
MIN_DIVERGENCE = 0.005
DISCOUNT = 0.75
BUCKET_BYTES = 16 << 20
#: Words whose symbol a worker process keeps.
MEMO_WORDS = 600_000
#: Cells up to which a level's counts are kept as a whole table while texts are read.
TABLE_CELLS = 1 << 22
END, OTHER = 0, 1
#: Stands for the end of a text among its words; no UTF-8 text holds this byte.
CLOSE = b"\xff"


def least_count(total: float, most: float, share: float | None = None) -> float:
    """Fewest occurrences, so that ``most`` * total^(1/3) can have them; or a fixed share of all."""
    return max(2.0, share * total if share is not None else total ** (2 / 3) / most)


def closed_words(texts: list[bytes | None]) -> list[bytes]:
    """The words of texts that follow each other, each text closed by CLOSE."""
    return (b" " + CLOSE + b" ").join([*(t or b"" for t in texts), b""]).translate(LOWER_ASCII).split()


def word_hash(word: bytes) -> int:
    """64-bit hash as a signed number."""
    h = xxhash.xxh64_intdigest(word)
    return h - (1 << 64) if h >= 1 << 63 else h


def ending(word: bytes) -> int:
    """The last two bytes of a word as a number."""
    return int.from_bytes(word[-2:], "big")


class Alphabet(dict):
    """Word -> symbol, with the words met so far; and a word's share in its symbol."""

    def __init__(self, frequent: dict[int, int], shared: dict[int, int], size: np.ndarray, once: np.ndarray):
        super().__init__()
        self.frequent, self.shared = frequent, shared
        unseen = np.minimum(0.5, (once + 0.5) / (size + 1.0))
        self.unseen = np.where(size > 0, unseen, 1.0)
        self.size = np.maximum(size, 1.0)
        self.counts, self.once = size, once

    def __missing__(self, word: bytes) -> int:
        symbol = END if word == CLOSE else self.frequent.get(word_hash(word))
        if symbol is None:
            symbol = self.shared.get(ending(word), OTHER)
        if len(self) > MEMO_WORDS:
            self.clear()
        self[word] = symbol
        return symbol

    @property
    def symbols(self) -> int:
        return len(self.size)

    def __reduce__(self):
        return _alphabet, (self.frequent, self.shared, self.counts, self.once)

    def log_share(self, symbol: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 of a word's probability in its symbol; a frequent word is its symbol."""
        is_shared = (symbol >= OTHER) & (symbol < OTHER + 1 + len(self.shared))
        known = count / self.size[symbol] * (1.0 - self.unseen[symbol])
        return np.where(is_shared, np.log10(np.where(count > 0, np.maximum(known, 1e-300), self.unseen[symbol])), 0.0)


@dataclass
class Tree:
    """Nodes in order of depth: 0 leads nowhere, 1 is the root, longer contexts follow.

    A node's child is the context that one symbol more on the left makes.
    ``entries`` are node * symbols + next symbol, sorted, with the smoothed
    probability; what a state has no entry for is ``backoff`` times what its
    suffix state gives.
    """

    symbols: int
    first: list[int]  # first node of every depth, one past the last at the end
    child_keys: np.ndarray
    child_nodes: np.ndarray
    state: np.ndarray  # node -> itself or the longest suffix that is a state
    suffix: np.ndarray  # state -> the next shorter one
    backoff: np.ndarray
    root: np.ndarray
    entries: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    probs: np.ndarray = field(default_factory=lambda: np.zeros(0))
    root_children: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # by symbol

    @property
    def depth(self) -> int:
        return len(self.first) - 2

    def step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Children of nodes; 0 where there is none."""
        if not len(self.child_keys):
            return np.zeros(len(node), np.int64)
        key = node * self.symbols + symbol
        at = np.minimum(np.searchsorted(self.child_keys, key), len(self.child_keys) - 1)
        return np.where(self.child_keys[at] == key, self.child_nodes[at], 0)

    def contexts(self, symbols: np.ndarray, exact: int | None = None) -> np.ndarray:
        """Longest context before every symbol, or that of length ``exact`` (0: none).

        Texts follow each other, each closed by END; a context holds an END
        only as its first symbol, so none reaches into the text before.
        """
        padded = np.concatenate((np.zeros(self.depth + 1, np.int64), symbols))
        best = np.ones(len(symbols), np.int64)
        alive, node = np.arange(len(symbols)), np.ones(len(symbols), np.int64)
        for d in range(1, (self.depth if exact is None else exact) + 1):
            left = padded[alive + self.depth + 1 - d]
            node = self.root_children[left] if d == 1 else self.step(node, left)
            there = node > 0
            alive, node = alive[there], node[there]
            best[alive] = node
        if exact:
            out = np.zeros(len(symbols), np.int64)
            out[alive] = node
            return out
        return best

    def probability(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Probability of symbols after states."""
        out, factor = np.zeros(len(state)), np.ones(len(state))
        open_, at = np.arange(len(state)), state.copy()
        while len(open_):
            is_root = at == 1
            done = open_[is_root]
            out[done] = factor[done] * self.root[symbol[done]]
            open_, at = open_[~is_root], at[~is_root]
            if not len(open_):
                break
            key = at * self.symbols + symbol[open_]
            place = np.minimum(np.searchsorted(self.entries, key), max(0, len(self.entries) - 1))
            hit = self.entries[place] == key if len(self.entries) else np.zeros(len(key), bool)
            out[open_[hit]] = factor[open_[hit]] * self.probs[place[hit]]
            open_, at = open_[~hit], at[~hit]
            factor[open_] *= self.backoff[at]
            at = self.suffix[at]
        return out

    def log_probs(self, symbols: np.ndarray) -> np.ndarray:
        """log10 probability of every symbol of texts that follow each other."""
        return np.log10(np.maximum(1e-300, self.probability(self.state[self.contexts(symbols)], symbols)))


class Grower:
    """Builds the tree on the driver, from the counts of one level after another."""

    def __init__(self, symbol_counts: np.ndarray, min_share: float | None, min_divergence: float):
        self.n_symbols = len(symbol_counts)
        self.total = float(symbol_counts.sum())
        self.min_count = least_count(self.total, CONTEXTS, min_share)
        self.min_divergence = min_divergence
        root = (symbol_counts + 0.5) / (self.total + 0.5 * self.n_symbols)
        self.levels: list[list[tuple[int, ...]]] = [[()]]
        self.number: dict[tuple[int, ...], int] = {(): 1}
        none = np.zeros(0, np.int64)
        self.tree = Tree(
            self.n_symbols, [1, 2], none, none, np.array([0, 1]), np.array([0, 1]), np.array([0.0, 1.0]), root,
            root_children=np.zeros(self.n_symbols, np.int64),
        )

    def extend(self, contexts: list[tuple[int, ...]]) -> int:
        """Adds candidates of the next depth; ``add_level`` says which become states."""
        contexts = sorted(c for c in contexts if c[1:] in self.number and END not in c[1:])
        for c in contexts:
            self.number[c] = len(self.number) + 1
        self.levels.append(contexts)
        t = self.tree
        keys = [self.number[c[1:]] * self.n_symbols + c[0] for c in contexts]
        keys = np.concatenate((t.child_keys, np.array(keys, np.int64)))
        nodes = np.concatenate((t.child_nodes, np.array([self.number[c] for c in contexts], np.int64)))
        order = np.argsort(keys, kind="stable")
        t.child_keys, t.child_nodes = keys[order], nodes[order]
        t.first.append(t.first[-1] + len(contexts))
        for c in contexts if t.depth == 1 else ():
            t.root_children[c[0]] = self.number[c]
        return len(contexts)

    def add_level(self, context: np.ndarray, symbol: np.ndarray, count: np.ndarray, held: np.ndarray) -> None:
        """States of the deepest level: entries as three columns, and how often each context holds."""
        t, level = self.tree, self.levels[-1]
        base = t.first[-2]
        order = np.lexsort((symbol, context))
        context, symbol, count = context[order], symbol[order], count[order].astype(np.float64)
        suffix = np.array([t.state[self.number[c[1:]]] for c in level], np.int64)
        n = np.maximum(1.0, held.astype(np.float64))
        kept = np.bincount(context, count - DISCOUNT, len(level))
        backoff = np.maximum(1e-9, 1.0 - kept / n)
        longer = (count - DISCOUNT) / n[context]
        shorter = t.probability(suffix[context], symbol)
        probs = longer + backoff[context] * shorter
        gain = np.bincount(context, count * np.log(probs / np.maximum(1e-300, shorter)), len(level))
        rest = np.maximum(0.0, n - np.bincount(context, count, len(level)))
        gain += rest * np.log(backoff)
        entries = np.bincount(context, minlength=len(level))
        stays = (gain >= self.min_divergence * n) & (gain >= 0.5 * entries * np.log(n)) & (entries > 0)
        t.state = np.concatenate((t.state, np.where(stays, base + np.arange(len(level)), suffix)))
        t.suffix = np.concatenate((t.suffix, suffix))
        t.backoff = np.concatenate((t.backoff, backoff))
        mine = stays[context]
        t.entries = np.concatenate((t.entries, (base + context[mine]) * self.n_symbols + symbol[mine]))
        t.probs = np.concatenate((t.probs, probs[mine]))


def _alphabet(frequent: dict, shared: dict, size: np.ndarray, once: np.ndarray) -> Alphabet:
    """This process's alphabet: a worker that runs several tasks keeps its words' symbols."""
    key = ("lm_scoring", hash((tuple(frequent), tuple(shared), size.tobytes())))
    return remembered(key, lambda: Alphabet(frequent, shared, size, once))


def choose_symbols(counts: DataFrame, total: int, ends: int, min_share: float | None = None) -> Alphabet:
    """Symbols from the vocabulary: its frequent rows alone reach the driver."""
    words = counts.filter("first and all > 0")
    frequent_at = least_count(total, CONTEXTS, min_share)
    frequent = words.filter(F.col("all") >= frequent_at).select("word", "all").orderBy("word").collect()
    endings = (
        words.filter(F.col("all") < frequent_at)
        .groupBy("ending")
        .agg(F.sum("all").alias("n"), F.count(F.when(F.col("all") == 1, 1)).alias("once"))
    )
    rest = endings.filter(F.col("n") < frequent_at).agg(F.sum("n").alias("n"), F.sum("once").alias("once")).first()
    endings = endings.filter(F.col("n") >= frequent_at).orderBy("ending").collect()
    shared = {r["ending"]: OTHER + 1 + k for k, r in enumerate(endings)}
    start = OTHER + 1 + len(shared)
    size = [ends, rest["n"] or 0, *(r["n"] for r in endings), *(r["all"] for r in frequent)]
    once = [0, rest["once"] or 0, *(r["once"] for r in endings), *(0 for _ in frequent)]
    of = {r["word"]: start + k for k, r in enumerate(frequent)}
    return _alphabet(of, shared, np.array(size, np.float64), np.array(once, np.float64))


def symbol_texts(docs: DataFrame, alphabet: Alphabet) -> DataFrame:
    """``symbols`` of every text of ``docs``, closed by END."""
    shared = docs.sparkSession.sparkContext.broadcast(alphabet)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                texts = batch.column(0).slice(at, 2_000).cast(pa.binary()).to_pylist()
                words = closed_words(texts)
                symbols = np.fromiter(map(alphabet.__getitem__, words), np.int32, len(words))
                closed = np.concatenate(([0], np.flatnonzero(symbols == END) + 1)).astype(np.int32)
                rows = pa.ListArray.from_arrays(pa.array(closed, pa.int32()), pa.array(symbols, pa.int32()))
                yield pa.RecordBatch.from_arrays([rows], names=["symbols"])

    return docs.select("text").mapInArrow(read, "symbols array<int>")


def count_level(texts: DataFrame, depth: int, tree: Tree) -> DataFrame:
    """(code, n) over all texts: code is the context's number at its depth * symbols + next symbol.

    A task sums its texts before anything is shuffled.
    """
    shared = texts.sparkSession.sparkContext.broadcast(tree)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        cells = (tree.first[depth + 1] - tree.first[depth]) * tree.symbols
        table = np.zeros(cells, np.int64) if cells <= TABLE_CELLS else None
        codes, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: list[np.ndarray] = []

        def merged() -> None:
            nonlocal codes, sums
            found, n = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            codes, where = np.unique(np.concatenate((codes, found)), return_inverse=True)
            sums = np.bincount(where, np.concatenate((sums, n)), len(codes)).astype(np.int64)

        def add(code: np.ndarray) -> None:
            if table is not None:
                table[:] += np.bincount(code, minlength=cells)
                return
            waiting.append(code)
            if sum(map(len, waiting)) > 2_000_000:
                merged()

        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                symbols = batch.column(0).slice(at, 2_000).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                node = tree.contexts(symbols, exact=depth)
                there = node > 0
                add((node[there] - tree.first[depth]) * tree.symbols + symbols[there])
        if waiting:
            merged()
        if table is not None:
            codes = np.flatnonzero(table)
            sums = table[codes]
        for lo in range(0, len(codes), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes[lo : lo + 100_000], pa.int64()), pa.array(sums[lo : lo + 100_000], pa.int64())],
                names=["code", "n"],
            )

    return texts.select("symbols").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def learn_tree(
    docs: DataFrame,
    alphabet: Alphabet,
    max_depth: int = MAX_DEPTH,
    min_share: float | None = None,
    entry_share: float | None = None,
    min_divergence: float = MIN_DIVERGENCE,
) -> Tree:
    """The suffix tree of the texts of ``docs``."""
    grower = Grower(alphabet.counts, min_share, min_divergence)
    tree, size = grower.tree, grower.n_symbols
    frequent = [(int(k),) for k in np.flatnonzero(alphabet.counts >= min(grower.min_count, grower.total))]
    if alphabet.counts[END] and (END,) not in frequent:
        frequent.append((END,))  # the beginning of a text
    least = math.ceil(least_count(grower.total, ENTRIES, entry_share))
    texts, _ = stage_table(symbol_texts(docs, alphabet), "lm_symbols")
    for depth in range(1, max_depth + 1):
        if not grower.total or not grower.extend(frequent):
            break
        counts, _ = stage_table(count_level(texts, depth, tree), f"lm_level{depth}")
        held = counts.groupBy(F.floor(F.col("code") / size).alias("context")).agg(F.sum("n").alias("n")).toPandas()
        kept = counts.filter(F.col("n") >= least).toPandas()
        level = grower.levels[-1]
        n = np.zeros(len(level), np.int64)
        n[held["context"].to_numpy(np.int64)] = held["n"].to_numpy(np.int64)
        code, c = kept["code"].to_numpy(np.int64), kept["n"].to_numpy(np.int64)
        grower.add_level(code // size, code % size, c, n)
        often = code[c >= grower.min_count]
        frequent = [(*level[k], int(x)) for k, x in zip(often // size, often % size, strict=True) if x != END]
    return tree


@dataclass
class Bucket:
    """A bucket's texts as numbers of its distinct words; word 0 is the end of a text."""

    words: list[bytes]
    here: np.ndarray  # word -> its count in the bucket's training texts
    parts: list[np.ndarray]  # tokens of ``STEP`` texts after each other

    STEP = 1_000

    @classmethod
    def of(cls, table: pa.Table) -> Bucket:
        place: defaultdict[bytes, int] = defaultdict()
        place.default_factory = place.__len__  # a new word gets the next number
        place[CLOSE] = 0
        held = table["held_out"].to_numpy()
        parts, here = [], np.zeros(1, np.int64)
        for at in range(0, table.num_rows, cls.STEP):
            words = closed_words(table["text"].slice(at, cls.STEP).cast(pa.binary()).to_pylist())
            tokens = np.fromiter(map(place.__getitem__, words), np.int32, len(words))
            length = np.diff(np.flatnonzero(tokens == 0), prepend=-1)
            here = np.concatenate((here, np.zeros(len(place) - len(here), np.int64)))
            here += np.bincount(tokens[np.repeat(~held[at : at + cls.STEP], length)], minlength=len(here))
            parts.append(tokens)
        return cls(list(place), here, parts)

    def hashes(self) -> np.ndarray:
        """Hashes of the words, without the end."""
        found = map(xxhash.xxh64_intdigest, self.words[1:])
        return np.fromiter(found, np.uint64, len(self.words) - 1).view(np.int64)


def bucket_words(table: pa.Table) -> pa.Table:
    own = Bucket.of(table)
    n = len(own.words) - 1
    return pa.table({
        "word": pa.array(own.hashes(), pa.int64()),
        "bucket": pa.array(np.full(n, table["bucket"][0].as_py()), pa.int64()),
        "here": pa.array(own.here[1:], pa.int64()),
        "ending": pa.array(np.fromiter(map(ending, own.words[1:]), np.int32, n), pa.int32()),
    })


def score_texts(docs: DataFrame, **options) -> DataFrame:
    """Base and tree scores of all texts, learned from those outside the held-out fold."""
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    held = id_bucket(F.col("doc_id"), FOLDS) == HELD_OUT_FOLD
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held.alias("held_out"))
    sizes = docs.agg(
        F.sum(F.octet_length("text")).alias("bytes"), F.count(F.when(~F.col("held_out"), 1)).alias("train")
    ).first()
    n_buckets = max(1, math.ceil((sizes["bytes"] or 0) / BUCKET_BYTES))
    bucketed = docs.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_buckets)))

    rows = bucketed.groupBy("bucket").applyInArrow(bucket_words, "word long, bucket long, here long, ending int")
    same = Window.partitionBy("word")
    rows = rows.withColumns({
        "all": F.sum("here").over(same),
        "first": F.col("bucket") == F.min("bucket").over(same),
    })
    counts, _ = stage_table(rows.filter("first or all <> here"), "lm_words")
    ends = int(sizes["train"])
    known = counts.filter("first").agg(F.sum("all").alias("n"), F.count(F.when(F.col("all") > 0, 1)).alias("v")).first()
    n_tokens = int(known["n"] or 0) + ends
    norm = float(n_tokens + int(known["v"]) + (ends > 0) + 1)

    alphabet = choose_symbols(counts, n_tokens, ends, options.get("min_share"))
    tree = learn_tree(docs.filter("not held_out"), alphabet, **options)
    shared = spark.sparkContext.broadcast((tree, alphabet))

    def score(texts: pa.Table, returned: pa.Table) -> pa.Table:
        tree, alphabet = shared.value
        own = Bucket.of(texts)
        hashes, count = own.hashes(), own.here.astype(np.float64)
        count[0] = ends
        word, total = returned["word"].to_numpy(), returned["all"].to_numpy()
        if len(word):
            order = np.argsort(word, kind="stable")
            at = np.minimum(np.searchsorted(word, hashes, sorter=order), len(word) - 1)
            elsewhere = word[order[at]] == hashes
            count[1:][elsewhere] = total[order[at[elsewhere]]]
        symbol = np.fromiter(map(alphabet.__getitem__, own.words), np.int64, len(own.words))
        base_log = np.log10((count + 1) / norm)
        share_log = alphabet.log_share(symbol, count)
        n, n_known, base, scores = [], [], [], []
        for token in own.parts:
            closed = np.flatnonzero(token == 0)
            begins = np.concatenate(([0], closed[:-1] + 1))
            n.append(closed - begins + 1)
            n_known.append(np.add.reduceat((count[token] > 0).astype(np.int64), begins))
            base.append(np.add.reduceat(base_log[token], begins))
            scores.append(np.add.reduceat(tree.log_probs(symbol[token]) + share_log[token], begins))
        return pa.table({
            "doc_id": texts["doc_id"], "held_out": texts["held_out"],
            "n_tokens": pa.array(np.concatenate(n), pa.int64()),
            "n_known": pa.array(np.concatenate(n_known), pa.int64()),
            "train_tokens": pa.array([n_tokens] * texts.num_rows, pa.int64()),
            "base_score": pa.array(np.concatenate(base), pa.float64()),
            "score": pa.array(np.concatenate(scores), pa.float64()),
        })

    elsewhere = counts.filter(F.col("all") != F.col("here")).select("bucket", "word", "all")
    return (
        bucketed.groupBy("bucket")
        .cogroup(elsewhere.groupBy("bucket"))
        .applyInArrow(
            score,
            f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )
