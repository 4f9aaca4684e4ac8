"""Near-duplicates by order MinHash, verified by banded alignment.

Items are shingles of ``ITEM`` words, each labelled with its occurrence number
in the text. One sketch keeps the ``PICKED`` items of smallest hash and hashes
them in text order, so two texts agree in a sketch if the same items come
first by hash and stand in the same order. Single words suit the threshold: an
edit takes one of them, but up to five shingles of five words. Texts of up to
``SHORT`` words have further sketches of ``SHORT_PICKED`` items. A text of
fewer items than that takes all it has.

Equal texts (in words, A-Z lower-cased) are one node from the start. Nodes
that share a sketch value are first paired with two of their bucket (smallest
and largest id, the same two in most buckets of a large group), so that a bucket
with a third of all texts makes two rows a text. A pair is aligned: its edit
distance in words, within the band that the threshold allows, must leave a
similarity of ``SIMILARITY`` or more. Every node's best pair comes first, then
its best among those that still lead to another component, and so on, so that
a large group of copies takes about a row a text and round. Buckets whose nodes
are not one component by then are paired again: with new hubs per band of
lengths while their open pairs are many and the hubs join some, then each node
with every other of another component, of which the join itself keeps those
whose words can overlap enough (a bound from bit signatures that loses none).
So no pair of a bucket stays untried unless its nodes are linked already.
Classes are the connected components of the links.

Cases: all texts without a word (null, empty, blank) are one class; repeated
rows are one document; a null id has null as class if it is alone; ties go
to the smallest id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.text import LOWER_ASCII, fresh, remembered
from strata.session import stage_table

SHINGLE = 5
SIMILARITY = 0.8
ITEM = 1
#: Two texts at the threshold agree in a sketch with a probability of about 0.07.
SKETCHES = 40
PICKED = 6
#: Short texts have few items, all of which six picks could touch.
SHORT = 24
SHORT_SKETCHES = 16
SHORT_PICKED = 3
#: Long integers of a signature: 8,192 bits, one set for every item.
SIGNATURE = 128
#: Words whose hashes a worker process keeps before its memory starts afresh.
MEMO_WORDS = 200_000
#: Open pairs a row of the open buckets from which new hubs are tried before all pairs are.
MANY_PAIRS = 8
#: A round that joins fewer than one in so many of its pairs or rows is the last of its kind.
FEW_JOINED = 10
#: Links that a task joins by itself; what more of them leave goes through rounds of joins.
LINKS_A_TASK = 200_000
#: Most bytes of ids that are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20

_RNG = np.random.default_rng(20_240_501)
MULTIPLIERS = _RNG.integers(1, 1 << 63, SKETCHES + SHORT_SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _RNG.integers(0, 1 << 63, SKETCHES + SHORT_SKETCHES, dtype=np.uint64)
GOLD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(32))) * GOLD
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """Word -> 64-bit hash, kept for the words that this process has met."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def word_hashes() -> WordHashes:
    return remembered("near_dedup", WordHashes)


def words_in(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LOWER_ASCII).split()


def labelled_shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all shingles of so many words, the k-th occurrence of one marked k."""
    n = max(1, len(words) - size + 1)
    width = min(size, len(words))
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = mixed(h + words[k : k + n])
    order = np.argsort(h, kind="stable")
    same = np.concatenate(([False], h[order][1:] == h[order][:-1]))
    if same.any():
        at = np.arange(n)
        begins = np.where(same, 0, at)
        label = np.empty(n, np.uint64)
        label[order] = (at - np.maximum.accumulate(begins)).astype(np.uint64)
        h = mixed(h + label * GOLD)
    return h


def sketch(words: np.ndarray) -> np.ndarray:
    """Order MinHash values of a text given as word hashes; a short text has ``SHORT_SKETCHES`` more."""
    items = labelled_shingles(words, ITEM)
    values = _sketch(items, PICKED, np.arange(SKETCHES))
    if len(words) > SHORT:
        return values
    return np.concatenate((values, _sketch(items, SHORT_PICKED, np.arange(SKETCHES, SKETCHES + SHORT_SKETCHES))))


def _sketch(items: np.ndarray, picks: int, numbers: np.ndarray) -> np.ndarray:
    ranks = mixed(items[None, :] * MULTIPLIERS[numbers, None] + SHIFTS[numbers, None])
    if len(items) > picks:
        picked = np.sort(np.argpartition(ranks, picks - 1, axis=1)[:, :picks], axis=1)
    else:
        picked = np.broadcast_to(np.arange(len(items)), (len(numbers), len(items)))
    out = numbers.astype(np.uint64)
    for k in range(picked.shape[1]):
        out = mixed(out + items[picked[:, k]])
    return out


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Word edits between two texts, or ``most`` + 1 where there are more.

    Only the band of ``most`` diagonals on each side of the main one can hold
    a path of so few edits. A column of the band is held as two bit vectors,
    of the places where the distance rises and where it falls from one row to
    the next, so that a word of ``b`` costs a few operations on whole numbers
    of ``2 * most + 1`` bits.
    """
    run = min(len(a), len(b))
    differs = np.flatnonzero(a[:run] != b[:run])
    cut = int(differs[0]) if len(differs) else run
    a, b = a[cut:], b[cut:]
    run = min(len(a), len(b))
    differs = np.flatnonzero(a[len(a) - run :][::-1] != b[len(b) - run :][::-1])
    cut = int(differs[0]) if len(differs) else run
    a, b = a[: len(a) - cut], b[: len(b) - cut]
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    if not n or not m:
        return max(n, m)
    return _band_distance(a.tolist(), b.tolist(), min(most, max(n, m)), most)


def _band_distance(a: list[int], b: list[int], reach: int, most: int) -> int:
    """The distance, column by column: bit k of a column j stands for row j - reach + k.

    As the band goes down by a row with each column, a column's rises and
    falls are stored as the next column sees them, one bit lower.
    """
    n, m = len(a), len(b)
    places: dict[int, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    band = (1 << 2 * reach + 1) - 1
    top = 1 << 2 * reach
    rises = band & ~((1 << reach) - 1)  # column 0: one more in every row from 1 on
    falls = 0
    distance = min(n, reach)  # at the band's lowest row, later at row n
    at_end = m - max(0, n - reach)  # columns in which row n lies in the band
    for j in range(1, m + 1):
        shift = j - reach - 1
        found = places.get(b[j - 1], 0)
        same = (found >> shift if shift >= 0 else found << -shift) & band
        level = ((((same & rises) + rises) ^ rises) | same | falls) & band  # equal to the cell up left
        more = falls | band & ~(level | rises)
        less = level & rises
        if j + reach <= n:
            if not level & top:
                distance += 1
        else:
            row = n - j + reach
            distance += (more >> row & 1) - (less >> row & 1)
        if distance - min(at_end, m - j) > most:
            return most + 1
        lower = level >> 1
        rises = less | band & ~(lower | more)
        falls = lower & more
    return min(distance, most + 1)


def most_edits(n: int, m: int, similarity: float) -> int:
    """Edits that leave 1 - edits / longer length at the threshold or above."""
    return int((1.0 - similarity) * max(n, m) + 1e-9)


def is_similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    most = most_edits(len(a), len(b), similarity)
    if abs(len(a) - len(b)) > most:
        return False
    # Words that one text has more often than the other can't be aligned.
    values, where = np.unique(np.concatenate((a, b)), return_inverse=True)
    na = np.bincount(where[: len(a)], minlength=len(values))
    nb = np.bincount(where[len(a) :], minlength=len(values))
    if max(len(a), len(b)) - int(np.minimum(na, nb).sum()) > most:
        return False
    return edit_distance(a, b, most) <= most


def text_key(text: bytes | None) -> bytes:
    """Digest of a text's words, equal for equal texts only."""
    return xxhash.xxh3_128_digest(b" ".join(words_in(text)))


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_words, values) of every document; a text without a word has no sketch values."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                keys, sizes, values = [], [], []
                for text in part.column(1).cast(pa.binary()).to_pylist():
                    words = words_in(text)
                    keys.append(xxhash.xxh3_128_digest(b" ".join(words)))
                    sizes.append(len(words))
                    hashes = np.array([known[w] for w in words], np.uint64)
                    values.append(sketch(hashes).view(np.int64) if words else [])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()),
                     pa.array(values, pa.list_(pa.int64()))],
                    names=["doc_id", "text_key", "n_words", "values"],
                )

    schema = f"doc_id {id_type}, text_key binary, n_words int, values array<long>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def lengths_allow(n: Column, m: Column, similarity: float) -> Column:
    """Whether texts of so many words can reach the similarity at all."""
    longer = F.greatest(n, m)
    return longer - F.least(n, m) <= F.floor(longer * F.lit(1.0 - similarity) + F.lit(1e-9))


def ordered_pairs(met: DataFrame, similarity: float) -> DataFrame:
    """(left, right, agreeing) of rows (node, n_words, other, other_words) whose lengths allow the similarity.

    Each pair comes once, with the number of its rows.
    """
    return (
        met.filter((F.col("node") != F.col("other")) & lengths_allow(F.col("n_words"), F.col("other_words"), similarity))
        .groupBy(F.least("node", "other").alias("left"), F.greatest("node", "other").alias("right"))
        .agg(F.count(F.lit(1)).alias("agreeing"))
    )


def candidate_pairs(sketched: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(left, right, agreeing): nodes with the smallest and the largest node of each of their buckets.

    A large group has the same two nodes in most of its buckets, so that a
    node of it has few pairs, not one or more for every sketch.
    """
    rows = sketched.select("node", "n_words", F.posexplode("values").alias("k", "value"))
    one = F.struct("node", "n_words")
    partners = rows.groupBy("k", "value").agg(F.min(one).alias("low"), F.max(one).alias("high")).filter("low.node < high.node")
    met = rows.join(partners, ["k", "value"]).select("node", "n_words", F.explode(F.array("low", "high")).alias("o"))
    return ordered_pairs(met.select("node", "n_words", F.col("o.node").alias("other"), F.col("o.n_words").alias("other_words")), similarity)


def open_rows(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows (node, n_words, k, value) of buckets with several components, and each node's ``root``."""
    named = rows.select("node", "n_words", "k", "value").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    several = named.groupBy("k", "value").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return named.join(several.filter("low < high").select("k", "value"), ["k", "value"])


def open_pair_count(rows: DataFrame) -> int:
    """Pairs of different components in the buckets, one that shares several buckets counted in each."""
    sizes = rows.groupBy("k", "value", "root").agg(F.count(F.lit(1)).cast("double").alias("n"))
    sizes = sizes.groupBy("k", "value").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"))
    return int(sizes.agg(F.sum((F.col("n") * F.col("n") - F.col("own")) / 2)).first()[0] or 0)


def band_hub_pairs(rows: DataFrame, signed: DataFrame, turn: int, similarity: float = SIMILARITY) -> DataFrame:
    """(left, right, agreeing): open nodes with one hub of their own and of the next band of lengths in each bucket.

    Lengths that allow the similarity lie in the same or in neighbouring bands.
    Pairs whose signatures don't allow it are left out.
    """
    band = F.floor(F.log("n_words") / F.lit(-np.log(similarity))).cast("int") if similarity < 1 else F.col("n_words")
    rows = rows.withColumn("band", band)
    hubs = rows.groupBy("k", "value", "band").agg(
        F.min_by(F.struct("node", "n_words", "root"), F.xxhash64("node", "k", F.lit(turn))).alias("o")
    )
    near = rows.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") + 1)))
    met = near.join(hubs, ["k", "value", "band"]).filter("root <> o.root")
    met = met.select("node", "n_words", F.col("o.node").alias("other"), F.col("o.n_words").alias("other_words"))
    pairs, sizes = ordered_pairs(met, similarity), rows.select("node", "n_words").distinct().join(signed, "node")
    one = sizes.select(F.col("node").alias("left"), F.col("n_words").alias("n"), F.col("bits").alias("a"), F.col("n_bits").alias("a_bits"))
    two = sizes.select(F.col("node").alias("right"), F.col("n_words").alias("m"), F.col("bits").alias("b"), F.col("n_bits").alias("b_bits"))
    return pairs.join(one, "left").join(two, "right").filter(words_allow(similarity)).select("left", "right", "agreeing")


def signatures(texts: DataFrame) -> DataFrame:
    """(node, bits, n_bits): a bit for every labelled word of the nodes' texts, and how many bits are set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                bits = []
                for text in part.column(1).cast(pa.binary()).to_pylist():
                    items = labelled_shingles(np.array([known[w] for w in words_in(text)], np.uint64), ITEM)
                    one = np.zeros(64 * SIGNATURE, np.bool_)
                    one[items % np.uint64(64 * SIGNATURE)] = True
                    bits.append(one)
                longs = [np.packbits(one).view(np.int64) for one in bits]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(longs, pa.list_(pa.int64())), pa.array([int(one.sum()) for one in bits], pa.int32())],
                    names=["node", "bits", "n_bits"],
                )

    return texts.select("node", "text").mapInArrow(run, "node long, bits array<long>, n_bits int")


def words_allow(similarity: float) -> Column:
    """Whether texts of n and m words and signatures a and b can reach the similarity.

    Words in common set common bits; those that share a bit with another are
    at most the words less the bits of either text.
    """
    bits = F.aggregate(F.zip_with("a", "b", lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda sum, x: sum + x)
    common = bits + F.least(F.col("n") - F.col("a_bits"), F.col("m") - F.col("b_bits"))
    longer = F.greatest("n", "m")
    return longer - common <= F.floor(longer * F.lit(1.0 - similarity) + F.lit(1e-9))


def remaining_pairs(rows: DataFrame, signed: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(left, right): all pairs of different components that share a bucket and can reach the similarity.

    Lengths and signatures are compared where the rows of a bucket meet, so
    that pairs that can't be links never leave the join. A pair of several
    common buckets leaves the one of smallest value only.
    """
    mine = rows.groupBy("node").agg(F.collect_set("value").alias("mine"))
    rows = rows.join(signed.join(mine, "node"), "node")
    one = rows.select("k", "value", F.col("node").alias("left"), F.col("root").alias("r"), F.col("n_words").alias("n"),
                      F.col("bits").alias("a"), F.col("n_bits").alias("a_bits"), F.col("mine").alias("x"))
    two = rows.select("k", "value", F.col("node").alias("right"), F.col("root").alias("s"), F.col("n_words").alias("m"),
                      F.col("bits").alias("b"), F.col("n_bits").alias("b_bits"), F.col("mine").alias("y"))
    fits = (
        (one["k"] == two["k"]) & (one["value"] == two["value"]) & (F.col("left") < F.col("right"))
        & (F.col("r") != F.col("s")) & lengths_allow(F.col("n"), F.col("m"), similarity)
        & (F.array_min(F.array_intersect("x", "y")) == one["value"]) & words_allow(similarity)
    )
    return one.join(two, fits).select("left", "right").distinct()


def best_pairs(pairs: DataFrame) -> DataFrame:
    """For every node its pair of most agreement; ties go to the smallest partner."""
    ends = pairs.select("agreeing", F.explode(F.array(F.struct(F.col("left").alias("node"), F.col("right").alias("other")),
                                                      F.struct(F.col("right").alias("node"), F.col("left").alias("other")))
                                             ).alias("e")).select("agreeing", "e.*")
    best = ends.groupBy("node").agg(F.min_by("other", F.struct(-F.col("agreeing"), F.col("other"))).alias("other"))
    return best.select(F.least("node", "other").alias("left"), F.greatest("node", "other").alias("right")).distinct()


def ends(pairs: DataFrame) -> DataFrame:
    """(node) of every node in the pairs."""
    return pairs.select(F.explode(F.array("left", "right")).alias("node")).distinct()


def texts_of(docs: DataFrame, needed: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the needed nodes, from each node's document."""
    needed = nodes.join(needed, "node").select(F.col("doc_id").alias("_id"), "node", "text_key")
    needed, _ = stage_table(needed, "near_needed")
    small = needed.count() * 64 <= BROADCAST_BYTES
    found = docs.select("doc_id", "text").join(F.broadcast(needed) if small else needed, F.col("doc_id") == F.col("_id"))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()
            same = [text_key(t) == k for t, k in zip(texts, keys, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(same, pa.bool_()))

    # An id may stand before several texts; only that of the node counts, once.
    found = found.select("node", "text", "text_key").mapInArrow(own, "node long, text string")
    used, _ = stage_table(found.dropDuplicates(["node"]), "near_texts")
    return used


def verified_links(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs whose texts align to at least the threshold."""
    small = pairs.count() * 64 <= BROADCAST_BYTES
    one = texts.select(F.col("node").alias("left"), F.col("text").alias("a"))
    two = texts.select(F.col("node").alias("right"), F.col("text").alias("b"))
    both = one.join(F.broadcast(pairs) if small else pairs, "left").join(two, "right")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_hashes()
        read = lambda t: np.array([known[w] for w in words_in(t)], np.uint64)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                one = part.column(2).cast(pa.binary()).to_pylist()
                two = part.column(3).cast(pa.binary()).to_pylist()
                same = [is_similar(read(a), read(b), similarity) for a, b in zip(one, two, strict=True)]
                yield part.select([0, 1]).filter(pa.array(same, pa.bool_()))

    return both.select("left", "right", "a", "b").mapInArrow(align, "left long, right long")


class Forest(dict):
    """Node -> a smaller node of its component, or itself, for the links met so far."""

    def root(self, node: int) -> int:
        up = self.setdefault(node, node)
        while up != node:
            top = self[node] = self[up]
            node, up = up, top
        return node

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)

    def links(self) -> pa.RecordBatch:
        """A link (left, right) from its component's smallest node to every other node."""
        found = [(self.root(node), node) for node in self]
        found = [(root, node) for root, node in found if root != node]
        left, right = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["left", "right"])


def fewer_links(links: DataFrame, tasks: int) -> DataFrame:
    """(left, right): links of the same components, at most one a node for every ``LINKS_A_TASK`` read.

    A task holds so many links at a time, whatever its share of them is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                forest.link(a, b)
                if len(forest) > 2 * LINKS_A_TASK:
                    yield forest.links()
                    forest.clear()
        yield forest.links()

    return links.select("left", "right").coalesce(tasks).mapInArrow(run, "left long, right long")


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of every linked node's component.

    Each task first joins the links of its part, ``LINKS_A_TASK`` at a time;
    links that are one such part are done by then. The others alternate
    between hanging larger and smaller neighbours on a node's smallest one.
    Links only ever get fewer or point further down, and a hub keeps one row
    per neighbour, so rounds are few and rows never more.
    """
    tasks = max(1, -(-links.count() // LINKS_A_TASK))
    links, _ = stage_table(fewer_links(links, tasks), "near_fewer")
    if tasks == 1:
        return links.select(F.col("right").alias("node"), F.col("left").alias("root"))
    edges = links.select(F.col("right").alias("node"), F.col("left").alias("near")).distinct()
    edges, _ = stage_table(edges, "near_edges")
    while True:
        both = edges.unionByName(edges.select(F.col("near").alias("node"), F.col("node").alias("near")))
        least = both.groupBy("node").agg(F.min("near").alias("low"))
        least = least.select("node", F.least("node", "low").alias("low"))
        large = both.filter("near > node").join(least, "node").select(F.col("near").alias("node"), F.col("low").alias("near"))
        large = large.filter("node <> near").distinct()
        low = large.groupBy("node").agg(F.min("near").alias("low"))
        joined = large.join(low, "node")
        small = (
            joined.filter("near <> low").select(F.col("near").alias("node"), F.col("low").alias("near"))
            .unionByName(joined.select("node", F.col("low").alias("near")))
            .filter("node <> near")
            .distinct()
        )
        new, _ = stage_table(small, "near_edges")
        if new.count() == edges.count() and new.exceptAll(edges).isEmpty():
            return new.select("node", F.col("near").alias("root"))
        edges = new


def joined_roots(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components (node, root) that further links leave of those known."""
    if roots is None:
        return components(links)
    if links.isEmpty():
        return roots
    return components(links.unionByName(roots.select(F.col("root").alias("left"), F.col("node").alias("right"))))


def between_components(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    left = roots.withColumnsRenamed({"node": "left", "root": "left_root"})
    right = roots.withColumnsRenamed({"node": "right", "root": "right_root"})
    named = pairs.join(left, "left", "left").join(right, "right", "left")
    return named.filter(F.coalesce("left_root", "left") != F.coalesce("right_root", "right")).select(*pairs.columns)


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id): the smallest document id of every document's class of near-duplicates.

    Each node's best pair is aligned first, round by round. What is linked by
    then has one class whatever its other pairs say, so that only pairs
    between different components are aligned after that; at last all of these
    that share a bucket.
    """
    described, _ = stage_table(describe(docs), "near_described")
    nodes = described.groupBy("text_key").agg(
        F.min("doc_id").alias("doc_id"), F.any_value("n_words").alias("n_words"), F.any_value("values").alias("values")
    )
    nodes, _ = stage_table(nodes.withColumn("node", F.monotonically_increasing_id()), "near_nodes")
    sketched = nodes.filter(F.col("doc_id").isNotNull()).select("node", "n_words", "values")
    pairs, _ = stage_table(candidate_pairs(sketched, similarity), "near_pairs")
    named = nodes.select("node", "doc_id", "text_key")
    tried = pairs.select("left", "right")

    roots, texts, last = None, None, False
    while True:
        one, _ = stage_table(pairs.select("left", "right") if last else best_pairs(pairs), "near_tried")
        if texts is None:  # every node has a best pair, so that later rounds need no others
            texts = texts_of(docs, ends(one), named)
        more, _ = stage_table(verified_links(one, texts, similarity), "near_links")
        roots = joined_roots(roots, more)
        if last:
            break
        last = more.count() * FEW_JOINED <= one.count()
        pairs, _ = stage_table(between_components(pairs.join(one, ["left", "right"], "left_anti"), roots), "near_pairs")

    rows = sketched.select("node", "n_words", F.posexplode("values").alias("k", "value"))
    rows, _ = stage_table(open_rows(rows, roots), "near_open_rows")
    texts = texts_of(docs, rows.select("node").distinct(), named)
    signed, _ = stage_table(signatures(texts), "near_signed")
    turn = 0
    while True:
        hubs = turn >= 0 and open_pair_count(rows) > MANY_PAIRS * rows.count()
        found = band_hub_pairs(rows, signed, turn, similarity) if hubs else remaining_pairs(rows, signed, similarity)
        one, _ = stage_table(found.select("left", "right").join(tried, ["left", "right"], "left_anti"), "near_tried")
        more, _ = stage_table(verified_links(one, texts, similarity), "near_links")
        roots = joined_roots(roots, more)
        if not hubs:
            break
        tried = tried.unionByName(one)
        turn = turn + 1 if more.count() * FEW_JOINED > one.count() else -1
        rows, _ = stage_table(open_rows(rows, roots), "near_open_rows")

    root_of = named.join(roots, "node", "left").select("text_key", "doc_id", F.coalesce("root", "node").alias("root"))
    smallest = root_of.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    classes = root_of.join(smallest, "root").select("text_key", "class_id")
    return described.select("doc_id", "text_key").join(classes, "text_key").select("doc_id", "class_id")


def drop_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of every class, that of the smallest id; documents without an id stay.

    An id that stands on several rows is one document and keeps one of them.
    """
    columns = docs.columns
    classes, _ = stage_table(near_classes(docs, similarity), "near_classes")
    stays = classes.select(F.col("class_id").alias("doc_id")).distinct()
    dropped = classes.filter("doc_id <> class_id").select("doc_id").distinct().join(stays, "doc_id", "left_anti")
    again = classes.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    id_name, mark = fresh(columns, "_id", "_dropped")
    marks = dropped.select(F.col("doc_id").alias(id_name), F.lit(True).alias(mark)).unionByName(
        again.join(dropped, "doc_id", "left_anti").select(F.col("doc_id").alias(id_name), F.lit(False).alias(mark))
    )
    marks, _ = stage_table(marks, "near_marks")
    small = marks.count() * 64 <= BROADCAST_BYTES
    marked = docs.join(F.broadcast(marks) if small else marks, F.col("doc_id") == F.col(id_name), "left")
    single = marked.filter(F.col(mark).isNull()).select(*columns)
    repeated = marked.filter(~F.col(mark)).select(*columns)
    return single.unionByName(repeated.dropDuplicates(["doc_id"]))
