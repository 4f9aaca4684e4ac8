"""Benchmark decontamination: SimHash of item-sized windows, then weighted shingles.

Texts are compared as lower-cased words of letters, digits and non-ASCII
characters. A window that shares no 5-word shingle with any item has
similarity 0 to all of them, so windows are taken where a document holds a
shingle of an item: as long as the item, and placed as the shingle stands in
it. An item of fewer words is one shingle of its own length, looked for at
every place of the documents. Windows of equal words are one from then on.

A window's fingerprint is the 64-bit SimHash of its words. Fingerprints are
cut into four blocks of 16 bits, and each item is indexed, among items of its
length, under every block value that differs in up to three bits. Whatever is
within 15 bits differs in at most three in one of the blocks, so that an
equality join finds all windows within the radius. What it finds is verified
by the weighted Jaccard similarity of the shingle sets, a shingle weighing as
many letters as it has; ``SIMILARITY`` or more is a match.

DataFrame operations only. Cases: a null or empty text or item matches
nothing; an item of under five words matches where its words stand; in
a document shorter than the item the window is the document; repeated rows of
a document count once; ties go to the first place; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.text import fresh
from strata.session import stage_table

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS = 4, 16
#: Bits in which one block may differ; a fingerprint may in BLOCKS times one more, less one.
BLOCK_RADIUS = 3
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Most bytes of shingles or document keys that are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def words_of(text: Column) -> Column:
    """Words without ASCII marks, in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-/:-`{-\x7f]+"), "")


def shingle_hashes(words: Column) -> Column:
    """Hash of the shingle at each place; fewer words than a shingle are one."""
    at = lambda i, k: F.get(words, i + k)
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, *[at(i, k) for k in range(1, SHINGLE)]))
    starts = F.when(F.size(words) > 0, F.greatest(F.size(words) - (SHINGLE - 1), F.lit(1))).otherwise(0)
    return F.slice(hashes, F.lit(1), starts)


def short_hashes(words: Column, n: int) -> Column:
    """Hash of the ``n`` words at each place, equal to the one shingle of a text of these words."""
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, n)]))
    return F.slice(hashes, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0)))


def weighted_shingles(words: Column) -> Column:
    """Distinct shingles of a text as (hash, letters)."""
    at = lambda i, k: F.coalesce(F.length(F.get(words, i + k)), F.lit(0))
    letters = F.transform(
        words, lambda w, i: F.length(w) + at(i, 1) + at(i, 2) + at(i, 3) + at(i, 4)
    )
    hashes = shingle_hashes(words)
    pairs = F.arrays_zip(hashes.alias("h"), F.slice(letters, F.lit(1), F.size(hashes)).alias("w"))
    return F.array_distinct(pairs)


def simhash(words: Column) -> Column:
    """64-bit SimHash: a bit is set where more than half of the words' hashes have it."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    with_bit = lambda b: F.aggregate(
        hashes, F.lit(0), lambda a, h: a + F.call_function("shiftright", h, b).bitwiseAND(1).cast("int")
    )
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(63)),
        F.lit(0).cast("long"),
        lambda a, b: F.when(
            2 * with_bit(b) > F.size(hashes), a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))
        ).otherwise(a),
    )


def block_values(fingerprint: Column) -> Column:
    """The fingerprint's blocks as (block, value)."""
    low = (1 << BLOCK_BITS) - 1
    return F.array(*[
        F.struct(
            F.lit(k).alias("block"),
            F.call_function("shiftright", fingerprint, F.lit(k * BLOCK_BITS)).bitwiseAND(low).cast("int").alias("value"),
        )
        for k in range(BLOCKS)
    ])


def prepared_items(benchmark: DataFrame) -> DataFrame:
    """(item_no, item_id, n, hashes, shingles, fingerprint) of every item that has a word."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    items = items.dropDuplicates().withColumn("item_no", F.monotonically_increasing_id())
    return items.select(
        "item_no", "item_id", F.size("words").alias("n"), shingle_hashes(F.col("words")).alias("hashes"),
        weighted_shingles(F.col("words")).alias("shingles"), simhash(F.col("words")).alias("fingerprint"),
    )


def item_index(items: DataFrame) -> DataFrame:
    """Items under every block value within the block radius: (n, block, value, item_no, item_print)."""
    masks = F.filter(
        F.sequence(F.lit(0), F.lit((1 << BLOCK_BITS) - 1)), lambda x: F.bit_count(x) <= BLOCK_RADIUS
    )
    rows = items.select("item_no", "n", F.col("fingerprint").alias("item_print"),
                        F.explode(block_values(F.col("fingerprint"))).alias("b"))
    rows = rows.select("item_no", "n", "item_print", "b.block", "b.value", F.explode(masks).alias("mask"))
    return rows.select("item_no", "n", "item_print", "block", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))


def row_key() -> Column:
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def item_windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(key, doc_id, start, n, content): item-sized windows at the shingles shared with an item."""
    anchors = items.select("n", F.posexplode("hashes").alias("offset", "hash")).distinct()
    anchors, _ = stage_table(anchors, "leak_anchors")
    small = anchors.count() * 128 <= BROADCAST_BYTES
    places = docs.select("key", F.posexplode(shingle_hashes(F.col("words"))).alias("pos", "hash"))
    short = [r["n"] for r in items.filter(F.col("n") < SHINGLE).select("n").distinct().collect()]  # of 1 to 4
    for length in sorted(short):
        at = F.posexplode(short_hashes(F.col("words"), length)).alias("pos", "hash")
        places = places.unionByName(docs.select("key", at))
    hits = places.join(F.broadcast(anchors) if small else anchors, "hash").select(
        "key", F.greatest(F.col("pos") - F.col("offset"), F.lit(0)).alias("start"), "n"
    )
    found = hits.distinct().groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("windows"))
    found, _ = stage_table(found.withColumnRenamed("key", "_key"), "leak_places")
    held = found.agg(F.sum(F.size("windows") * 48 + 128)).first()[0] or 0
    few = held <= BROADCAST_BYTES
    placed = docs.join(F.broadcast(found) if few else found, F.col("key") == F.col("_key"))
    rows = placed.select("key", "doc_id", "words", F.explode("windows").alias("w"))
    # A document shorter than the item, or ending within the window: the window moves left.
    start = F.greatest(F.least(F.col("w.start"), F.size("words") - F.col("w.n")), F.lit(0))
    content = F.array_join(F.slice("words", start + 1, F.col("w.n")), " ")
    return rows.select("key", "doc_id", start.alias("start"), F.col("w.n").alias("n"), content.alias("content")).distinct()


def similarity_of(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays of distinct (hash, letters)."""
    weight = lambda x: F.aggregate(x, F.lit(0), lambda s, y: s + y["w"])
    other = F.transform(b, lambda y: y["h"])
    common = weight(F.filter(a, lambda x: F.array_contains(other, x["h"])))
    return common / (weight(a) + weight(b) - common)


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, key, item_id, start, similarity): best window of every document for every item it leaks."""
    items, _ = stage_table(prepared_items(benchmark), "leak_items")
    keyed = docs.select("doc_id", "text").withColumn("key", row_key())
    keyed = keyed.select("doc_id", "key", words_of(F.col("text")).alias("words"))
    windows, _ = stage_table(item_windows(keyed, items), "leak_windows")

    distinct = windows.select("n", "content").distinct().withColumn("words", F.split("content", " "))
    prints = distinct.withColumn("fingerprint", simhash(F.col("words")))
    prints, _ = stage_table(prints, "leak_prints")
    probes = prints.select("n", "content", "fingerprint", F.explode(block_values(F.col("fingerprint"))).alias("b"))
    probes = probes.select("n", "content", "fingerprint", "b.block", "b.value")
    near = (
        # Hundreds of rows an item: the planner, which sees the items' size alone, must not broadcast them.
        probes.join(item_index(items).hint("merge"), ["n", "block", "value"])
        .filter(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select("n", "content", "item_no")
        .distinct()
    )
    checked = near.join(items.select("item_no", "item_id", "shingles"), "item_no").select(
        "n", "content", "item_id",
        similarity_of(F.col("shingles"), weighted_shingles(F.split("content", " "))).alias("similarity"),
    ).filter(F.col("similarity") >= similarity)
    matches = windows.join(checked, ["n", "content"])
    best = F.min(F.struct((-F.col("similarity")).alias("s"), F.col("start"))).alias("best")
    return matches.groupBy("doc_id", "key", "item_id").agg(best).select(
        "doc_id", "key", "item_id", F.col("best.start").alias("start"), (-F.col("best.s")).alias("similarity")
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    columns = docs.columns
    id_name, key, row = fresh(columns, "_id", "_key", "_row")
    leaks = find_leaks(docs, benchmark, similarity).select(F.col("doc_id").alias(id_name), F.col("key").alias(key))
    leaks, _ = stage_table(leaks.distinct(), "leak_documents")
    small = leaks.count() * 128 <= BROADCAST_BYTES
    same = (F.col(row) == F.col(key)) & F.col("doc_id").eqNullSafe(F.col(id_name))
    kept = docs.withColumn(row, row_key()).join(F.broadcast(leaks) if small else leaks, same, "left_anti")
    return kept.select(*columns)
